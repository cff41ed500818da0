"""Language identification: held-out accuracy, the models, odd rows."""

import zlib
from collections import Counter

import numpy as np

from innledger.llm import language
from innledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, code int, n string, own long"


def test_held_out_rows(spark):
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held_out]) > 0.995
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) < 0.02 * len(rows)


def test_symbols_of_each_text():
    from innledger.llm.common import byte_arrays
    import pyarrow as pa

    texts = ["Ab, c", "", None, "1 2", "é", "x\n\ny ", "İß𝒳 z", "  lead"]
    symbol, text, letters = language.symbols(*byte_arrays(pa.array(texts)))
    got = {}
    for s, t in zip(symbol.tolist(), text.tolist(), strict=True):
        got.setdefault(t, []).append(s)
    assert got[0] == [0, 97, 98, 0, 99, 0] and got[5] == [0, 120, 0, 121, 0]
    assert got[7] == [0, 108, 101, 97, 100, 0] and set(got) == {0, 4, 5, 6, 7}
    assert letters.tolist() == [3, 0, 0, 0, 1, 2, letters[6], 4]
    assert got[4] == [0, ord("é"), 0]


def plain_model(texts):
    """Interpolated Kneser-Ney by dictionaries: a function of three symbols."""
    three = Counter()
    for text in texts:
        line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        if line.strip():
            line = " " + line
            three.update(line[i : i + 3] for i in range(len(line) - 2))
    two = Counter(t[1:] for t in three)
    one = Counter(t[1:] for t in two)

    def discount(counts):
        once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.5

    def share(counts, gram, lower):
        of = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
        if not of:
            return lower
        d = discount(counts)
        return (max(counts[gram] - d, 0) if gram in counts else 0) / sum(of) + d * len(of) / sum(of) * lower

    def probability(gram, alphabet):
        lower = 1 / alphabet
        for counts in (one, two, three):
            order = {id(one): 1, id(two): 2, id(three): 3}[id(counts)]
            lower = share(counts, gram[-order:], lower)
        return lower

    return probability


CORPUS = {
    "en": ["The cat, and the dog!", "a wood; the  cat", "", "42", "that hat"],
    "de": ["Der Hund und die Katze", "über Öl im Wald", "das Öl"],
    "ru": ["кот и жук", "жук", "кит или кот"],
    "zh": ["漢字 漢語", "語言漢字"],
}


def corpus(spark):
    rows = [(4 * k + 1, t, lang) for k, (lang, t) in enumerate((g, t) for g, ts in CORPUS.items() for t in ts)]
    rows = [(i, t, lang) for i, t, lang in rows for i in [_teaching(i)]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def _teaching(i):
    """The next id from 1000 * i that is not held out."""
    return next(j for j in range(1000 * i, 1000 * i + 1000) if zlib.crc32(str(j).encode()) % 4 != 2)


def test_models_against_dictionaries(spark):
    """Seen and unseen trigrams, letters of other scripts, letters that no language has."""
    model = language.trained(corpus(spark))
    assert model.langs == ["de", "en", "ru", "zh"]
    letters = sorted({c for ts in CORPUS.values() for t in ts for c in t.lower() if c.isalpha()})
    rng = np.random.default_rng(5)
    grams = {"".join(rng.choice([" ", *letters, "ω", "𝒳"], 3)) for _ in range(600)}
    for texts in CORPUS.values():
        grams |= {t.lower()[i : i + 3] for t in texts for i in range(len(t) - 2)}
    grams = sorted(g for g in grams if all(c == " " or c.isalpha() for c in g))
    points = np.array([[0 if c == " " else ord(c) for c in g] for g in grams], np.int64)
    codes = points[:, 0] << 42 | points[:, 1] << 21 | points[:, 2]
    got = model.logs(codes)
    plain = [plain_model(CORPUS[lang]) for lang in model.langs]
    want = np.log([[p(g, len(letters) + 2) for p in plain] for g in grams])
    assert np.allclose(got, want, atol=1e-4)


def test_probabilities_add_up_to_one(spark):
    model = language.trained(corpus(spark))
    letters = sorted({ord(c) for ts in CORPUS.values() for t in ts for c in t.lower() if c.isalpha()})
    last = np.array([0, *letters, ord("ω")], np.int64)  # the last stands for all that none has
    for history in ("th", " k", "漢字", "ωω", " ω"):
        a, b = (0 if c == " " else ord(c) for c in history)
        assert np.allclose(np.exp(model.logs(a << 42 | b << 21 | last)).sum(0), 1, atol=1e-4)


def test_scripts_and_unseen_trigrams(spark):
    """Letters of one script are told apart, and lower orders decide where no trigram is known."""
    docs = spark.createDataFrame([(1, "語漢", "x"), (2, "жик", "x"), (3, "öü", "x")], "doc_id long, text string, lang string")
    got = language.identified(docs, language.trained(corpus(spark))).collect()
    assert [r.lang_pred for r in got] == ["zh", "ru", "de"]


def test_hashes_are_those_of_spark(spark):
    codes = np.random.default_rng(2).integers(0, 1 << 63, 500)
    df = spark.createDataFrame([(int(c),) for c in codes], "code long")
    want = [r[0] for r in df.select(language._hash("code", 3)).collect()]
    assert language.hashes(codes, 3).tolist() == want


def test_odd_rows(spark):
    teach = [(i, t, lang, 1, "n", 1) for i in range(40) for t, lang in [
        ("the cat and the dog went to the wood", "en"), ("der hund und die katze sind im wald", "de")
    ]]
    odd = [
        (1000, None, "en", None, None, None), (1001, "", "de", 1, "n", 1), (1002, "12 … ?!", None, 1, "n", 1),
        (None, "the dog", "fr", 1, "n", 1), (1003, "the dog and cat " * 50000, None, 1, "n", 1),
        (1004, "жук и кот", None, 1, "n", 1), (1005, "die katze", None, 1, "n", 1),
    ]
    docs = spark.createDataFrame(teach + odd, DOCS)
    model = language.trained(docs)
    assert model.langs == ["de", "en"]
    rows = language.identified(docs, model).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(teach) + len(odd) and got[1000].n is None
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(got[i].score == 0 and got[i].rejected for i in (1000, 1001, 1002))
    assert [got[i].lang_pred for i in (None, 1003, 1005)] == ["en", "en", "de"]
    assert got[1004].rejected and got[1004].lang_pred in ("de", "en") and not got[0].rejected


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    model = language.trained(docs)
    assert language.identified(docs, model).collect() == []
    one = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language.identified(one, language.trained(one)).first().lang_pred == "und"


def test_columns_of_the_same_names_are_replaced(spark):
    docs = spark.createDataFrame(
        [(1, "der Wald", "old", 7, "kept")], "doc_id long, text string, Lang_Pred string, score int, other string"
    )
    row = language.identified(docs, language.trained(corpus(spark))).first().asDict()
    assert set(row) == {"doc_id", "text", "other", "lang_pred", "score", "rejected"}
    assert row["lang_pred"] == "de" and row["other"] == "kept" and 0 < row["score"] <= 1

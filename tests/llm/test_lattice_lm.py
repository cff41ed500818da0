"""Likelihoods against plain counting and all segmentations written out."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from innledger.llm import lattice_lm
from innledger.llm.queries import QUERIES, SUBWORDS

SCHEMA = "doc_id long, text string, word string, c string, n int, base string"


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in text.translate({i: " " for i in range(9, 14)}).split(" ") if w]


def plain(rows):
    """What the contract says, row by row; rows are (text, whether it teaches)."""
    counts = Counter()
    for text, learns in rows:
        if learns:
            counts.update([*words(text), None])
    total = sum(counts.values())
    below = total + len(counts) + 1
    out = []
    for text, learns in rows:
        own = [*words(text), None]
        base = sum(math.log10((counts[w] + 1) / below) for w in own)
        out.append((not learns, len(own), sum(counts[w] > 0 for w in own), total, base))
    return out


def test_base_scores_of_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(lattice_lm, "FREQUENT", 500)
    sf = "/root/testdata/sf0.01"
    got = sorted(QUERIES["op10_lm_scoring"](spark, sf).collect())
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = plain([(r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in docs])
    assert [r.doc_id for r in got] == [r.doc_id for r in docs]
    for r, w in zip(got, want, strict=True):
        assert tuple(r)[1:5] == w[:4] and r.base_score == pytest.approx(w[4], rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    held_out = [r for r in got if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out) * 2


def all_cuts(text, lattice):
    """The probability of ``text`` by every segmentation."""
    if not text:
        return 1.0
    found = 0.0
    for n in range(1, min(len(text), lattice.longest) + 1):
        value = lattice.pieces.get(text[:n])
        if value is None and n == 1:
            value = sum(lattice.bytes[b] for b in text[0].encode())
        if value is not None:
            found += math.exp(value) * all_cuts(text[n:], lattice)
    return found


def test_words_are_summed_over_all_cuts():
    processor = SentencePieceProcessor(model_file=SUBWORDS)
    counts = Counter(i for w in ("the", "there", "other", "hers") * 5 for i in processor.encode(w))
    lattice = lattice_lm.Lattice(SUBWORDS, counts, 3)
    for word in ("there", "a", "otherhers", "ñandú", "𝒳y", "zzzz", ""):
        assert lattice.word(word) == pytest.approx(math.log(all_cuts("▁" + word, lattice)), abs=1e-9)
    total = sum(map(math.exp, [*lattice.pieces.values(), *lattice.bytes, lattice.end]))
    assert total == pytest.approx(1, abs=1e-9)
    assert math.isfinite(lattice.word("x" * 200_000))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lattice_lm, "FREQUENT", 2)
    texts = ["a b a", None, "", "A  new\tword", "a b a", "b " * 60_000, "x" * 3000, "é ▁ a"]
    rows = [(i, t, "w", "c", 1, "b") for i, t in enumerate(texts)] + [(2, "", None, None, None, None)]
    rows += [(None, "a", None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = lattice_lm.scored(docs, F.col("doc_id") != 3, SUBWORDS).collect()
    want = plain([(r[1], r[0] not in (3, None)) for r in rows])
    assert sorted(((r.doc_id is None, *tuple(r)[1:5], round(r.base_score, 6)) for r in got)) == sorted(
        (r[0] is None, *w[:4], round(w[4], 6)) for r, w in zip(rows, want, strict=True)
    )
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].score == by_id[4].score and by_id[1].score == by_id[2].score


def test_empty_and_unlearned_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert lattice_lm.scored(docs, F.lit(True), SUBWORDS).collect() == []
    one = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    row = lattice_lm.scored(one, F.lit(False), SUBWORDS).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)

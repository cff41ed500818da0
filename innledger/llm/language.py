"""Language identification by interpolated Kneser-Ney character models.

One model of three characters for each language. Texts are lower-cased; letters are told apart
by their code points, everything between letters is one space. Three code points of 21 bits
make the code of a trigram, so nothing is folded while counting.

Counts are made over all training texts and stay tables: discounts, histories and lower orders
are groupings and joins of them. A trigram's probability is interpolated, with absolute
discounts, from the next shorter history's, which counts in how many different contexts a
symbol was seen instead of how often. A trigram that a language never had goes back to the
language's own bigrams, these to its letters, and these to a share for letters it never had.

What predicts is sent to the executors: log-probabilities in arrays sorted by hash, for each
trigram, bigram and letter seen in any language. Hashes have 22 bits for trigrams and 20 for
bigrams, which bounds the arrays however large the corpus; where two meet in one hash, the one
seen more often stands. The language with the lowest cross-entropy per character wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from innledger.llm.common import byte_arrays, held_out, stored

#: Rows whose crc32(doc_id) modulo this is ``HELD_OUT_PART`` teach nothing.
FOLDS, HELD_OUT_PART = 4, 2
#: Bits of a code point, and of the hashes of trigrams, bigrams and letters.
POINT = 21
BITS = {3: 22, 2: 20, 1: 20}
#: Differences of cross-entropies, in nats a character, are multiplied by the number of
#: characters up to this before they become a probability.
EVIDENCE = 200
#: A text is rejected if its cross-entropy is so many standard deviations above the mean
#: of its language's training texts of like length.
REJECTED_BEYOND = 4.0
#: Bytes of text looked at together.
BLOCK = 2 << 20
UNDETERMINED = "und"


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(p).isalpha() for p in range(0x110000)])


def symbols(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, the text of each, and the number of letters of each text.

    A symbol is the code point of a letter, or 0. Every text with a letter begins and ends in a space, and spaces are never doubled.
    """
    # A line feed after each text: no byte of another character, and no letter.
    ends = starts[1:] + np.arange(len(starts) - 1)
    apart = np.insert(data, starts[1:], ord("\n"))
    lowered = apart.tobytes().decode("utf-8", "replace")
    # Lower-casing may add characters, so texts are found again by counting line feeds.
    own = apart == ord("\n")
    marks = np.zeros(int(own.sum()), bool)
    marks[np.searchsorted(np.flatnonzero(own), ends)] = True
    points = np.frombuffer(lowered.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_line = points == ord("\n")
    text = np.zeros(len(points), np.int64)
    text[np.flatnonzero(is_line)[marks]] = 1
    text = np.cumsum(text) - text
    symbol = np.where(_letters()[points], points, 0)
    letters = np.bincount(text, symbol > 0, len(starts) - 1).astype(np.int64)
    # One space before each text, and of the spaces in it the first of each run.
    first = np.ones(len(text), bool)
    first[1:] = text[1:] != text[:-1]
    space = symbol == 0
    follows = np.zeros(len(text), bool)
    follows[1:] = space[:-1]
    kept = (~space | ~(follows | first)) & (letters[text] > 0)
    at = np.flatnonzero(first & (letters[text] > 0))
    place = np.searchsorted(np.flatnonzero(kept), at)
    return (
        np.insert(symbol[kept], place, 0),
        np.insert(text[kept], place, text[at]),
        letters,
    )


def trigrams(symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the trigrams within texts, and the text of each. The space before a text
    counts as its first history; where it is the only one, it is doubled."""
    wide = symbol.astype(np.int64)
    code = np.empty(max(0, len(wide) - 1), np.int64)
    if len(code):
        before = np.concatenate([[0], wide[:-2]])
        before[np.flatnonzero(np.concatenate([[True], text[1:-1] != text[:-2]]))] = 0
        code = (before << 2 * POINT) | (wide[:-1] << POINT) | wide[1:]
    inside = text[1:] == text[:-1]
    return code[inside], text[1:][inside]


def _blocks(batch: pa.RecordBatch, place: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, starts = byte_arrays(batch.column(place))
    first = 0
    while first < len(starts) - 1:
        last = int(np.searchsorted(starts, starts[first] + BLOCK, "right")) - 1
        last = min(len(starts) - 1, max(first + 1, last))
        yield first, last, data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each language has each trigram in each block of texts."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for first, last, data, starts in _blocks(batch, 1):
            code, text = trigrams(*symbols(data, starts)[:2])
            own = langs[first:last]
            for lang in sorted(set(own)):
                used, n = np.unique(code[(own == lang)[text]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(n, pa.int64())],
                    names=["lang", "code", "n"],
                )


def _discounts(counts: DataFrame, n: str) -> DataFrame:
    """Each language's absolute discount, from how many counts are one and two."""
    once, twice = (F.count_if(F.col(n) == k).cast("double") for k in (1, 2))
    usual = once / F.nullif(once + 2 * twice, F.lit(0.0))
    return counts.groupBy("lang").agg(
        F.when((once > 0) & (twice > 0), usual).otherwise(0.5).alias("discount")
    )


def _interpolated(counts: DataFrame, n: str, history: str, lower: DataFrame, on: str):
    """The histories of ``counts`` with the share they leave (``left``), and ``counts`` with
    the probability ``p``, interpolated with that of the next shorter gram in ``lower``."""
    histories = (
        counts.groupBy("lang", history)
        .agg(F.sum(n).cast("double").alias("total"), F.count("*").alias("kinds"))
        .join(F.broadcast(_discounts(counts, n)), "lang")  # a row for each language
        .withColumn("left", F.col("discount") * F.col("kinds") / F.col("total"))
    )
    shorter = lower.select("lang", F.col("code").alias(on), F.col("p").alias("shorter"))
    p = (F.col(n) - F.col("discount")) / F.col("total") + F.col("left") * F.col("shorter")
    return histories, counts.join(histories, ["lang", history]).join(shorter, ["lang", on]).withColumn(
        "p", p
    )


def kneser_ney(counts: DataFrame) -> dict[str, DataFrame]:
    """Interpolated Kneser-Ney of ``counts`` (``lang``, ``code``, ``n``; a row each trigram).

    ``p3``, ``p2`` and ``p1`` hold the grams' probabilities; ``left3`` and ``left2`` the share
    that a history of two and of one symbol leaves to shorter ones; ``none`` the probability
    of a letter that the language never had. Letters of all languages, and one for those
    that none has, make up the alphabet.
    """
    low = (1 << POINT) - 1
    middle = F.shiftright("code", POINT)
    three = counts.select(
        "lang", "code", "n", middle.alias("ab"), F.col("code").bitwiseAND((1 << 2 * POINT) - 1).alias("bc")
    )
    two = three.groupBy("lang", F.col("bc").alias("code")).agg(F.count("*").alias("n"))
    two = two.select("lang", "code", "n", middle.alias("b"), F.col("code").bitwiseAND(low).alias("c"))
    one = two.groupBy("lang", F.col("c").alias("code")).agg(F.count("*").alias("n"))
    alphabet = one.agg(F.count_distinct("code") + 1).first()[0]
    none = (
        one.groupBy("lang")
        .agg(F.sum("n").cast("double").alias("total"), F.count("*").alias("kinds"))
        .join(_discounts(one, "n"), "lang")
        .withColumn("p", F.col("discount") * F.col("kinds") / F.col("total") / alphabet)
    )
    p1 = one.join(F.broadcast(none), "lang").select(
        "lang", "code", "n", ((F.col("n") - F.col("discount")) / F.col("total") + F.col("p")).alias("p")
    )
    left2, p2 = _interpolated(two, "n", "b", p1, "c")
    left3, p3 = _interpolated(three, "n", "ab", p2, "bc")
    return {
        "p3": p3.select("lang", "code", "n", "p"),
        "p2": p2.select("lang", "code", "n", "p"),
        "p1": p1,
        "left3": left3.select("lang", F.col("ab").alias("code"), F.col("total").alias("n"), F.col("left").alias("p")),
        "left2": left2.select("lang", F.col("b").alias("code"), F.col("total").alias("n"), F.col("left").alias("p")),
        "none": none.select("lang", F.lit(0).cast("long").alias("code"), F.lit(1).alias("n"), "p"),
    }


#: The primes of XXH64, fixed values.
_PRIMES = (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
)


def hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """The leading bits of XXH64 (seed 42) of each code, as Spark's ``xxhash64`` has it."""
    one, two, three, four, five = (np.uint64(p) for p in _PRIMES)

    def turned(x, by):
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    with np.errstate(over="ignore"):
        x = turned(codes.astype(np.int64).view(np.uint64) * two, 31) * one
        x ^= np.uint64(42) + five + np.uint64(8)
        x = turned(x, 27) * one + four
        x ^= x >> np.uint64(33)
        x *= two
        x ^= x >> np.uint64(29)
        x *= three
        x ^= x >> np.uint64(32)
    return (x >> np.uint64(64 - BITS[order])).astype(np.int32)


def _hash(code: str, order: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(code), 64 - BITS[order]).cast("int")


class _Array:
    """Logarithms of one kind of gram: a row for each hash, a column for each language."""

    def __init__(self, rows: DataFrame, order: int, langs: list[str]):
        """Collects at most ``2 ** BITS[order]`` rows a language."""
        # The gram that stands for a hash is the same one in all languages.
        slots = rows.groupBy(_hash("code", order).alias("slot"), "code").agg(F.sum("n").alias("n"))
        stands = slots.groupBy("slot").agg(F.max(F.struct("n", "code")).alias("most"))
        stands = stands.select("slot", F.col("most.code").alias("code"))
        found = rows.join(stands, "code").select("lang", "slot", "code", F.ln("p").alias("log")).toPandas()
        self.order = order
        self.hashes, first, at = np.unique(found["slot"].to_numpy(np.int32), return_index=True, return_inverse=True)
        self.codes = found["code"].to_numpy(np.int64)[first]
        self.logs = np.full((len(self.hashes), len(langs)), np.nan, np.float32)
        column = found["lang"].map({lang: k for k, lang in enumerate(langs)}).to_numpy(int)
        self.logs[at, column] = found["log"].to_numpy(float)

    def places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each code's hash stands, and whether it does."""
        own = hashes(codes, self.order)
        at = np.searchsorted(self.hashes, own)
        at[at == len(self.hashes)] = 0
        return at, (self.hashes[at] == own) if len(self.hashes) else np.zeros(len(codes), bool)

    def looked_up(self, codes: np.ndarray, otherwise) -> np.ndarray:
        """The logarithms of all languages; ``otherwise`` gives those of grams not held."""
        at, held = self.places(codes)
        out = np.empty((len(codes), self.logs.shape[1]), np.float32)
        out[held] = self.logs[at[held]]
        if not held.all():
            out[~held] = otherwise(codes[~held])
        return out

    def fill(self, otherwise) -> None:
        """Give languages that never had a gram the value ``otherwise`` gives."""
        self.logs = np.where(np.isnan(self.logs), otherwise(self.codes), self.logs)


class Models:
    """The models of all languages as sorted arrays, and the calibration of the rejection."""

    def __init__(self, langs: list[str], parts: dict[str, DataFrame], spread: np.ndarray):
        self.langs, self.spread = langs, spread
        array = {name: _Array(rows, int(name[-1]) - name.startswith("left"), langs)
                 for name, rows in parts.items() if name != "none"}
        none = {r["lang"]: r["p"] for r in parts["none"].select("lang", "p").collect()}
        self.none = np.log([none[lang] for lang in langs]).astype(np.float32)
        self.three, self.two, self.one = array["p3"], array["p2"], array["p1"]
        self.left3, self.left2 = array["left3"], array["left2"]
        for left in (self.left3, self.left2):
            left.fill(self._all)
        self.one.fill(self._no_letter)
        self.two.fill(self._of_one)
        self.three.fill(self._of_two)

    def _all(self, codes: np.ndarray) -> np.ndarray:
        """A history that was never seen leaves everything to the shorter one."""
        return np.zeros((len(codes), len(self.langs)), np.float32)

    def _no_letter(self, codes: np.ndarray) -> np.ndarray:
        return np.broadcast_to(self.none, (len(codes), len(self.langs)))

    def _of_one(self, codes: np.ndarray) -> np.ndarray:
        low = (1 << POINT) - 1
        return self.left2.looked_up(codes >> POINT, self._all) + self.one.looked_up(
            codes & low, self._no_letter
        )

    def _of_two(self, codes: np.ndarray) -> np.ndarray:
        low = (1 << 2 * POINT) - 1
        return self.left3.looked_up(codes >> POINT, self._all) + self.two.looked_up(
            codes & low, self._of_one
        )

    def logs(self, codes: np.ndarray) -> np.ndarray:
        """Log-probabilities of trigrams, a row each, a column for each language."""
        return self.three.looked_up(codes, self._of_two)


def trained(docs: DataFrame) -> Models:
    """The models of all languages, learned from ``text`` and ``lang`` of rows that are not held
    out and have a language.

    What reaches the driver, and from there the executors, is at most 2**22 trigrams and
    2**20 bigrams and letters each, with a number for each language.
    """
    learning = docs.filter(~held_out("doc_id", FOLDS, HELD_OUT_PART) & F.col("lang").isNotNull())
    counts = (
        learning.select("lang", "text")
        .mapInArrow(_counted, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    parts = kneser_ney(stored(counts, "trigrams"))
    parts |= {name: stored(parts[name], name) for name in ("p3", "p2", "p1")}
    # Mean and variance of a training character's surprise calibrate the rejection.
    log = F.ln("p")
    spread = (
        parts["p3"].groupBy("lang")
        .agg((F.sum(-log * F.col("n")) / F.sum("n")).alias("mean"),
             (F.sum(log * log * F.col("n")) / F.sum("n")).alias("square"))
        .orderBy("lang").collect()
    )
    found = sorted(spread, key=lambda r: r["lang"])
    return Models(
        [r["lang"] for r in found],
        parts,
        np.array([(r["mean"], max(0.0, r["square"] - r["mean"] ** 2) ** 0.5) for r in found]).reshape(-1, 2),
    )


def predictions(model: Models, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each text: number of its language (-1: none), score, whether it is rejected."""
    symbol, text, letters = symbols(data, starts)
    code, owner = trigrams(symbol, text)
    number = len(starts) - 1
    langs = len(model.langs)
    best, score = np.full(number, -1), np.zeros(number)
    rejected = np.ones(number, bool)
    if not langs:
        return best, score, rejected
    logs = model.logs(code)
    length = np.maximum(1, np.bincount(owner, minlength=number))
    entropy = np.empty((number, langs))
    for k in range(langs):
        entropy[:, k] = -np.bincount(owner, logs[:, k], number) / length
    lowest = entropy.min(1, keepdims=True)
    weight = np.exp(-(entropy - lowest) * np.minimum(length, EVIDENCE)[:, None])
    some = letters > 0
    best[some] = entropy.argmin(1)[some]
    score[some] = (1 / weight.sum(1))[some]
    mean, spread = model.spread[best].T
    limit = mean + REJECTED_BEYOND * spread / np.sqrt(np.minimum(length, EVIDENCE))
    rejected[some] = (lowest[:, 0] > limit)[some]
    return best, score, rejected


def identified(docs: DataFrame, model: Models) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` added.

    ``lang_pred`` is the language with the lowest cross-entropy per character, the first in
    the alphabet of equal ones; ``und`` if the text is null or has no letter, or if nothing
    was learned. ``score`` is the language's share of the likelihoods, 0 for ``und``.
    ``rejected`` marks texts that are unlikely even in that language. Other columns are
    carried along untouched; those of the three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["lang_pred", "score", "rejected"]
    docs = docs.drop(*names)
    place = docs.columns.index("text")

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        values = np.array([*model.langs, UNDETERMINED], object)
        for batch in batches:
            parts = [predictions(model, data, starts) for _, _, data, starts in _blocks(batch, place)]
            best, score, rejected = (
                map(np.concatenate, zip(*parts, strict=True)) if parts else ([], [], [])
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values[np.array(best, int)], pa.string()),
                 pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*batch.schema.names, *names],
            )

    kinds = StringType(), DoubleType(), BooleanType()
    added = [StructField(n, k) for n, k in zip(names, kinds, strict=True)]
    return docs.mapInArrow(identify, StructType([*docs.schema.fields, *added]))

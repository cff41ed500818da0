"""Document likelihood under a unigram model of subwords, over all segmentations.

The pieces are those of an existing vocabulary; how likely each is, is counted in the
training texts. A text's probability is the sum over all ways to cut its words into pieces,
found by the forward recursion in log space, times that of the end.

Texts share most of their words, so a word is scored once, in a table of all words and
their counts. The most frequent words are looked up while texts are read, from a copy of
bounded size; the others are joined with the table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.llm.common import stored, text_list

#: Words that are looked up while texts are read; about 12 MB.
FREQUENT = 1 << 18
#: Distinct words that a task counts before it passes the counts on.
COUNTED = 400_000
#: SentencePiece's mark for the beginning of a word.
_BEGIN = "▁"


@lru_cache(maxsize=2)
def _processor(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of all texts, and how often training texts have them."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    taught: Counter = Counter()
    others: set = set()

    def counts():
        rest = others - taught.keys()
        words = [*taught, *rest]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()).cast(pa.string()),
             pa.array([*taught.values(), *[0] * len(rest)], pa.int64())], schema=schema
        )
        taught.clear()
        others.clear()

    for batch in batches:
        for learn, text in zip(batch.column(0).to_pylist(), text_list(batch.column(1)), strict=True):
            words = text.lower().split()
            (taught if learn else others).update(words)
            if len(taught) + len(others) > COUNTED:
                yield from counts()
    yield from counts()


def _count_pieces(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(path)
        totals = np.zeros(processor.get_piece_size(), np.int64)
        for batch in batches:
            n = batch.column(1).to_numpy(zero_copy_only=False)
            words = batch.column(0).to_pylist()
            for first in range(0, len(words), 20_000):
                ids = processor.encode(words[first : first + 20_000], out_type=int, num_threads=1)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((i for own in ids for i in own), np.int64, int(sizes.sum()))
                weight = np.repeat(n[first : first + 20_000], sizes)
                np.add.at(totals, flat, weight)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(totals[used], pa.int64())], names=["piece", "n"]
        )

    return count


class Lattice:
    """Natural log-probabilities of words by forward recursion over a vocabulary's pieces."""

    def __init__(self, path: str, counts: dict[int, int], ends: int):
        processor = _processor(path)
        ids = [
            i for i in range(processor.get_piece_size())
            if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i))
        ]
        # One is added to each count; the end is a piece like any other.
        total = math.log(sum(counts.get(i, 0) + 1 for i in ids) + ends + 1)
        self.end = math.log(ends + 1) - total
        self.pieces: dict[str, float] = {}
        self.bytes = [0.0] * 256
        for i in ids:
            value = math.log(counts.get(i, 0) + 1) - total
            if processor.is_byte(i):
                self.bytes[int(processor.id_to_piece(i)[3:5], 16)] = value
            else:
                self.pieces[processor.id_to_piece(i)] = value
        self.longest = max(map(len, self.pieces))

    def word(self, word: str) -> float:
        """Log of the sum over all cuts of the marked word into pieces.

        A character that no piece consists of is spelled in byte pieces.
        """
        text = _BEGIN + word
        get, exp, log = self.pieces.get, math.exp, math.log
        forward = [0.0]
        for end in range(1, len(text) + 1):
            terms = []
            for begin in range(max(0, end - self.longest), end):
                value = get(text[begin:end])
                if value is not None:
                    terms.append(forward[begin] + value)
            if get(text[end - 1]) is None:
                spelled = sum(self.bytes[b] for b in text[end - 1].encode("utf-8", "replace"))
                terms.append(forward[end - 1] + spelled)
            high = max(terms)
            forward.append(high + log(sum(exp(t - high) for t in terms)) if len(terms) > 1 else high)
        return forward[-1]


def _score_words(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in batches:
            values = [lattice.word(w) / math.log(10) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], names=["word", "c", "lattice"]
            )

    return score


def _look_up(shared):
    """Sums over the frequent words of each text, and its other words with their numbers."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
         ("known", pa.int64()), ("base", pa.float64()), ("lattice", pa.float64()),
         ("words", pa.list_(pa.string())), ("numbers", pa.list_(pa.int32()))]
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, c, base, lattice = shared.value
        place = dict(zip(words, range(len(words)), strict=True))
        none = len(words)
        c, base, lattice = (np.append(x, 0) for x in (c, base, lattice))
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in text_list(batch.column(2)):
                own = text.lower().split()
                at = np.fromiter((place.get(w, none) for w in own), np.int64, len(own))
                rare = Counter(own[k] for k in np.flatnonzero(at == none).tolist())
                row = (len(own), int((c[at] > 0).sum()), float(base[at].sum()),
                       float(lattice[at].sum()), [*rare], [*rare.values()])
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            columns[4] = pa.array(columns[4], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array(x, f.type) for x, f in zip(columns, list(schema)[2:], strict=True)],
                schema=schema,
            )

    return look


def _least_count(words: DataFrame) -> int:
    """The count from which on words are frequent: at most ``FREQUENT`` have it.

    Found on a table of how many words have counts of each size, sixteen sizes a doubling.
    """
    size = F.floor(F.log2("c") * 16)
    sizes = (
        words.filter("c > 0")
        .groupBy(size.alias("size"))
        .agg(F.count("*").alias("words"), F.min("c").alias("least"))
        .collect()
    )
    least, taken = 2**62, 0
    for row in sorted(sizes, reverse=True):
        taken += row.words
        if taken > FREQUENT:
            break
        least = row.least
    return least


def scored(docs: DataFrame, learning: Column, vocabulary: str) -> DataFrame:
    """Likelihoods of all texts, learned from those where ``learning`` is true.

    Returns for each row ``doc_id``, ``held_out`` (it did not teach), ``n_tokens`` (words
    and one end), ``n_known`` (tokens that training texts have), ``train_tokens``,
    ``base_score`` (log10 probability by add-one word counts) and ``score`` (by the
    lattice). Words are runs of other than ASCII white space, A-Z lower-cased. A null text
    is empty: only the end is scored. Rows for which ``learning`` is null do not teach.
    Repeated rows count and are scored as often as they stand there.
    """
    spark = docs.sparkSession
    learns = F.coalesce(learning, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long"), learns.alias("learns"), "text")
    words = stored(
        texts.select("learns", "text")
        .mapInArrow(_count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("c")),
        "words",
    )
    ends = texts.filter("learns").count()
    total, distinct = words.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    tokens = (total or 0) + ends
    denominator = tokens + 1 * (distinct + (ends > 0) + 1)

    pieces = (
        words.filter("c > 0")
        .select("word", "c")
        .mapInArrow(_count_pieces(vocabulary), "piece int, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .collect()
    )  # at most as many as the vocabulary has
    counts = {r.piece: r.n for r in pieces}
    model = spark.sparkContext.broadcast((vocabulary, counts, ends))
    table = stored(
        words.select("word", "c").mapInArrow(_score_words(model), "word string, c long, lattice double"),
        "scored-words",
    )

    def base(c):
        return F.log10((c + 1) / F.lit(float(denominator)))

    top = table.filter(F.col("c") >= _least_count(table)).toPandas()
    c = top["c"].to_numpy(np.int64)
    frequent = spark.sparkContext.broadcast(
        (
            [w.encode() for w in top["word"]],
            c,
            np.log10((c + 1) / denominator),
            top["lattice"].to_numpy(float),
        )
    )
    read = stored(
        texts.select("doc_id", (~F.col("learns")).alias("held_out"), "text")
        .mapInArrow(
            _look_up(frequent),
            "doc_id long, held_out boolean, n_tokens long, known long, base double, "
            "lattice double, words array<string>, numbers array<int>",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "looked-up",
    )
    number = F.col("number")
    rest = (
        read.select("row", F.explode(F.arrays_zip("words", "numbers")).alias("x"))
        .select("row", F.col("x.words").alias("word"), F.col("x.numbers").alias("number"))
        .join(table, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, number).otherwise(0)).alias("rest_known"),
            F.sum(number * base(F.col("c"))).alias("rest_base"),
            F.sum(number * F.col("lattice")).alias("rest_lattice"),
        )
    )
    end_base = math.log10((ends + 1) / denominator)
    end = Lattice(vocabulary, counts, ends).end / math.log(10)

    def whole(first, second, end):
        return F.col(first) + F.coalesce(F.col(second), F.lit(0)) + F.lit(end)

    return read.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        whole("known", "rest_known", int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        whole("base", "rest_base", end_base).alias("base_score"),
        whole("lattice", "rest_lattice", end).alias("score"),
    )

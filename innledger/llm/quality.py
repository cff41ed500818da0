"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Tokens are runs of word characters and runs of other signs, lower-cased. A token that
repeats the one before it counts as the token "the same again", so that stuttering texts
share n-grams whatever they stutter. A document's features are its hashed one- and
two-token n-grams with their relative frequencies; its score is a sparse dot product.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from innledger.llm.common import Recent, mixed, slices, text_list
from innledger.llm.labelled import one_label_each, sampled, with_texts

#: The classifier learns from at most so many labelled documents, whole texts.
SAMPLE = 8192
BITS = 20
EPOCHS = 3
#: Frequencies are multiplied by this, so that a tenth of a text already decides.
SCALE = 10.0
#: FTRL-Proximal: learning rate, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
THRESHOLD = 0.5

TOKEN = re.compile(r"\w+|[^\w\s]+")
CACHED_TOKENS = 250_000
_AGAIN = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_codes = Recent(lambda tokens: map(xxhash.xxh3_64_intdigest, tokens), CACHED_TOKENS)


def _token_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all tokens, and how many each text has."""
    found = [TOKEN.findall(x.decode("utf-8", "replace").lower()) for x in texts]
    known = _codes.holding(set().union(*found))
    counts = np.array([len(x) for x in found], np.int64)
    codes = map(known.__getitem__, chain.from_iterable(found))
    return np.fromiter(codes, np.uint64, int(counts.sum())), counts


def _ngrams(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts and the text each belongs to."""
    text = np.repeat(np.arange(len(counts)), counts)
    inside = np.zeros(len(codes), bool)
    inside[1:] = text[1:] == text[:-1]
    token = codes.copy()
    token[1:][inside[1:] & (codes[1:] == codes[:-1])] = _AGAIN
    with np.errstate(over="ignore"):
        pairs = mixed(token[:-1] * _PAIR + token[1:])[inside[1:]]
    hashed = np.concatenate([mixed(token), pairs]) >> np.uint64(64 - BITS)
    return hashed.astype(np.int64), np.concatenate([text, text[1:][inside[1:]]])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of each text: the distinct n-grams and their scaled frequencies."""
    for batch in batches:
        texts, labels = text_list(batch.column("text")), batch.column("label").to_pylist()
        for first, last in slices(texts):
            hashed, owner = _ngrams(*_token_codes(texts[first:last]))
            out = []
            for k in range(last - first):
                slots, n = np.unique(hashed[owner == k], return_counts=True)
                weight = (n * (SCALE / max(1, n.sum()))).astype("<f4")
                out.append((labels[first + k], slots.astype("<i4").tobytes(), weight.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True
                )],
                names=["label", "slots", "weights"],
            )


def ftrl(examples: list[tuple[int, np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, float]:
    """Weights and intercept by FTRL-Proximal, one example after the other."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last is the intercept
    for _ in range(EPOCHS):
        for label, slots, values in examples:
            at = np.append(slots, size)
            x = np.append(values, 1.0)
            l1 = np.where(at == size, 0.0, L1)
            w = _weights(z[at], n[at], l1)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = _weights(z, n, np.append(np.full(size, L1), 0.0))
    return w[:-1].astype("<f4"), float(w[-1])


def _weights(z: np.ndarray, n: np.ndarray, l1: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= l1, 0.0, w)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    examples = [
        (y, np.frombuffer(s, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(float))
        for batch in batches
        for y, s, v in zip(*(c.to_pylist() for c in batch.columns), strict=True)
    ]
    weights, intercept = ftrl(examples, 1 << BITS)
    used = np.flatnonzero(weights)
    yield pa.RecordBatch.from_pydict(
        {
            "slots": [used.astype("<i4").tobytes()],
            "weights": [weights[used].tobytes()],
            "intercept": [intercept],
        }
    )


def trained(docs: DataFrame, labels: DataFrame, label: str = "quality") -> dict:
    """The classifier: n-gram slots, their weights, the intercept.

    Learns from at most ``SAMPLE`` rows of ``labels`` that are not held out. Without any
    label every score is one half. Its size is bounded by the hash space.
    """
    sample = sampled(one_label_each(labels, label), SAMPLE, seed=8)
    examples = with_texts(docs, sample).withColumn("label", F.col("label").cast("int"))
    fitted = (
        examples.select("doc_id", "label", "text")
        .mapInArrow(_examples_with_order, "doc_id long, label int, slots binary, weights binary")
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id"))
        .select("label", "slots", "weights")
        .mapInArrow(_fit, "slots binary, weights binary, intercept double")
        .collect()
    )
    row = fitted[0] if fitted else {"slots": b"", "weights": b"", "intercept": 0.0}
    return {
        "slots": np.frombuffer(row["slots"], "<i4"),
        "weights": np.frombuffer(row["weights"], "<f4"),
        "intercept": row["intercept"],
    }


def _examples_with_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for part in _examples([batch]):
            ids = batch.column("doc_id").slice(at, part.num_rows).cast(pa.int64())
            at += part.num_rows
            yield pa.RecordBatch.from_arrays(
                [ids, *part.columns], names=["doc_id", "label", "slots", "weights"]
            )


def scored(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality added as ``column``.

    Empty and null texts get the intercept's probability. All other columns, whatever
    their names, are carried along untouched; ``column`` must be a new name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS)
        table[shared.value["slots"]] = shared.value["weights"]
        for batch in batches:
            texts = text_list(batch.column(place))
            scores = []
            for first, last in slices(texts):
                hashed, owner = _ngrams(*_token_codes(texts[first:last]))
                sums = np.bincount(owner, table[hashed], last - first)
                total = np.maximum(1, np.bincount(owner, minlength=last - first))
                scores.append(sums * SCALE / total + shared.value["intercept"])
            margin = np.concatenate(scores) if scores else np.zeros(0)
            p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, column]
            )

    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.mapInArrow(score, schema)

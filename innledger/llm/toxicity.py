"""Toxicity: non-negative positive-unlabelled learning.

Only confirmed toxic documents count as labelled; everything else in the training rows is
unlabelled text, a mixture with a known share of toxic documents (the class prior). The
risk of calling unlabelled text toxic is corrected by that share and kept from going below
zero, which is where over-fitting would push it.

Features are whole words and their four- and five-letter pieces, hashed. Those that tell
confirmed documents from the rest are kept, and a few linear classifiers learn on them,
each from its own half of the unlabelled sample. A document's margin adds up over its
distinct words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from innledger.llm.common import Recent, held_out, slices, text_list
from innledger.llm.labelled import FOLDS, HELD_OUT_PART, one_label_each, sampled, with_texts

#: The classifiers learn from at most so many confirmed and unlabelled documents.
CONFIRMED, UNLABELLED = 2048, 4096
BITS = 22
#: Features kept, and classifiers averaged.
FEATURES, MEMBERS = 768, 3
#: Least log-likelihood gain of a kept feature: chance alone gives one feature of a
#: million this much.
LEAST_GAIN = 14.0
STEPS, RATE, DECAY = 400, 0.05, 1e-4
THRESHOLD = 0.7

WORD = re.compile(r"\w+")
PIECES = (4, 5)
CACHED_WORDS = 500_000


def _word_slots(word: str) -> list[int]:
    """Hashed features of a word: itself, and its pieces (with marks at both ends)."""
    marked = f"<{word}>"
    parts = {marked[i : i + n] for n in PIECES for i in range(len(marked) - n + 1)}
    return [xxhash.xxh32_intdigest(p) >> (32 - BITS) for p in parts | {marked}]


def _words(text: bytes) -> set[str]:
    return set(WORD.findall(text.decode("utf-8", "replace").lower()))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct features of each text."""
    for batch in batches:
        slots = []
        for text in text_list(batch.column("text")):
            own: set[int] = set()
            for word in _words(text):
                own.update(_word_slots(word))
            slots.append(np.array(sorted(own), "<i4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), batch.column("confirmed"),
             batch.column("unlabelled"), pa.array(slots, pa.binary())],
            names=["doc_id", "confirmed", "unlabelled", "slots"],
        )


def told_apart(positive: list[np.ndarray], mixture: list[np.ndarray], prior: float) -> np.ndarray:
    """The features that speak most for a confirmed document, by likelihood ratio."""
    in_p = np.bincount(np.concatenate(positive), minlength=1 << BITS)
    in_u = np.bincount(np.concatenate([*mixture, np.zeros(0, int)]), minlength=1 << BITS)
    p = in_p / len(positive)
    u = (in_u + 0.5) / (len(mixture) + 1)
    clean = np.maximum(u - prior * p, 0.5 / (len(mixture) + 1)) / max(1 - prior, 1e-6)
    gain = np.where((in_p > 1) & (p > clean), in_p * np.log(np.maximum(p, 1e-12) / clean), 0)
    best = np.argsort(-gain, kind="stable")[:FEATURES]
    return np.sort(best[gain[best] >= LEAST_GAIN])


def matrix(examples: list[np.ndarray], kept: np.ndarray) -> np.ndarray:
    """Presence of each kept feature in each example."""
    x = np.zeros((len(examples), len(kept)), np.float32)
    for row, slots in zip(x, examples, strict=True):
        at = np.searchsorted(kept, slots)
        row[at[(at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == slots)]] = 1
    return x


def non_negative_pu(
    positive: np.ndarray, mixture: np.ndarray, prior: float
) -> tuple[np.ndarray, float]:
    """Linear classifier that minimises the non-negative PU risk with the sigmoid loss.

    Risk: prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]). Where the second
    part falls below zero, the step goes against it instead. Weights stay at zero or
    above: every kept feature speaks for the class, and long texts must not add up
    evidence against it.
    """
    w, b = np.zeros(positive.shape[1]), -1.0
    first, second, steps = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    for _ in range(STEPS):
        fp, fu = positive @ w + b, mixture @ w + b
        sp, su = 1 / (1 + np.exp(-np.clip(fp, -30, 30))), 1 / (1 + np.exp(-np.clip(fu, -30, 30)))
        negative = su.mean() - prior * sp.mean()
        dp, du = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        pull = -prior * np.append(dp @ positive, dp.sum())
        push = np.append(du @ mixture, du.sum()) + pull
        grad = pull + push if negative >= 0 else -push
        grad[:-1] += DECAY * w
        steps += 1
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        move = (first / (1 - 0.9**steps)) / (np.sqrt(second / (1 - 0.99**steps)) + 1e-8)
        w, b = np.maximum(w - RATE * move[:-1], 0), b - RATE * move[-1]
    return w, float(b)


def _fit_with(prior: float):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positive, mixture = [], []
        for batch in batches:
            for is_p, is_u, slots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                slots = np.frombuffer(slots, "<i4")
                positive += [slots] * is_p
                mixture += [slots] * is_u
        if not positive or not mixture:
            return
        kept = told_apart(positive, mixture, prior)
        x, u = matrix(positive, kept), matrix(mixture, kept)
        fits = [
            non_negative_pu(x, u[np.arange(len(u)) % MEMBERS != m] if len(u) > MEMBERS else u, prior)
            for m in range(MEMBERS)
        ]
        yield pa.RecordBatch.from_pydict(
            {
                "slots": [kept.astype("<i4").tobytes()],
                "weights": [np.mean([w for w, _ in fits], 0).astype("<f4").tobytes()],
                "intercept": [float(np.mean([b for _, b in fits]))],
            }
        )

    return fit


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict:
    """The averaged classifier: feature slots, weights, intercept; at most ``FEATURES``.

    Learns from rows that are not held out: at most ``CONFIRMED`` documents marked toxic,
    and at most ``UNLABELLED`` documents taken without looking at marks. The class prior is
    the share of marks that are toxic. Without confirmed documents every score is zero.
    """
    marks = one_label_each(labels, label)
    share = marks.agg(F.avg((F.col("label") == 1).cast("double"))).first()[0]
    prior = min(max(share or 0.0, 1e-4), 0.9)
    confirmed = sampled(marks.filter("label = 1").select("doc_id"), CONFIRMED, seed=4)
    training = docs.filter(~held_out("doc_id", FOLDS, HELD_OUT_PART)).select("doc_id")
    mixture = sampled(training, UNLABELLED, seed=5)
    sample = (
        confirmed.withColumn("confirmed", F.lit(True))
        .unionByName(mixture.withColumn("unlabelled", F.lit(True)), allowMissingColumns=True)
        .groupBy("doc_id")
        .agg(F.max("confirmed").alias("confirmed"), F.max("unlabelled").alias("unlabelled"))
        .fillna(False)
    )
    fitted = (
        with_texts(docs, sample)
        .select("doc_id", "confirmed", "unlabelled", "text")
        .mapInArrow(_examples, "doc_id long, confirmed boolean, unlabelled boolean, slots binary")
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id"))
        .select("confirmed", "unlabelled", "slots")
        .mapInArrow(_fit_with(prior), "slots binary, weights binary, intercept double")
        .collect()
    )
    row = fitted[0] if fitted else {"slots": b"", "weights": b"", "intercept": -35.0}
    return {
        "slots": np.frombuffer(row["slots"], "<i4"),
        "weights": np.frombuffer(row["weights"], "<f4"),
        "intercept": row["intercept"],
    }


def scored(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic added as ``column``.

    Empty and null texts get the intercept's probability. All other columns are carried
    along untouched; ``column`` must be a new name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = dict(
            zip(shared.value["slots"].tolist(), shared.value["weights"].tolist(), strict=True)
        )
        recent = Recent(
            lambda words: (sum(weight.get(s, 0.0) for s in _word_slots(w)) for w in words),
            CACHED_WORDS,
        )
        for batch in batches:
            margins = []
            texts = text_list(batch.column(place))
            for first, last in slices(texts):
                words = [_words(x) for x in texts[first:last]]
                known = recent.holding(set().union(*words))
                margins += [sum(map(known.__getitem__, own)) for own in words]
            margin = np.array(margins, float) + shared.value["intercept"]
            p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p, pa.float64())], names=[*batch.schema.names, column]
            )

    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    return docs.mapInArrow(score, schema)

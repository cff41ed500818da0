"""SimHash near-duplicates by signatures with one bit left out.

A fingerprint has 64 bits. If two differ in at most ``k`` of them and both are cut into
``k // 2 + 1`` segments, one segment differs by at most one bit. So every fingerprint is
indexed by each segment as it is, and by each segment with one bit left out: for a bit that
is left out, fingerprints that have it meet those that have not. An equality join on these
keys finds each pair, the distance is verified on the pair, and of the keys on which a
pair meets only one lets it pass. Equal fingerprints are one row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.llm.common import numbered, stored, text_list, tidy
from innledger.llm.components import connected_components

SHINGLE, DISTANCE = 3, 2
SEED = 42
#: Bytes of hashed shingles whose bits are counted at once.
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is in more than half of the shingles' hashes; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    first = (ends - sizes)[: len(last)].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)]
    values = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), _BLOCK):
        part = np.unpackbits(values[at : at + _BLOCK], axis=1, bitorder="little")
        counts += part.sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(values), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``tie`` (a digest of the text) and ``fp``, a signed 64-bit fingerprint.

    Words are runs of other than ASCII white space, A-Z lower-cased. A null text is empty.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x, shingle) for x in text_list(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())],
                names=["doc_id", "tie", "fp"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(tidy(digest), "doc_id long, tie long, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each segment."""
    number = distance // 2 + 1
    edges = [64 * i // number for i in range(number + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _mask(bits: int) -> Column:
    return F.lit((1 << bits) - 1 if bits < 64 else -1)


def _index(fps: DataFrame, distance: int, holding: bool) -> DataFrame:
    """``fp`` under its keys: (segment, bit left out or -1, segment without that bit).

    Of the keys without a bit, only those of bits that are set (``holding``) or are not.
    """
    keys = []
    for number, (first, bits) in enumerate(_segments(distance)):
        part = F.shiftrightunsigned("fp", first).bitwiseAND(_mask(bits))
        keys.append(F.struct(F.lit(number * 100 + 99).alias("slot"), part.alias("rest")))
        for bit in range(bits):
            one = F.lit((1 << bit) - (1 << 64) * (bit == 63))
            is_set = part.bitwiseAND(one) != 0
            rest = part.bitwiseAND(F.bitwise_not(one))
            key = F.struct(F.lit(number * 100 + bit).alias("slot"), rest.alias("rest"))
            keys.append(F.when(is_set if holding else ~is_set, key))
    key = F.explode(F.filter(F.array(*keys), lambda k: k.isNotNull())).alias("key")
    return fps.select("fp", key).select("fp", "key.slot", "key.rest")


def _meeting_slot(difference: Column, distance: int) -> Column:
    """The one slot at which a pair with this difference is let through."""
    slot = None
    for number, (first, bits) in reversed(list(enumerate(_segments(distance)))):
        part = F.shiftrightunsigned(difference, first).bitwiseAND(_mask(bits))
        here = F.when(part == 0, number * 100 + 99).when(
            F.bit_count(part) == 1, number * 100 + F.length(F.bin(part)) - 1
        )
        slot = here if slot is None else F.coalesce(here, slot)
    return slot


def linked_fingerprints(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a``, ``b`` of the distinct values of ``fp`` that differ in 1 to ``distance``
    bits, each once."""
    left = _index(fps, distance, True).select(F.col("fp").alias("a"), "slot", "rest")
    right = _index(fps, distance, False).select(
        F.col("fp").alias("b"), F.col("slot").alias("__slot"), F.col("rest").alias("__rest")
    )
    difference = F.col("a").bitwiseXOR(F.col("b"))
    whole = F.col("slot") % 100 == 99  # equal segments: each pair would meet in both orders
    return left.join(
        right,
        (F.col("slot") == F.col("__slot"))
        & (F.col("rest") == F.col("__rest"))
        & (~whole | (F.col("a") < F.col("b")))
        & (F.bit_count(difference) <= distance)
        & (F.col("slot") == _meeting_slot(difference, distance)),
    ).select("a", "b")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row for each of ``docs``: ``doc_id``, ``tie``, ``fp``, ``component``,
    ``component_id``, ``keep``.

    Documents are linked if their fingerprints differ in at most ``distance`` bits; a
    component is what links reach, and ``component_id`` its smallest doc_id. ``keep`` marks
    the rows to keep of a component: those of that doc_id, and of several different texts
    under it those with one digest. Null ids count as the largest; a component of nothing
    else has a null id. Texts without a word have fingerprint zero and link like any other.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    found = connected_components(linked_fingerprints(rows.select("fp").distinct(), distance))
    names = (
        rows.groupBy("fp")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("best"))
        .join(found, F.col("fp") == F.col("node"), "left")
        .select("fp", "best", F.coalesce("component", "fp").alias("component"))
    )
    best = names.groupBy("component").agg(F.min("best").alias("__best"))
    of_fp = names.join(best, "component").select(F.col("fp").alias("__fp"), "component", "__best")
    return rows.join(of_fp, F.col("fp") == F.col("__fp")).select(
        "doc_id",
        "tie",
        "fp",
        "component",
        F.col("__best.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("__best.doc_id")) & (F.col("tie") == F.col("__best.tie"))).alias("keep"),
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component, as ``near_duplicates`` marks it.

    Of rows equal in id and text an arbitrary one stays. Other columns are carried along.
    """
    keep = near_duplicates(docs, shingle, distance).filter("keep")
    keep = keep.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).distinct()
    own = numbered(docs)
    doc_id, text = (own[docs.columns.index(c)] for c in ("doc_id", "text"))
    same = doc_id.cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__tie"))
    kept = own.join(keep, same).dropDuplicates(["__id", "__tie"])
    return kept.select(*own.columns).toDF(*docs.columns)

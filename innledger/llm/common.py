"""What several of the operators share: stored intermediate tables, texts as bytes, splits."""

from __future__ import annotations

import ctypes
import ctypes.util
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innledger.session import stored  # noqa: F401

#: Stands for a null id inside the operators; sorts before every other id.
NULL_ID = -(2**63)


def new_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    while name in df.columns:
        name = f"_{name}"
    return name


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named _0, _1 and so on, which clash with no other name here."""
    return df.toDF(*(f"_{i}" for i in range(len(df.columns))))


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id gives null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether a row is kept out of learning; rows without an id always are."""
    return F.coalesce(remainder(doc_id, parts) == part, F.lit(True))


def byte_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one array of UTF-8 bytes, and where each starts.

    The second array has one entry more than there are texts. Null counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    starts = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def text_list(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def text_slices(column: pa.Array, most: int = 2 << 20):
    """The texts of an Arrow column as bytes, about ``most`` bytes at once, each list with the
    number of its first text. Null counts as empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes) // most
    edges = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(sizes)]
    for first, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield first, text_list(column.slice(first, stop - first))


def tidy(function: Callable, forget: bool = True) -> Callable:
    """``function`` on the batches of a task, which gives its memory back when the task ends.

    Worker processes outlive a stage, and what they keep lies beside what the next one needs.
    ``forget`` also drops the values that an earlier operator remembers in ``Recent``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if forget and Recent.used_last is not None:
            Recent.used_last.young, Recent.used_last.old, Recent.used_last = {}, {}, None
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Return freed memory of Arrow and of the C library to the system, where that is glibc."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim is not None:
        trim(0)


def slices(texts: list, most: int = 2 << 20):
    """Ranges of ``texts`` of about ``most`` bytes each, at least one text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


class Recent:
    """Values of the keys met lately, each computed once while it is remembered.

    Two generations of at most half of ``most`` keys each (a single call may exceed that):
    a key used again moves to the young one, so frequent keys outlive any number of rare.
    Worker processes outlive an operator, so only the memory used last keeps its values.
    """

    used_last: Recent | None = None

    def __init__(self, compute: Callable[[list], Iterable], most: int):
        self.compute, self.most = compute, most
        self.young: dict = {}
        self.old: dict = {}

    def holding(self, keys: set) -> dict:
        """A dictionary with the values of all ``keys``, valid until the next call."""
        self._take_turn()
        return self._with(keys)

    def values_of(self, keys: list) -> list:
        """The value of each of ``keys``, which may repeat, in their order. No value is None."""
        self._take_turn()
        values = list(map(self.young.get, keys))
        absent = [i for i, value in enumerate(values) if value is None]
        known = self._with({keys[i] for i in absent})
        for i in absent:
            values[i] = known[keys[i]]
        return values

    def _take_turn(self) -> None:
        if Recent.used_last is not self:
            if Recent.used_last is not None:
                Recent.used_last.young, Recent.used_last.old = {}, {}
            Recent.used_last = self
        if len(self.young) > self.most // 2:
            self.old, self.young = self.young, {}

    def _with(self, keys: set) -> dict:
        old, young = self.old, self.young
        absent = keys.difference(young)
        again = {k for k in absent if k in old}
        young.update((k, old[k]) for k in again)
        new = list(absent - again)
        young.update(zip(new, self.compute(new), strict=True))
        return young


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finishing steps of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

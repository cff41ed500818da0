"""Cut words that lie in a window of 50 words which an earlier document has too.

Most windows occur once, so a count-min sketch comes first. Documents are dealt into slices.
A slice knows each of its windows by two independent 64-bit hashes and fills a sketch of its
own: two rows of cells, cut into blocks by the windows' first bits, a count for each document
a window occurs in. The slices' parts of a block meet in one task, which adds them up and
tells every slice which of its cells are at 2 or more. A window whose two cells both are may
be in several documents; every window that is in several has such cells, so none is lost.

Only those windows go on to the exact pass: each slice sends each of them once, with the
smallest document it is in, to the task that groups it by both hashes (128 bits) and finds
the smallest document of all. Back comes one state for a window: all of the slice's documents
lose it, or all but the smallest.

No key is hot: a window is sent once by a slice, however often it occurs, and slices and
blocks are dealt by hashes. The sketch grows with the input, lies nowhere as a whole and is
not broadcast. Texts are shuffled once, by slice; the three passes over them read the same
exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from innledger.llm.common import NULL_ID, mixed, text_list

WINDOW = 50
#: Bytes of text of a slice, and cells of a row of a block; both grow with the input between
#: these bounds, so that the parts of a sketch that slices send do not become tiny.
SLICE_BYTES = 1 << 23, 1 << 26
BLOCK_CELLS = 1 << 22, 1 << 27
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers of the two window hashes.
_BASES = 0xD6E8FEB86659FD93, 0xCA5A826395121157


@cache
def _few_powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, 1 << 21)


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` to the powers below ``size``, and their inverses, modulo 2**64."""
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(
            np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64)
            for b in (base, inverse)
        )


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of each range of ``values``, the same wherever the range lies."""
    size = len(values) + 1
    up, down = _few_powers(base) if size <= 1 << 21 else _powers(base, size)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts])


class Windows:
    """The windows of a slice's documents: hashes, and the documents they are in."""

    def __init__(self, texts: list[bytes], bases: tuple[int, ...] = _BASES):
        self.n_words = np.zeros(len(texts), np.int64)
        found = [self._of(texts[a:b], self.n_words[a:b], bases) for a, b in _runs(texts)]
        self.counts = np.maximum(self.n_words - WINDOW + 1, 0)
        nothing = np.zeros(0, np.uint64)
        #: For each base the hashes of all windows, document by document.
        self.hashes = [
            np.concatenate([f[i] for f in found]) if found else nothing for i in range(len(bases))
        ]
        #: The document of each window, by number.
        self.document = np.repeat(np.arange(len(texts), dtype=np.int32), self.counts)

    @staticmethod
    def _of(texts: list[bytes], n_words: np.ndarray, bases: tuple[int, ...]) -> list[np.ndarray]:
        words = [text.split() for text in texts]
        n_words[:] = [len(w) for w in words]
        joined = np.frombuffer(b" ".join([b" ".join(w) for w in words if w]), np.uint8)
        del words
        counts = np.maximum(n_words - WINDOW + 1, 0)
        if not counts.any():
            return [np.zeros(0, np.uint64) for _ in bases]
        spaces = np.flatnonzero(joined == 32)
        starts, ends = np.r_[0, spaces + 1], np.r_[spaces, len(joined)]
        codes = joined.astype(np.uint64) + np.uint64(1)
        skipped = np.cumsum(n_words) - n_words - (np.cumsum(counts) - counts)
        at = np.arange(counts.sum()) + np.repeat(skipped, counts)
        return [
            _rolling(_rolling(codes, starts, ends, base), at, at + WINDOW, base) for base in bases
        ]


def _runs(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most or i == len(texts) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def _packed(values: np.ndarray) -> bytes:
    """Ascending numbers as the bytes of their gaps, all lowest bytes first."""
    gaps = np.diff(values, prepend=values.dtype.type(0))
    return gaps.view(np.uint8).reshape(len(gaps), gaps.itemsize).T.tobytes()


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    with np.errstate(over="ignore"):
        return np.cumsum(np.ascontiguousarray(planes.T).view(kind)[:, 0], dtype=kind)


def _cells(hashes: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each hash in the two rows of its block."""
    mask = np.uint64(cells - 1)
    return [(h & mask).astype(np.uint32) for h in (hashes, mixed(hashes ^ _ODD))]


def _block_ranges(hashes: np.ndarray, blocks: int) -> Iterator[tuple[int, int, int]]:
    """Block, first and stop of the ascending hashes of each block."""
    block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    edges = np.r_[0, np.flatnonzero(np.diff(block)) + 1, len(block)]
    for first, stop in zip(edges[:-1], edges[1:]):
        if first < stop:
            yield int(block[first]), int(first), int(stop)


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the windows by both hashes, then as they stand, and where new ones begin."""
    order = np.argsort(first, kind="stable")
    f, s = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = f[1:] != f[:-1]
    if (s[1:] != s[:-1])[~new[1:]].any():  # different windows with the same first hash
        order = np.lexsort((second, first))
        f, s = first[order], second[order]
        new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
    return order, np.flatnonzero(new)


def _sketch(texts: list[bytes], blocks: int, cells: int) -> Iterator[tuple[int, bytes, bytes]]:
    """A slice's part of the sketch: for each block the cells of both rows, as often as they
    count. A window counts once for each document, and no more than twice."""
    windows = Windows(texts, _BASES[:1])
    (first,) = windows.hashes
    order, start = _distinct(first, first)
    if not len(start):
        return
    document = windows.document[order]
    # Documents ascend within a window, so it is in several if the last one differs.
    last = np.r_[start[1:], len(first)] - 1
    counted = np.repeat(first[order[start]], 1 + (document[last] != document[start]))
    del order, document, windows
    for block, a, b in _block_ranges(counted, blocks):
        yield block, *(_packed(np.sort(row)) for row in _cells(counted[a:b], cells))


def _repeated(parts: list[bytes], cells: int) -> Iterator[bytes]:
    """Of each slice's cells of a row, those which all slices together count twice or more."""
    counts = np.zeros(cells, np.uint8)
    for part in parts:
        own = _unpacked(part, np.uint32)
        again = own[1:][own[1:] == own[:-1]]
        counts[own] = np.minimum(counts[own] + 1, 2)
        counts[again] = 2
    for part in parts:
        own = np.unique(_unpacked(part, np.uint32))
        yield _packed(own[counts[own] == 2])


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each value is among the ascending others."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def _candidates(
    texts: list[bytes], ids: np.ndarray, replies: Iterable[dict], blocks: int, cells: int
) -> Iterator[dict]:
    """The windows of a slice that may be in several documents, by block: both hashes, the
    smallest document and whether the slice has others."""
    windows = Windows(texts)
    first, second = windows.hashes
    flagged = {r["block"]: [_unpacked(r[c], np.uint32) for c in "ab"] for r in replies}
    order = np.argsort(first)
    maybe = []
    for block, a, b in _block_ranges(first[order], blocks):
        if block in flagged:
            own = order[a:b]
            rows = zip(_cells(first[own], cells), flagged[block])
            maybe.append(own[np.logical_and(*(_member(*row) for row in rows))])
    if not maybe:
        return
    maybe = np.sort(np.concatenate(maybe))
    first, second, owner = first[maybe], second[maybe], ids[windows.document[maybe]]
    del windows, flagged
    if not len(maybe):
        return
    order, start = _distinct(first, second)
    first, second = first[order[start]], second[order[start]]
    least = np.minimum.reduceat(owner[order], start)
    several = least < np.maximum.reduceat(owner[order], start)
    for block, a, b in _block_ranges(first, blocks):
        yield {
            "block": block,
            "a": _packed(first[a:b]),
            "b": second[a:b].tobytes(),
            "least": least[a:b].view(np.uint8).reshape(-1, 8).T.tobytes(),
            "several": np.packbits(several[a:b]).tobytes(),
        }


def _verdicts(rows: list[dict]) -> Iterator[dict]:
    """For each slice the windows it loses, whole or in all but its smallest document."""
    first = [_unpacked(r["a"], np.uint64) for r in rows]
    second = [np.frombuffer(r["b"], np.uint64) for r in rows]
    least, several = [], []
    for row, own in zip(rows, first):
        planes = np.frombuffer(row["least"], np.uint8).reshape(8, -1)
        least.append(np.ascontiguousarray(planes.T).view(np.int64)[:, 0])
        several.append(np.unpackbits(np.frombuffer(row["several"], np.uint8), count=len(own)))
    place = np.repeat(np.arange(len(rows)), [len(x) for x in first])
    f, s, d = np.concatenate(first), np.concatenate(second), np.concatenate(least)
    order, start = _distinct(f, s)
    smallest = np.empty_like(d)
    stop = np.r_[start[1:], len(order)]
    smallest[order] = np.repeat(np.minimum.reduceat(d[order], start), stop - start)
    whole = smallest < d
    lost = whole | np.concatenate(several).astype(bool)
    for i, row in enumerate(rows):
        mine = (place == i) & lost
        if mine.any():
            # Ascending still, as they were sent.
            yield {
                "slice": row["slice"],
                "a": _packed(f[mine]),
                "b": s[mine].astype(np.uint32).tobytes(),
                "whole": np.packbits(whole[mine]).tobytes(),
            }


def _covered(texts: list[bytes], ids: np.ndarray, verdicts: list[dict]) -> list[np.ndarray]:
    """For each text whether its words stay."""
    windows = Windows(texts, _BASES if verdicts else ())
    gone = np.zeros(len(windows.document), bool)
    if verdicts:
        verdicts = [(_unpacked(v["a"], np.uint64), v) for v in verdicts]
        verdicts.sort(key=lambda v: int(v[0][0]))  # blocks do not overlap
        lost = np.concatenate([f for f, _ in verdicts])
        check = np.concatenate([np.frombuffer(v["b"], np.uint32) for _, v in verdicts])
        whole = np.concatenate(
            [np.unpackbits(np.frombuffer(v["whole"], np.uint8), count=len(f)) for f, v in verdicts]
        ).astype(bool)
        first, second = windows.hashes
        at = np.searchsorted(lost, first)
        left = np.flatnonzero(at < len(lost))
        while len(left):  # a second time round only for equal first hashes
            left = left[lost[at[left]] == first[left]]
            same = check[at[left]] == second[left].astype(np.uint32)
            hits, verdict = left[same], at[left[same]]
            owner = ids[windows.document[hits]]
            least = np.full(len(lost), np.iinfo(np.int64).max)
            np.minimum.at(least, verdict, owner)
            gone[hits] = whole[verdict] | (owner > least[verdict])
            left = left[~same]
            at[left] += 1
            left = left[at[left] < len(lost)]
    kept, stop = [], np.cumsum(windows.counts)
    for i, n in enumerate(windows.n_words):
        own = np.flatnonzero(gone[stop[i] - windows.counts[i] : stop[i]])
        edges = np.zeros(n + 1, np.int32)
        edges[own] += 1
        edges[own + WINDOW] -= 1
        kept.append(np.cumsum(edges[:n]) == 0)
    return kept


def _between(low_high: tuple[int, int], value: float) -> int:
    low, high = low_high
    return 1 << int(np.ceil(np.log2(min(max(value, low), high))))


def cut(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", text_bytes: int | None = None
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text``.

    A word goes if a window of 50 words around it also starts in a document with a smaller
    id. Words are runs of anything but ASCII white space; what is kept is joined by single
    spaces. Null texts have no words. Ids are whole numbers; a null id is smaller than all
    others; rows with the same id are parts of no other's past, and each is judged alone.
    Columns of ``docs`` keep their names, those of the result must be free. ``text_bytes``
    spares the pass that adds up how long the texts are.
    """
    if text_bytes is None:
        text_bytes = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    slices = max(1, -(-text_bytes // _between(SLICE_BYTES, text_bytes / (1 << 13))))
    cells = _between(BLOCK_CELLS, text_bytes / (1 << 14))
    blocks = max(1, -(-text_bytes // cells))

    inner = {name: f"_{i}" for i, name in enumerate(docs.columns)}
    own_id, own_text = inner[doc_id], inner[text]
    plain = docs.toDF(*inner.values())
    number = F.coalesce(F.col(own_id).cast("long"), F.lit(NULL_ID))
    dealt = plain.withColumns(
        {"id": number, "slice": F.expr(f"pmod(xxhash64(`{own_id}`, `{own_text}`), {slices})")}
    )
    by_slice = dealt.groupBy("slice")

    def table(rows: Iterable[dict], ddl: str) -> pa.Table:
        names = [field.split()[0] for field in ddl.split(", ")]
        rows, kinds = list(rows), {"slice": pa.int64(), "block": pa.int64()}
        return pa.table(
            {n: pa.array([r[n] for r in rows], kinds.get(n, pa.binary())) for n in names}
        )

    def ids_of(part: pa.Table) -> np.ndarray:
        return part.column("id").to_numpy()

    def sketched(part: pa.Table) -> pa.Table:
        found = _sketch(text_list(part.column(own_text)), blocks, cells)
        number = part.column("slice")[0].as_py()
        return table(({"block": x, "slice": number, "a": a, "b": b} for x, a, b in found), parts)

    def merged(part: pa.Table) -> pa.Table:
        rows = [_repeated(part.column(c).to_pylist(), cells) for c in "ab"]
        about = zip(part.column("block").to_pylist(), part.column("slice").to_pylist(), *rows)
        return table(
            ({"block": x, "slice": n, "a": a, "b": b} for x, n, a, b in about if a and b), parts
        )

    def estimated(part: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(part) or not len(replies):
            return table([], sent)
        number = part.column("slice")[0].as_py()
        found = _candidates(
            text_list(part.column(own_text)), ids_of(part), replies.to_pylist(), blocks, cells
        )
        return table((row | {"slice": number} for row in found), sent)

    def grouped(part: pa.Table) -> pa.Table:
        return table(_verdicts(part.to_pylist()), states)

    def finished(part: pa.Table, verdicts: pa.Table) -> pa.Table:
        texts = text_list(part.column(own_text))
        kept = _covered(texts, ids_of(part), verdicts.to_pylist())
        left = [
            b" ".join(t.split() if k.all() else compress(t.split(), k.tolist()))
            for t, k in zip(texts, kept)
        ]
        return part.drop_columns(["id", "slice"]).append_column(
            "n_words", pa.array([len(k) for k in kept], pa.int64())
        ).append_column(
            "n_removed", pa.array([len(k) - int(k.sum()) for k in kept], pa.int64())
        ).append_column(
            "kept_sha256", pa.array([sha256(x).hexdigest() for x in left])
        ).append_column("kept_text", pa.array(left, pa.binary()).cast(pa.string()))

    parts = "block long, slice long, a binary, b binary"
    sent = "block long, slice long, a binary, b binary, least binary, several binary"
    states = "slice long, a binary, b binary, whole binary"
    result = StructType([*plain.schema.fields]).add("n_words", "long").add("n_removed", "long")
    result = result.add("kept_sha256", "string").add("kept_text", "string")

    flagged = by_slice.applyInArrow(sketched, parts).groupBy("block").applyInArrow(merged, parts)
    maybe = by_slice.cogroup(flagged.groupBy("slice")).applyInArrow(estimated, sent)
    verdicts = maybe.groupBy("block").applyInArrow(grouped, states)
    done = by_slice.cogroup(verdicts.groupBy("slice")).applyInArrow(finished, result)
    return done.toDF(*docs.columns, "n_words", "n_removed", "kept_sha256", "kept_text")

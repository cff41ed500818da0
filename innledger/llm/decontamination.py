"""Benchmark decontamination by templates.

Numbers, names and units are replaced by typed placeholders, so that a question with other
figures or other people has the same template. Five-token windows of the templates are
looked up in a table of the benchmark's windows. Where enough windows of an item lie close
together in a document, the values in the slots are compared: a copy repeats them, a
re-parameterised copy replaces a value by the same other one wherever it stands, and two
values by two others. Windows of hardly any words are looked up by their own values, and by their template only beside a
window of words; items shorter than a window are looked up whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from innledger.llm.common import Recent, mixed, new_name, stored, text_slices, tidy

WINDOW = 5
#: Share of an item's windows that a document must have, and of its slots that must agree.
COVERAGE = 0.8
#: Share of the slots met that must follow a one-to-one map; of values drawn anew, some come
#: out equal by chance.
ONE_TO_ONE = 2 / 3
#: The template of a window of hardly any words says nothing by itself.
LEAST_WORDS = 2
#: Benchmark texts looked up in one pass over the documents; larger benchmarks take several.
BLOCK_BYTES = 16 << 20
CACHED_TOKENS = 250_000

# Unit words and number words that count as slots.
UNITS = frozenset(
    "mm cm m km g kg mg t ml cl l s sec min h hr kmh mph hz khz mhz ghz w kw mw v a "
    "inch inches foot feet yard yards mile miles ounce ounces pound pounds ton tons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter "
    "centimeters gram grams kilogram kilograms liter liters litre litres degree degrees "
    "percent dollar dollars euro euros cent cents usd eur gbp".split()
)
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
    "eighty ninety hundred thousand million billion".split()
)

TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n]")
#: Kinds of tokens, kept in the low bits of a token's code.
_WORD, _NUMBER, _TITLE, _UNIT, _END = range(5)
_KIND = np.uint64(7)
#: Codes of the placeholders.
_SLOT = {kind: np.uint64(8 * (kind + 1)) for kind in (_NUMBER, _TITLE, _UNIT)}
_BIT = {_NUMBER: np.uint8(1), _TITLE: np.uint8(2), _UNIT: np.uint8(4)}
_STEP = 0xD6E8FEB86659FD93
#: Weight of each token of a window in its hash.
_WEIGHTS = [np.uint64(pow(_STEP, WINDOW - 1 - k, 1 << 64)) for k in range(WINDOW)]


def _code(token: str) -> int:
    small = token.lower()
    if token in ".!?:\n":
        return _END
    if token[0].isdigit() or small in NUMBERS:
        kind = _NUMBER
    elif small in UNITS:
        kind = _UNIT
    else:
        kind = _TITLE if token.istitle() else _WORD
    return xxhash.xxh3_64_intdigest(small) & ~7 | kind


_codes = Recent(lambda tokens: map(_code, tokens), CACHED_TOKENS)


@dataclass
class Templates:
    """Templates of several texts, one after the other."""

    tokens: list[list[str]]
    plain: np.ndarray  # the words themselves, upper case aside
    kinds: np.ndarray  # what each can be besides a word, as bits of _BIT
    slot: np.ndarray  # whether each is a placeholder and cannot be a word
    owner: np.ndarray  # the text of each
    index: np.ndarray  # its place among the tokens of the text
    hashes: np.ndarray  # of the windows, one for each way to read them
    at: np.ndarray  # where the window of each hash begins
    exact: np.ndarray  # whether each hash is of the values and not of the template
    weak: np.ndarray  # where windows begin that can be read with hardly any words


def templates(texts: list[bytes]) -> Templates:
    """A capitalised word that begins a sentence can be a name or not, so the windows that
    have it get a hash for either."""
    tokens = [TOKEN.findall(x.decode("utf-8", "replace")) for x in texts]
    known = _codes.holding(set().union(*tokens))
    counts = np.array([len(t) for t in tokens], np.int64)
    total = int(counts.sum())
    codes = np.fromiter(map(known.__getitem__, chain.from_iterable(tokens)), np.uint64, total)
    owner = np.repeat(np.arange(len(texts)), counts)
    index = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    kind = codes & _KIND
    begins = index == 0
    begins[1:] |= kind[:-1] == _END
    kept = kind != _END
    codes, owner, index, kind, begins = (x[kept] for x in (codes, owner, index, kind, begins))
    number = kind == _NUMBER
    name = kind == _TITLE
    unit = kind == _UNIT
    unit[:1] = False
    unit[1:] &= number[:-1] & (owner[1:] == owner[:-1])
    plain = codes & ~_KIND
    either = name & begins
    slot = number | unit | (name & ~begins)
    codes, kinds = plain.copy(), np.zeros(len(plain), np.uint8)
    for which, of in ((number, _NUMBER), (name, _TITLE), (unit, _UNIT)):
        codes[which & slot] = _SLOT[of]
        kinds[which] = _BIT[of]
    at = np.arange(max(0, len(codes) - WINDOW + 1))
    at = at[owner[at] == owner[at + WINDOW - 1]]
    before = np.concatenate([[0], np.cumsum(~slot)])
    words = before[at + WINDOW] - before[at]
    valued = at[words < WINDOW]  # of the others, the template is the text
    maybe = np.concatenate([[0], np.cumsum(slot | either)])
    weak = at[WINDOW - (maybe[at + WINDOW] - maybe[at]) < LEAST_WORDS]
    hashes = _hashes(codes, at)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            some = np.flatnonzero(either[at + k] & (words > LEAST_WORDS))
            change = (_SLOT[_TITLE] - codes[at[some] + k]) * _WEIGHTS[k]
            hashes = np.concatenate([hashes, hashes[some] + change])
            at, words = np.append(at, at[some]), np.append(words, words[some] - 1)
    enough = words >= LEAST_WORDS
    hashes = mixed(np.concatenate([hashes[enough], _hashes(plain, valued)]))
    at = np.concatenate([at[enough], valued])
    exact = np.arange(len(at)) >= len(at) - len(valued)
    return Templates(tokens, plain, kinds, slot, owner, index, hashes, at, exact, weak)


def _hashes(codes: np.ndarray, at: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Of the windows of ``codes`` that begin ``at``."""
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * np.uint64(_STEP) + codes[at + k]
    return out


class _Benchmark:
    """Windows of the items of one block, by hash."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in rows]
        self.items = templates([text for _, text in rows])
        order = np.argsort(self.items.hashes, kind="stable")
        self.hashes, self.at = self.items.hashes[order], self.items.at[order]
        self.exact = self.items.exact[order]
        owner = self.items.owner
        sizes = np.bincount(owner, minlength=len(rows))
        self.windows = np.maximum(sizes - WINDOW + 1, 0)
        weak = self.items.weak
        self.weak = np.split(weak, np.searchsorted(owner[weak], np.arange(1, max(1, len(rows)))))
        few = np.array([len(x) for x in self.weak])[: len(rows)]
        #: Windows that must be met by their hashes; the weak ones can follow.
        self.least = np.maximum(1, np.ceil(COVERAGE * self.windows) - few)
        self.short = {}
        for size in range(1, WINDOW):
            own = np.flatnonzero(sizes == size)
            if len(own):
                hashes = mixed(_hashes(self.items.plain, np.searchsorted(owner, own), size))
                order = np.argsort(hashes, kind="stable")
                self.short[size] = hashes[order], own[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, docs: Templates) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of equal windows, in the documents and in the items, and whether only
        their values are known to be equal."""
        some = np.flatnonzero(self.maybe[(docs.hashes >> np.uint64(44)).astype(np.int64)])
        which, found = _equal(self.hashes, docs.hashes[some])
        return docs.at[some[which]], self.at[found], self.exact[found]

    def whole(self, docs: Templates) -> Iterator[tuple[int, dict]]:
        """What documents have of items that are shorter than a window."""
        for size, (hashes, own) in self.short.items():
            at = np.arange(max(0, len(docs.owner) - size + 1))
            at = at[docs.owner[at] == docs.owner[at + size - 1]]
            which, found = _equal(hashes, mixed(_hashes(docs.plain, at, size)))
            pairs = np.stack([docs.owner[at[which]], own[found]], 1)
            for doc, item in np.unique(pairs, axis=0).tolist():
                slots = int(self.items.slot[self.items.owner == item].sum())
                yield doc, {
                    "item_id": self.ids[item], "matched": 1, "windows": 1, "slots": slots,
                    "renamed": 0,
                }

    def leaks(self, docs: Templates) -> Iterator[tuple[int, dict]]:
        """For each document that has an item: its number, and what was found."""
        yield from self.whole(docs)
        in_docs, in_items, exact = self.hits(docs)
        doc, item = docs.owner[in_docs], self.items.owner[in_items]
        order = np.lexsort((exact, in_items, in_docs, item, doc))
        doc, item, in_docs, in_items, exact = (
            x[order] for x in (doc, item, in_docs, in_items, exact)
        )
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
        edges = np.append(np.flatnonzero(new), len(doc))
        enough = np.diff(edges) >= self.least[item[edges[:-1]]]
        for a, b in zip(edges[:-1][enough], edges[1:][enough], strict=True):
            leak = self._held(docs, int(item[a]), in_docs[a:b], in_items[a:b], exact[a:b])
            if leak is not None:
                yield int(doc[a]), {"item_id": self.ids[item[a]], **leak}

    def _held(
        self, docs: Templates, item: int, p: np.ndarray, q: np.ndarray, exact: np.ndarray
    ) -> dict | None:
        """What one document has of one item, from the equal windows at ``p`` and ``q``.

        Every alignment that has enough windows by itself is compared, and every stretch of
        the document, half as long again as the item, that begins where a run of equal
        windows does; the first one that is consistent counts. A copy as it is lies on one
        alignment, so what stands around it does not matter.
        """
        least = COVERAGE * self.windows[item]
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1]) | (q[1:] != q[:-1])
        p, q, exact = p[new], q[new], exact[new]  # of equal ones, the template comes first
        if len(np.unique(q)) < self.least[item]:
            return None
        p, q = self._with_weak(docs, item, p, q, np.unique((p - q)[~exact]))
        shift = p - q
        if len(np.unique(q)) < least:
            return None
        for d, n in zip(*np.unique(shift, return_counts=True), strict=True):
            if n >= least and (leak := self._matched(docs, item, p[shift == d], q[shift == d])):
                return leak
        order = np.lexsort((p, shift))
        run = np.ones(len(p), bool)
        run[order[1:]] = (np.diff(shift[order]) > 0) | (np.diff(p[order]) > 1)
        starts = np.unique(np.searchsorted(p, p[run]))
        length = math.ceil(1.5 * int(self.windows[item])) + WINDOW
        ends = np.searchsorted(p, p[starts] + length, "right")
        for a, b in zip(starts, ends, strict=True):
            if b - a >= least and len(np.unique(q[a:b])) >= least:
                if leak := self._matched(docs, item, p[a:b], q[a:b]):
                    return leak
        return None

    def _with_weak(
        self, docs: Templates, item: int, p: np.ndarray, q: np.ndarray, shifts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Equal windows, and also those of hardly any words that have the same template on
        an alignment that has a window of words."""
        weak = self.weak[item]
        if not len(weak) or not len(shifts):
            return p, q
        doc = docs.owner[p[0]]
        begin, end = np.searchsorted(docs.owner, [doc, doc + 1])
        more = []
        for d in shifts.tolist():
            there = weak[(weak + d >= begin) & (weak + d + WINDOW <= end)]
            fits = np.ones(len(there), bool)
            for k in range(WINDOW):
                i, j = there + k, there + d + k
                fits &= (self.items.plain[i] == docs.plain[j]) | (self.items.kinds[i] & docs.kinds[j] > 0)
            more.append(np.stack([there[fits] + d, there[fits]], 1))
        pairs = np.unique(np.concatenate([np.stack([p, q], 1), *more]), axis=0)
        return pairs[:, 0], pairs[:, 1]

    def _matched(self, docs: Templates, item: int, p: np.ndarray, q: np.ndarray) -> dict | None:
        """The entry of one stretch, or None if its slots are not consistent.

        Where a window of the item is met several times, the alignment with the most equal
        words and values counts, or else the one with the most windows.
        """
        same = sum((docs.plain[p + k] == self.items.plain[q + k]).astype(np.int64) for k in range(WINDOW))
        _, at = np.unique(p - q, return_inverse=True)
        orders = [np.bincount(at, same)[at]]
        if at.any():
            orders.append(np.bincount(at)[at])
        for best in orders:
            order = np.argsort(best, kind="stable")  # later ones overwrite earlier ones
            slots, renamed, consistent = self._compared(docs, p[order], q[order])
            if consistent:
                return {
                    "matched": len(np.unique(q)), "windows": int(self.windows[item]),
                    "slots": slots, "renamed": renamed,
                }
        return None

    def _compared(self, docs: Templates, p: np.ndarray, q: np.ndarray) -> tuple[int, int, bool]:
        """Slots of the item that were met, how many have other values, and whether that is
        consistent: enough keep their value, or enough follow a map that is one to one.

        The map takes each value of the item to one value of the document and no two to the
        same. It is made of the pairs of values met most often, equal values first. Two thirds
        of all slots must follow it, and ``COVERAGE`` of those whose value fills several. So
        where no value fills several slots, other values count if they mostly differ among
        themselves.
        """
        there = (q[:, None] + np.arange(WINDOW)).ravel()
        here = (p[:, None] + np.arange(WINDOW)).ravel()
        held = self.items.kinds[there] > 0
        pairs = dict(zip(there[held].tolist(), here[held].tolist(), strict=True))
        met: Counter[tuple[str, str]] = Counter()
        names = set()
        for there, here in pairs.items():
            value, other = _value(self.items, there), _value(docs, here)
            met[value, other] += 1
            if value != other or self.items.slot[there]:
                names.add(value)
        # What only begins sentences and stays as it is may be any word.
        met = Counter({k: n for k, n in met.items() if k[0] in names})
        times: Counter[str] = Counter()
        for (value, _), n in met.items():
            times[value] += n
        slots = times.total()
        renamed = sum(n for (value, other), n in met.items() if value != other)
        taken, given, follow, several = set(), set(), 0, 0
        for (value, other), n in sorted(met.items(), key=lambda x: (-x[1], x[0][0] != x[0][1], x[0])):
            if value not in taken and other not in given:
                taken.add(value)
                given.add(other)
                follow += n
                several += n * (times[value] > 1)
        return slots, renamed, (
            slots - renamed >= COVERAGE * slots
            or follow >= ONE_TO_ONE * slots
            and several >= COVERAGE * sum(n for n in times.values() if n > 1)
        )


def _equal(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal values in ``hashes`` and in the sorted ``known``."""
    low = np.searchsorted(known, hashes)
    number = np.searchsorted(known, hashes, "right") - low
    nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    return np.repeat(np.arange(len(hashes)), number), np.repeat(low, number) + nth


def _value(of: Templates, at: int) -> str:
    return of.tokens[of.owner[at]][of.index[at]].lower()


LEAKS = "array<struct<item_id: bigint, matched: int, windows: int, slots: int, renamed: int>>"


def with_leaks(docs: DataFrame, benchmark: DataFrame, column: str = "leaks") -> DataFrame:
    """``docs`` with the benchmark items each holds as the array ``column``.

    An entry has ``item_id``, how many of the item's ``windows`` were ``matched``, how many
    ``slots`` these have, and how many of them hold another value (``renamed``). Null and
    empty texts hold nothing. Items of fewer than five tokens count as one window and are
    held where all their words and values are, upper case aside; repeated items are found
    each. Other columns are carried along untouched; one named ``column`` is replaced.

    The benchmark is sent to the executors in blocks of about ``BLOCK_BYTES``, with a pass
    over the documents for each. Where there are several, what a block finds is stored and
    the block released before the next one is read.
    """
    docs = docs.drop(column)
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    if blocks == 1:
        return _looked_up(docs, _shared(items), column)
    kept = docs.columns
    number, found = new_name(docs, "number"), new_name(docs, "found")
    docs = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered-documents")
    parts = []
    for k in range(blocks):
        block = _shared(items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k))
        leaks = _looked_up(docs.select(number, "text"), block, column)
        parts.append(stored(leaks.filter(F.size(column) > 0).select(number, column), "leaks"))
        block.unpersist()
    every = reduce(DataFrame.unionByName, parts).groupBy(number).agg(F.flatten(F.collect_list(column)).alias(found))
    nothing = F.array().cast(_leaks_type(docs))
    return docs.join(every, number, "left").select(*kept, F.coalesce(found, nothing).alias(column))


def _shared(items: DataFrame) -> Broadcast:
    """One block of the benchmark on the executors."""
    rows = [(r.item_id, r.text.encode()) for r in items.collect()]
    return items.sparkSession.sparkContext.broadcast(rows)


def _looked_up(docs: DataFrame, shared: Broadcast, column: str) -> DataFrame:
    place = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField(column, _leaks_type(docs))])
    entry = pa.struct(
        [("item_id", pa.int64())]
        + [(n, pa.int32()) for n in ("matched", "windows", "slots", "renamed")]
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Benchmark(shared.value)
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for first, texts in text_slices(batch.column(place)):
                for k, leak in known.leaks(templates(texts)):
                    found[first + k].append(leak)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(entry))],
                names=[*batch.schema.names, column],
            )

    return docs.mapInArrow(tidy(look, forget=False), schema)


def _leaks_type(docs: DataFrame):
    return docs.sparkSession.range(0).select(F.expr(f"cast(null AS {LEAKS})")).schema[0].dataType


def leaked_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item it holds: ``doc_id`` and the entry."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark, "leak")
    return found.select("doc_id", F.inline("leak"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are."""
    column = new_name(docs, "leaks")
    return with_leaks(docs, benchmark, column).filter(F.size(column) == 0).drop(column)

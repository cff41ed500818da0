"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Lengths run from 1 to the capacity, so how many pieces have each length is a table of at
most ``capacity`` rows however large the corpus is. The bins are planned on that table:

* pieces longer than a third of the capacity share a bin with at most one of their kind;
  the longest is matched greedily with the longest that still fits beside it;
* shorter pieces go, longest first, into the smallest gap that holds them.

The plan says which ranks of a length go to which run of bins. Spark numbers the pieces of
each length and looks their places up, so no task sees more than its share of the pieces.
"""

from __future__ import annotations

import codecs
import json
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from innledger.llm.common import Recent, numbered, slices, stored, text_list

PIECES = "doc_id long, piece int, start long, length long, ids binary"
#: Words encoded at once; the encoder returns far more than the ids.
ENCODED = 4096
#: Words cut into parts at once; parts that they share are encoded once.
CUT = 32_768
#: Tokens of the words seen lately are kept between batches: about so many words.
CACHED_WORDS = 1_000_000

#: The preparation of texts that ``_part_ids`` repeats; other tokenizers do all of it themselves.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Signs other than those of ASCII that show and the Latin letters from U+00C0 to U+017F, without
#: the one that becomes two in lower case. NFC leaves the rest as it is, next to each other too.
ODD = "[^!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]"
#: The same split, for words in lower case without odd signs; line breaks part the words.
LETTERS = "a-z\u00df-\u00f6\u00f8-\u017f"
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}\n]+|\n")
#: How the vocabulary spells each byte.
SPELLED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTES = "".join(
    chr(b if b in SPELLED else 0x100 + sum(x not in SPELLED for x in range(b))) for b in range(256)
)
#: Ends the ids of a word, where those of many words follow each other.
WORD_END = 0xFFFFFFFF


def _whole_ids(tokenizer: Tokenizer) -> Callable[[list[str]], list[bytes]]:
    """Each word as the tokenizer encodes it, all its steps included."""

    def encode(words: list[str]) -> list[bytes]:
        ids = []
        for at in range(0, len(words), ENCODED):
            found = tokenizer.encode_batch_fast(words[at : at + ENCODED], add_special_tokens=False)
            ids += [array("I", x.ids).tobytes() for x in found]
        return ids

    return encode


def _part_ids(tokenizer: Tokenizer) -> Callable[[list[str]], list[bytes]]:
    """Words without odd signs, cut into the parts that the tokenizer's model merges within.

    Most of a tokenizer's time goes into preparing each word. Here the model gets many distinct
    parts as one text; every part ends in a token with the vocabulary's suffix.
    """
    model = Tokenizer(tokenizer.model)
    model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(BYTES[10])
    suffix = tokenizer.model.end_of_word_suffix
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    last = np.zeros(max(vocabulary.values()) + 1, bool)
    last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    word_end = np.array([WORD_END], "<u4").tobytes()

    def runs(ids: np.ndarray, ends: np.ndarray, left_out: int) -> list[bytes]:
        """The ids before each of ``ends``, without the last ``left_out`` of them."""
        data, ends = ids.tobytes(), 4 * ends
        starts = np.r_[0, ends[:-1]].tolist()
        return [data[a:b] for a, b in zip(starts, (ends - 4 * left_out).tolist(), strict=True)]

    def merged(parts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(parts), ENCODED):
            text = "\n".join(parts[at : at + ENCODED]).encode()
            text = codecs.charmap_decode(text, "strict", BYTES)[0]
            (found,) = model.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            yield from runs(ids, np.flatnonzero(last[ids]) + 1, 0)

    def encode(words: list[str]) -> list[bytes]:
        ids = []
        for at in range(0, len(words), CUT):
            cut = PARTS.findall("\n".join([*words[at : at + CUT], ""]).lower())
            parts = list({*cut} - {"\n"})
            known = dict(zip(parts, merged(parts), strict=True)) | {"\n": word_end}
            found = np.frombuffer(b"".join(map(known.__getitem__, cut)), "<u4")
            ids += runs(found, np.flatnonzero(found == WORD_END) + 1, 1)
        return ids

    return encode


@lru_cache(maxsize=1)
def _word_ids(path: str) -> Recent:
    tokenizer = Tokenizer.from_file(path)
    whole = _whole_ids(tokenizer)
    rules = json.loads(tokenizer.to_str())
    names = rules["added_tokens"]
    if (
        rules["normalizer"] != NORMALIZER
        or rules["pre_tokenizer"] != PRE_TOKENIZER
        or rules["model"].get("dropout")
        or not rules["model"].get("end_of_word_suffix")
        or any(x["normalized"] for x in names)
    ):
        return Recent(lambda words: whole([w.decode("utf-8", "replace") for w in words]), CACHED_WORDS)
    by_parts = _part_ids(tokenizer)
    # Names of special tokens are found as they are spelled, before anything else.
    odd = re.compile("|".join([ODD, *(re.escape(x["content"]) for x in names)])).search

    def encode(words: list[bytes]) -> Iterable[bytes]:
        text = b"\n".join(words).decode("utf-8", "replace")
        texts = text.split("\n") if words else []
        if not odd(text.replace("\n", "")):
            return by_parts(texts)
        is_odd = [odd(x) is not None for x in texts]
        slow = iter(whole(list(compress(texts, is_odd))))
        fast = iter(by_parts([x for x, by in zip(texts, is_odd, strict=True) if not by]))
        return (next(slow if by else fast) for by in is_odd)

    return Recent(encode, CACHED_WORDS)


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0
) -> DataFrame:
    """Token ids of every text, cut into pieces of at most ``capacity`` tokens.

    Takes ``doc_id`` and ``text``; other columns are ignored. Every document ends in
    ``end_id``, so an empty or null text is one piece of one token. A document that fits is
    one piece; a longer one is cut every ``capacity`` tokens. Repeated rows give repeated
    pieces, a null id stays null. ``ids`` holds little-endian unsigned 32-bit integers.

    The vocabulary must not join across white space: texts are split there first, and words
    met before are not encoded again.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
            ("length", pa.int64()), ("ids", pa.binary()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = _word_ids(tokenizer_path)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), text_list(batch.column(1))
            for first, last in slices(texts):
                words = [x.split() for x in texts[first:last]]
                found = iter(recent.values_of(list(chain.from_iterable(words))))
                out = []
                for doc_id, own in zip(doc_ids[first:last], words, strict=True):
                    ids = b"".join([*islice(found, len(own)), end])
                    out += [
                        (doc_id, k, at // 4, len(part) // 4, part)
                        for k, at in enumerate(range(0, len(ids), step))
                        for part in (ids[at : at + step],)
                    ]
                columns = zip(*out, strict=True)
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def planned_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Runs of bins for pieces of each length: (length, first rank, pieces, first bin,
    pieces a bin, place in the bin)."""
    left = {n: c for n, c in counts.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    runs: list[tuple[int, ...]] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}  # gap: (first bin, bins)
    gaps: list[int] = []
    bins = 0

    def keep(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in open_bins:
                insort(gaps, gap)
                open_bins[gap] = []
            open_bins[gap].append((first, number))

    def put(length: int, number: int, first: int, each: int, place: int) -> None:
        runs.append((length, taken[length], number, first, each, place))
        taken[length] += number
        left[length] -= number

    large = sorted(n for n in left if 3 * n > capacity)
    for a in reversed(large):
        while left[a]:
            fits = bisect_left(large, capacity - a + 1) - 1
            while fits >= 0 and (not left[large[fits]] or large[fits] > a):
                fits -= 1
            b = large[fits] if fits >= 0 else None
            if b is None or (b == a and left[a] == 1):
                smaller = [x for x in large[: max(fits, 0)] if left[x]] if b == a else []
                b = smaller[-1] if smaller else None
            number = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
            put(a, number, bins, 1, 0)
            if b is not None:
                put(b, number, bins, 1, a)
            keep(capacity - a - (b or 0), bins, number)
            bins += number
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(gaps, n)
            if at == len(gaps):  # no gap holds it
                number = -(-left[n] // (capacity // n))
                keep(capacity, bins, number)
                bins += number
                continue
            gap = gaps[at]
            first, number = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap], gaps[at]
            each = min(gap // n, left[n])
            used = min(number, left[n] // each)
            put(n, used * each, first, each, capacity - gap)
            keep(gap - each * n, first, used)
            keep(gap, first + used, number - used)
    return runs


def packed(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Place every row of ``pieces`` in a sequence: adds ``sequence_id`` and ``offset``.

    ``length`` must lie between 1 and ``capacity``; all other columns are carried along.
    Pieces of a sequence follow each other without gaps from offset 0. Which of several
    pieces of one length goes where is arbitrary. An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    own = numbered(pieces)
    length = f"_{pieces.columns.index('length')}"
    rows = stored(own.withColumn("__row", F.monotonically_increasing_id()), "pieces").withColumn(
        "__part", F.shiftright("__row", 33)
    )
    # A length that a third of all pieces share is numbered part by part.
    counts = rows.groupBy("__part", F.col(length).alias("__length")).agg(
        F.count("*").alias("__n")
    )
    by_length = {r[0]: r[1] for r in counts.groupBy("__length").agg(F.sum("__n")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in by_length):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    runs = spark.createDataFrame(
        planned_bins(by_length, capacity),
        "__run_length long, __first long, __pieces long, __bin long, __each long, __place long",
    )
    before = Window.partitionBy("__length").orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = counts.select(
        F.col("__part").alias("__own_part"),
        "__length",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
    )
    within = Window.partitionBy("__part", length).orderBy("__row")
    ranked = rows.withColumn("__rank", F.row_number().over(within) - 1)
    placed = ranked.join(
        starts,
        (F.col("__part") == F.col("__own_part")) & (F.col(length) == F.col("__length")),
    ).withColumn("__rank", F.col("__rank") + F.col("__start"))
    at = F.col("__rank") - F.col("__first")
    return (
        # A few runs for each length: their number is bounded by the capacity.
        placed.join(
            F.broadcast(runs), (F.col(length) == F.col("__run_length")) & (at >= 0) & (at < F.col("__pieces"))
        )
        .withColumn("sequence_id", F.col("__bin") + F.floor(at / F.col("__each")).cast("long"))
        .withColumn("offset", F.col("__place") + at % F.col("__each") * F.col(length))
        .select(*own.columns, "sequence_id", "offset")
        .toDF(*pieces.columns, "sequence_id", "offset")
    )


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """The token ids of every sequence, joined in order; needs the column ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        packed_pieces.groupBy("sequence_id")
        .agg(parts.alias("parts"), F.sum("length").alias("length"))
        .select(
            "sequence_id",
            "length",
            F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        )
    )

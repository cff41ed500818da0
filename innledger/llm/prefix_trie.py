"""The prefix trie of a table of conversations: what a cache of shared beginnings would save.

A turn is known by a 16-byte digest of its role and text, so texts stay where they are. A
conversation is one row, the digests and sizes of its turns (about 24 bytes a turn). Rows
are dealt by ranges of (digests, id), so the conversations that share a beginning lie side by
side and the copies of one may lie in many shards. In a shard the digests get dense numbers
in the order of the digests (a dictionary), and the distinct sequences go into a ternary
search tree, medians first, which keeps the search among siblings balanced. One backward pass
over the nodes in the order of their making adds up members, leaves and savings.

Only what a shard's first sequence has in common with the last of the shard before, and its
last with the first of the shard after, lies in several shards. Each such boundary node is
opened in one shard and closed in one: the opening shard counts it as a child and takes off
its first use, the closing one knows if it is a leaf. So the parts of a boundary node are
plain sums, and meet in one aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.llm.common import stored

#: Turns of a shard; its tree takes a few hundred bytes a turn.
SHARD_TURNS = 1 << 17
#: Conversation ids of a row of a long list of them.
CHUNK = 4096
_NODES = (
    "key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long,"
    " n_children long, n_leaves long, saved_tokens long, ends_sha256 string,"
    " shard long, ends array<string>"
)
_EMPTY = sha256(b"").hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``keys`` and ``sizes``: each conversation's turns in order.

    Turns of one number are ordered by their digests; rows without a conv_id belong to no
    conversation. Null roles and texts are empty.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    written = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    key = F.substring(F.unhex(F.sha2(written.cast("binary"), 256)), 1, 16)
    listed = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", key.alias("key"), F.octet_length(text).alias("size")).alias("turn"),
    )
    in_order = listed.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("t"))
    return in_order.selectExpr("conv_id", "t.key AS keys", "t.size AS sizes")


def rebuilt(own: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations whose beginnings come from others.

    Conversation c gets the first h turns of conversation c - c % ``every`` (fewer or none
    where it has not so many or is absent), then its own turns after its first h; h is the
    crc32 of c as text modulo ``most``.
    """
    heads = own.select(
        F.col("conv_id").alias("base"),
        F.slice("keys", 1, most - 1).alias("head_keys"),
        F.slice("sizes", 1, most - 1).alias("head_sizes"),
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    both = own.withColumns(
        {"h": h.cast("int"), "base": F.expr(f"conv_id - conv_id % {every}")}
    ).join(heads, "base", "left")
    return both.selectExpr(
        "conv_id",
        *(
            f"concat(coalesce(slice(head_{c}, 1, h), slice({c}, 1, 0)),"
            f" slice({c}, h + 1, greatest(size({c}) - h, 0))) AS {c}"
            for c in ("keys", "sizes")
        ),
    )


class TernaryTree:
    """Sequences of small numbers in a ternary search tree.

    A node stands for a prefix; node 0 for the empty one. ``equal`` leads to the search tree
    of its children, ``low`` and ``high`` to siblings with smaller and larger symbols.
    """

    def __init__(self):
        self.symbol, self.low, self.equal, self.high = [-1], [-1], [-1], [-1]
        self.parent, self.depth = [-1], [0]

    def child(self, node: int, symbol: int) -> int:
        """The child of ``node`` by this symbol, made if there is none."""
        links, at = self.equal, node
        while (found := links[at]) >= 0:
            other = self.symbol[found]
            if symbol == other:
                return found
            links, at = (self.low if symbol < other else self.high), found
        made = links[at] = len(self.symbol)
        self.symbol.append(symbol)
        for link in (self.low, self.equal, self.high):
            link.append(-1)
        self.parent.append(node)
        self.depth.append(self.depth[node] + 1)
        return made

    def path(self, sequence: list[int]) -> list[int]:
        """The nodes of all prefixes, from the empty one on."""
        nodes = [0]
        for symbol in sequence:
            nodes.append(self.child(nodes[-1], symbol))
        return nodes


def medians_first(n: int) -> Iterator[int]:
    """The numbers below ``n``, each range's middle before its halves."""
    ranges = [(0, n)]
    while ranges:
        first, stop = ranges.pop()
        if first < stop:
            middle = (first + stop) // 2
            yield middle
            ranges += [(middle + 1, stop), (first, middle)]


def _common(a: list | None, b: list | None) -> int:
    """The length of the common prefix; -1 where there is no other sequence."""
    if a is None or b is None:
        return -1
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def _shard_nodes(rows: pa.Table, ends: pa.Table, chunk: int) -> pa.Table:
    """The nodes of a shard: whole, or, where other shards have them too, this shard's part."""
    about = ends.to_pylist()[0]
    convs = rows.column("conv_id").to_pylist()
    keys, sizes = rows.column("keys").to_pylist(), rows.column("sizes").to_pylist()
    order = sorted(range(len(convs)), key=lambda i: (keys[i], convs[i]))
    number = {key: i for i, key in enumerate(sorted({k for row in keys for k in row}))}
    distinct: list[tuple[list, list]] = []  # rows' first number, ids that end there
    for i in order:
        if distinct and keys[distinct[-1][0]] == keys[i]:
            distinct[-1][1].append(convs[i])
        else:
            distinct.append((i, [convs[i]]))

    tree = TernaryTree()
    size, ending = {0: 0}, {}
    for i in medians_first(len(distinct)):
        row, ids = distinct[i]
        path = tree.path([number[k] for k in keys[row]])
        for node, n in zip(path[1:], sizes[row], strict=True):
            size[node] = n
        ending[path[-1]] = ids

    first, last = keys[order[0]], keys[order[-1]]
    from_before, to_after = _common(first, about["before"]), _common(last, about["after"])
    prefix_key, opened, open_still = {}, set(), set()
    for sequence, shared, marked in ((first, from_before, opened), (last, to_after, open_still)):
        digest = sha256()
        path = tree.path([number[k] for k in sequence])
        for depth in range(shared + 1):
            if depth:
                digest.update(sequence[depth - 1])
            prefix_key[path[depth]] = digest.digest()
            marked.add(path[depth])

    n = len(tree.symbol)
    members, least, children = [0] * n, [None] * n, [0] * n
    leaves, saved = [0] * n, [0] * n
    out: dict[str, list] = {name.split()[0]: [] for name in _NODES.split(", ")}
    for node in range(n - 1, -1, -1):
        ids = ending.get(node, ())
        members[node] += len(ids)
        if ids and (least[node] is None or ids[0] < least[node]):
            least[node] = ids[0]
        if tree.equal[node] < 0 and node not in open_still:
            leaves[node] += 1
        saved[node] += (members[node] - (node not in opened)) * size[node]
        up = tree.parent[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            children[up] += node not in opened
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    for node in range(n):
        ids, key, up = ending.get(node, ()), prefix_key.get(node), tree.parent[node]
        out["key"].append(key)
        out["parent_key"].append(prefix_key.get(up))
        out["conv_id"].append(least[node])
        out["depth"].append(tree.depth[node])
        whole = up >= 0 and up not in prefix_key
        out["parent_conv_id"].append(least[up] if whole else None)
        out["n_convs"].append(members[node])
        out["n_children"].append(children[node])
        out["n_leaves"].append(leaves[node])
        out["saved_tokens"].append(saved[node])
        listed = [",".join(map(str, ids[i : i + chunk])) for i in range(0, len(ids), chunk)]
        out["ends_sha256"].append(
            sha256(",".join(listed).encode()).hexdigest() if key is None else None
        )
        out["shard"].append(about["shard"])
        out["ends"].append(listed if key is not None else None)
    types = {"key": pa.binary(), "parent_key": pa.binary(), "ends_sha256": pa.string()}
    types["ends"] = pa.list_(pa.string())
    return pa.table({c: pa.array(v, types.get(c, pa.int64())) for c, v in out.items()})


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's chunks, which come one after the other in their order."""
    last, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([last], pa.binary()), pa.array([digest.hexdigest()])], ["key", "digest"]
        )

    for batch in batches:
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key != last:
                if last is not None:
                    yield row()
                last, digest = key, sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if last is not None:
        yield row()


def trie(
    conversations: DataFrame, shard_turns: int = SHARD_TURNS, chunk: int = CHUNK
) -> DataFrame:
    """One row per node of the trie of ``sequences``-like rows (conv_id, keys, sizes).

    ``conv_id`` is the smallest member; with ``depth`` it names a node. No conversations
    give no rows, not even the root. ``conv_id`` must be unique.
    """
    sequences = stored(conversations.select("conv_id", "keys", "sizes"), "sequences")
    turns = sequences.agg(F.sum(F.size("keys") + 1)).first()[0] or 1
    shards = -(-turns // shard_turns)
    dealt = sequences.repartitionByRange(shards, "keys", "conv_id")
    dealt = stored(dealt.withColumn("shard", F.spark_partition_id().cast("long")), "shards")
    ends = dealt.groupBy("shard").agg(F.min("keys").alias("first"), F.max("keys").alias("last"))
    ends = ends.selectExpr(  # one row a shard
        "shard",
        "lag(last) OVER (ORDER BY shard) AS before",
        "lead(first) OVER (ORDER BY shard) AS after",
    )

    def shard_nodes(rows: pa.Table, ends: pa.Table) -> pa.Table:
        return _shard_nodes(rows, ends, chunk)

    parts = dealt.groupBy("shard").cogroup(ends.groupBy("shard"))
    nodes = stored(parts.applyInArrow(shard_nodes, _NODES), "trie-nodes")

    boundary = nodes.filter("key IS NOT NULL")
    chunks = boundary.select("key", "shard", F.posexplode("ends").alias("chunk", "ids"))
    one_by_one = chunks.repartition("key").sortWithinPartitions("key", "shard", "chunk")
    digests = one_by_one.select("key", "ids").mapInArrow(
        _list_digests, "key binary, digest string"
    )
    merged = boundary.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    merged = merged.join(digests, "key", "left").withColumn(
        "ends_sha256", F.coalesce("digest", F.lit(_EMPTY))
    )
    merged = stored(merged.drop("digest"), "boundary-nodes")
    parents = merged.select(
        F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_of_shards")
    )
    whole = nodes.filter("key IS NULL").select(merged.columns)
    result = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    ]
    across = whole.filter("parent_key IS NOT NULL").unionByName(merged)
    across = across.join(parents, "parent_key", "left").withColumn(
        "parent_conv_id", F.col("parent_of_shards")
    )
    return whole.filter("parent_key IS NULL").select(result).unionByName(across.select(result))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    return trie(rebuilt(stored(sequences(conversations), "conversations")))

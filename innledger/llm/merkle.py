"""A Merkle manifest: one root for a dataset, and for every row the witness that it is part.

Rows form trees (here one per language), each ordered by a key; eight consecutive nodes
become their parent until one node, the subroot, is left. The subroots, ordered by the name
of their tree, form one more tree, whose top is the root.

Trees grow by appends. ``OpenTree`` takes nodes one after the other and keeps the subtrees
that still wait for siblings open, each leaf below them with the part of its witness that is
known; a run of eight that completes extends the witnesses of all leaves below it. On Spark
the appends of a tree are cut into aligned blocks of 8**4 nodes, which touch no other
block's runs. A block's root is then one append to the tree above, whose blocks are cut
alike, and so on: three rounds reach 6.9e10 rows. On the way back every block hands its own
witness to the nodes below it. No task sees more than a block, whatever share of the rows a
tree or a key holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from innledger.llm.common import stored

ARITY = 8
#: Levels of a block. Blocks hold so many nodes that a Spark group is worth its while.
BLOCK_LEVELS = 4
_NODE = "tree string, position long, total long, digest string"
_WITNESS = "before array<string>, after array<string>"


def node(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(nodes: int) -> int:
    """Levels above ``nodes`` nodes until one is left."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


class OpenTree:
    """A tree that grows by appended nodes.

    ``witness[i]`` is what is known of leaf ``i``'s witness: for each closed run above it
    the siblings before and after, from the bottom up.
    """

    def __init__(self):
        self.witness: list[list[tuple[str, str]]] = []
        self.open: list[list[tuple[str, int]]] = [[]]  # by level: digest, first leaf below

    def append(self, digest: str) -> None:
        self.witness.append([])
        self._add(0, digest, len(self.witness) - 1)

    def _add(self, level: int, digest: str, first: int) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((digest, first))
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """Extend the witnesses below an open run and append its parent one level up."""
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in run]
        ends = [first for _, first in run[1:]] + [len(self.witness)]
        for i, (_, first) in enumerate(run):
            step = "".join(digests[:i]), "".join(digests[i + 1 :])
            for leaf in range(first, ends[i]):
                self.witness[leaf].append(step)
        self._add(level + 1, node(*digests), run[0][1])

    def closed(self, levels: int) -> str:
        """The top after ``levels`` levels, short last runs completed."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        ((top, _),) = self.open[levels]
        return top


def _grown(block: pa.Table, levels: int) -> tuple[OpenTree, str]:
    """The tree of a block's rows, which are sorted by position, and its top."""
    tree = OpenTree()
    for digest in block.column("digest").to_pylist():
        tree.append(digest)
    total = block.column("total")[0].as_py()
    return tree, tree.closed(min(levels, height(total)))


def _block_root(block: pa.Table, levels: int) -> pa.Table:
    block, size = block.sort_by("position"), ARITY**levels
    _, top = _grown(block, levels)
    first = block.slice(0, 1).to_pylist()[0]
    return pa.table(
        {
            "tree": [first["tree"]],
            "position": pa.array([first["position"] // size], pa.int64()),
            "total": pa.array([-(-first["total"] // size)], pa.int64()),
            "digest": [top],
        }
    )


def _with_witness(block: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    """The rows of a block with their whole witness: within it, then the block's own."""
    block = block.sort_by("position")
    tree, _ = _grown(block, levels)
    lists = pa.list_(pa.string())
    for part, name in enumerate(("before", "after")):
        rest = above.column(name)[0].as_py()
        found = [[step[part] for step in steps] + rest for steps in tree.witness]
        block = block.append_column(name, pa.array(found, lists))
    return block.drop_columns(["block"])


def _numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Each row's position in its ``tree`` by ``order``, and the tree's total, stored.

    Rows are dealt by ranges of (tree, order), numbered in each range, and moved on by what
    lies in the ranges before. Equal rows are interchangeable; a row number spreads them.
    """
    spread = df.withColumn("spread", F.monotonically_increasing_id())
    keys = ["tree", *order, "spread"]
    ranges = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    schema = StructType([*ranges.schema.fields]).add("part", "long").add("place", "long")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, place = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            found = []
            for tree in batch.column("tree").to_pylist():
                place = place + 1 if tree == last else 0
                last = tree
                found.append(place)
            batch = batch.append_column("part", pa.array([part] * len(found), pa.int64()))
            yield batch.append_column("place", pa.array(found, pa.int64()))

    rows = stored(ranges.mapInArrow(places, schema), "places")
    counts = rows.groupBy("tree", "part").agg(F.count("*").alias("n"))
    before = counts.selectExpr(
        "tree",
        "part",
        "sum(n) OVER (PARTITION BY tree ORDER BY part) - n AS before",
        "sum(n) OVER (PARTITION BY tree) AS total",
    )
    return rows.join(before, ["tree", "part"]).select(
        *df.columns, (F.col("before") + F.col("place")).alias("position"), "total"
    )


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"position div {ARITY**levels}"))


def _grown_up(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """The block roots of round after round, until each tree is one node."""

    def root(block: pa.Table) -> pa.Table:
        return _block_root(block, levels)

    rounds, nodes = [], leaves.select("tree", "position", "total", "digest")
    while True:
        roots = _blocks(nodes, levels).groupBy("tree", "block").applyInArrow(root, _NODE)
        nodes = stored(roots, "block-roots")
        rounds.append(nodes)
        if (nodes.agg(F.max("total")).first()[0] or 0) <= 1:
            return rounds


def _witnessed(
    leaves: DataFrame, rounds: list[DataFrame], tops: DataFrame, levels: int
) -> DataFrame:
    """``leaves`` with ``before`` and ``after``; ``tops`` has those of every tree's top."""

    def extended(block: pa.Table, above: pa.Table) -> pa.Table:
        return _with_witness(block, above, levels)

    above = tops.select("tree", F.lit(0).cast("long").alias("block"), "before", "after")
    for nodes in [*reversed(rounds[:-1]), leaves]:
        schema = StructType(nodes.schema.fields + StructType.fromDDL(_WITNESS).fields)
        blocks = _blocks(nodes, levels).groupBy("tree", "block")
        witnessed = blocks.cogroup(above.groupBy("tree", "block")).applyInArrow(extended, schema)
        above = witnessed.select("tree", F.col("position").alias("block"), "before", "after")
    return witnessed


def manifest(
    df: DataFrame, tree: str, order: list[str], digest: str, levels: int = BLOCK_LEVELS
) -> DataFrame:
    """``df`` with ``position``, ``subroot``, ``root`` and ``witness``.

    ``digest`` is the column with a row's leaf; ``tree`` names the tree it belongs to (null
    is a tree of its own, which comes first), in which rows ascend by ``order`` (nulls
    first) and then by their digests. ``witness`` is an array of (before, after): the
    siblings to the left and right, concatenated, from the bottom up to the root. Blocks have
    ``levels`` levels. An empty ``df`` gives no rows. Columns of ``df`` keep their names, whatever they are; those of
    the result must be free.
    """
    inner = {name: f"_{i}" for i, name in enumerate(df.columns)}
    plain = df.toDF(*inner.values())
    # Never null, and sorts as the name does, null first.
    name = F.coalesce(F.concat(F.lit("="), F.col(inner[tree]).cast("string")), F.lit(""))
    plain = plain.withColumns({"tree": name, "digest": F.col(inner[digest])})
    leaves = _numbered(stored(plain, "leaves"), [inner[c] for c in order] + ["digest"])
    rounds = _grown_up(leaves, levels)

    subroots = rounds[-1].select(F.col("tree").alias("name"), "digest")
    subroots = _numbered(subroots.withColumn("tree", F.lit("")), ["name"])
    top_rounds = _grown_up(subroots, levels)
    root = top_rounds[-1].select("tree", F.col("digest").alias("root"))  # one row
    nothing = F.array().cast("array<string>")
    top = top_rounds[-1].select("tree", nothing.alias("before"), nothing.alias("after"))
    tops = stored(
        _witnessed(subroots, top_rounds, top, levels)
        .join(root, "tree")
        .select("name", F.col("digest").alias("subroot"), "before", "after", "root"),
        "subroots",
    )
    found = _witnessed(leaves, rounds, tops.withColumnRenamed("name", "tree"), levels)
    about = tops.select(F.col("name").alias("tree"), "subroot", "root")
    return found.join(about, "tree").select(
        *(F.col(i).alias(c) for c, i in inner.items()),
        "position",
        "subroot",
        "root",
        F.arrays_zip("before", "after").alias("witness"),
    )


def folded(leaf: str, witness: str = "witness") -> Column:
    """The root that a leaf and its witness lead to."""
    return F.expr(
        f"aggregate({witness}, {leaf}, (d, w) -> sha2(concat(w.before, d, w.after), 256))"
    )


def proof_digest(witness: str = "witness") -> Column:
    """A digest of all siblings, level by level, left to right."""
    return F.expr(
        f"sha2(array_join(transform({witness}, w -> concat(w.before, w.after)), ''), 256)"
    )


def field_digest(columns: list[Column]) -> Column:
    """The digest of a row: each value with its length in bytes before it, null as ``-``."""
    fields = []
    for column in columns:
        value = column.cast("string")
        written = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        fields.append(F.coalesce(written, F.lit("-")))
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def tamper_report(docs: DataFrame) -> DataFrame:
    """Every document's leaf, proof and what a tampered text does to it.

    Tampered are the texts of documents whose id's crc32 three divides: A to Z in lower
    case. A null id is not tampered with; a null text stays null. Repeated rows are leaves
    of their own. Columns other than the five of ``documents`` are left out.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    about = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = field_digest([*about, F.translate("text", upper, upper.lower())])
    leaves = docs.select(
        "doc_id", "lang", field_digest([*about, F.col("text")]).alias("leaf"),
        F.when(hit, lowered).alias("tampered"),
    )
    found = manifest(leaves, "lang", ["doc_id"], "leaf").withColumn(
        "presented", F.coalesce("tampered", "leaf")
    )
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"),
        folded("presented").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

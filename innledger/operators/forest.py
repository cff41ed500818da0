"""A random forest of regression trees as groupings, windows and joins.

A regression tree needs of its training rows only how much they weigh and add up to per
combination of feature values. So the rows are read once: every row gets a bootstrap weight
for each tree, Poisson distributed by a digest of its id, and weights and labels are added up
per tree and combination. All trees then grow together on that table, a level a job: sums per
feature value, running sums in their order, the split with the largest gain.

Sums are exact, weights come from digests and ties go to the first feature and the
lowest threshold, so the same table gives the same trees on any cluster, in any partitioning
and in any engine. The forest is a table with a row per node; applying it is a join a level,
and rows with the same feature values are scored once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.session import stored

#: Hexadecimal digits of a digest that make one weight, and weights of a digest.
_DIGITS = 4
_WEIGHTS = 64 // _DIGITS
#: A split must lower the sum of squares by more than this share of the squared sum.
LEAST_GAIN = 1e-9
#: Sums are exact because labels are taken in whole hundredths; a sum of labels above 9e16
#: fails the query.
HUNDRED = 100
#: Values of nodes are whole millionths, so that their mean over the trees is exact too.
MILLION = 1_000_000
#: The root of each tree; a node's children are twice its number, and the one after.
ROOT = 1


def poisson_thresholds(digits: int = _DIGITS) -> list[str]:
    """Digits from which on a weight is more than 0, more than 1 and so on.

    A weight is Poisson distributed with mean 1, as the number of times that a row is drawn
    in a large sample with replacement.
    """
    found, below, term, k = [], 0.0, math.exp(-1), 0
    while (cut := round((below := below + term) * 16**digits)) < 16**digits:
        found.append(f"{cut:0{digits}x}")
        k += 1
        term /= k
    return found


def bootstrap(df: DataFrame, key: str, label: str, trees: int, seed: int, by: Sequence[str]):
    """``tree``, the columns ``by``, ``weight`` and ``total``: the weighted sum of the label
    in hundredths.

    Combines before the shuffle; its size depends on the combinations, not on the rows.
    """
    digests = math.ceil(trees / _WEIGHTS)
    blocks = df.select(
        *by,
        F.expr(f"CAST(round(`{label}` * {HUNDRED}) AS BIGINT)").alias("label"),
        F.col(key).cast("string").alias("key"),
        F.expr(f"explode(sequence(0, {digests - 1}))").alias("block"),
    ).withColumn("digest", F.expr(f"sha2(concat_ws('|', key, {seed}, block), 256)"))
    drawn = ", ".join(
        f"struct({i} AS i, substr(digest, {1 + i * _DIGITS}, {_DIGITS}) AS u)"
        for i in range(_WEIGHTS)
    )
    cuts = poisson_thresholds()
    times = " ".join(f"WHEN u < '{cut}' THEN {n}" for n, cut in enumerate(cuts))
    return (
        blocks.select(*by, "label", "block", F.expr(f"inline(array({drawn}))"))
        .filter(f"u >= '{cuts[0]}' AND block * {_WEIGHTS} + i < {trees}")
        .select(
            *by,
            "label",
            F.expr(f"block * {_WEIGHTS} + i AS tree"),
            F.expr(f"CASE {times} ELSE {len(cuts)} END AS n"),
        )
        .groupBy("tree", *by)
        .agg(F.expr("sum(n) AS weight"), F.expr("sum(n * label) AS total"))
    )


def _as_double(*columns: str) -> list[str]:
    return [f"CAST({c} AS DOUBLE) AS {c}" for c in columns]


def _splits(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """The best split of every (tree, node) that has one: ``feature`` and ``threshold``."""
    listed = ", ".join(
        f"struct({i} AS feature, CAST(`{c}` AS DOUBLE) AS value)" for i, c in enumerate(features)
    )
    sums = (
        rows.select("tree", "node", "weight", "total", F.expr(f"inline(array({listed}))"))
        .groupBy("tree", "node", "feature", "value")
        .agg(F.expr("sum(weight) AS weight"), F.expr("sum(total) AS total"))
    )
    in_order = "PARTITION BY tree, node, feature ORDER BY value"
    to_here = f"{in_order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    whole = f"{in_order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    sides = sums.selectExpr(
        "tree", "node", "feature", "value",
        f"lead(value) OVER ({in_order}) AS next",
        f"sum(weight) OVER ({to_here}) AS left_weight",
        f"sum(total) OVER ({to_here}) AS left_total",
        f"sum(weight) OVER ({whole}) AS weight",
        f"sum(total) OVER ({whole}) AS total",
    ).filter("next IS NOT NULL")
    gains = sides.selectExpr(
        "tree", "node", "feature", "(value + next) / 2 AS threshold",
        *_as_double("left_weight", "left_total", "weight", "total"),
        "CAST(weight - left_weight AS DOUBLE) AS right_weight",
        "CAST(total - left_total AS DOUBLE) AS right_total",
    ).selectExpr(
        "tree", "node", "feature", "threshold", "total * total / weight AS whole",
        # Spark may test this before the filter, and the last value has nothing above it.
        "left_total * left_total / left_weight"
        " + right_total * right_total / nullif(right_weight, 0) - total * total / weight AS gain",
    )
    best = gains.filter(f"gain > {LEAST_GAIN} * whole").groupBy("tree", "node").agg(
        F.expr("max(struct(gain, -feature AS feature, -threshold AS threshold)) AS best")
    )
    return best.selectExpr(
        "tree", "node", "-best.feature AS feature", "-best.threshold AS threshold"
    )


def _value(features: Sequence[str]) -> str:
    """The value of the feature whose number is in ``feature``."""
    cases = " ".join(f"WHEN {i} THEN CAST(`{c}` AS DOUBLE)" for i, c in enumerate(features))
    return f"CASE feature {cases} END"


def _below(features: Sequence[str]) -> str:
    return f"2 * node + CAST({_value(features)} > threshold AS INT)"


def grown(samples: DataFrame, features: Sequence[str], max_depth: int) -> DataFrame:
    """The nodes of the trees that grow on ``bootstrap`` rows.

    ``feature`` (a number) and ``threshold`` lead to the children of a node, the first for
    values up to the threshold; both are NULL in a leaf. ``weight`` is that of the training
    rows of the node, ``millionths`` their mean. Each level is stored before the next: a lost
    executor repeats one.
    """
    columns = ["tree", "node", *features, "weight", "total"]
    rows = samples.withColumn("node", F.lit(ROOT)).select(columns)
    levels = None
    for depth in range(max_depth + 1):
        # All that a level does is by tree and something else, so one exchange serves it.
        rows = rows.repartition("tree")
        if depth < max_depth:
            placed = rows.join(_splits(rows, features), ["tree", "node"], "left")
        else:
            empty = {"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double")}
            placed = rows.withColumns(empty)
        placed = stored(placed, "level")
        level = placed.select("tree", "node", "feature", "threshold", "weight", "total")
        levels = level if levels is None else levels.unionByName(level)
        rows = placed.filter("feature IS NOT NULL")
        rows = rows.withColumn("node", F.expr(_below(features))).select(columns)
    nodes = levels.groupBy("tree", "node").agg(
        F.expr("any_value(feature) AS feature"),
        F.expr("any_value(threshold) AS threshold"),
        F.expr("sum(weight) AS weight"),
        F.expr("sum(total) AS total"),
    )
    mean = f"CAST(total AS DOUBLE) / CAST(weight AS DOUBLE) * {MILLION // HUNDRED}"
    return nodes.selectExpr(
        "tree", "node", "feature", "threshold", "weight",
        f"CAST(floor({mean} + 0.5) AS BIGINT) AS millionths",
    )


def depth(nodes: DataFrame) -> int:
    """The depth of the deepest tree."""
    return max((nodes.agg(F.max("node")).first()[0] or ROOT).bit_length() - 1, 0)


def fallen(
    samples: DataFrame, nodes: DataFrame, features: Sequence[str], steps: int
) -> DataFrame:
    """``samples``, which have a ``tree``, with the ``leaf`` they fall into and its mean.

    ``steps`` is at least the depth of the trees.
    """
    at = samples.withColumn("node", F.lit(ROOT))
    inner = nodes.filter("feature IS NOT NULL").select("tree", "node", "feature", "threshold")
    for _ in range(steps):
        # A leaf finds nothing and stays.
        down = F.expr(f"coalesce({_below(features)}, node)")
        at = at.join(inner, ["tree", "node"], "left").withColumn("node", down)
        at = at.drop("feature", "threshold")
    values = nodes.filter("feature IS NULL").select("tree", "node", "millionths")
    return at.join(values, ["tree", "node"], "left").withColumnRenamed("node", "leaf")


def predicted(
    df: DataFrame, nodes: DataFrame, features: Sequence[str], prediction: str
) -> DataFrame:
    """``df`` with the mean of the trees' values.

    Every combination of feature values is scored once and joined back. NULL features match
    no combination and give NULL.
    """
    names = [f"_{i}" for i in range(len(features))]
    combos = df.select(*features).dropna().distinct().toDF(*names)
    # One row: the numbers of the trees.
    trees = nodes.filter(f"node = {ROOT}").agg(F.sort_array(F.collect_list("tree")).alias("trees"))
    everywhere = combos.select(*names, F.explode(F.lit(trees.first()[0])).alias("tree"))
    scores = (
        fallen(everywhere, nodes, names, depth(nodes))
        .groupBy(*names)
        .agg(F.expr(f"CAST(sum(millionths) AS DOUBLE) / (count(*) * {MILLION}) AS `{prediction}`"))
    )
    same = reduce(and_, (df[f] == scores[n] for f, n in zip(features, names)))
    return df.join(scores, same, "left").drop(*names)


def leaf_report(samples: DataFrame, nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """The leaves of each tree held against the ``bootstrap`` rows that fall into them.

    ``leaves``, their ``weight``, and in how many the stored weight or mean differs from that
    of the rows (``wrong``); a leaf without rows is wrong, and so are rows without a leaf.
    """
    found = (
        fallen(samples, nodes, features, depth(nodes))
        .groupBy("tree", F.col("leaf").alias("node"))
        .agg(F.expr("sum(weight) AS rows_weight"), F.expr("sum(total) AS total"))
    )
    leaves = nodes.filter("feature IS NULL").join(found, ["tree", "node"], "full")
    mean = f"CAST(total AS DOUBLE) / CAST(rows_weight AS DOUBLE) * {MILLION // HUNDRED}"
    right = f"weight <=> rows_weight AND millionths <=> CAST(floor({mean} + 0.5) AS BIGINT)"
    return leaves.groupBy("tree").agg(
        F.expr("count(weight) AS leaves"),
        F.expr("sum(weight) AS weight"),
        F.expr(f"count_if(NOT ({right})) AS wrong"),
    )

"""Exact quantiles per group without bringing a group together.

Spark's ``percentile`` keeps every distinct value of a group in one task. Here a group is
first counted in buckets of value, which tells in which bucket each wanted rank lies. The
buckets that hold one are cut again, between their smallest and largest value, and once more;
only the values of the last cells are counted one by one. All counts combine before the
shuffle. What a task sees of a group is its buckets, the cells of one bucket, or the distinct
values of one cell. A bucket spans a thousandth of its values, in which there are some 2**42
doubles, and two cuts by 4,096 leave about 2**18 of them, however dense the values lie. (Values
within a thousandth of zero share a bucket; there, cells are 6e-11 wide.)
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Buckets per factor e of the value: 14,000 of them reach up to a million.
_BUCKETS_PER_E = 1024
# Number of a value's bucket: never falls as the value grows, and stays NaN for NaN.
_BUCKET = f"rint(signum(v) * log1p(abs(v)) * {_BUCKETS_PER_E})"
# Cuts after the buckets, and cells of a cut.
_CUTS = 2
_CELLS = 4096
# Number of a value's cell between the ends of what is cut. Equal ends, infinite or NaN ones
# among them, leave one cell.
_CELL = (
    f"CASE WHEN low = high THEN 0D ELSE least(floor((v - low) / (high - low) * {_CELLS}),"
    f" {_CELLS - 1}) END"
)


def grouped_quantiles(
    df: DataFrame, group: str, value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """Minimum, the named quantiles and maximum of ``value`` per non-NULL ``group``.

    Quantiles interpolate linearly between neighbouring ranks. NULL values are ignored,
    but a group of only NULLs keeps its row.
    """
    rows = df.selectExpr(f"`{group}` AS g", f"`{value}` AS v").filter("g IS NOT NULL")
    located = rows.withColumn("p0", F.expr(_BUCKET))
    ends = _counted(located, ["g", "p0"])
    totals = ends.groupBy("g").agg(
        F.expr("sum(n) AS total"), F.expr("min(low) AS min"), F.expr("max(high) AS max")
    )

    # Every quantile wants the values at two neighbouring ranks, counted from 0.
    ranks = ", ".join(
        f"struct('{name}' AS name, {end} AS is_upper,"
        f" CAST({side}((total - 1) * {q}D) AS BIGINT) AS rank,"
        f" (total - 1) * {q}D - floor((total - 1) * {q}D) AS part)"
        for name, q in quantiles.items()
        for side, end in (("floor", "false"), ("ceil", "true"))
    )
    wanted = totals.filter("total > 0").selectExpr("g", f"inline(array({ranks}))")
    path, cells = ["g"], ends
    for cut in range(_CUTS + 1):
        wanted, path = _found(wanted, cells, path, f"p{cut}"), [*path, f"p{cut}"]
        hit = wanted.select(*path, "low", "high").distinct()
        located = located.join(hit, path)
        wanted = wanted.drop("low", "high")
        if cut < _CUTS:
            located = located.withColumn(f"p{cut + 1}", F.expr(_CELL)).drop("low", "high")
            cells = _counted(located, [*path, f"p{cut + 1}"])
    values = located.groupBy(*path, "v").agg(F.expr("count(*) AS n"))
    values = values.withColumns({"low": F.col("v"), "high": F.col("v")})
    found = _found(wanted, values, path, "v")

    def interpolated(name):
        low = f"max(CASE WHEN name = '{name}' AND NOT is_upper THEN v END)"
        high = f"max(CASE WHEN name = '{name}' AND is_upper THEN v END)"
        part = f"max(CASE WHEN name = '{name}' THEN part END)"
        # Between equal values nothing is to interpolate, and infinities have no difference.
        between = f"{low} + ({high} - {low}) * {part}"
        return F.expr(f"CASE WHEN {low} = {high} THEN {low} ELSE {between} END").alias(name)

    picked = found.groupBy("g").agg(*[interpolated(name) for name in quantiles])
    return totals.join(picked, "g", "left").selectExpr(f"g AS `{group}`", "min", *quantiles, "max")


def _counted(located: DataFrame, path: list[str]) -> DataFrame:
    return located.groupBy(*path).agg(
        F.expr("count(v) AS n"), F.expr("min(v) AS low"), F.expr("max(v) AS high")
    )


def _found(wanted: DataFrame, cells: DataFrame, path: list[str], cell: str) -> DataFrame:
    """``wanted`` with the cell below ``path`` that each rank lies in, and the rank within."""
    before = f"sum(n) OVER (PARTITION BY {', '.join(path)} ORDER BY {cell}) - n"
    counted = cells.filter("n > 0").withColumn("before", F.expr(before))
    return (
        wanted.join(counted, path)
        .filter("before <= rank AND rank < before + n")
        .withColumn("rank", F.expr("rank - before"))
        .drop("before", "n")
    )

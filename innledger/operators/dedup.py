"""One row per key, the same one on every run."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Keep the row that sorts first by ``order_by``, or else the one with the fewest NULLs;
    then the one whose other columns sort first, NULLs last.

    This is a ``min`` over a struct, not a ``row_number`` window: rows are reduced to
    one per key before the shuffle, so a key that holds most of the table costs no more
    than any other. A NULL key counts as one key.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    lead = [c for c in (order_by or ()) if c not in keys]
    empty = {c: f"_empty_{i}" for i, c in enumerate(others)}
    filled = F.struct(
        *[F.col(c) for c in lead],
        sum((F.isnull(c).cast("int") for c in others), F.lit(0)).alias("_empty"),
        *[x for c in others if c not in lead for x in (F.isnull(c).alias(empty[c]), F.col(c))],
    )
    best = df.groupBy(*keys).agg(F.min(filled).alias("best"))
    return best.selectExpr(
        *[f"`{c}`" if c in keys else f"best.`{c}` AS `{c}`" for c in df.columns]
    )

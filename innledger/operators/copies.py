"""Equal rows as one row with a count, and back."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Copies that are written where their row lies. A row that stands for more is heavy: it is
#: cut into chunks of so many copies, and the chunks are dealt out.
CHUNK = 4096


def collapse_copies(df: DataFrame, columns: Sequence[str], count_column: str) -> DataFrame:
    """Distinct rows of ``columns`` with their number; counted before the shuffle."""
    return df.groupBy(*columns).agg(F.expr("count(*)").alias(count_column))


def expand_copies(df: DataFrame, count_column: str) -> DataFrame:
    """Repeat each row ``count_column`` times and drop that column.

    Rows are repeated in place, without an exchange. Only heavy rows are taken aside and
    dealt out; without any, adaptive execution drops that branch.
    """
    n = F.col(f"`{count_column}`")
    light, heavy = df.filter(n <= CHUNK), df.filter(n > CHUNK)
    return expand_in_place(light, count_column).unionByName(expand_dealt(heavy, count_column))


def expand_in_place(df: DataFrame, count_column: str) -> DataFrame:
    """Repeat rows where they lie; for counts that are known to be small."""
    kept = [f"`{c}`" for c in df.columns if c != count_column]
    return df.selectExpr(*kept, f"explode(sequence(1, `{count_column}`)) AS _copy").selectExpr(
        *kept
    )


def expand_dealt(df: DataFrame, count_column: str) -> DataFrame:
    """Repeat rows with very many copies: their chunks go to as many tasks as a shuffle has."""
    kept = [f"`{c}`" for c in df.columns if c != count_column]
    n = f"`{count_column}`"
    chunks = df.selectExpr("*", f"explode(sequence(0, ({n} - 1) div {CHUNK})) AS _chunk")
    # By chunk and row, so that neither one heavy row nor many light chunks meet in a task.
    keys = [F.col(c) for c in kept]
    return (
        chunks.repartition(shuffle_width(df.sparkSession), "_chunk", *keys)
        .selectExpr(*kept, f"least({CHUNK}, {n} - _chunk * {CHUNK}) AS _copies")
        .selectExpr(*kept, "explode(sequence(1, _copies)) AS _copy")
        .selectExpr(*kept)
    )


def shuffle_width(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with in this session (``session.tuned``)."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", usual))

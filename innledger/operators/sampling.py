"""Bounded reports: top rows and repeatable samples."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.functions.hashing import id_digest


def top_rows(df: DataFrame, metric: str, tie_break: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the largest metric; NULLs come last."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *tie_break).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """At most ``n`` rows without replacement, the same ones on every run.

    Each task keeps its own first ``n`` by digest, so nothing is sorted as a whole.
    """
    return df.orderBy(id_digest(f"`{key}`", seed), key).limit(n)

"""Repeatable pseudo-random values of an id."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(key: str, seed: int) -> str:
    return f"md5(concat_ws('|', CAST({key} AS STRING), '{seed}'))"


def id_digest(key: str, seed: int) -> Column:
    """Hex digest of id and seed: the same in any engine, run and partitioning."""
    return F.expr(_digest(key, seed))


def in_share(key: str, seed: int, share: float) -> Column:
    """Whether the id belongs to this share (below 1) of all ids: a low enough digest."""
    return F.expr(f"{_digest(key, seed)} < '{int(share * 16**8):08x}'")

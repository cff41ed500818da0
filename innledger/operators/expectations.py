"""Named row rules: drop the rows that break one, and count what they did."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]


def _passes(rule: str, null_passes: bool) -> str:
    return f"coalesce({rule}, {str(null_passes).lower()})"


def expect_or_drop(
    df: DataFrame,
    rules: Rules,
    null_passes: bool = True,
    observation: Observation | None = None,
) -> DataFrame:
    """Keep the rows that satisfy every rule.

    A rule that evaluates to NULL passes unless ``null_passes`` is off. With an
    ``observation`` the failures of each rule are counted while the data flows to its
    sink, at no extra pass.
    """
    checks = {name: _passes(rule, null_passes) for name, rule in rules.items()}
    if observation is not None:
        failed = [F.expr(f"count_if(NOT {check})").alias(name) for name, check in checks.items()]
        df = df.observe(observation, F.expr("count(*)").alias("rows"), *failed)
    return df.filter(" AND ".join(checks.values()) or "true")


def rule_metrics(
    df: DataFrame, table_name: str, rules: Rules, null_passes: bool = True
) -> DataFrame:
    """One row per rule with its passed and failed counts, all from a single pass."""
    counts = [
        F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(name).alias("rule"),
            F.expr(f"count_if({_passes(rule, null_passes)})").alias("passed"),
            F.expr(f"count_if(NOT {_passes(rule, null_passes)})").alias("failed"),
        )
        for name, rule in rules.items()
    ]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))

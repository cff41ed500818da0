"""Sums of money that do not depend on the order rows arrive in."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts are added as whole numbers of this fraction. Four decimals cover every
# currency's minor unit.
UNITS_PER_ONE = 10_000
# Units are added in two parts, so that no sum of BIGINTs overflows below some 10**11 rows.
_PART_BITS = 24
# Below this an amount is added with 18 decimals, from there on with four.
_COARSE = "1e15D"


def _sum_or_fail(values: str) -> str:
    """Sum that fails the query instead of going over to another type or to NULL."""
    message = "raise_error('a sum of money is beyond 38 digits')"
    return (
        f"CASE WHEN count({values}) > 0"
        f" THEN coalesce(CAST(try_sum({values}) AS DOUBLE), CAST({message} AS DOUBLE)) END"
    )


def _exact_sum(amount: str, times: str) -> str:
    a = f"({amount})"
    rounded = f"rint({a} * {UNITS_PER_ONE})"
    whole = f"({rounded} / {UNITS_PER_ONE} = {a} AND abs({rounded}) < 9e15D)"
    units = f"CASE WHEN {whole} THEN CAST({rounded} AS BIGINT) END"
    finite = f"(NOT isnan({a}) AND abs({a}) < double('infinity'))"
    product = f"({a} * {times})"
    rest = f"NOT {whole} AND {finite}"
    high = f"try_multiply(shiftright({units}, {_PART_BITS}), {times})"
    low = f"try_multiply(({units}) & {(1 << _PART_BITS) - 1}L, {times})"
    fine = f"CASE WHEN {rest} AND abs{product} < {_COARSE} THEN CAST({product} AS DECIMAL(38, 18)) END"
    coarse = f"CASE WHEN {rest} AND abs{product} >= {_COARSE} THEN CAST({product} AS DECIMAL(38, 4)) END"
    odd = f"sum(CASE WHEN NOT {finite} THEN {a} END)"
    both = (
        f"CASE WHEN count({units}) > 0 THEN coalesce(try_add(try_multiply(try_sum({high}),"
        f" {1 << _PART_BITS}L), try_sum({low})) / {UNITS_PER_ONE},"
        f" ({_sum_or_fail(high)} * {1 << _PART_BITS} + {_sum_or_fail(low)}) / {UNITS_PER_ONE}) END"
    )
    parts = [both, _sum_or_fail(fine), _sum_or_fail(coarse), odd]
    added = " + ".join(f"coalesce({part}, 0D)" for part in parts)
    return f"CASE WHEN count({a}) > 0 THEN {added} END"


def exact_sum(amount: str, times: str = "1L") -> Column:
    """Sum of a DOUBLE amount, each taken ``times`` times, the same in any order of rows.

    Float addition gives different last digits for different partitionings. Here amounts
    with up to four decimals are added as whole BIGINT units in two parts; the others as
    DECIMAL with 18 decimals, from 10**15 on with four; NaN and infinities as doubles,
    where the order does not matter. Each of these sums is exact, and they are put
    together in a fixed order. What does not fit 38 digits fails the query. NULL amounts
    are ignored; a group of only NULLs sums to NULL. ``times`` is a BIGINT and never NULL.
    """
    return F.expr(_exact_sum(amount, times))


def exact_avg(amount: str) -> Column:
    """Average over the non-NULL amounts, from ``exact_sum``."""
    return F.expr(f"try_divide({_exact_sum(amount, '1L')}, count({amount}))")

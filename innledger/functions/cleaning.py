"""Cell-level repairs. None of them drops a row."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the cleaning rules are defined by.
VALID_CURRENCIES = ("EUR", "USD", "GBP")
FAKE_COUNTRY = "XX"


def listed(value: str, allowed: Iterable[str]) -> str:
    """Condition that the value is one of the allowed texts; NULL for a NULL value."""
    return f"{value} IN ({', '.join(repr(a) for a in allowed)})"


def blank_to_null(text: str) -> Column:
    return F.expr(f"nullif({text}, '')")


def negative_to_null(amount: str) -> Column:
    """NULL for amounts below zero; zero itself is kept."""
    return F.expr(f"CASE WHEN {amount} < 0 THEN NULL ELSE {amount} END")


def unlisted_to_null(value: str, allowed: Iterable[str]) -> Column:
    return F.expr(f"CASE WHEN {listed(value, allowed)} THEN {value} END")


def ordered_dates(first: str, second: str) -> tuple[Column, Column]:
    """The two dates, exchanged where the first is the later one.

    A NULL on either side leaves both as they are.
    """
    return (
        F.expr(f"CASE WHEN {first} > {second} THEN {second} ELSE {first} END"),
        F.expr(f"CASE WHEN {first} > {second} THEN {first} ELSE {second} END"),
    )

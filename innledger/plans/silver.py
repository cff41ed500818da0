"""Silver: the five tables cleaned."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from innledger.functions.cleaning import (
    FAKE_COUNTRY,
    VALID_CURRENCIES,
    blank_to_null,
    negative_to_null,
    ordered_dates,
    unlisted_to_null,
)
from innledger.operators.copies import collapse_copies, expand_copies
from innledger.operators.dedup import first_per_key
from innledger.operators.expectations import expect_or_drop

BOOKING_RULES = {
    "currency_valid": "currency IN ({})".format(", ".join(f"'{c}'" for c in VALID_CURRENCIES))
}
HOTEL_RULES = {"country_valid": f"country != '{FAKE_COUNTRY}'"}


def hotels(
    raw: DataFrame, null_passes: bool = True, observation: Observation | None = None
) -> DataFrame:
    """Hotels without the fake country. A missing country is kept by default."""
    return expect_or_drop(raw, HOTEL_RULES, null_passes, observation)


def customers(raw: DataFrame, tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per customer, blank e-mails as NULL."""
    cleaned = raw.withColumn("email", blank_to_null("email"))
    return first_per_key(cleaned, ["customer_id"], tie_break)


def rooms(raw: DataFrame, tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per room."""
    return first_per_key(raw, ["room_id"], tie_break)


def bookings(raw: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Bookings in a valid currency, dates in order, negative amounts as NULL.

    Bookings are not deduplicated. The ``observation`` counts those dropped.
    """
    checkin, checkout = ordered_dates("checkin_date", "checkout_date")
    valid = expect_or_drop(raw, BOOKING_RULES, null_passes=False, observation=observation)
    return valid.withColumns(
        {
            "checkin_date": checkin,
            "checkout_date": checkout,
            "total_amount": negative_to_null("total_amount"),
        }
    )


def counted_payments(
    raw: DataFrame, raw_bookings: DataFrame, copies: str = "copies"
) -> DataFrame:
    """Payments flagged against the bookings as they arrived, before cleaning.

    ``orphan``: there is no booking, or its amount is NULL. ``over_amount``: the payment
    exceeds the booking's amount; NULL when either is NULL. A booking that arrived several
    times repeats its payments: equal arrivals are joined once, and ``copies`` says how
    often the row stands.
    """
    booked = collapse_copies(raw_bookings, ["booking_id", "total_amount"], copies)
    flagged = raw.join(booked, "booking_id", "left").withColumns(
        {
            "orphan": F.expr("total_amount IS NULL"),
            "over_amount": F.expr("amount > total_amount"),
            "currency": unlisted_to_null("currency", VALID_CURRENCIES),
            copies: F.expr(f"coalesce({copies}, 1)"),
        }
    )
    return flagged.select(*raw.columns, "orphan", "over_amount", copies)


def payments(raw: DataFrame, raw_bookings: DataFrame) -> DataFrame:
    """``counted_payments`` with every repetition as a row of its own."""
    return expand_copies(counted_payments(raw, raw_bookings, "_copies"), "_copies")

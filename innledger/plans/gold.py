"""Gold: the business KPIs, each from silver tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.functions.money import exact_avg, exact_sum
from innledger.operators.overlap import overlapping_pairs


def daily_revenue(bookings: DataFrame) -> DataFrame:
    """Confirmed revenue and bookings per check-in date.

    Currencies are added up without conversion. Rows are not ordered; a stored table has
    no order, so readers sort (``serving.by_date``).
    """
    confirmed = bookings.filter(
        "status = 'confirmed' AND total_amount IS NOT NULL AND currency IS NOT NULL"
    )
    return (
        confirmed.groupBy("checkin_date")
        .agg(
            F.round(exact_sum("total_amount"), 2).alias("gross_revenue"),
            F.expr("count(*)").alias("bookings_count"),
        )
        .withColumnRenamed("checkin_date", "date")
    )


def cancellation_rate(bookings: DataFrame) -> DataFrame:
    """Share of cancelled bookings per source, in percent."""
    counted = bookings.groupBy("source").agg(
        F.expr("count(*)").alias("total_bookings"),
        F.expr("count_if(status = 'cancelled')").alias("cancelled"),
    )
    return counted.withColumn(
        "cancellation_rate_pct", F.expr("try_divide(cancelled, total_bookings) * 100")
    )


def collection_rate(
    payments: DataFrame, bookings: DataFrame, copies: str | None = None
) -> DataFrame:
    """Payments received against bookings' value, per hotel.

    A booking counts once per payment on it. Payments whose booking the cleaning removed
    fall in a group with NULL hotel, value and rate. Both sides are added up per booking
    before they meet, so a booking with very many payments joins as one row. ``copies``
    names the column that says how often a payment stands (``silver.counted_payments``).
    """
    times = copies or "1L"
    paid = (
        payments.filter("NOT orphan AND NOT over_amount AND currency IS NOT NULL")
        .groupBy("booking_id")
        .agg(
            F.expr(f"sum({times})").alias("payments"),
            exact_sum("amount", times).alias("paid"),
        )
    )
    booked = bookings.groupBy("booking_id", "hotel_id").agg(
        F.expr("count(*)").alias("arrivals"), exact_sum("total_amount").alias("value")
    )
    totals = (
        paid.join(booked, "booking_id", "left")
        .groupBy("hotel_id")
        .agg(
            exact_sum("value", "payments").alias("total_bookings_value"),
            exact_sum("paid", "coalesce(arrivals, 1)").alias("total_payments_value"),
        )
    )
    return totals.withColumn(
        "collection_rate", F.expr("try_divide(total_payments_value, total_bookings_value)")
    )


def overbooking_alerts(bookings: DataFrame) -> DataFrame:
    """Pairs of bookings, neither cancelled, that hold the same room at the same time.

    A booking with NULL status is left out.
    """
    return overlapping_pairs(bookings.filter("status != 'cancelled'"))


def customer_value(bookings: DataFrame) -> DataFrame:
    """Bookings, revenue and average ticket per customer, whatever the status."""
    return bookings.groupBy("customer_id").agg(
        F.expr("count(*)").alias("bookings_count"),
        exact_sum("total_amount").alias("revenue_sum"),
        exact_avg("total_amount").alias("avg_ticket"),
    )

"""What a dashboard or a report asks of the gold tables."""

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innledger.functions.texts import fixed_point
from innledger.operators.copies import collapse_copies
from innledger.operators.quantiles import grouped_quantiles
from innledger.operators.sampling import sample_rows, top_rows
from innledger.plans import pricing

# Fixed values of the reports.
COLLECTION_TARGET = 0.95
TOP_ROWS = 10
PAGE_ROWS = 25
PAGE_ORDER = ("room_id", "booking_id_1", "booking_id_2", "overlap_start", "overlap_end")
SAMPLE_ROWS = 200
TICKET_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def by_date(daily: DataFrame) -> DataFrame:
    return daily.orderBy("date")


def daily_bookings_trend(daily: DataFrame) -> DataFrame:
    """Bookings per calendar day."""
    return daily.groupBy(F.expr("CAST(date_trunc('DAY', date) AS DATE)").alias("day")).agg(
        F.expr("sum(bookings_count)").alias("bookings")
    )


def revenue_in_range(
    daily: DataFrame, first: date | str | None = None, last: date | str | None = None
) -> DataFrame:
    """Days from ``first`` to ``last``, both included; an open end is None."""
    if first is not None:
        daily = daily.filter(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        daily = daily.filter(F.col("date") <= F.lit(last).cast("date"))
    return daily


def collection_for_hotel(collection: DataFrame, hotel_id) -> DataFrame:
    """The collection rate of one hotel."""
    return collection.filter(F.col("hotel_id") == F.lit(hotel_id)).select(
        "hotel_id", "collection_rate"
    )


def collection_report(collection: DataFrame) -> DataFrame:
    """Hotels by falling collection rate, marked when below target, with display texts."""
    return collection.selectExpr(
        "hotel_id",
        "total_bookings_value",
        "total_payments_value",
        "collection_rate",
        f"coalesce(collection_rate < {COLLECTION_TARGET}, false) AS below_target",
        f"{fixed_point('total_bookings_value')} AS bookings_value_text",
        f"{fixed_point('total_payments_value')} AS payments_value_text",
        f"concat({fixed_point('(collection_rate * 100)')}, '%') AS collection_rate_text",
    ).orderBy(F.col("collection_rate").desc_nulls_last(), "hotel_id")


def ticket_box_plot(customers: DataFrame) -> DataFrame:
    """Spread of the average ticket among customers with equally many bookings."""
    return grouped_quantiles(customers, "bookings_count", "avg_ticket", TICKET_QUARTILES)


def top_customers(customers: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    return top_rows(customers, "revenue_sum", ["customer_id"], n)


def top_overbooked_rooms(alerts: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """Rooms with the most overlapping pairs; NULL rooms are not counted."""
    counted = alerts.filter("room_id IS NOT NULL").groupBy("room_id").count()
    return top_rows(counted, "count", ["room_id"], n)


def overbooking_page(
    alerts: DataFrame, page: int = 0, page_rows: int = PAGE_ROWS, room_id=None
) -> DataFrame:
    """One page of the alerts, in order of all their columns; pages count from 0.

    Skipping pages sorts the skipped rows into one task: this form is for the first pages.
    ``overbooking_after`` reads on from any place at the cost of one page.
    """
    if room_id is not None:
        alerts = alerts.filter(F.col("room_id") == F.lit(room_id))
    return alerts.orderBy(*PAGE_ORDER).offset(page * page_rows).limit(page_rows)


def overbooking_after(
    alerts: DataFrame, after: tuple | None = None, page_rows: int = PAGE_ROWS, room_id=None
) -> DataFrame:
    """The alerts that follow ``after`` in order of all their columns, one page of them.

    ``copy`` numbers equal alerts from 1. ``after`` is the last row of the page before, with
    its copy; None starts at the beginning. Equal alerts are counted first, and of the
    different ones only the first of each task are kept, so a page far into the list costs
    what the first one does.
    """
    if room_id is not None:
        alerts = alerts.filter(F.col("room_id") == F.lit(room_id))
    seen = F.lit(0).cast("long")
    if after is not None:
        *values, copy = after
        last = [
            F.lit(v).cast(alerts.schema[c].dataType).alias(c)
            for c, v in zip(PAGE_ORDER, values, strict=True)
        ]
        # The plain test on the room reaches the scan, the one on all columns does not.
        alerts = alerts.filter(F.col("room_id") >= last[0])
        alerts = alerts.filter(F.struct(*PAGE_ORDER) >= F.struct(*last))
        seen = F.when(F.struct(*PAGE_ORDER) == F.struct(*last), F.lit(copy)).otherwise(seen)
    counted = collapse_copies(alerts, PAGE_ORDER, "copies").withColumn("seen", seen.cast("long"))
    first = counted.filter("copies > seen").orderBy(*PAGE_ORDER).limit(page_rows)
    numbers = F.sequence(F.col("seen") + 1, F.least("copies", F.col("seen") + page_rows))
    return (
        first.select(*PAGE_ORDER, F.explode(numbers).alias("copy"))
        .orderBy(*PAGE_ORDER, "copy")
        .limit(page_rows)
    )


def filter_values(df: DataFrame, column: str, other_filters: str) -> DataFrame:
    """Values a filter offers, with how many rows the other filters leave for each."""
    return df.groupBy(column).agg(F.expr(f"count_if({other_filters})").alias("associated"))


def cross_filter_values(df: DataFrame, filters: Mapping[str, str]) -> DataFrame:
    """The values that several filters offer, all in one pass over ``df``.

    ``filters`` has the predicate set on each column. A row has the ``filter`` (a column),
    one of its values as text, and how many rows all the other filters leave for it
    (``associated``); a predicate that is NULL leaves none. Values that the others rule out
    stay on offer with 0.
    """
    columns = list(filters)
    passed = " + ".join(
        f"if(coalesce({rule}, false), {1 << i}, 0)" for i, rule in enumerate(filters.values())
    )
    every = (1 << len(columns)) - 1
    # Equal rows meet first, so the sets expand counts and not rows.
    counted = df.groupBy(*columns, F.expr(passed).alias("_passed")).agg(
        F.expr("count(*)").alias("_rows")
    )
    others = [
        F.expr(f"sum(if((_passed | {1 << i}) = {every}, _rows, 0))").alias(f"_others_{i}")
        for i in range(len(columns))
    ]
    sets = counted.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        F.grouping_id().alias("_set"), *others
    )
    # A set's number has a bit for every column that it leaves out, the first one highest.
    offers = ", ".join(
        f"struct({every ^ (1 << (len(columns) - 1 - i))} AS of, '{c}' AS filter,"
        f" CAST(`{c}` AS STRING) AS value, _others_{i} AS associated)"
        for i, c in enumerate(columns)
    )
    offered = sets.select("_set", F.expr(f"inline(array({offers}))")).filter("_set = of")
    return offered.select("filter", "value", "associated")


def prediction_bounds(predictions: DataFrame) -> DataFrame:
    """Ends of the diagonal on which predicted equals actual."""
    return predictions.selectExpr("min(actual_price) AS lowest", "max(actual_price) AS highest")


def prediction_scatter(predictions: DataFrame) -> DataFrame:
    return predictions.select("booking_id", "actual_price", "predicted_price")


def prediction_sample(
    model: DataFrame, features: DataFrame, n: int = SAMPLE_ROWS, seed: int = 42
) -> DataFrame:
    """The scatter of at most ``n`` bookings. They are chosen first: only they are scored."""
    chosen = sample_rows(features, "booking_id", n, seed)
    return prediction_scatter(pricing.predicted_prices(model, chosen))

import datetime as dt

import pytest

from innledger.plans import gold, serving, silver

BOOKING = (
    "booking_id STRING, customer_id STRING, hotel_id STRING, room_id STRING, checkin_date DATE,"
    " checkout_date DATE, total_amount DOUBLE, currency STRING, status STRING, source STRING"
)
PAYMENT = "booking_id STRING, amount DOUBLE, currency STRING, orphan BOOLEAN, over_amount BOOLEAN"


def day(n):
    return dt.date(2024, 5, n)


def booking(i, **changes):
    row = {
        "booking_id": i, "customer_id": "c1", "hotel_id": "h1", "room_id": "r1",
        "checkin_date": day(1), "checkout_date": day(3), "total_amount": 100.0,
        "currency": "EUR", "status": "confirmed", "source": "web",
    }
    return tuple((row | changes).values())


@pytest.fixture
def bookings(spark):
    return lambda *data: spark.createDataFrame(list(data), BOOKING)


def test_daily_revenue(bookings):
    df = bookings(
        booking("b1", total_amount=0.1),
        booking("b2", total_amount=0.2, currency="USD"),
        booking("b3", total_amount=None),
        booking("b4", currency=None),
        booking("b5", status="cancelled"),
        booking("b6", status=None),
        booking("b7", checkin_date=None),
        booking("b8", checkin_date=day(2), total_amount=0.0),
    )
    daily = serving.by_date(gold.daily_revenue(df))
    assert [tuple(r) for r in daily.collect()] == [
        (None, 100.0, 1), (day(1), 0.3, 2), (day(2), 0.0, 1),
    ]
    assert daily.columns == ["date", "gross_revenue", "bookings_count"]


def test_cancellation_rate_keeps_the_null_source(bookings, rows):
    df = bookings(
        booking("b1", status="cancelled"), booking("b2"), booking("b3", status=None),
        booking("b4", source=None), booking(None, source=None, status="cancelled"),
    )
    assert rows(gold.cancellation_rate(df)) == [
        ("web", 3, 1, 1 / 3 * 100), (None, 2, 1, 50.0),
    ]


def test_collection_rate(spark, bookings, rows):
    df = bookings(
        booking("b1", total_amount=100.0),
        booking("b2", hotel_id="h2", total_amount=0.0),
        booking("b3", hotel_id="h3", total_amount=None),
        booking("b4", hotel_id=None, total_amount=50.0),
    )
    payments = spark.createDataFrame(
        [
            ("b1", 30.0, "EUR", False, False),
            ("b1", 50.0, "EUR", False, False),  # two instalments: the booking counts twice
            ("b1", 1.0, None, False, False),
            ("b1", 1.0, "EUR", True, None),
            ("b1", 1.0, "EUR", False, True),
            ("b1", None, "EUR", False, None),  # no amount: nothing to compare, left out
            ("b2", 0.0, "EUR", False, False),
            ("b3", 7.0, "EUR", False, False),
            ("b4", 5.0, "EUR", False, False),
            ("b9", 9.0, "EUR", False, False),  # the booking was removed in cleaning
        ],
        PAYMENT,
    )
    assert rows(gold.collection_rate(payments, df)) == [
        ("h1", 200.0, 80.0, 0.4),
        ("h2", 0.0, 0.0, None),  # zero denominator
        ("h3", None, 7.0, None),  # only NULL amounts
        (None, 50.0, 14.0, 0.28),
    ]


def test_collection_rate_equals_the_plain_join(spark, bookings):
    """Adding up per booking first gives what joining row by row gives."""
    df = bookings(
        *[
            booking(f"b{i % 17}", hotel_id=f"h{i % 3}", total_amount=i * 1.01 if i % 5 else None)
            for i in range(60)
        ]
    )
    payments = spark.createDataFrame(
        [(f"b{i % 23}", i * 0.37, "EUR", False, False) for i in range(200)], PAYMENT
    )
    plain = (
        payments.select("booking_id", "amount")
        .join(df.select("booking_id", "hotel_id", "total_amount"), "booking_id", "left")
        .groupBy("hotel_id")
        .agg({"total_amount": "sum", "amount": "sum"})
    )
    want = {r.hotel_id: (r["sum(total_amount)"], r["sum(amount)"]) for r in plain.collect()}
    got = {
        r.hotel_id: (r.total_bookings_value, r.total_payments_value)
        for r in gold.collection_rate(payments, df).collect()
    }
    assert got.keys() == want.keys() and None in got
    for hotel, values in got.items():
        assert values == pytest.approx(want[hotel]) or hotel is None
    assert got[None] == (None, pytest.approx(want[None][1]))


def test_overbooking_alerts(bookings, rows):
    df = bookings(
        booking("b1"),
        booking("b2", checkin_date=day(2), checkout_date=day(4)),
        booking("b3", status="cancelled"),
        booking("b4", status=None),
        booking("b5", room_id="r2"),
        booking("b6", room_id=None),
        booking("b7", checkout_date=None),
        booking("b8", checkin_date=day(4), checkout_date=day(5)),  # touches b2
        booking("b0", checkin_date=day(2), checkout_date=day(2), status="pending"),
    )
    assert rows(gold.overbooking_alerts(df)) == [
        ("r1", "b0", "b1", day(2), day(2)),  # a stay without a night, inside b1
        ("r1", "b1", "b2", day(2), day(3)),
    ]


def test_customer_value(bookings, rows):
    df = bookings(
        booking("b1", total_amount=10.0),
        booking("b2", total_amount=None),
        booking("b3", total_amount=5.5, status="cancelled"),
        booking("b4", customer_id="c2", total_amount=None),
        booking("b5", customer_id=None, total_amount=1.0),
    )
    assert rows(gold.customer_value(df)) == [
        ("c1", 3, 15.5, 7.75), ("c2", 1, None, None), (None, 1, 1.0, 1.0),
    ]


def test_hot_keys_give_whole_results(spark):
    """A third of payments on one booking, a third of bookings copies of another."""
    n = 3000
    one = (
        "'c' AS customer_id, 'h' AS hotel_id, 'r' AS room_id, date'2024-05-01' AS checkin_date,"
        " date'2024-05-02' AS checkout_date, 10D AS total_amount, 'EUR' AS currency,"
        " 'confirmed' AS status, 'web' AS source"
    ).split(", ")
    bookings = spark.range(n).selectExpr("concat('b', id) AS booking_id", *one).union(
        spark.range(n).selectExpr("'copy' AS booking_id", *one)
    )
    payments = (
        spark.range(n).selectExpr("'b0' AS booking_id")
        .union(spark.range(n).selectExpr("concat('b', id)"))
        .union(spark.range(2).selectExpr("'copy'"))
        .union(spark.range(n).selectExpr("CAST(NULL AS STRING)"))
        .selectExpr("booking_id", "1D AS amount", "'EUR' AS currency")
    )
    flagged = silver.payments(payments, bookings)
    assert flagged.count() == n + n + 2 * n + n
    assert flagged.filter("orphan").count() == n
    joined = n + n + 2 * n * n  # each payment on the copies meets each copy twice over
    counted = silver.counted_payments(payments, bookings)
    assert counted.count() == n + n + 2 + n
    cleaned = silver.bookings(bookings)
    for rates in (
        gold.collection_rate(flagged, cleaned),
        gold.collection_rate(counted, cleaned, copies="copies"),
    ):
        [row] = rates.collect()
        assert (row.total_bookings_value, row.total_payments_value) == (10.0 * joined, joined)

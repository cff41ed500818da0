import datetime as dt

from innledger.plans import silver

BOOKING = (
    "booking_id STRING, checkin_date DATE, checkout_date DATE, total_amount DOUBLE, currency STRING"
)
PAYMENT = "booking_id STRING, amount DOUBLE, currency STRING"


def day(n):
    return dt.date(2024, 5, n)


def test_hotels_drop_only_the_fake_country(spark, rows):
    df = spark.createDataFrame(
        [("h1", "XX"), ("h2", None), ("h3", "IT")], "hotel_id STRING, country STRING"
    )
    assert rows(silver.hotels(df)) == [("h2", None), ("h3", "IT")]
    assert rows(silver.hotels(df, null_passes=False)) == [("h3", "IT")]


def test_customers_blank_email_and_duplicates(spark, rows):
    data = [("c1", "", 0), ("c1", "x@y", 1), ("c2", None, 0), ("c3", " ", 0)]
    df = spark.createDataFrame(data, "customer_id STRING, email STRING, line INT")
    assert rows(silver.customers(df, ["line"])) == [
        ("c1", None, 0), ("c2", None, 0), ("c3", " ", 0),
    ]


def test_without_a_tie_break_the_fuller_row_stays(spark, rows):
    data = [("c1", "", None), ("c1", "x@y", None), ("c2", None, "n"), ("c2", "a@b", None)]
    df = spark.createDataFrame(data, "customer_id STRING, email STRING, name STRING")
    assert rows(silver.customers(df)) == [("c1", "x@y", None), ("c2", "a@b", None)]


def test_rooms_exact_copies(spark, rows):
    data = [("r1", 2), ("r1", 2), ("r2", 3)]
    df = spark.createDataFrame(data, "room_id STRING, max_occupancy INT")
    assert rows(silver.rooms(df)) == [("r1", 2), ("r2", 3)]


def test_bookings_repairs(spark, rows):
    data = [
        ("b1", day(5), day(2), 10.0, "EUR"),  # inverted
        ("b2", day(2), None, -1.0, "USD"),  # open end, negative
        ("b3", None, day(2), 0.0, "GBP"),  # zero is kept
        ("b4", day(1), day(1), None, "EUR"),
        ("b5", day(1), day(2), 5.0, "XXX"),
        ("b6", day(1), day(2), 5.0, None),
        ("b7", day(1), day(2), 5.0, "EUR"),
        ("b7", day(1), day(2), 5.0, "EUR"),  # bookings are not deduplicated
        ("b8", day(1), day(2), 5.0, "eur"),
    ]
    df = spark.createDataFrame(data, BOOKING)
    cleaned = silver.bookings(df)
    assert rows(cleaned) == [
        ("b1", day(2), day(5), 10.0, "EUR"),
        ("b2", day(2), None, None, "USD"),
        ("b3", None, day(2), 0.0, "GBP"),
        ("b4", day(1), day(1), None, "EUR"),
        ("b7", day(1), day(2), 5.0, "EUR"),
        ("b7", day(1), day(2), 5.0, "EUR"),
    ]
    assert rows(silver.bookings(cleaned)) == rows(cleaned)
    assert cleaned.columns == df.columns


def test_payments_flags(spark, rows):
    bookings = spark.createDataFrame(
        [
            ("b1", None, None, 100.0, "EUR"),
            ("b2", None, None, None, "EUR"),
            ("b3", None, None, -5.0, "EUR"),
            ("b4", None, None, 100.0, "XXX"),
            (None, None, None, 100.0, "EUR"),
        ],
        BOOKING,
    )
    payments = spark.createDataFrame(
        [
            ("b1", 100.0, "EUR"),  # equal is not over
            ("b1", 100.01, "USD"),
            ("b1", None, "GBP"),
            ("b2", 1.0, "EUR"),  # the booking's amount is NULL
            ("b3", 1.0, "XXX"),  # against the amount as it arrived
            ("b4", 1.0, None),  # the booking's currency does not matter
            ("b9", 1.0, "EUR"),
            (None, 1.0, "EUR"),  # NULL ids never match
        ],
        PAYMENT,
    )
    flagged = silver.payments(payments, bookings)
    assert flagged.columns == ["booking_id", "amount", "currency", "orphan", "over_amount"]
    assert rows(flagged) == sorted(
        [
            ("b1", 100.0, "EUR", False, False),
            ("b1", 100.01, "USD", False, True),
            ("b1", None, "GBP", False, None),
            ("b2", 1.0, "EUR", True, None),
            ("b3", 1.0, None, False, True),
            ("b4", 1.0, None, False, False),
            ("b9", 1.0, "EUR", True, None),
            (None, 1.0, "EUR", True, None),
        ],
        key=repr,
    )


def test_repeated_booking_fans_its_payments_out(spark, rows):
    bookings = spark.createDataFrame(
        [("b1", None, None, a, "EUR") for a in (100.0, 100.0, 10.0, None)], BOOKING
    )
    payments = spark.createDataFrame([("b1", 50.0, "EUR"), ("b1", 50.0, "EUR")], PAYMENT)
    one = [
        ("b1", 50.0, "EUR", False, False),
        ("b1", 50.0, "EUR", False, False),
        ("b1", 50.0, "EUR", False, True),
        ("b1", 50.0, "EUR", True, None),
    ]
    assert rows(silver.payments(payments, bookings)) == sorted(one * 2, key=repr)

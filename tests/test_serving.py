import datetime as dt

import pytest

from innledger.plans import serving


def day(n):
    return dt.date(2024, 5, n)


@pytest.fixture
def daily(spark):
    data = [(day(n), float(n), n) for n in range(1, 6)] + [(None, 9.0, 9)]
    return spark.createDataFrame(data, "date DATE, gross_revenue DOUBLE, bookings_count BIGINT")


@pytest.fixture
def collection(spark):
    data = [
        ("h1", 100.0, 95.0, 0.95), ("h2", 100.0, 94.0, 0.94), ("h3", 1234.5, 1300.0, 1.053058),
        (None, None, 5.0, None),
    ]
    return spark.createDataFrame(
        data,
        "hotel_id STRING, total_bookings_value DOUBLE, total_payments_value DOUBLE,"
        " collection_rate DOUBLE",
    )


@pytest.fixture
def alerts(spark):
    data = [(f"r{n % 12:02}", n, n + 100, day(1 + n % 9), day(10)) for n in range(60)]
    data += [(None, 1, 2, day(1), day(2))] * 9 + [("r03", 900, 901, day(1), day(2))]
    return spark.createDataFrame(
        data,
        "room_id STRING, booking_id_1 BIGINT, booking_id_2 BIGINT, overlap_start DATE,"
        " overlap_end DATE",
    )


def test_trend(daily, rows):
    assert rows(serving.daily_bookings_trend(daily.union(daily)))[0] == (None, 18)
    assert rows(serving.daily_bookings_trend(daily))[1:] == [(day(n), n) for n in range(1, 6)]


def test_range_includes_both_ends(daily, rows):
    dates = lambda *ends: [r[0] for r in rows(serving.revenue_in_range(daily, *ends))]
    assert dates(day(2), day(4)) == [day(2), day(3), day(4)]
    assert dates("2024-05-04", None) == [day(4), day(5)]
    assert dates(None, "2024-05-01") == [day(1)]
    assert len(dates()) == 6


def test_collection_for_hotel(collection, rows):
    assert rows(serving.collection_for_hotel(collection, "h2")) == [("h2", 0.94)]


def test_collection_report(collection):
    report = serving.collection_report(collection).collect()
    assert [(r.hotel_id, r.below_target) for r in report] == [
        ("h3", False), ("h1", False), ("h2", True), (None, False),
    ]
    assert [r.collection_rate_text for r in report] == ["105.31%", "95.00%", "94.00%", None]
    assert [r.bookings_value_text for r in report] == ["1234.50", "100.00", "100.00", None]
    assert report[3].payments_value_text == "5.00"


def test_box_plot(spark, rows):
    data = [(2, 10.0), (2, 20.0), (2, 40.0), (2, None), (1, 5.0), (3, None)]
    df = spark.createDataFrame(data, "bookings_count BIGINT, avg_ticket DOUBLE")
    assert rows(serving.ticket_box_plot(df)) == [
        (1, 5.0, 5.0, 5.0, 5.0, 5.0),
        (2, 10.0, 15.0, 20.0, 30.0, 40.0),
        (3, None, None, None, None, None),
    ]


def test_top_customers(spark):
    data = [(f"c{n:02}", float(n % 7)) for n in range(20)] + [("none", None)]
    df = spark.createDataFrame(data, "customer_id STRING, revenue_sum DOUBLE")
    top = [r.customer_id for r in serving.top_customers(df).collect()]
    assert top[:4] == ["c06", "c13", "c05", "c12"]
    assert len(top) == 10


def test_top_overbooked_rooms(alerts):
    top = [tuple(r) for r in serving.top_overbooked_rooms(alerts).collect()]
    assert top[:3] == [("r03", 6), ("r00", 5), ("r01", 5)]
    assert len(top) == 10


def test_pages_cover_everything_once(alerts):
    pages = [
        [tuple(r) for r in serving.overbooking_page(alerts, page).collect()] for page in range(4)
    ]
    assert [len(p) for p in pages] == [25, 25, 20, 0]
    ordered = alerts.orderBy(*serving.PAGE_ORDER).collect()
    assert sum(pages, []) == [tuple(r) for r in ordered]
    assert serving.overbooking_page(alerts, room_id="r05").count() == 5



def walk(alerts, page_rows, **options):
    """All pages, each read on from the last row of the one before."""
    seen, after = [], None
    while True:
        page = serving.overbooking_after(alerts, after, page_rows, **options).collect()
        seen += [tuple(r) for r in page]
        if len(page) < page_rows:
            return seen
        after = tuple(page[-1])


@pytest.mark.parametrize("page_rows", [3, 25])
def test_cursor_reads_every_row_once(alerts, page_rows):
    known = alerts.filter("room_id IS NOT NULL")
    often = known.filter("room_id = 'r03'")
    for _ in range(3):  # eight copies
        often = often.unionByName(often)
    repeated = known.filter("room_id != 'r03'").unionByName(often)
    seen = walk(repeated, page_rows)
    assert len(seen) == len(set(seen))  # copies are numbered
    assert [r[:5] for r in seen] == [
        tuple(r) for r in repeated.orderBy(*serving.PAGE_ORDER).collect()
    ]
    assert len(walk(repeated, page_rows, room_id="r03")) == often.count()


def test_a_page_far_on_is_not_sorted_into_one_task(alerts):
    after = ("r05", 3, 4, None, None, 1)
    plan = serving.overbooking_after(alerts, after)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange SinglePartition" not in plan


def test_filter_values(alerts, rows):
    values = dict(rows(serving.filter_values(alerts, "room_id", "overlap_start < '2024-05-02'")))
    assert len(values) == 13
    assert values[None] == 9
    assert values["r03"] == 2  # of the room's six rows
    assert values["r01"] == 0  # still offered


def test_cross_filters_in_one_scan(spark, rows):
    data = [(1, "a", 10), (1, "b", 20), (2, "a", 10), (2, "c", None), (None, "a", 10), (2, "a", 10)]
    df = spark.createDataFrame(data, "h INT, r STRING, d INT").cache()
    got = serving.cross_filter_values(df, {"h": "h = 2", "r": "r = 'a'", "d": "d < 15"})
    assert rows(got) == sorted(
        [("h", "1", 1), ("h", "2", 2), ("h", None, 1), ("r", "a", 2), ("r", "b", 0),
         ("r", "c", 0), ("d", "10", 2), ("d", "20", 0), ("d", None, 0)], key=repr
    )
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1


def test_prediction_reports(spark, rows):
    data = [(n, float(n), 1, 2, 2, "double", 1, 0, True) for n in range(500)]
    df = spark.createDataFrame(
        data,
        "booking_id INT, actual_price DOUBLE, stay_duration INT, max_occupancy INT,"
        " room_type_num INT, room_type_code STRING, season INT, is_weekend INT, is_train BOOLEAN",
    )
    assert rows(serving.prediction_bounds(df)) == [(0.0, 499.0)]
    model = spark.createDataFrame(  # one tree that is one leaf
        [(0, 1, None, None, 500, 7_500_000)],
        "tree INT, node INT, feature INT, threshold DOUBLE, weight LONG, millionths LONG",
    )
    sample = serving.prediction_sample(model, df)
    assert sample.columns == ["booking_id", "actual_price", "predicted_price"]
    assert sample.count() == 200
    assert {r.predicted_price for r in sample.collect()} == {7.5}
    assert serving.prediction_sample(model, df.limit(30)).count() == 30


@pytest.mark.parametrize(
    "value",
    [0.0, 0.125, 0.375, 1.005, 2.675, 0.005, 0.015, 1e-9, 0.994999999, 0.995, 0.9999, 99.995,
     1234.5, -0.125, -0.001, -2.5, 81.125, 1e15 + 0.125, 3.999e15, 1e17, 123456789.985, 1 / 3],
)
def test_texts_round_as_python_does(spark, value):
    from innledger.functions.texts import fixed_point

    df = spark.createDataFrame([(value,)], "v DOUBLE")
    assert df.selectExpr(fixed_point("v")).first()[0] == f"{value:.2f}"


def test_report_texts_on_ties(spark):
    data = [(1, 0.125, 1.005, 0.81125), (2, None, None, None)]
    df = spark.createDataFrame(
        data,
        "hotel_id INT, total_bookings_value DOUBLE, total_payments_value DOUBLE,"
        " collection_rate DOUBLE",
    )
    first, second = serving.collection_report(df).collect()
    assert tuple(first)[-3:] == ("0.12", "1.00", "81.12%")
    assert tuple(second)[-3:] == (None, None, None)

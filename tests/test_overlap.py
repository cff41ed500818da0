"""The overlap join against a brute-force pair search."""

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from innledger.operators.overlap import overlapping_pairs

SCHEMA = "room_id STRING, booking_id BIGINT, checkin_date DATE, checkout_date DATE"
DAY0 = dt.date(1969, 12, 20)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def brute_force(stays):
    found = Counter()
    for room, i, s1, e1 in stays:
        for other, j, s2, e2 in stays:
            if None in (room, i, s1, e1, other, j, s2, e2) or room != other or i >= j:
                continue
            if s1 < e2 and s2 < e1:
                found[(room, i, j, max(s1, s2), min(e1, e2))] += 1
    return found


def check(spark, stays):
    df = spark.createDataFrame(stays, SCHEMA)
    assert Counter(tuple(r) for r in overlapping_pairs(df).collect()) == brute_force(stays)


ROOM = st.sampled_from(["a", "b", None])
LENGTH = st.one_of(st.integers(0, 6), st.sampled_from([16, 17, 40, 300, 5000]))
STAY = st.tuples(
    ROOM,
    st.one_of(st.none(), st.integers(1, 12)),
    st.one_of(st.none(), st.integers(0, 40)),
    st.one_of(st.none(), LENGTH),
).map(
    lambda t: (t[0], t[1], day(t[2]), None if None in (t[2], t[3]) else day(t[2] + t[3]))
)


@settings(
    max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(stays=st.lists(STAY, min_size=1, max_size=40))
def test_random_stays(spark, stays):
    check(spark, stays)


@pytest.mark.parametrize("longest", [1, 2, 15, 16, 17, 18, 255, 256, 257, 4097, 70000, 1100000])
def test_every_level_boundary(spark, longest):
    rng = random.Random(longest)
    stays = []
    for i in range(150):
        start = rng.randrange(0, min(2 * longest + 3, 1_700_000))
        length = rng.choice([0, 1, rng.randrange(0, longest + 1), longest])
        stays.append((rng.choice("ab"), i, day(start), day(start + length)))
    check(spark, stays)


def test_whole_calendar(spark):
    stays = [
        ("a", 1, dt.date(1, 1, 1), dt.date(9999, 12, 31)),
        ("a", 2, dt.date(1, 1, 1), dt.date(1, 1, 2)),
        ("a", 3, dt.date(9999, 12, 30), dt.date(9999, 12, 31)),
        ("a", 4, dt.date(9999, 12, 31), dt.date(9999, 12, 31)),
        ("a", 5, dt.date(2024, 2, 29), dt.date(2024, 2, 29)),
    ]
    check(spark, stays)


def test_no_overlap_keeps_the_schema(spark):
    df = spark.createDataFrame([("a", 1, day(0), day(2)), ("a", 2, day(2), day(4))], SCHEMA)
    pairs = overlapping_pairs(df)
    assert pairs.collect() == []
    assert pairs.dtypes == [
        ("room_id", "string"),
        ("booking_id_1", "bigint"),
        ("booking_id_2", "bigint"),
        ("overlap_start", "date"),
        ("overlap_end", "date"),
    ]
    assert overlapping_pairs(df.limit(0)).collect() == []


def test_text_ids_order_as_text(spark):
    df = spark.createDataFrame(
        [("a", "B9", day(0), day(3)), ("a", "B10", day(1), day(2))],
        SCHEMA.replace("BIGINT", "STRING"),
    )
    assert [tuple(r) for r in overlapping_pairs(df).collect()] == [
        ("a", "B10", "B9", day(1), day(2))
    ]


@pytest.mark.parametrize("seed", range(3))
def test_times_of_day(spark, seed):
    rng = random.Random(seed)
    noon = dt.datetime(2024, 2, 27)

    def stay(i):
        start = noon + dt.timedelta(hours=6 * rng.randrange(0, 60))
        hours = rng.choice([0, 6, 12, 18, 24, 48, 6 * rng.randrange(0, 80)])
        return (rng.choice("ab"), i % 70, start, start + dt.timedelta(hours=hours))

    stays = [stay(i) for i in range(80)]
    for kind in ("TIMESTAMP", "TIMESTAMP_NTZ"):
        df = spark.createDataFrame(stays, SCHEMA.replace("DATE", kind))
        assert Counter(tuple(r) for r in overlapping_pairs(df).collect()) == brute_force(stays)


def test_date_and_time_together(spark):
    df = spark.createDataFrame(
        [("a", 1, day(0), day(3)), ("a", 2, day(3), day(4)), ("a", 3, None, day(9))], SCHEMA
    )
    timed = df.withColumn("checkout_date", F.expr("checkout_date + INTERVAL 10 HOURS"))
    assert [tuple(r)[:3] for r in overlapping_pairs(timed).collect()] == [("a", 1, 2)]


def test_repeated_rows_repeat_pairs(spark):
    stays = [("a", 1, day(0), day(5))] * 3 + [("a", 2, day(1), day(2))] * 2
    check(spark, stays)


def test_hot_room_and_hot_copies(spark):
    """One room holds two thirds of the rows, one booking a third of them."""
    n = 3000
    spread = spark.range(n).selectExpr(
        "'hot' AS room_id", "id AS booking_id",
        "date_add(date'2020-01-01', cast(id * 2 AS int)) AS checkin_date",
        "date_add(date'2020-01-01', cast(id * 2 + 3 AS int)) AS checkout_date",
    )
    copies = spark.range(n).selectExpr(
        "'hot' AS room_id", f"{n}L AS booking_id",
        "date'2020-01-02' AS checkin_date", "date'2020-01-03' AS checkout_date",
    )
    others = spark.range(n).selectExpr(
        "concat('r', id) AS room_id", f"id + {2 * n} AS booking_id",
        "date'2020-01-02' AS checkin_date", "date'2020-01-03' AS checkout_date",
    )
    pairs = overlapping_pairs(spread.union(copies).union(others))
    # Neighbours in the spread overlap by a day; every copy meets the first booking only.
    assert pairs.count() == (n - 1) + n


@pytest.mark.parametrize("room", ["hot", "other"])
def test_a_stay_without_end_leaves_no_hot_block(spark, room, monkeypatch):
    """Of the rows that meet in one key, none has more than a stated share."""
    from innledger.operators import overlap

    begins = []
    plain = overlap._begins
    monkeypatch.setattr(overlap, "_begins", lambda df: begins.append(plain(df)) or begins[0])
    n = 4000
    hot = spark.range(n).selectExpr(
        "'hot' AS room_id", "id AS booking_id",
        "date_add(date'2015-01-01', cast(id AS int)) AS checkin_date",
        "date_add(date'2015-01-01', cast(id + 1 AS int)) AS checkout_date",
    )
    endless = spark.createDataFrame(
        [(room, n, dt.date(2015, 1, 2), dt.date(9999, 12, 31))], SCHEMA
    )
    assert overlapping_pairs(hot.union(endless)).count() == (n - 1 if room == "hot" else 0)
    most = begins[0].groupBy("room", "level", "block").count().selectExpr("max(count)").first()[0]
    assert most <= (256 if room == "hot" else 1)


def test_copies_are_written_by_several_tasks(spark):
    stays = spark.range(400).selectExpr(
        "'a' AS room_id", "id % 2 AS booking_id", "date'2024-01-01' AS checkin_date",
        "date'2024-01-03' AS checkout_date",
    )
    parts = overlapping_pairs(stays).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in parts) == 200 * 200 and len(parts) > 1


def test_plan_has_no_cross_join(spark):
    df = spark.createDataFrame([("a", 1, day(0), day(2))], SCHEMA)
    plan = overlapping_pairs(df)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan

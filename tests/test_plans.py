"""What the physical plans must and must not contain."""

import contextlib
import re

import pytest

import __spark_entry__ as registered
from innledger.plans import gold, pricing, silver
from innledger.sources import star_schema
from innledger.sources.layers import LayerStore

SF_DIR = "/root/testdata/sf0.001"
# These train a model or land files before they return; their tables are covered as others.
EAGER = {
    "bronze_ingest",
    "predicted_prices",
    "price_model_metrics",
    "prediction_sample",
    "scored_bookings",
    "prediction_scatter",
    "catalog_report",
    "overbooking_walk",
}
QUERIES = {
    n: q
    for n, q in registered.queries().items()
    if n in registered._QUERIES and n not in EAGER
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


@contextlib.contextmanager
def settings(spark, **values):
    keys = {f"spark.sql.{k}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(autouse=True)
def whole_plans(spark):
    with settings(spark, maxMetadataStringLength="10000", **{"debug.maxToStringFields": "1000"}):
        yield


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Silver tables as they are stored."""
    store = LayerStore(spark, str(tmp_path_factory.mktemp("lake")))
    raw = {n: make(spark, SF_DIR) for n, make in star_schema.RAW_TABLES.items()}
    store.write(silver.bookings(raw["bookings"]), "silver.bookings")
    store.write(silver.payments(raw["payments"], raw["bookings"]), "silver.payments")
    store.write(silver.rooms(raw["rooms"]), "silver.rooms")
    return store


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan


def scans(plan):
    return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", plan)


def test_filters_and_columns_reach_the_scan(store):
    bookings = store.read("silver.bookings")
    [(pushed, columns)] = scans(plan_of(gold.daily_revenue(bookings)))
    assert "EqualTo(status,confirmed)" in pushed
    assert "IsNotNull(total_amount)" in pushed
    assert {c.split(":")[0] for c in columns.split(",")} == {
        "checkin_date", "total_amount", "currency", "status",
    }
    for pushed, columns in scans(plan_of(gold.overbooking_alerts(bookings))):
        assert "Not(EqualTo(status,cancelled))" in pushed
        assert "customer_id" not in columns
    [(_, columns)] = scans(plan_of(gold.cancellation_rate(bookings)))
    assert columns == "status:string,source:string"


def test_price_features_read_only_what_they_use(store):
    features = pricing.price_features(store.read("silver.bookings"), store.read("silver.rooms"))
    found = sorted(scans(plan_of(features)), key=lambda scan: "GreaterThan" in scan[0])
    assert "IsNotNull(max_occupancy)" in found[0][0]
    assert "GreaterThan(total_amount,0.0)" in found[1][0]
    assert "hotel_id" not in found[0][1] + found[1][1]


def test_kpis_combine_before_the_shuffle(store):
    bookings = store.read("silver.bookings")
    for kpi in (gold.daily_revenue, gold.cancellation_rate, gold.customer_value):
        plan = plan_of(kpi(bookings))
        assert "partial_count" in plan
        assert plan.count("Exchange") == 1
        assert "SortAggregate" not in plan


def test_box_plot_computes_customer_values_once(spark):
    plan = final_plan_of(QUERIES["ticket_box_plot"](spark, SF_DIR))
    assert plan.count("FileScan") - plan.count("ReusedExchange") <= 1


def test_hot_booking_is_split(spark):
    """A third of all payments are on one booking; the join gives them several tasks."""
    n = 60000
    bookings = spark.range(n).selectExpr(
        "id AS booking_id", "id % 7 AS hotel_id", "500D AS total_amount", "'EUR' AS currency",
        "date'2024-01-01' AS checkin_date", "date'2024-01-02' AS checkout_date",
    )
    payments = spark.range(3 * n).selectExpr(
        f"if(id % 3 = 0, 7, id % {n}) AS booking_id",
        "xxhash64(id) % 10000 / 100D AS amount", "'EUR' AS currency",
    )
    small = {
        "autoBroadcastJoinThreshold": "-1",
        "shuffle.partitions": "16",
        "adaptive.advisoryPartitionSizeInBytes": "64KB",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with settings(spark, **small):
        flagged = silver.payments(payments, bookings)
        assert "skew=true" in final_plan_of(flagged)
        rates = gold.collection_rate(flagged, silver.bookings(bookings))
        assert "skew=true" in final_plan_of(rates)
        kept = flagged.filter("amount <= 500").count()
        assert kept == 3 * n
        total = rates.selectExpr("sum(total_bookings_value)").first()[0]
        assert total == 500.0 * 3 * n

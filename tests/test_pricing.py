import datetime as dt

import pytest
from pyspark.sql import functions as F

from innledger.operators import forest
from innledger.plans import pricing, serving

BOOKING = (
    "booking_id STRING, room_id STRING, hotel_id STRING, checkin_date DATE,"
    " checkout_date DATE, total_amount DOUBLE"
)
ROOM = "room_id STRING, hotel_id STRING, room_type_code STRING, max_occupancy INT"


def booking(i, checkin=dt.date(2024, 5, 1), nights=2, amount=100.0, room="r1"):
    out = checkin + dt.timedelta(days=nights) if checkin and nights is not None else None
    return (i, room, "h1", checkin, out, amount)


@pytest.fixture(scope="module")
def rooms(spark):
    data = [
        ("r1", "h1", "single", 1), ("r2", "h1", "suite", 3), ("r3", "h1", "DLX", 2),
        ("r4", "h1", None, 4), ("r5", "h1", "family", None),
    ]
    return spark.createDataFrame(data, ROOM)


@pytest.fixture(scope="module")
def features(spark, rooms):
    """Prices that depend on nights, room and season."""
    bookings = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS booking_id",
        "concat('r', 1 + id % 4) AS room_id",
        "'h1' AS hotel_id",
        "date_add(date'2024-01-01', CAST(id % 365 AS INT)) AS checkin_date",
        "date_add(date'2024-01-02', CAST(id % 365 + id % 7 AS INT)) AS checkout_date",
        "CAST(80 * (1 + id % 7) + 50 * (id % 4) + 30 * quarter(date_add(date'2024-01-01',"
        " CAST(id % 365 AS INT))) AS DOUBLE) AS total_amount",
    )
    return pricing.price_features(bookings, rooms).cache()


@pytest.fixture(scope="module")
def predictions(features):
    model = pricing.train_price_model(features, trees=8, max_depth=8).cache()
    return pricing.predicted_prices(model, features).cache()


def test_which_bookings_are_fit(spark, rooms):
    data = [
        booking("ok"), booking("null amount", amount=None), booking("zero", amount=0.0),
        booking("negative", amount=-1.0), booking("no night", nights=0),
        booking("no end", nights=None), booking("no start", checkin=None),
        booking("unknown room", room="r9"), booking("no room", room=None),
        booking("no occupancy", room="r5"), booking("no type", room="r4"),
    ]
    df = pricing.price_features(spark.createDataFrame(data, BOOKING), rooms)
    assert sorted(r.booking_id for r in df.collect()) == ["no type", "ok"]


def test_feature_values(spark, rooms):
    data = [
        booking("1", dt.date(2024, 3, 31), 1, room="r1"),  # Sunday, first quarter
        booking("2", dt.date(2024, 4, 1), 30, room="r2"),  # Monday
        booking("3", dt.date(2024, 12, 28), 7, room="r3"),  # Saturday, unlisted type
        booking("4", dt.date(2024, 7, 5), 2, room="r4"),  # Friday, no type
    ]
    df = pricing.price_features(spark.createDataFrame(data, BOOKING), rooms).orderBy("booking_id")
    names = ["stay_duration", "max_occupancy", "room_type_num", "month", "season", "is_weekend"]
    assert [tuple(r) for r in df.select(names).collect()] == [
        (1, 1, 1, 3, 1, 1), (30, 3, 3, 4, 2, 0), (7, 2, 2, 12, 4, 1), (2, 4, 2, 7, 3, 0),
    ]


def test_room_types_can_be_replaced(spark, rooms):
    df = spark.createDataFrame([booking("1", room="r3")], BOOKING)
    assert pricing.price_features(df, rooms, {"DLX": 9}).first().room_type_num == 9


def test_split_does_not_depend_on_partitioning(features):
    def train_ids(df):
        return {r.booking_id for r in df.filter("is_train").select("booking_id").collect()}

    ids = train_ids(features)
    assert train_ids(features.repartition(5)) == ids
    assert 0.75 < len(ids) / features.count() < 0.85


def test_every_fit_booking_is_scored(features, predictions):
    assert predictions.columns == [
        "booking_id", "actual_price", "predicted_price", "stay_duration", "max_occupancy",
        "room_type_code", "season", "is_train",
    ]
    assert predictions.count() == features.count()
    low, high = features.selectExpr("min(actual_price)", "max(actual_price)").first()
    assert predictions.filter(f"predicted_price < {low} OR predicted_price > {high}").count() == 0


def test_metrics_match_spark_ml_and_beat_the_mean(predictions):
    from pyspark.ml.evaluation import RegressionEvaluator

    got = pricing.price_model_metrics(predictions).first()
    held_out = predictions.filter("NOT is_train")
    for name in ("rmse", "r2"):
        evaluator = RegressionEvaluator(
            labelCol="actual_price", predictionCol="predicted_price", metricName=name
        )
        assert got[name] == pytest.approx(evaluator.evaluate(held_out))
    assert got.test_rows == held_out.count()
    assert got.rmse < 0.5 * got.baseline_rmse


def test_model_does_not_depend_on_partitions(features):
    """The same trees, to the last node, however the table is stored."""
    found = []
    stored = (
        features.repartition(3), features.repartition(16, "season"), features.coalesce(1),
        features.repartition(64),
    )
    for features in stored:
        model = pricing.train_price_model(features, trees=4, max_depth=5)
        found.append(sorted(map(tuple, model.collect()), key=repr))
    assert found[0] == found[1] == found[2] == found[3]
    assert len({row[0] for row in found[0]}) == 4


def test_leaves_hold_what_falls_into_them(features):
    model = pricing.train_price_model(features, trees=5, max_depth=4).cache()
    samples = pricing.price_samples(features, trees=5)
    report = forest.leaf_report(samples, model, pricing.FEATURES).collect()
    assert len(report) == 5 and all(r.wrong == 0 and r.leaves > 1 for r in report)
    # A leaf with another value is found, and so is one that is missing.
    moved = F.expr("millionths + CAST(feature IS NULL AND tree = 3 AS INT)")
    bad = model.withColumn("millionths", moved)
    report = {r.tree: r for r in forest.leaf_report(samples, bad, pricing.FEATURES).collect()}
    assert report[3].wrong == report[3].leaves and report[0].wrong == 0
    lost = model.filter("NOT (feature IS NULL AND tree = 2)")
    report = {r.tree: r for r in forest.leaf_report(samples, lost, pricing.FEATURES).collect()}
    assert report[2].wrong > 0 and report[1].wrong == 0


def test_metrics_without_held_out_rows(predictions):
    got = pricing.price_model_metrics(predictions.filter("is_train")).first()
    assert (got.test_rows, got.rmse, got.r2) == (0, None, None)


def test_saved_model_predicts_the_same(spark, features, tmp_path):
    model = pricing.train_price_model(features, trees=3, max_depth=3).cache()
    for _ in range(2):  # saving replaces
        pricing.save_model(model, str(tmp_path / "model"))
    loaded = pricing.load_model(spark, str(tmp_path / "model"))
    a, b = (
        pricing.predicted_prices(m, features).orderBy("booking_id").collect()
        for m in (model, loaded)
    )
    assert a == b


def test_only_the_sample_is_scored(spark, features, tmp_path):
    """No more feature combinations reach the model than there are chosen bookings."""
    model = pricing.train_price_model(features, trees=3, max_depth=3).cache()
    sample = serving.prediction_sample(model, features, n=7)
    scored = pricing.predicted_prices(model, features).join(
        sample.select("booking_id"), "booking_id", "left_semi"
    )
    assert sorted(map(tuple, sample.collect())) == sorted(
        map(tuple, serving.prediction_scatter(scored).collect())
    )
    plan = sample._jdf.queryExecution().optimizedPlan().toString()
    limits = [line for line in plan.splitlines() if "GlobalLimit 7" in line]
    scans = [line for line in plan.splitlines() if "InMemoryRelation" in line]
    # Both sides of the join back, the combinations and the rows, are read below the limit.
    assert len(limits) == 2 and scans


def test_training_without_rows(features):
    model = pricing.train_price_model(features.limit(0), trees=2, max_depth=2)
    assert model.collect() == []
    got = pricing.predicted_prices(model, features).selectExpr("count(*)", "count(predicted_price)")
    assert tuple(got.first()) == (features.count(), 0)

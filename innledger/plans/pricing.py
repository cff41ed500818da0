"""Price prediction: features, training, scoring."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.functions.hashing import in_share
from innledger.functions.stays import is_weekend, room_type_number, season, stay_nights
from innledger.operators import forest
from innledger.session import stored

# Fixed values of the model.
FEATURES = ["stay_duration", "max_occupancy", "room_type_num", "season", "is_weekend"]
SEED = 42
TREES = 100
#: Levels of splits. Any number can be asked for; every level is one more pass over the
#: table of feature combinations, not over the bookings.
DEPTH = 10
TRAIN_SHARE = 0.8


def price_features(
    bookings: DataFrame, rooms: DataFrame, room_types: Mapping[str, int] | None = None
) -> DataFrame:
    """Bookings fit for the model, with its features and their part of the split.

    A booking is fit with a positive amount, at least one night and a known occupancy.
    Four fifths are for training, chosen by a digest of the booking id, so the split does
    not change with partitioning.
    """
    about_rooms = rooms.select("room_id", "room_type_code", "max_occupancy")
    return (
        bookings.filter("total_amount > 0")
        .withColumn("stay_duration", stay_nights("checkin_date", "checkout_date"))
        .filter("stay_duration > 0")
        .select("booking_id", "room_id", "checkin_date", "total_amount", "stay_duration")
        .join(about_rooms, "room_id", "left")
        .filter("max_occupancy IS NOT NULL")
        .select(
            "booking_id",
            F.col("total_amount").alias("actual_price"),
            "stay_duration",
            "max_occupancy",
            "room_type_code",
            room_type_number("room_type_code", room_types).alias("room_type_num"),
            F.month("checkin_date").alias("month"),
            season("checkin_date").alias("season"),
            is_weekend("checkin_date").alias("is_weekend"),
            # A NULL id hashes like an empty one, so the flag is never NULL.
            in_share("booking_id", SEED, TRAIN_SHARE).alias("is_train"),
        )
    )


def price_samples(features: DataFrame, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """The training part as each tree sees it: weights and summed prices by combination."""
    training = features.filter("is_train")
    return forest.bootstrap(training, "booking_id", "actual_price", trees, seed, FEATURES)


def train_price_model(
    features: DataFrame, trees: int = TREES, max_depth: int = DEPTH, seed: int = SEED
) -> DataFrame:
    """The forest as a table of nodes. Every split may use every feature.

    The bookings are read once, by all executors. Neither the partitioning nor the cluster
    changes a node. Prices count in whole cents.
    """
    samples = stored(price_samples(features, trees, seed), "price-samples")
    return forest.grown(samples, FEATURES, max_depth)


def predicted_prices(model: DataFrame, features: DataFrame) -> DataFrame:
    """Every fit booking with its predicted price; ``is_train`` tells the parts apart."""
    return forest.predicted(features, model, FEATURES, "predicted_price").select(
        "booking_id",
        "actual_price",
        "predicted_price",
        "stay_duration",
        "max_occupancy",
        "room_type_code",
        "season",
        "is_train",
    )


def price_model_metrics(predictions: DataFrame) -> DataFrame:
    """Root mean squared error and R² on the rows held out, in one pass.

    ``baseline_rmse`` is the error of always predicting their mean.
    """
    return (
        predictions.filter("NOT is_train")
        .selectExpr("actual_price", "actual_price - predicted_price AS error")
        .selectExpr(
            "count(*) AS test_rows",
            "avg(error * error) AS mse",
            "var_pop(actual_price) AS variance",
        )
        .selectExpr(
            "test_rows",
            "sqrt(mse) AS rmse",
            "1 - try_divide(mse, variance) AS r2",
            "sqrt(variance) AS baseline_rmse",
        )
    )


def save_model(model: DataFrame, path: str) -> None:
    """Write the nodes to ``path``. A model saved there before must not be ``model``."""
    model.write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

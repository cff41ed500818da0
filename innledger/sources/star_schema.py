"""The five raw tables of the lodging domain, derived from an order-and-parts star schema.

Hotels come from suppliers, rooms from parts, customers from customers, bookings from
orders and payments from order lines. The arithmetic plants the defects the cleaning
rules exist for: fake countries, repeated rows, blank e-mails, inverted dates, negative
and missing amounts, unknown currencies, payments without a booking.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Types of the columns in use; declaring them spares a look into the files.
_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "part": "p_partkey BIGINT, p_type STRING, p_size INT",
    "customer": "c_custkey BIGINT, c_name STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
        " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
        " l_extendedprice DOUBLE"
    ),
}


# Nights and season make the price, in whole cents, and something under 50,000 is left to
# chance. The nights are those between the dates below, whichever comes first.
_NIGHTS = "abs(o_orderkey % 11 - 2)"
_AMOUNT = (
    f"CAST(600000 * {_NIGHTS} * (5 + quarter(o_orderdate))"
    " + CAST(round(o_totalprice * 100) AS BIGINT) % 5000000 AS DOUBLE) / 100"
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _copies_when(repeated: str) -> str:
    """Copy number 0 for every row, and 1 as well for the repeated ones."""
    return f"explode(CASE WHEN {repeated} THEN array(0, 1) ELSE array(0) END) AS copy_no"


def raw_hotels(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "supplier")
        .withColumnRenamed("s_nationkey", "n_nationkey")
        .join(_table(spark, folder, "nation"), "n_nationkey", "left")
        .selectExpr(
            "s_suppkey AS hotel_id",
            "s_name AS hotel_name",
            "CAST(3 + s_suppkey % 3 AS INT) AS stars",
            "CASE n_nationkey WHEN 0 THEN 'XX' WHEN 1 THEN NULL ELSE n_name END AS country",
        )
    )


def raw_rooms(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").selectExpr(
        "p_partkey AS room_id",
        "p_partkey % 10 AS hotel_id",
        "CASE p_type WHEN 'ECONOMY' THEN 'single' WHEN 'STANDARD' THEN 'double'"
        " WHEN 'PROMO' THEN 'suite' WHEN 'LARGE' THEN 'family' ELSE p_type END"
        " AS room_type_code",
        "p_type AS room_type_desc",
        "CASE WHEN p_size % 10 = 0 THEN NULL ELSE 1 + p_size % 4 END AS max_occupancy",
        _copies_when("p_partkey % 50 = 0"),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS name",
        "CASE WHEN c_custkey % 7 = 0 THEN ''"
        " ELSE concat('c', CAST(c_custkey AS STRING), '@example.com') END AS email",
        _copies_when("c_custkey % 40 = 0"),
    )


def raw_bookings(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").selectExpr(
        "o_orderkey AS booking_id",
        "o_custkey AS customer_id",
        "floor(o_custkey / 10) AS room_id",
        "floor(o_custkey / 10) % 10 AS hotel_id",
        "CAST(o_orderdate AS DATE) AS checkin_date",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL"
        " ELSE date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 11 - 2 AS INT)) END"
        " AS checkout_date",
        f"CASE WHEN o_orderkey % 23 = 0 THEN -({_AMOUNT}) WHEN o_orderkey % 29 = 0 THEN NULL"
        f" ELSE {_AMOUNT} END AS total_amount",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'XXX' WHEN o_orderkey % 13 = 1 THEN NULL"
        " WHEN o_orderkey % 13 < 6 THEN 'USD' WHEN o_orderkey % 13 < 9 THEN 'GBP'"
        " ELSE 'EUR' END AS currency",
        "CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'cancelled'"
        " ELSE 'pending' END AS status",
        "CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'mobile'"
        " WHEN o_orderpriority = '2-HIGH' THEN 'expedia'"
        " WHEN o_orderpriority = '3-MEDIUM' THEN 'booking.com'"
        " WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'walk_in' ELSE 'web' END AS source",
    )


def raw_payments(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS payment_id",
        "CASE WHEN l_partkey % 31 = 0 THEN -l_orderkey - 1 ELSE l_orderkey END AS booking_id",
        "l_extendedprice AS amount",
        "CASE l_suppkey % 10 WHEN 9 THEN 'XXX' WHEN 8 THEN NULL ELSE 'EUR' END AS currency",
    )


RAW_TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hotels": raw_hotels,
    "rooms": raw_rooms,
    "customers": raw_customers,
    "bookings": raw_bookings,
    "payments": raw_payments,
}

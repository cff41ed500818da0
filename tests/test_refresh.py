"""Landing files, layer tables and the full refresh."""

import datetime as dt
from types import SimpleNamespace

import pytest

from innledger.plans.refresh import (
    TABLES,
    record_rules,
    refresh_all,
    refresh_bronze,
    refresh_layer,
)
from innledger.schemas import LANDING_TABLES
from innledger.session import shared_folder, tuned
from innledger.sources.landing import REJECTED, ingest, read_landing, write_landing
from innledger.sources.layers import LayerStore

FILES = {
    "hotels": """hotel_id,hotel_name,stars,country
H1,Alpha,4,XX
H2,Beta,3,IT
H3,Beta,5,
""",
    "rooms": """room_id,hotel_id,room_type_code,room_type_desc,max_occupancy
H2-R1,H2,DLX,Deluxe,3
H2-R1,H2,DLX,Deluxe,3
H2-R2,H2,STD,Standard,2
H3-R1,H3,suite,Suite,4
""",
    "customers": """phone,customer_id,email
001,C1,c1@x
002,C2,
,C1,c1@x
NA,C3,""
""",
    "payments": """booking_id,amount,currency
B1,50.5,EUR
B1,49.5,EUR
B2,500,USD
B999,1,EUR
""",
}


def bookings_file():
    lines = [
        "booking_id,customer_id,hotel_id,room_id,checkin_date,checkout_date,total_amount,"
        "currency,status,source"
    ]
    for n in range(1, 81):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=n)
        end = day + dt.timedelta(days=1 + n % 3)
        room = ["H2-R1", "H2-R2", "H3-R1"][n % 3]
        status = ["confirmed", "cancelled", "pending"][n % 7 % 3]
        lines.append(f"B{n},C{1 + n % 3},{room[:2]},{room},{day},{end},{100 + n},EUR,{status},web")
    lines.append("B99,C1,H2,H2-R1,2024-03-09,2024-03-02,-5,GBP,confirmed,")
    return "\n".join(lines) + "\n"


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    (folder / "bookings.csv").write_text(bookings_file())
    return str(folder)


def test_declared_types_follow_the_header(spark, landing):
    df = read_landing(spark, f"{landing}/customers.csv", "customers")
    assert df.dtypes == [
        ("phone", "string"), ("customer_id", "string"), ("email", "string"), (REJECTED, "string"),
    ]
    got = [tuple(r)[:3] for r in df.collect()]
    assert got == [
        ("001", "C1", "c1@x"), ("002", "C2", None), (None, "C1", "c1@x"), ("NA", "C3", None),
    ]
    hotels = read_landing(spark, f"{landing}/hotels.csv", "hotels")
    assert dict(hotels.dtypes)["stars"] == "int"


def test_inferred_types(spark, landing):
    df = read_landing(spark, f"{landing}/bookings.csv", "bookings", infer=True)
    types = dict(df.dtypes)
    assert (types["checkin_date"], types["total_amount"]) == ("date", "int")
    assert df.count() == 81


def test_ingestion_stamp_is_one_value(spark, landing):
    df = ingest(spark, landing, "bookings")
    assert df.columns[-1] == "ingestion_date"
    assert df.select("ingestion_date").distinct().count() == 1


def test_csv_round_trip(spark, rows, landing, tmp_path):
    df = read_landing(spark, f"{landing}/bookings.csv", "bookings").drop(REJECTED)
    out = str(tmp_path / "out")
    for _ in range(2):  # writing replaces
        write_landing(df.repartition(3), out, "bookings")
    again = read_landing(spark, f"{out}/bookings.csv", "bookings").drop(REJECTED)
    assert again.dtypes == df.dtypes
    assert rows(again) == rows(df)


@pytest.mark.parametrize("in_catalog", [False, True])
def test_full_refresh(spark, rows, landing, tmp_path, in_catalog):
    store = LayerStore(spark, None if in_catalog else str(tmp_path / "lake"))
    metrics = refresh_all(store, landing, str(tmp_path / "model"), trees=3)
    assert metrics["bronze.rooms"] == {"rows": 4, "rejects": 0}
    assert metrics["silver.bookings"]["rows"] >= metrics["silver.bookings"]["currency_valid"]
    assert metrics["silver.hotels"] == {"rows": 3, "country_valid": 1}
    assert metrics["gold.predicted_prices"]["test_rows"] > 0
    counts = {n: store.read(n).count() for n in [f"bronze.{t}" for t in LANDING_TABLES] + [*TABLES]}
    assert counts["bronze.hotels"] == 3
    assert counts["silver.hotels"] == 2
    assert (counts["bronze.rooms"], counts["silver.rooms"]) == (4, 3)
    assert (counts["bronze.customers"], counts["silver.customers"]) == (4, 3)
    assert counts["silver.bookings"] == 81
    assert counts["silver.payments"] == 4
    assert counts["gold.customer_value"] == 3
    assert rows(store.read("silver.payments"), "booking_id", "orphan", "over_amount") == [
        ("B1", False, False), ("B1", False, False), ("B2", False, True), ("B999", True, None),
    ]
    assert rows(store.read("gold.collection_rate")) == [("H2", 202.0, 100.0, 100.0 / 202.0)]
    swapped = store.read("silver.bookings").filter("booking_id = 'B99'").first()
    assert swapped.checkin_date == dt.date(2024, 3, 2)
    assert swapped.checkout_date == dt.date(2024, 3, 9)
    assert (swapped.total_amount, swapped.source) == (None, None)
    predicted = store.read("gold.predicted_prices")
    assert predicted.count() == counts["gold.price_features"] > 0

    history = store.read("quality.rule_history").filter("table_name LIKE '%hotels'")
    found = rows(history, "table_name", "rule", "passed", "failed")
    assert found == [("bronze.hotels", "record_parses", 3, 0), ("silver.hotels", "country_valid", 2, 1)]
    record_rules(store, "again", {"silver.hotels": {"rows": 5, "country_valid": 4}})
    assert store.read("quality.rule_history").filter("run = 'again'").count() == 1
    assert store.read("quality.rule_history").select("run").distinct().count() == 2

    # A second refresh replaces the tables.
    refresh_bronze(store, landing, ["payments"])
    refresh_layer(store, "silver", ["silver.payments"])
    assert store.read("silver.payments").count() == 4


def test_creating_layers_drops_nothing(spark, landing):
    store = LayerStore(spark)
    store.create_layers()
    refresh_bronze(store, landing, ["hotels"])
    store.create_layers()
    assert store.read("bronze.hotels").count() == 3


def test_shared_folder_follows_the_session(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(f"{shared}/")
    assert shared_folder(spark) != shared_folder(spark)


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://h:7077", ""])
def test_shared_folder_is_required_on_a_cluster(master):
    session = SimpleNamespace(conf={"spark.master": master})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


TEXTS = ['two\nlines', 'a "quoted" word', ' blanks around ', 'comma, and\r\nbreak', "plain", '"', "\\"]


def test_texts_survive_landing_files(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "customer_id INT, email STRING")
    write_landing(df, str(tmp_path), "customers")
    again = read_landing(spark, f"{tmp_path}/customers.csv", "customers")
    assert sorted((int(r.customer_id), r.email) for r in again.collect()) == list(enumerate(TEXTS))
    assert all(r[REJECTED] is None for r in again.collect())


def test_records_that_do_not_fit_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "payments.csv").write_text(
        "booking_id,amount,currency\nB1,10.5,EUR\nB2,\"1,200.50\",EUR\nB3,7,EUR,extra\nB4\n"
    )
    store = LayerStore(spark, str(tmp_path / "lake"))
    counts = refresh_bronze(store, str(tmp_path), ["payments"])
    assert counts == {"bronze.payments": {"rows": 4, "rejects": 3}}
    amounts = {r.booking_id: r.amount for r in store.read("bronze.payments").collect()}
    assert amounts == {"B1": 10.5, "B2": None, "B3": 7.0, "B4": None}
    rejects = store.read("bronze.payments_rejects")
    assert sorted(r[REJECTED] for r in rejects.collect()) == ['B2,"1,200.50",EUR', "B3,7,EUR,extra", "B4"]


def test_prefixed_databases(spark, tmp_path):
    store = LayerStore(spark, prefix="trial_")
    store.create_layers()
    store.write(spark.range(3), "gold.numbers")
    assert store.read("gold.numbers").count() == spark.table("trial_gold.numbers").count() == 3


def test_tuned_starts_large_shuffles_with_many_partitions(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert tuned(spark, 10 << 40).conf.get(key) == str((10 << 40) // (128 << 20))
        assert tuned(spark, 1).conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        spark.conf.unset(key)

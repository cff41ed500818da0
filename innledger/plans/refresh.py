"""The full refresh: landing files to bronze, silver, gold and the price model.

Each table is written before the next layer reads it, so a lost executor repeats one
table's work at most, and the bookings that six tables need are cleaned once. Tables of
one layer do not need each other; their Spark jobs are submitted side by side, so small
tables do not leave a cluster idle.
"""

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from innledger.plans import gold, pricing, silver
from innledger.schemas import LANDING_TABLES
from innledger.sources.landing import REJECTED, ingest
from innledger.sources.layers import LayerStore


class LayerTable(NamedTuple):
    """The tables of earlier layers that a table is built from, and how."""

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


TABLES: dict[str, LayerTable] = {
    "silver.hotels": LayerTable(("bronze.hotels",), silver.hotels),
    "silver.customers": LayerTable(("bronze.customers",), silver.customers),
    "silver.rooms": LayerTable(("bronze.rooms",), silver.rooms),
    "silver.bookings": LayerTable(("bronze.bookings",), silver.bookings),
    "silver.payments": LayerTable(("bronze.payments", "bronze.bookings"), silver.payments),
    "gold.daily_revenue": LayerTable(("silver.bookings",), gold.daily_revenue),
    "gold.cancellation_rate": LayerTable(("silver.bookings",), gold.cancellation_rate),
    "gold.collection_rate": LayerTable(
        ("silver.payments", "silver.bookings"), gold.collection_rate
    ),
    "gold.overbooking_alerts": LayerTable(("silver.bookings",), gold.overbooking_alerts),
    "gold.customer_value": LayerTable(("silver.bookings",), gold.customer_value),
    "gold.price_features": LayerTable(
        ("silver.bookings", "silver.rooms"), pricing.price_features
    ),
}


def _side_by_side(work: Callable, items: Iterable) -> list:
    items = list(items)
    if not items:
        return []
    with ThreadPoolExecutor(len(items)) as pool:
        return list(pool.map(work, items))


def refresh_bronze(
    store: LayerStore,
    landing: str,
    tables: Iterable[str] = LANDING_TABLES,
    infer: bool = False,
    one_line: bool = False,
    ranges: bool = False,
) -> dict[str, dict]:
    """Ingest ``landing/<table>.csv`` into ``bronze.<table>``.

    How the files are read is described at ``read_landing``. Records with a cell that is not of its type, or with too few or many cells, are also
    kept in ``bronze.<table>_rejects``, with their text as it was. Returns the numbers of
    rows and rejects.
    """

    def refresh(table):
        observation = Observation()
        rows = ingest(store.spark, landing, table, infer, one_line, ranges)
        counted = rows.observe(
            observation, F.count("*").alias("rows"), F.count(REJECTED).alias("rejects")
        )
        store.write(counted.drop(REJECTED), f"bronze.{table}")
        # All columns: Spark finds a cell that does not fit only if it reads it.
        store.write(rows.filter(F.col(REJECTED).isNotNull()), f"bronze.{table}_rejects")
        return f"bronze.{table}", observation.get

    return dict(_side_by_side(refresh, tables))


def refresh_layer(
    store: LayerStore, layer: str, names: Iterable[str] = TABLES
) -> dict[str, dict]:
    """Rebuild the layer's tables, or those of them that are named.

    Returns counts collected while tables are written: their rows, and for hotels and bookings
    the rows that came and those that a rule dropped.
    """

    def refresh(name):
        inputs, build = TABLES[name]
        sources = [store.read(i) for i in inputs]
        observation = Observation()
        if build not in (silver.hotels, silver.bookings):
            counted = build(*sources).observe(observation, F.count("*").alias("rows"))
            store.write(counted, name)
            return {name: observation.get}
        store.write(build(*sources, observation=observation), name)
        return {name: observation.get}

    metrics = {}
    for found in _side_by_side(refresh, [n for n in names if n.startswith(f"{layer}.")]):
        metrics.update(found)
    return metrics


HISTORY = "quality.rule_history"


def record_rules(store: LayerStore, run: str, metrics: Mapping[str, Mapping[str, int]]) -> None:
    """Add what ``refresh_bronze`` and ``refresh_layer`` counted to the history of rules.

    A row per run, table and rule: how many rows passed and failed. The records that parse
    are a rule of bronze tables; a table without rules has one row, all rows passed.
    """
    rows = []
    for table, counts in metrics.items():
        failures = {rule: n for rule, n in counts.items() if rule != "rows"}
        for rule, failed in (failures or {"written": 0}).items():
            rule = "record_parses" if rule == "rejects" else rule
            rows.append((run, table, rule, counts["rows"] - failed, failed))
    schema = "run string, table_name string, rule string, passed long, failed long"
    store.append(store.spark.createDataFrame(rows, schema), HISTORY)


def refresh_prices(
    store: LayerStore,
    model_path: str,
    trees: int = pricing.TREES,
    max_depth: int = pricing.DEPTH,
    seed: int = pricing.SEED,
) -> DataFrame:
    """Train on ``gold.price_features``, save the model and ``gold.predicted_prices``.

    Prices are predicted with the model as it was saved. Returns the model's metrics on the
    held-out rows.
    """
    features = store.read("gold.price_features")
    pricing.save_model(pricing.train_price_model(features, trees, max_depth, seed), model_path)
    model = pricing.load_model(store.spark, model_path)
    store.write(pricing.predicted_prices(model, features), "gold.predicted_prices")
    return pricing.price_model_metrics(store.read("gold.predicted_prices"))


def refresh_all(
    store: LayerStore,
    landing: str,
    model_path: str,
    run: str | None = None,
    ranges: bool = False,
    **training: int,
) -> dict[str, dict]:
    """Everything, from landing files to predictions. Returns rule counts and model metrics.

    ``ranges`` reads large landing files in several tasks each.

    The rule counts also go to the history, as those of ``run``, by default the time in UTC.
    ``training`` are the parameters of ``refresh_prices``: trees, max_depth, seed.
    """
    store.create_layers()
    metrics = refresh_bronze(store, landing, ranges=ranges)
    metrics.update(refresh_layer(store, "silver"))
    metrics.update(refresh_layer(store, "gold"))
    record_rules(store, run or datetime.now(UTC).isoformat(), metrics)
    scores = refresh_prices(store, model_path, **training)
    return {**metrics, "gold.predicted_prices": scores.first().asDict()}

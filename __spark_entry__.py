
from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cache, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innledger.functions.hashing import id_digest
from innledger.operators import forest
from innledger.operators.expectations import rule_metrics
from innledger.operators.sampling import sample_rows
from innledger.plans import gold, pricing, serving, silver
from innledger.plans.refresh import (
    HISTORY,
    record_rules,
    refresh_bronze,
    refresh_layer,
    refresh_prices,
)
from innledger.schemas import INGESTION_COLUMN, LANDING_TABLES
from innledger.session import shared_folder, tuned
from innledger.sources import star_schema as raw
from innledger.sources.landing import REJECTED, read_landing, write_landing
from innledger.sources.layers import LayerStore

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the filtered reports.
RANGE = ("1997-01-01", "1998-06-30")
_IN_RANGE = f"BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"
HOTEL = 3
ROOM = 7
PAGE = 1
PAGES_WALKED = 4
# What the landing files plant: one amount in so many does not parse, and one name in so
# many has a line break, quotes, commas and blanks.
BAD_AMOUNT_EVERY, ODD_NAME_EVERY = 1009, 11
_ODD_NAME = "concat(name, '\\n  \"Jr\", esq. ')"
# Cells whose characters are counted after the round trip.
TEXT_CELLS = {
    "hotels": ["hotel_name", "country"],
    "rooms": ["room_type_code", "room_type_desc"],
    "customers": ["name", "email"],
    "bookings": ["currency", "status", "source"],
    "payments": ["currency"],
}


def _hotels(spark, sf):
    return silver.hotels(raw.raw_hotels(spark, sf))


def _customers(spark, sf):
    return silver.customers(raw.raw_customers(spark, sf), ["copy_no"])


def _half_blank_customers(spark, sf):
    """Customers without the column that says which copy is first, and of those that are
    there twice one copy without an e-mail."""
    return raw.raw_customers(spark, sf).selectExpr(
        "customer_id", "name", "if(copy_no = 0 AND customer_id % 40 = 0, '', email) AS email"
    )


def _rooms(spark, sf):
    return silver.rooms(raw.raw_rooms(spark, sf), ["copy_no"])


def _bookings(spark, sf):
    return silver.bookings(raw.raw_bookings(spark, sf))


def _payments(spark, sf):
    return silver.payments(raw.raw_payments(spark, sf), raw.raw_bookings(spark, sf))


def _daily(spark, sf):
    return gold.daily_revenue(_bookings(spark, sf))


def _collection(spark, sf):
    payments = silver.counted_payments(raw.raw_payments(spark, sf), raw.raw_bookings(spark, sf))
    return gold.collection_rate(payments, _bookings(spark, sf), copies="copies")


def _alerts(spark, sf):
    return gold.overbooking_alerts(_bookings(spark, sf))


def _customer_value(spark, sf):
    return gold.customer_value(_bookings(spark, sf))


def _features(spark, sf):
    return pricing.price_features(_bookings(spark, sf), _rooms(spark, sf))


@cache
def _priced_store(app: str, sf: str) -> LayerStore:
    """The whole pricing job: features, the saved model, predictions. Done once for a
    session and its tables, with the defaults of the package."""
    spark = SparkSession.getActiveSession()
    store = LayerStore(spark, shared_folder(spark))
    store.write(_features(spark, sf), "gold.price_features")
    refresh_prices(store, f"{store.root}/model")
    return store


def _priced(spark, sf) -> LayerStore:
    return _priced_store(spark.sparkContext.applicationId, sf)


def _model(spark, sf):
    """The model as it was saved."""
    return pricing.load_model(spark, f"{_priced(spark, sf).root}/model")


def _predictions(spark, sf):
    """Scored anew with the saved model."""
    features = _priced(spark, sf).read("gold.price_features")
    return pricing.predicted_prices(_model(spark, sf), features)


def _sampled_predictions(spark, sf):
    features = _priced(spark, sf).read("gold.price_features")
    return serving.prediction_sample(_model(spark, sf), features)


def _model_metrics(spark, sf):
    """Whether the model is better than the mean, and by how much."""
    return pricing.price_model_metrics(_predictions(spark, sf)).selectExpr(
        "test_rows",
        *[f"round({c}, 4) AS {c}" for c in ("rmse", "r2", "baseline_rmse")],
        "rmse < baseline_rmse AND r2 > 0.5 AS useful",
    )


def _model_leaves(spark, sf):
    """The saved leaves against the training rows that fall into them."""
    features = _priced(spark, sf).read("gold.price_features")
    samples = pricing.price_samples(features)
    return forest.leaf_report(samples, _model(spark, sf), pricing.FEATURES)


def _catalog_report(spark, sf):
    """Two tables written to databases of the catalog and read back from there."""
    store = LayerStore(spark, prefix=f"innledger_{uuid4().hex}_")
    store.create_layers()
    store.write(_bookings(spark, sf), "silver.bookings")
    store.write(gold.cancellation_rate(store.read("silver.bookings")), "gold.cancellation_rate")
    return store.read("gold.cancellation_rate")


def _repeated_alerts(spark, sf):
    """Alerts on bookings of which some are listed three times."""
    bookings = _bookings(spark, sf)
    again = bookings.filter("booking_id % 5 = 0")
    return gold.overbooking_alerts(bookings.unionByName(again).unionByName(again))


def _walked_pages(spark, sf):
    """The first pages of the alerts, each read on from the last row of the one before."""
    store = LayerStore(spark, shared_folder(spark))
    store.write(_repeated_alerts(spark, sf), "gold.overbooking_alerts")
    alerts, after, pages = store.read("gold.overbooking_alerts"), None, []
    for _ in range(PAGES_WALKED):
        page = serving.overbooking_after(alerts, after)
        rows = page.collect()  # one page
        if not rows:
            break
        pages.append(page)
        after = tuple(rows[-1])
    empty = serving.overbooking_after(alerts).limit(0)
    return reduce(DataFrame.unionByName, pages, empty)


def _bronze_ingest(spark, sf):
    """Land the five raw tables as CSV, ingest them, and count what arrived."""
    store = LayerStore(spark, shared_folder(spark))
    landing = f"{store.root}/landing"
    planted = {
        "payments": {
            "amount": f"CASE WHEN payment_id % {BAD_AMOUNT_EVERY} = 0 THEN '1,200.50'"
            " ELSE CAST(amount AS STRING) END"
        },
        "customers": {
            "name": f"CASE WHEN customer_id % {ODD_NAME_EVERY} = 0 THEN {_ODD_NAME} ELSE name END"
        },
    }

    def land(table):
        df = raw.RAW_TABLES[table](spark, sf)
        odd = {c: F.expr(e) for c, e in planted.get(table, {}).items()}
        write_landing(df.withColumns(odd) if odd else df, landing, table)

    with ThreadPoolExecutor(len(LANDING_TABLES)) as pool:
        list(pool.map(land, LANDING_TABLES))
    refresh_bronze(store, landing)

    def counted(table):
        df = store.read(f"bronze.{table}")
        filled = " + ".join(f"count({c})" for c in df.columns if c != INGESTION_COLUMN)
        texts = " + ".join(f"coalesce(sum(length({c})), 0)" for c in TEXT_CELLS[table])
        rejects = store.read(f"bronze.{table}_rejects").count()
        return df.selectExpr(
            f"'{table}' AS table_name",
            "count(*) AS row_count",
            f"count({INGESTION_COLUMN}) AS stamped_rows",
            f"{filled} AS filled_cells",
            f"{texts} AS text_length",
            f"{rejects}L AS rejects",
        )

    return reduce(DataFrame.unionByName, map(counted, LANDING_TABLES))


def _landing_ranges(spark, sf):
    """Customers in CSV files, of whose names every second has a line break, quotes and commas,
    read by ranges of bytes."""
    folder = f"{shared_folder(spark)}/ranges"
    write_landing(
        raw.raw_customers(spark, sf).withColumn(
            "name", F.expr(f"CASE WHEN customer_id % 2 = 0 THEN {_ODD_NAME} ELSE name END")
        ),
        folder,
        "customers",
    )
    rows = read_landing(spark, f"{folder}/customers.csv", "customers", ranges=True)
    return rows.select("customer_id", "name", "email", F.expr(f"{REJECTED} IS NULL").alias("fits"))


def _rule_history(spark, sf):
    """Two refreshes of hotels and bookings, the second with half the bookings, and what the
    history says of them."""
    store = LayerStore(spark, shared_folder(spark))
    landing = f"{store.root}/landing"
    write_landing(raw.raw_hotels(spark, sf), landing, "hotels")
    for run, part in (("first", "true"), ("second", "booking_id % 2 = 0")):
        write_landing(raw.raw_bookings(spark, sf).filter(part), landing, "bookings")
        metrics = refresh_bronze(store, landing, ["hotels", "bookings"])
        metrics |= refresh_layer(store, "silver", ["silver.hotels", "silver.bookings"])
        metrics |= refresh_layer(store, "gold", ["gold.cancellation_rate"])
        record_rules(store, run, metrics)
    return store.read(HISTORY)


def _cross_filters(spark, sf):
    """The three filters of the dashboard, each with the other two set."""
    rules = {
        "hotel_id": f"hotel_id = {HOTEL}",
        "room_id": f"room_id % 10 = {HOTEL}",
        "checkin_date": f"checkin_date {_IN_RANGE}",
    }
    return serving.cross_filter_values(_bookings(spark, sf), rules)


def _box_plot(spark, sf):
    plot = serving.ticket_box_plot(_customer_value(spark, sf))
    # Engines interpolate quantiles in different operation order; compare eight digits.
    return plot.selectExpr(
        "bookings_count",
        *[f"round({c}, 8) AS {c}_ticket" for c in ("min", "q1", "median", "q3", "max")],
    )


def _price_sample(spark, sf):
    """The sampling operator on its own, on values any engine can compute."""
    sample = sample_rows(
        _features(spark, sf).select("booking_id", "actual_price"),
        "booking_id",
        serving.SAMPLE_ROWS,
        pricing.SEED,
    )
    return sample.withColumn("digest", id_digest("booking_id", pricing.SEED))


_QUERIES: dict[str, Query] = {
    "bronze_ingest": _bronze_ingest,
    "landing_ranges": _landing_ranges,
    "silver_hotels": _hotels,
    "silver_customers": _customers,
    "silver_rooms": _rooms,
    "silver_bookings": _bookings,
    "silver_payments": _payments,
    "dq_rule_metrics": lambda spark, sf: rule_metrics(
        raw.raw_hotels(spark, sf), "hotels", silver.HOTEL_RULES
    ),
    "daily_revenue": lambda spark, sf: serving.by_date(_daily(spark, sf)),
    "cancellation_rate": lambda spark, sf: gold.cancellation_rate(_bookings(spark, sf)),
    "collection_rate": _collection,
    "overbooking_alerts": _alerts,
    "customer_value": _customer_value,
    "daily_bookings_trend": lambda spark, sf: serving.daily_bookings_trend(_daily(spark, sf)),
    "revenue_in_range": lambda spark, sf: serving.revenue_in_range(_daily(spark, sf), *RANGE),
    "collection_for_hotel": lambda spark, sf: serving.collection_for_hotel(
        _collection(spark, sf), HOTEL
    ),
    "collection_report": lambda spark, sf: serving.collection_report(_collection(spark, sf)),
    "ticket_box_plot": _box_plot,
    "top_customers": lambda spark, sf: serving.top_customers(_customer_value(spark, sf)),
    "top_overbooked_rooms": lambda spark, sf: serving.top_overbooked_rooms(_alerts(spark, sf)),
    "overbooking_page": lambda spark, sf: serving.overbooking_page(_alerts(spark, sf), PAGE),
    "filter_values": lambda spark, sf: serving.filter_values(
        _alerts(spark, sf), "room_id", f"overlap_start {_IN_RANGE}"
    ),
    "filter_values_hotel": lambda spark, sf: serving.filter_values(
        _collection(spark, sf), "hotel_id", f"collection_rate < {serving.COLLECTION_TARGET}"
    ),
    "filter_values_date": lambda spark, sf: serving.filter_values(
        _daily(spark, sf), "date", f"date {_IN_RANGE}"
    ),
    "cross_filter_values": _cross_filters,
    "rule_history": _rule_history,
    "price_features": _features,
    "price_sample": _price_sample,
    "predicted_prices": _predictions,
    "scored_bookings": lambda spark, sf: _priced(spark, sf).read("gold.predicted_prices"),
    "price_model_metrics": _model_metrics,
    "price_model_nodes": _model,
    "price_model_leaves": _model_leaves,
    "prediction_sample": _sampled_predictions,
    "prediction_scatter": lambda spark, sf: serving.prediction_scatter(_predictions(spark, sf)),
    "catalog_report": _catalog_report,
    "overbooking_room_page": lambda spark, sf: serving.overbooking_page(
        _alerts(spark, sf), room_id=ROOM
    ),
    "overbooking_walk": _walked_pages,
    "silver_customers_untied": lambda spark, sf: silver.customers(
        _half_blank_customers(spark, sf)
    ),
    "prediction_bounds": lambda spark, sf: serving.prediction_bounds(_features(spark, sf)),
}


def _on_tuned_session(query: Query) -> Query:
    return lambda spark, sf_dir: query(tuned(spark), sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: overlapping bookings of the same room."""
    return queries()["overbooking_alerts"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    own = _QUERIES | _llm()[0]
    return {name: _on_tuned_session(query) for name, query in own.items()}


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """The training-data operators and their pipeline, where they can be imported, and the
    SQL of those that SQL can express."""
    try:
        import corpus_pipeline
        from innledger.llm import queries as llm
    except ImportError:
        return {}, {}
    return llm.QUERIES | {"pipeline": corpus_pipeline.run}, llm.ORACLE


# --- The same queries as SQL on the driver's tables ---------------------------------

_CTES = {
    "raw_hotels": """
        SELECT s_suppkey AS hotel_id, s_name AS hotel_name,
               CAST(3 + s_suppkey % 3 AS INT) AS stars,
               CASE WHEN s_nationkey = 0 THEN 'XX' WHEN s_nationkey = 1 THEN NULL
                    ELSE n_name END AS country
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "raw_rooms": """
        SELECT p_partkey AS room_id, p_partkey % 10 AS hotel_id,
               CASE p_type WHEN 'ECONOMY' THEN 'single' WHEN 'STANDARD' THEN 'double'
                           WHEN 'PROMO' THEN 'suite' WHEN 'LARGE' THEN 'family'
                           ELSE p_type END AS room_type_code,
               p_type AS room_type_desc,
               CAST(CASE WHEN p_size % 10 = 0 THEN NULL ELSE 1 + p_size % 4 END AS INT)
                 AS max_occupancy,
               copy_no
        FROM part JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1 AS copy_no) c
          ON copy_no = 0 OR p_partkey % 50 = 0""",
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_name AS name,
               CASE WHEN c_custkey % 7 = 0 THEN ''
                    ELSE concat('c', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
               copy_no
        FROM customer JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1 AS copy_no) c
          ON copy_no = 0 OR c_custkey % 40 = 0""",
    "raw_bookings": """
        SELECT o_orderkey AS booking_id, o_custkey AS customer_id,
               CAST(floor(o_custkey / 10.0) AS BIGINT) AS room_id,
               CAST(floor(o_custkey / 10.0) AS BIGINT) % 10 AS hotel_id,
               CAST(o_orderdate AS DATE) AS checkin_date,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 11 - 2 AS INT) END
                 AS checkout_date,
               CASE WHEN o_orderkey % 23 = 0 THEN -amount
                    WHEN o_orderkey % 29 = 0 THEN NULL ELSE amount END AS total_amount,
               CASE WHEN o_orderkey % 13 = 0 THEN 'XXX' WHEN o_orderkey % 13 = 1 THEN NULL
                    WHEN o_orderkey % 13 < 6 THEN 'USD' WHEN o_orderkey % 13 < 9 THEN 'GBP'
                    ELSE 'EUR' END AS currency,
               CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'cancelled'
                                  ELSE 'pending' END AS status,
               CASE WHEN o_orderkey % 89 = 0 THEN NULL
                    WHEN o_orderpriority = '1-URGENT' THEN 'mobile'
                    WHEN o_orderpriority = '2-HIGH' THEN 'expedia'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'booking.com'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'walk_in'
                    ELSE 'web' END AS source
        FROM (SELECT *, CAST(600000 * abs(o_orderkey % 11 - 2) * (5 + quarter(o_orderdate))
                             + CAST(round(o_totalprice * 100) AS BIGINT) % 5000000 AS DOUBLE)
                        / 100 AS amount
              FROM orders)""",
    "raw_payments": """
        SELECT l_orderkey * 10 + l_linenumber AS payment_id,
               CASE WHEN l_partkey % 31 = 0 THEN -l_orderkey - 1 ELSE l_orderkey END
                 AS booking_id,
               l_extendedprice AS amount,
               CASE WHEN l_suppkey % 10 = 9 THEN 'XXX' WHEN l_suppkey % 10 = 8 THEN NULL
                    ELSE 'EUR' END AS currency
        FROM lineitem""",
    "hotels": "SELECT * FROM raw_hotels WHERE coalesce(country <> 'XX', true)",
    "customers": """
        SELECT customer_id, name, nullif(email, '') AS email, copy_no
        FROM raw_customers
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY copy_no) = 1""",
    "rooms": """
        SELECT * FROM raw_rooms
        QUALIFY row_number() OVER (PARTITION BY room_id ORDER BY copy_no) = 1""",
    "bookings": """
        SELECT booking_id, customer_id, room_id, hotel_id,
               CASE WHEN checkin_date > checkout_date THEN checkout_date
                    ELSE checkin_date END AS checkin_date,
               CASE WHEN checkin_date > checkout_date THEN checkin_date
                    ELSE checkout_date END AS checkout_date,
               CASE WHEN total_amount < 0 THEN NULL ELSE total_amount END AS total_amount,
               currency, status, source
        FROM raw_bookings WHERE currency IN ('EUR', 'USD', 'GBP')""",
    "payments": """
        SELECT p.payment_id, p.booking_id, p.amount,
               CASE WHEN p.currency IN ('EUR', 'USD', 'GBP') THEN p.currency END AS currency,
               b.total_amount IS NULL AS orphan, p.amount > b.total_amount AS over_amount
        FROM raw_payments p LEFT JOIN raw_bookings b ON p.booking_id = b.booking_id""",
    "daily": """
        SELECT checkin_date AS date,
               round(CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE), 2)
                 AS gross_revenue,
               count(*) AS bookings_count
        FROM bookings
        WHERE status = 'confirmed' AND total_amount IS NOT NULL AND currency IS NOT NULL
        GROUP BY checkin_date""",
    "cancellation": """
        SELECT source, count(*) AS total_bookings,
               CAST(sum(CASE WHEN status = 'cancelled' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled,
               CAST(sum(CASE WHEN status = 'cancelled' THEN 1 ELSE 0 END) AS DOUBLE)
                 / count(*) * 100 AS cancellation_rate_pct
        FROM bookings GROUP BY source""",
    "collection": """
        SELECT hotel_id, total_bookings_value, total_payments_value,
               total_payments_value / nullif(total_bookings_value, 0) AS collection_rate
        FROM (SELECT b.hotel_id,
                     CAST(sum(CAST(b.total_amount AS DECIMAL(18, 2))) AS DOUBLE)
                       AS total_bookings_value,
                     CAST(sum(CAST(p.amount AS DECIMAL(18, 2))) AS DOUBLE)
                       AS total_payments_value
              FROM payments p LEFT JOIN bookings b ON p.booking_id = b.booking_id
              WHERE NOT p.orphan AND NOT p.over_amount AND p.currency IS NOT NULL
              GROUP BY b.hotel_id)""",
    "alerts": """
        SELECT a.room_id, a.booking_id AS booking_id_1, b.booking_id AS booking_id_2,
               greatest(a.checkin_date, b.checkin_date) AS overlap_start,
               least(a.checkout_date, b.checkout_date) AS overlap_end
        FROM bookings a JOIN bookings b
          ON a.room_id = b.room_id AND a.booking_id < b.booking_id
         AND a.checkin_date < b.checkout_date AND b.checkin_date < a.checkout_date
        WHERE a.status <> 'cancelled' AND b.status <> 'cancelled'""",
    "value_of_customers": """
        SELECT customer_id, count(*) AS bookings_count,
               CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue_sum,
               CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE)
                 / nullif(count(total_amount), 0) AS avg_ticket
        FROM bookings GROUP BY customer_id""",
    "features": """
        SELECT booking_id, total_amount AS actual_price,
               CAST(checkout_date - checkin_date AS INT) AS stay_duration,
               max_occupancy, room_type_code,
               CAST(CASE room_type_code WHEN 'single' THEN 1 WHEN 'double' THEN 2
                    WHEN 'suite' THEN 3 WHEN 'family' THEN 4 ELSE 2 END AS INT) AS room_type_num,
               CAST(month(checkin_date) AS INT) AS month,
               CAST((month(checkin_date) - 1) // 3 + 1 AS INT) AS season,
               CAST(isodow(checkin_date) >= 6 AS INT) AS is_weekend,
               -- 0.8 as a hexadecimal fraction is 0.cccc...
               md5(booking_id || '|42') < 'cccccccc' AS is_train
        FROM bookings b LEFT JOIN (SELECT room_id AS r, room_type_code, max_occupancy
                                   FROM rooms) ON r = b.room_id
        WHERE total_amount > 0 AND checkout_date - checkin_date > 0
          AND max_occupancy IS NOT NULL""",
}


def _sql(select: str, more: dict[str, str] | None = None) -> str:
    # "bookings" and "rooms" only exist as CTEs; none shadows a driver table.
    ctes = [f"{name} AS ({body})" for name, body in _CTES.items()]
    # What several levels of the forest read is kept, or it would be worked out anew in each.
    ctes += [f"{name} AS MATERIALIZED ({body})" for name, body in (more or {}).items()]
    return f"WITH {', '.join(ctes)} {select}"


def _forest_ctes() -> dict[str, str]:
    """The price model, level by level: ``model`` has its nodes, ``scored`` its predictions."""
    names, depth = pricing.FEATURES, pricing.DEPTH
    by = ", ".join(names)
    cuts = forest.poisson_thresholds()
    times = " ".join(f"WHEN u < '{cut}' THEN {n}" for n, cut in enumerate(cuts))
    value = " ".join(f"WHEN {i} THEN CAST({c} AS DOUBLE)" for i, c in enumerate(names))
    down = f"2 * node + CAST(CASE feature {value} END > threshold AS INT)"
    listed = ", ".join(f"{{feature: {i}, value: CAST({c} AS DOUBLE)}}" for i, c in enumerate(names))
    ctes = {
        "drawn": f"""
            SELECT {by}, CAST(round(actual_price * 100) AS BIGINT) AS label, b * 16 + i AS tree,
                   substr(sha256(concat_ws('|', booking_id, {pricing.SEED}, b)), 1 + i * 4, 4) AS u
            FROM features, range(7) AS x(b), range(16) AS y(i)
            WHERE is_train AND b * 16 + i < {pricing.TREES}""",
        "samples": f"""
            SELECT tree, {by}, CAST(sum(n) AS BIGINT) AS weight,
                   CAST(sum(n * label) AS BIGINT) AS total
            FROM (SELECT *, CASE {times} ELSE {len(cuts)} END AS n FROM drawn)
            WHERE n > 0 GROUP BY tree, {by}""",
        "rows_0": f"SELECT tree, 1 AS node, {by}, weight, total FROM samples",
    }
    for k in range(depth):
        ctes[f"splits_{k}"] = f"""
            SELECT tree, node, feature, threshold
            FROM (SELECT *, CAST(lt AS DOUBLE) * CAST(lt AS DOUBLE) / CAST(lw AS DOUBLE)
                            + CAST(total - lt AS DOUBLE) * CAST(total - lt AS DOUBLE)
                              / nullif(CAST(weight - lw AS DOUBLE), 0)
                            - CAST(total AS DOUBLE) * CAST(total AS DOUBLE)
                              / CAST(weight AS DOUBLE) AS gain,
                         (value + next) / 2 AS threshold
                  FROM (SELECT tree, node, feature, value,
                               lead(value) OVER (PARTITION BY tree, node, feature
                                                 ORDER BY value) AS next,
                               sum(w) OVER (PARTITION BY tree, node, feature
                                            ORDER BY value) AS lw,
                               sum(t) OVER (PARTITION BY tree, node, feature
                                            ORDER BY value) AS lt,
                               sum(w) OVER (PARTITION BY tree, node, feature) AS weight,
                               sum(t) OVER (PARTITION BY tree, node, feature) AS total
                        FROM (SELECT tree, node, s.feature AS feature, s.value AS value,
                                     CAST(sum(weight) AS BIGINT) AS w,
                                     CAST(sum(total) AS BIGINT) AS t
                              FROM (SELECT tree, node, weight, total, unnest([{listed}]) AS s
                                    FROM rows_{k})
                              GROUP BY ALL))
                  WHERE next IS NOT NULL)
            WHERE gain > {forest.LEAST_GAIN} * (CAST(total AS DOUBLE) * CAST(total AS DOUBLE)
                                                / CAST(weight AS DOUBLE))
            QUALIFY row_number() OVER (PARTITION BY tree, node
                                       ORDER BY gain DESC, feature, threshold) = 1"""
        ctes[f"rows_{k + 1}"] = f"""
            SELECT tree, {down} AS node, {by}, weight, total
            FROM rows_{k} JOIN splits_{k} USING (tree, node)"""
    levels = [
        f"SELECT tree, node, weight, total, feature, threshold"
        f" FROM rows_{k} LEFT JOIN splits_{k} USING (tree, node)"
        for k in range(depth)
    ]
    levels.append(f"SELECT tree, node, weight, total, NULL, NULL FROM rows_{depth}")
    ctes["model"] = f"""
        SELECT CAST(tree AS INT) AS tree, CAST(node AS INT) AS node,
               CAST(any_value(feature) AS INT) AS feature,
               any_value(threshold) AS threshold, CAST(sum(weight) AS BIGINT) AS weight,
               CAST(floor(CAST(sum(total) AS DOUBLE) / CAST(sum(weight) AS DOUBLE) * 10000 + 0.5)
                    AS BIGINT) AS millionths
        FROM ({" UNION ALL ".join(levels)}) GROUP BY tree, node"""
    ctes["at_0"] = f"""
        SELECT *, 1 AS node
        FROM (SELECT DISTINCT {by} FROM features), (SELECT DISTINCT tree FROM model)"""
    for k in range(depth):
        ctes[f"at_{k + 1}"] = f"""
            SELECT a.* REPLACE (coalesce({down.replace("node", "a.node")}, a.node) AS node)
            FROM at_{k} a LEFT JOIN model m
              ON m.tree = a.tree AND m.node = a.node AND m.feature IS NOT NULL"""
    ctes["scores"] = f"""
        SELECT {by}, CAST(sum(millionths) AS DOUBLE) / (count(*) * 1000000) AS predicted_price
        FROM at_{depth} JOIN model USING (tree, node) GROUP BY {by}"""
    ctes["scored"] = f"SELECT * FROM features JOIN scores USING ({by})"
    return ctes


def _bronze_sql() -> str:
    # A blank cell of a CSV file is read as NULL.
    odd_name = f"""CASE WHEN customer_id % {ODD_NAME_EVERY} = 0
        THEN name || chr(10) || '  "Jr", esq. ' ELSE name END"""
    bad = f"payment_id % {BAD_AMOUNT_EVERY} = 0"
    columns = {
        "hotels": (["hotel_id", "stars"], TEXT_CELLS["hotels"], "false"),
        "rooms": (
            ["room_id", "hotel_id", "max_occupancy", "copy_no"],
            TEXT_CELLS["rooms"],
            "false",
        ),
        "customers": (["customer_id", "copy_no"], [odd_name, "nullif(email, '')"], "false"),
        "bookings": (
            ["booking_id", "customer_id", "room_id", "hotel_id", "checkin_date",
             "checkout_date", "total_amount"],
            TEXT_CELLS["bookings"],
            "false",
        ),
        "payments": (
            ["payment_id", "booking_id", f"CASE WHEN NOT {bad} THEN amount END"],
            TEXT_CELLS["payments"],
            bad,
        ),
    }
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS row_count, count(*) AS stamped_rows, "
        f"{' + '.join(f'count({c})' for c in [*others, *texts])} AS filled_cells, "
        f"CAST({' + '.join(f'coalesce(sum(length({c})), 0)' for c in texts)} AS BIGINT)"
        f" AS text_length, count(*) FILTER (WHERE {rejected}) AS rejects FROM raw_{table}"
        for table, (others, texts, rejected) in columns.items()
    )


def oracle_sql() -> dict[str, str]:
    scored = """
        SELECT booking_id, actual_price, predicted_price, stay_duration, max_occupancy,
               room_type_code, season, is_train
        FROM scored"""
    of_model = {
        "scored_bookings": scored,
        "predicted_prices": scored,
        "prediction_scatter": "SELECT booking_id, actual_price, predicted_price FROM scored",
        "prediction_sample": """
            SELECT booking_id, actual_price, predicted_price
            FROM scored ORDER BY md5(booking_id || '|42'), booking_id LIMIT 200""",
        "price_model_metrics": """
            SELECT test_rows, round(rmse, 4) AS rmse, round(r2, 4) AS r2,
                   round(baseline_rmse, 4) AS baseline_rmse, true AS useful
            FROM (SELECT count(*) AS test_rows, sqrt(avg(error * error)) AS rmse,
                         1 - avg(error * error) / var_pop(actual_price) AS r2,
                         sqrt(var_pop(actual_price)) AS baseline_rmse
                  FROM (SELECT actual_price, actual_price - predicted_price AS error
                        FROM scored WHERE NOT is_train))""",
        "price_model_nodes": "SELECT * FROM model",
        "price_model_leaves": """
            SELECT tree, count(*) AS leaves, CAST(sum(weight) AS BIGINT) AS weight,
                   CAST(0 AS BIGINT) AS wrong
            FROM model WHERE feature IS NULL GROUP BY tree""",
    }
    selects = {
        "bronze_ingest": _bronze_sql(),
        "landing_ranges": """
            SELECT CAST(customer_id AS VARCHAR) AS customer_id,
                   CASE WHEN customer_id % 2 = 0
                        THEN name || chr(10) || '  "Jr", esq. ' ELSE name END AS name,
                   nullif(email, '') AS email, true AS fits
            FROM raw_customers""",
        "silver_hotels": "SELECT * FROM hotels",
        "silver_customers": "SELECT * FROM customers",
        "silver_rooms": "SELECT * FROM rooms",
        "silver_bookings": "SELECT * FROM bookings",
        "silver_payments": "SELECT * FROM payments",
        "dq_rule_metrics": """
            SELECT 'hotels' AS table_name, 'country_valid' AS rule,
                   count(*) FILTER (WHERE coalesce(country <> 'XX', true)) AS passed,
                   count(*) FILTER (WHERE country = 'XX') AS failed
            FROM raw_hotels""",
        "daily_revenue": "SELECT * FROM daily ORDER BY date",
        "cancellation_rate": "SELECT * FROM cancellation",
        "collection_rate": "SELECT * FROM collection",
        "overbooking_alerts": "SELECT * FROM alerts",
        "customer_value": "SELECT * FROM value_of_customers",
        "daily_bookings_trend": """
            SELECT CAST(date_trunc('day', date) AS DATE) AS day,
                   CAST(sum(bookings_count) AS BIGINT) AS bookings
            FROM daily GROUP BY 1""",
        "revenue_in_range": f"SELECT * FROM daily WHERE date {_IN_RANGE}",
        "collection_for_hotel": f"""
            SELECT hotel_id, collection_rate FROM collection WHERE hotel_id = {HOTEL}""",
        "collection_report": """
            SELECT hotel_id, total_bookings_value, total_payments_value, collection_rate,
                   coalesce(collection_rate < 0.95, false) AS below_target,
                   printf('%.2f', total_bookings_value) AS bookings_value_text,
                   printf('%.2f', total_payments_value) AS payments_value_text,
                   printf('%.2f', collection_rate * 100) || '%' AS collection_rate_text
            FROM collection ORDER BY collection_rate DESC NULLS LAST, hotel_id""",
        "ticket_box_plot": """
            SELECT bookings_count,
                   round(min(avg_ticket), 8) AS min_ticket,
                   round(quantile_cont(avg_ticket, 0.25), 8) AS q1_ticket,
                   round(median(avg_ticket), 8) AS median_ticket,
                   round(quantile_cont(avg_ticket, 0.75), 8) AS q3_ticket,
                   round(max(avg_ticket), 8) AS max_ticket
            FROM value_of_customers GROUP BY bookings_count""",
        "top_customers": """
            SELECT * FROM value_of_customers
            ORDER BY revenue_sum DESC NULLS LAST, customer_id LIMIT 10""",
        "top_overbooked_rooms": """
            SELECT room_id, count(*) AS "count" FROM alerts WHERE room_id IS NOT NULL
            GROUP BY room_id ORDER BY count(*) DESC, room_id LIMIT 10""",
        "overbooking_page": f"""
            SELECT * FROM alerts
            ORDER BY room_id, booking_id_1, booking_id_2, overlap_start, overlap_end
            LIMIT 25 OFFSET {PAGE * 25}""",
        "overbooking_room_page": f"""
            SELECT * FROM alerts WHERE room_id = {ROOM}
            ORDER BY booking_id_1, booking_id_2, overlap_start, overlap_end LIMIT 25""",
        "overbooking_walk": f"""
            SELECT room_id, booking_id_1, booking_id_2, overlap_start, overlap_end,
                   CAST(n AS BIGINT) AS copy
            FROM (SELECT *, unnest(range(1, CAST(CASE WHEN booking_id_1 % 5 = 0 THEN 3 ELSE 1 END
                    * CASE WHEN booking_id_2 % 5 = 0 THEN 3 ELSE 1 END + 1 AS BIGINT))) AS n
                  FROM alerts)
            ORDER BY room_id, booking_id_1, booking_id_2, overlap_start, overlap_end, n
            LIMIT {PAGES_WALKED * 25}""",
        "catalog_report": "SELECT * FROM cancellation",
        "silver_customers_untied": """
            SELECT customer_id, min(name) AS name,
                   min(nullif(CASE WHEN copy_no = 0 AND customer_id % 40 = 0 THEN '' ELSE email
                              END, '')) AS email
            FROM raw_customers GROUP BY customer_id""",
        "filter_values": f"""
            SELECT room_id, count(*) FILTER (WHERE overlap_start {_IN_RANGE}) AS associated
            FROM alerts GROUP BY room_id""",
        "filter_values_hotel": """
            SELECT hotel_id, count(*) FILTER (WHERE collection_rate < 0.95) AS associated
            FROM collection GROUP BY hotel_id""",
        "filter_values_date": f"""
            SELECT date, count(*) FILTER (WHERE date {_IN_RANGE}) AS associated
            FROM daily GROUP BY date""",
        "cross_filter_values": " UNION ALL ".join(
            f"""SELECT '{column}' AS filter, CAST({column} AS VARCHAR) AS value,
                       count(*) FILTER (WHERE {others}) AS associated
                FROM bookings GROUP BY {column}"""
            for column, others in (
                ("hotel_id", f"room_id % 10 = {HOTEL} AND checkin_date {_IN_RANGE}"),
                ("room_id", f"hotel_id = {HOTEL} AND checkin_date {_IN_RANGE}"),
                ("checkin_date", f"hotel_id = {HOTEL} AND room_id % 10 = {HOTEL}"),
            )
        ),
        "rule_history": " UNION ALL ".join(
            f"""SELECT '{run}' AS run, '{table}' AS table_name, '{rule}' AS rule,
                       count(*) FILTER (WHERE {passes}) AS passed,
                       count(*) FILTER (WHERE NOT {passes}) AS failed FROM {rows}"""
            for run, part in (("first", "true"), ("second", "booking_id % 2 = 0"))
            for table, rule, passes, rows in (
                ("bronze.hotels", "record_parses", "true", "raw_hotels"),
                ("bronze.bookings", "record_parses", "true", f"raw_bookings WHERE {part}"),
                ("silver.hotels", "country_valid", "coalesce(country <> 'XX', true)",
                 "raw_hotels"),
                ("silver.bookings", "currency_valid",
                 "coalesce(currency IN ('EUR', 'USD', 'GBP'), false)",
                 f"raw_bookings WHERE {part}"),
                ("gold.cancellation_rate", "written", "true",
                 f"(SELECT DISTINCT source FROM bookings WHERE {part})"),
            )
        ),
        "price_features": "SELECT * FROM features",
        "price_sample": """
            SELECT booking_id, actual_price, md5(booking_id || '|42') AS digest
            FROM features ORDER BY digest, booking_id LIMIT 200""",
        "prediction_bounds": """
            SELECT min(actual_price) AS lowest, max(actual_price) AS highest FROM features""",
    }
    own = {name: _sql(select) for name, select in selects.items()}
    own |= {name: _sql(select, _forest_ctes()) for name, select in of_model.items()}
    return own | _llm()[1]

"""Registered queries over the driver's tables.

Every query takes ``(spark, sf_dir)``, derives the raw tables from the
driver's Parquet files (``sources.testdata``) and returns a DataFrame over the
whole input. The independent DuckDB statement of each key is in
``plans.oracle.ORACLE_SQL``.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleaning import (
    clean_discount_code, date_parts_sql, fill_region, parse_flag, typed_sql,
)
from tidemark.operators import distinct as D
from tidemark.operators import intermediate as I
from tidemark.operators import quality as Q
from tidemark.operators.marts import MONTH_KEYS, report_order
from tidemark.operators.staging import orders, rejects, stg_events
from tidemark.plans import oracle as O
from tidemark.plans.build import (
    INTERMEDIATE, MARTS, REPORTS, STAGING, ChecksFailed, Models, materialize, staging_views,
)
from tidemark.session import lake_root, written, written_meanwhile
from tidemark.sources.raw import load_bronze, read_found, read_raw, write_csv
from tidemark.sources.sinks import CODEC, Layout
from tidemark.sources.testdata import raw_tables
from tidemark.streaming import follow_events, ingest_raw_stream, refresh_customers

# Loyalty threshold on the driver's data (FIXTURES.md §3); the library
# default stays at the reference's value.
THRESHOLD = O.THRESHOLD

Query = Callable[[SparkSession, str], DataFrame]


ModelQuery = Callable[[Models], DataFrame]


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(raw_tables(spark, sf_dir), THRESHOLD)


# --------------------------------------------------------------------------- probes over raw tables

def _made_once(m: Models, name: str):
    """A raw table written down for a block that reads it more than once: its
    joins are not made again for every read."""
    return written_meanwhile(m.raw[name], f"raw-{name}", CODEC)


def q_src_events_csv(m: Models) -> DataFrame:
    """S1+S4: raw events exported as CSV (as the spreadsheet exporter does),
    scanned back with the declared all-text schema, loaded into bronze Parquet."""
    events = m.raw["events"]
    spark = events.sparkSession
    root = os.path.join(lake_root(spark), f"landing-{uuid.uuid4().hex[:8]}")
    write_csv(events, os.path.join(root, "events_csv"))
    scanned = read_raw(spark, "events", os.path.join(root, "events_csv"), "csv")
    return Layout(spark, root).write(scanned, "bronze", "events")


def q_stream_ingest_events(m: Models) -> DataFrame:
    """Incremental bronze load: raw events land as CSV in two batches (orders,
    then everything else); an ``availableNow`` file stream with one checkpoint
    loads each batch once. The bronze table must equal the whole raw table."""
    spark = m.raw["events"].sparkSession
    root = os.path.join(lake_root(spark), f"stream-{uuid.uuid4().hex[:8]}")
    landing, bronze = os.path.join(root, "landing"), os.path.join(root, "bronze", "events")
    checkpoint = os.path.join(root, "checkpoints", "events")
    is_order = F.col("event_type").eqNullSafe(F.lit("order"))

    def ingest() -> None:
        ingest_raw_stream(spark, "events", os.path.join(landing, "*"), bronze,
                          checkpoint).awaitTermination()

    with _made_once(m, "events") as events:
        write_csv(events.where(is_order), os.path.join(landing, "batch-1"))
        ingest()
        write_csv(events.where(~is_order), os.path.join(landing, "batch-2"))
    ingest()
    return spark.read.parquet(bronze)


def q_op_region_fill(m: Models) -> DataFrame:
    ev = m.raw["events"].where(F.col("event_id").isNotNull()).select(
        F.lit("events").alias("source"), F.col("event_id").alias("row_key"),
        F.col("country").alias("raw_country"), F.col("region").alias("raw_region"),
        fill_region("country", "region", trim_values=False).alias("region"))
    cu = m.raw["customers"].where(F.col("customer_id").isNotNull()).select(
        F.lit("customers").alias("source"), F.col("customer_id").alias("row_key"),
        F.col("country").alias("raw_country"), F.col("region").alias("raw_region"),
        fill_region("country", "region", trim_values=True).alias("region"))
    return ev.unionByName(cu)


def q_op_discount_code_clean(m: Models) -> DataFrame:
    ev = m.raw["events"].where(F.col("event_id").isNotNull())
    return ev.select("event_id", F.col("discount_code").alias("raw_discount_code"),
                     clean_discount_code("discount_code").alias("discount_code"))


def q_op_flag_parse(m: Models) -> DataFrame:
    ev = m.raw["events"].where(F.col("event_id").isNotNull())
    return ev.select("event_id", F.col("is_refunded").alias("raw_is_refunded"),
                     parse_flag("is_refunded").alias("is_refunded"))


def q_op_date_parts(m: Models) -> DataFrame:
    ev = m.raw["events"].where(F.col("event_id").isNotNull())
    typed = ev.selectExpr("event_id", f"{typed_sql('event_date', 'timestamp_ntz')} AS event_date")
    return typed.selectExpr("event_id", "event_date",
                            *[f"{sql} AS {n}" for n, sql in date_parts_sql("event_date").items()])


# --------------------------------------------------------------------------- probes over models

def q_orders_with_loyalty(m: Models) -> DataFrame:
    """Each order with its customer's loyalty flag."""
    o = orders(m.stg_events).select("event_id", "customer_id", "channel", "net_revenue_usd")
    return I.with_loyalty(o, I.loyalty_flags(m.int_customer_orders, m.threshold))


def q_dq_schema_drift_csv(m: Models) -> DataFrame:
    """Drift of CSV files whose header differs from the declared columns:
    products without ``vendor`` and with an undeclared ``maker``."""
    spark = m.raw["products"].sparkSession
    root = os.path.join(lake_root(spark), f"drift-{uuid.uuid4().hex[:8]}")
    found = {}
    for name, df in m.raw.items():
        df = df.withColumnRenamed("vendor", "maker") if name == "products" else df
        write_csv(df, os.path.join(root, name))
        found[f"raw.{name}"] = read_found(spark, os.path.join(root, name))
    return Q.dq_schema_drift(found)


def q_mart_channel_performance_default(m: Models) -> DataFrame:
    """M9 with the library's default loyalty threshold."""
    return Models(m.raw).mart_channel_performance


def _check_tables(m: Models) -> dict[str, DataFrame]:
    return {f"raw.{k}": v for k, v in m.raw.items()} | m.staged()


def q_sink_roundtrip(m: Models) -> DataFrame:
    """The channel mart written to the gold layer and scanned back."""
    spark = m.stg_events.sparkSession
    layout = Layout(spark, os.path.join(lake_root(spark), f"build-{uuid.uuid4().hex[:8]}"))
    return layout.write(m.mart_channel_performance, "gold", "mart_channel_performance")


def _model_query(name: str) -> ModelQuery:
    return lambda m: m.model(name)


def _report_query(name: str) -> ModelQuery:
    return lambda m: m.report(name)


def _raw_query(name: str) -> ModelQuery:
    return lambda m: m.raw[name]


def _new_layout(spark: SparkSession, name: str, schemas: dict | None = None) -> Layout:
    return Layout(spark, os.path.join(lake_root(spark), f"{name}-{uuid.uuid4().hex[:8]}"), schemas)


def _csv_back(m: Models, name: str) -> DataFrame:
    """A raw table exported as CSV and read back, cells with line feeds included."""
    spark = m.raw[name].sparkSession
    path = os.path.join(_new_layout(spark, "landing").root, f"{name}_csv")
    df = m.raw[name]
    text = {"products": "product_name", "customers": "segment"}[name]
    write_csv(df.withColumn(text, F.concat(text, F.lit('\n"'), text, F.lit('",'))), path)
    return read_raw(spark, name, path, "csv", {"multiLine": True})


def in_text(df: DataFrame, name: str, *kept: str) -> DataFrame:
    """(mart, row) and ``kept`` columns: each row of a table as one text, its
    other columns by name."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("~"))
             for c in sorted(df.columns) if c not in kept]
    return df.select(F.lit(name).alias("mart"), F.concat_ws("|", *cells).alias("row"), *kept)


def q_gold_by_name(m: Models) -> DataFrame:
    """The production build into layers of other names, and all rows of
    the seven marts read back by table name, as text."""
    spark = m.stg_events.sparkSession
    layout = _new_layout(spark, "named", {"silver": " tidemark_clean ",
                                          "gold": "tidemark_reporting"})
    materialize(m.raw, layout, m.threshold, register=True)
    return reduce(DataFrame.unionByName, [
        in_text(spark.table(f"tidemark_reporting.{n}"), n) for n in MARTS])


def q_silver_views(m: Models) -> DataFrame:
    """Staging as catalog views over loaded bronze, read by name in another
    session: the typed products."""
    spark = m.stg_events.sparkSession
    layout = _new_layout(spark, "views", {"bronze": "tidemark_raw", "silver": "tidemark_views"})
    load_bronze(m.raw, layout)
    staging_views(layout)
    return spark.newSession().table("tidemark_views.stg_products")


# What the marts read of the events.
MART_EVENT_COLUMNS = (
    "event_id", "event_type", "customer_id", "product_id", "event_date", "country", "region",
    "channel", "currency", "unit_price_local", "net_revenue_usd", "discount_local",
    "fx_rate_to_usd", "discount_code", "is_refunded", *MONTH_KEYS)


def q_report_order(m: Models) -> DataFrame:
    """O1, O2: the seven marts in report order with row positions, stored, as text.
    What they read of the events is written once; several are made at a time."""
    layout = _new_layout(m.stg_events.sparkSession, "ordered")
    build = layout.begin()
    read = orders(m.stg_events).select(*MART_EVENT_COLUMNS)
    staged = Models(m.raw, m.threshold, {"stg_events": written(read, "mart-events", CODEC)})
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda n: build.write(report_order(n, staged.model(n)), "gold", n), MARTS))
    release = build.publish()
    return reduce(DataFrame.unionByName, [
        in_text(layout.read("gold", n, release), n, "position") for n in MARTS])


def broken_events(events: DataFrame) -> DataFrame:
    """Raw events with planted faults: of the line items of quantity 11 the type
    is capitalised, and those of quantity 7 are there three times."""
    quantity = F.col("quantity")
    times = F.when(quantity == "7", 3).otherwise(1)
    kind = F.when(quantity == "11", F.upper("event_type")).otherwise(F.col("event_type"))
    return (events.withColumn("event_type", kind)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy"))


def q_dq_violations(m: Models) -> DataFrame:
    """Write, audit, publish over raw events with planted faults. The
    repeated keys stop the build; what it publishes is the quarantine."""
    layout = _new_layout(m.stg_events.sparkSession, "audited")
    raw = {**m.raw, "events": broken_events(m.raw["events"])}
    try:
        materialize(raw, layout, m.threshold)
    except ChecksFailed:
        pass
    return layout.read("silver", "quarantine")


def badly_typed_events(events: DataFrame) -> DataFrame:
    """Raw events with cells that cannot be cast, planted by quantity."""
    q = F.col("quantity")
    return events.withColumns({
        "quantity": F.when(q == "13", "13 pcs").when(q == "50", "99999999999").otherwise(q),
        "event_date": F.when(q == "8", F.concat(F.lit("~"), "event_date"))
        .otherwise(F.col("event_date")),
        "net_revenue_usd": F.when(q == "21", F.translate("net_revenue_usd", ".", ","))
        .otherwise(F.col("net_revenue_usd")),
        "unit_price_local": F.when(q == "30", "N/A").otherwise(F.col("unit_price_local")),
        "latitude": F.when(q == "40", "1234567.0").otherwise(F.col("latitude"))})


def q_dq_file_drift(m: Models) -> DataFrame:
    """S5 by file: each raw table lands as CSV in two folders, the second products
    folder with ``maker`` for ``vendor``; the files' folders and their columns."""
    spark = m.raw["products"].sparkSession
    root = _new_layout(spark, "landed").root
    for name in m.raw:
        with _made_once(m, name) as df:
            for batch in ("first", "second"):
                changed = name == "products" and batch == "second"
                rows = df.withColumnRenamed("vendor", "maker") if changed else df
                write_csv(rows, os.path.join(root, name, batch))
    found = Q.dq_file_drift(spark, {n: os.path.join(root, n, "*") for n in m.raw})
    folder = F.element_at(F.split("file", "/"), -2).alias("folder")
    return found.select("model", folder, "column_name", "status").distinct()


def q_dq_rejects(m: Models) -> DataFrame:
    """the cells that a lenient build turns into null."""
    return rejects({**m.raw, "events": badly_typed_events(m.raw["events"])})


def q_inc_customer_orders(m: Models) -> DataFrame:
    """M4 kept up to date: raw events land as CSV in two batches, each applied
    once by a stream, and the summary is made from the stored partials."""
    spark = m.raw["events"].sparkSession
    layout = _new_layout(spark, "followed")
    landing = os.path.join(layout.root, "landing")
    half = F.coalesce(F.crc32("event_id") % 2, F.lit(0))

    def follow() -> None:
        follow_events(spark, os.path.join(landing, "*"), layout,
                      os.path.join(layout.root, "checkpoint")).awaitTermination()

    with _made_once(m, "events") as events:
        write_csv(events.where(half == 0), os.path.join(landing, "batch-0"))
        follow()
        write_csv(events.where(half == 1), os.path.join(landing, "batch-1"))
    follow()
    return refresh_customers(layout, m.stg_customers, m.threshold)["int_customer_orders"]


def _bitmaps(m: Models) -> DataFrame:
    layout = _new_layout(m.stg_events.sparkSession, "bitmaps")
    return layout.write(D.customer_bitmaps(m.stg_events, m.stg_products, m.threshold),
                        "silver", "customer_bitmaps")


# Queries that write files while being built (timed by the full build in the bench).
WRITING = ("src_events_csv", "stream_ingest_events", "sink_roundtrip", "dq_schema_drift_csv",
           "src_products_csv", "src_customers_csv", "gold_by_name", "silver_views",
           "report_order", "dq_violations", "dq_file_drift", "inc_customer_orders",
           "bm_every_level", "bm_billing_cycle_revenue", "bm_billing_cycle")

OVER_MODELS: dict[str, ModelQuery] = {
    "src_events": _raw_query("events"),
    "src_products": _raw_query("products"),
    "src_customers": _raw_query("customers"),
    "src_events_csv": q_src_events_csv,
    "src_products_csv": lambda m: _csv_back(m, "products"),
    "src_customers_csv": lambda m: _csv_back(m, "customers"),
    "stream_ingest_events": q_stream_ingest_events,
    **{n: _model_query(n) for n in STAGING},
    "orders_only": lambda m: orders(m.stg_events),
    "orders_with_loyalty": q_orders_with_loyalty,
    "op_region_fill": q_op_region_fill,
    "op_discount_code_clean": q_op_discount_code_clean,
    "op_flag_parse": q_op_flag_parse,
    "op_date_parts": q_op_date_parts,
    # Every order's rank among its customer's orders
    "op_purchase_rank": lambda m: I.all_purchase_ranks(m.stg_events),
    "op_days_to_second_purchase": lambda m: I.second_purchase(m.stg_events),
    **{n: _model_query(n) for n in INTERMEDIATE},
    **{n: _model_query(n) for n in MARTS},
    "mart_channel_performance_default": q_mart_channel_performance_default,
    "dq_not_null": lambda m: Q.dq_not_null(_check_tables(m)),
    "dq_unique": lambda m: Q.dq_unique(_check_tables(m)),
    "dq_accepted_values": lambda m: Q.dq_accepted_values(_check_tables(m)),
    "dq_row_counts": lambda m: Q.dq_row_counts(_check_tables(m)),
    "dq_schema_drift": lambda m: Q.dq_schema_drift(_check_tables(m)),
    "dq_schema_drift_csv": q_dq_schema_drift_csv,
    "dq_orphans": lambda m: Q.dq_orphans(m.stg_events, m.stg_products, m.stg_customers),
    "dq_violations": q_dq_violations,
    "dq_rejects": q_dq_rejects,
    "dq_file_drift": q_dq_file_drift,
    "dq_castability": lambda m: Q.dq_castability(
        {**m.raw, "events": badly_typed_events(m.raw["events"])}),
    # typed events of the same raw rows, with nulls for what was rejected
    "stg_events_lenient": lambda m: stg_events(badly_typed_events(m.raw["events"]), lenient=True),
    "sink_roundtrip": q_sink_roundtrip,
    "gold_by_name": q_gold_by_name,
    "silver_views": q_silver_views,
    "report_order": q_report_order,
    "inc_customer_orders": q_inc_customer_orders,
    # Distinct customers at every level from one table of bitmaps
    "bm_every_level": lambda m: D.every_level(_bitmaps(m)),
    "bm_billing_cycle_revenue": lambda m: D.billing_cycle_revenue(_bitmaps(m)),
    "bm_billing_cycle": lambda m: D.billing_cycles(_bitmaps(m)),
    **{n: _report_query(n) for n in REPORTS},
}


def _over_driver_tables(fn: ModelQuery) -> Query:
    return lambda spark, sf_dir: fn(models(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _over_driver_tables(fn) for name, fn in OVER_MODELS.items()}

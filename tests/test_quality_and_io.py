"""Data checks on clean/broken fixtures; sinks, CSV source and streaming ingest."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemark.operators import quality as Q
from tidemark.operators import staging as S
from tidemark.plans.build import (
    INTERMEDIATE, MARTS, STAGING, Models, materialize, stored_models,
)
from tidemark.plans.inspect import nodes
from tidemark.sources import raw
from tidemark.sources.raw import read_raw, write_csv
from tidemark.sources.sinks import Layout, layer_name
from tidemark.streaming import ingest_raw_stream


def _tables(spark, event_rows, product_rows, customer_rows):
    raw = {"events": fx.events(spark, event_rows), "products": fx.products(spark, product_rows),
           "customers": fx.customers(spark, customer_rows)}
    m = Models(raw)
    return raw, m, {f"raw.{k}": v for k, v in raw.items()} | m.staged()


def _failures(df):
    return {(r.model, r.column_name): r.failures for r in df.collect()}


def test_checks_pass_on_clean_data(spark):
    raw, m, t = _tables(spark, [{"event_id": "E1", "customer_id": "C1", "product_id": "P1"}],
                        [{"product_id": "P1"}], [{"customer_id": "C1"}])
    checks = m.checks().collect()
    assert len(checks) == 14 and all(r.failures == 0 for r in checks)


def test_broken_keys_trip_each_check(spark):
    ev = [{"event_id": "E1", "customer_id": "C1", "product_id": "P1"},
          {"event_id": "E1", "customer_id": "C1", "product_id": "P1"},
          {"event_id": "E2", "customer_id": "C1", "product_id": None},
          {"event_id": "E3", "customer_id": "C1", "product_id": "P1", "event_type": "ORDER"}]
    raw, m, t = _tables(spark, ev, [{"product_id": "P1"}, {"product_id": "P1"}],
                        [{"customer_id": "C1"}])
    nn = _failures(Q.dq_not_null(t))
    assert nn[("stg_events", "product_id")] == 1 and nn[("stg_events", "event_id")] == 0
    uq = _failures(Q.dq_unique(t))
    assert uq[("stg_events", "event_id")] == 1 and uq[("stg_products", "product_id")] == 1
    assert uq[("raw.products", "product_id")] == 1
    av = _failures(Q.dq_accepted_values(t))
    assert av[("stg_events", "event_type")] == 1
    combined = {(r.check_name, r.model, r.column_name): r.failures for r in m.checks().collect()}
    separate = {(r.check_name, r.model, r.column_name): r.failures
                for df in (Q.dq_not_null(t), Q.dq_unique(t), Q.dq_accepted_values(t))
                for r in df.collect()}
    assert combined == separate and len(combined) == 14


def test_orphans_and_row_counts(spark):
    ev = [{"customer_id": "C1", "product_id": "P1"}, {"customer_id": "GHOST", "product_id": "P1"},
          {"customer_id": "GHOST", "product_id": "NOPE"}, {"customer_id": None, "product_id": "P1"}]
    raw, m, t = _tables(spark, ev, [{"product_id": "P1"}], [{"customer_id": "C1"}])
    orph = {r.foreign_key: (r.orphan_keys, r.orphan_events)
            for r in Q.dq_orphans(m.stg_events, m.stg_products, m.stg_customers).collect()}
    assert orph == {"customer_id": (1, 2), "product_id": (1, 1)}
    counts = {r.model: r.row_count for r in Q.dq_row_counts(t).collect()}
    assert counts == {"raw.events": 4, "raw.products": 1, "raw.customers": 1}


def test_schema_drift(spark):
    raw, m, t = _tables(spark, [{"customer_id": "C1"}], [{"product_id": "P1"}],
                        [{"customer_id": "C1"}])
    drifted = dict(t)
    drifted["raw.products"] = t["raw.products"].drop("vendor").withColumn("extra", F.lit("x"))
    rows = {(r.model, r.column_name): r.status for r in Q.dq_schema_drift(drifted).collect()}
    assert rows[("raw.products", "vendor")] == "missing"
    assert rows[("raw.products", "extra")] == "added"
    assert rows[("raw.events", "event_id")] == "ok"


def test_drift_names_the_file(spark, scratch):
    rows = fx.products(spark, [{"product_id": "P1"}]).coalesce(1)
    path = os.path.join(scratch, "products")
    write_csv(rows, os.path.join(path, "a"))
    write_csv(rows.withColumnRenamed("vendor", 'odd, "name"').drop("category"),
              os.path.join(path, "b"))
    found = Q.dq_file_drift(spark, {"products": os.path.join(path, "*")}).collect()
    odd = {(r.file.rsplit("/", 2)[1], r.column_name, r.status) for r in found if r.status != "ok"}
    assert odd == {("b", 'odd, "name"', "added"), ("b", "vendor", "missing"),
                   ("b", "category", "missing")}
    assert {r.file.rsplit("/", 2)[1] for r in found} == {"a", "b"}


def test_layer_names_and_roundtrip(spark, scratch):
    assert layer_name(" gold ", "x") == "gold" and layer_name(None, "silver") == "silver"
    layout = Layout(spark, scratch)
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    back = layout.write(df, "gold", "t")
    assert sorted(r.v for r in back.collect()) == [0, 2, 4, 6, 8]
    assert layout.path("gold", "t") == os.path.join(scratch, "gold", "t")
    # full rebuild replaces the table
    layout.write(spark.range(2).withColumn("v", F.col("id")), "gold", "t")
    assert layout.read("gold", "t").count() == 2


def test_csv_source_keeps_padding_and_reads_blanks_as_null(spark, scratch):
    raw = fx.events(spark, [{"event_id": "E1", "channel": " Website ", "discount_code": "",
                             "region": "  "}])
    path = os.path.join(scratch, "events_csv")
    write_csv(raw, path)
    back = read_raw(spark, "events", path, "csv").collect()[0]
    assert back.channel == " Website " and back.region == "  " and back.discount_code is None
    assert S.stg_events(read_raw(spark, "events", path, "csv")).collect()[0].channel == "Website"


def test_materialize_writes_silver_checks_and_gold(spark, scratch):
    ev = fx.orders_for("C1", 3, product_id="P1") + fx.orders_for("C2", 1, product_id="P1")
    raw = {"events": fx.events(spark, ev), "products": fx.products(spark, [{"product_id": "P1"}]),
           "customers": fx.customers(spark, [{"customer_id": "C1"}, {"customer_id": "C2"}])}
    gold, checks = materialize(raw, Layout(spark, scratch), threshold=2, register=True)
    by_name = spark.sql("SELECT total_orders FROM gold.mart_channel_performance").collect()
    assert [r.total_orders for r in by_name] == [4]
    assert set(gold) == set(MARTS)
    assert gold["mart_channel_performance"].collect()[0].loyal_customers == 1
    assert checks.count() == 14
    assert os.path.isdir(os.path.join(scratch, "silver", "stg_events"))
    names = {t.name for t in spark.catalog.listTables("silver")}
    assert names >= {*STAGING, *INTERMEDIATE}
    assert {t.name for t in spark.catalog.listTables("gold")} >= set(MARTS)
    summary = spark.sql("SELECT customer_id, total_orders FROM silver.int_customer_orders")
    assert {tuple(r) for r in summary.collect()} == {("C1", 3), ("C2", 1)}


def test_reports_read_the_written_tables(spark, scratch):
    ev = fx.orders_for("C1", 3, product_id="P1") + fx.orders_for("C2", 1, product_id="P1")
    raw = {"events": fx.events(spark, ev), "products": fx.products(spark, [{"product_id": "P1"}]),
           "customers": fx.customers(spark, [{"customer_id": "C1"}, {"customer_id": "C2"}])}
    layout = Layout(spark, scratch)
    materialize(raw, layout, threshold=2)
    m = stored_models(layout)
    assert m.threshold == 2
    mart = m.mart_sales_by_month.withColumn("total_orders", F.lit(99).cast("bigint"))
    m = Models(threshold=2, stored={"mart_sales_by_month": mart})
    assert m.report("rep_peak_month").first().total_orders == 99


def test_streaming_ingest_is_incremental(spark, scratch):
    landing, bronze = os.path.join(scratch, "landing"), os.path.join(scratch, "bronze")
    ckpt = os.path.join(scratch, "ckpt")
    write_csv(fx.events(spark, [{"event_id": "E1"}, {"event_id": "E2"}]), os.path.join(landing, "b1"))
    q = ingest_raw_stream(spark, "events", os.path.join(landing, "*"), bronze, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(bronze).count() == 2
    write_csv(fx.events(spark, [{"event_id": "E3"}]), os.path.join(landing, "b2"))
    q = ingest_raw_stream(spark, "events", os.path.join(landing, "*"), bronze, ckpt)
    q.awaitTermination(120)
    assert sorted(r.event_id for r in spark.read.parquet(bronze).collect()) == ["E1", "E2", "E3"]


def test_command_line_build_from_csv(spark, scratch, capsys):
    from tidemark.__main__ import main
    ev = fx.orders_for("C1", 3, product_id="P1") + fx.orders_for("C2", 1, product_id="P2")
    paths = {}
    for name, df in (("events", fx.events(spark, ev)),
                     ("products", fx.products(spark, [{"product_id": "P1"}, {"product_id": "P2"}])),
                     ("customers", fx.customers(spark, [{"customer_id": "C1"}, {"customer_id": "C2"}]))):
        paths[name] = os.path.join(scratch, "in", name)
        write_csv(df, paths[name])
    lake = os.path.join(scratch, "lake")
    assert main(["build", "--events", paths["events"], "--products", paths["products"],
                 "--customers", paths["customers"], "--lake", lake, "--threshold", "3"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert len(out) == 15 and '"gold"' in out[-1]
    chan = spark.read.parquet(os.path.join(lake, "gold", "mart_channel_performance")).collect()[0]
    assert (chan.total_orders, chan.unique_customers, chan.loyal_customers) == (4, 2, 1)
    assert os.path.isdir(os.path.join(lake, "bronze", "events"))
    assert main(["report", "rep_billing_cycle", "rep_loyal_share", "--lake", lake,
                 "--threshold", "3"]) == 0
    share = spark.read.parquet(os.path.join(lake, "gold", "reports", "rep_loyal_share")).collect()[0]
    assert (share.loyal_customers, share.ordering_customers) == (1, 2)


def test_command_line_shows_report_order(spark, scratch, capsys):
    from tidemark.__main__ import main
    rows = [{"event_id": f"E{i}", "customer_id": "C1", "product_id": "P1", "channel": channel,
             "net_revenue_usd": usd}
            for i, (channel, usd) in enumerate([("Amazon", "5.00"), ("Website", "70.00"),
                                                ("Store", "20.00")])]
    paths = {n: os.path.join(scratch, "in", n) for n in ("events", "products", "customers")}
    for name, df in (("events", fx.events(spark, rows)),
                     ("products", fx.products(spark, [{"product_id": "P1"}])),
                     ("customers", fx.customers(spark, [{"customer_id": "C1"}]))):
        write_csv(df, paths[name])
    lake = os.path.join(scratch, "lake")
    call = ["build", *[x for n, p in paths.items() for x in (f"--{n}", p)], "--lake", lake]
    assert main([*call, "--warn"]) == 0
    assert '"added"' not in capsys.readouterr().out
    main(["report", "mart_channel_performance", "--lake", lake])
    out = capsys.readouterr().out
    assert out.index("Website") < out.index("Store") < out.index("Amazon")
    # a column that the file does not declare is reported, then the build stops
    write_csv(fx.products(spark, [{"product_id": "P1"}]).withColumnRenamed("vendor", "maker"),
              paths["products"])
    with pytest.raises(ValueError, match="vendor"):
        main(call)
    drift = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {(r["column_name"], r["status"]) for r in drift} == {("maker", "added"),
                                                               ("vendor", "missing")}


def test_failing_checks_and_repeated_events(spark, scratch):
    from tidemark.__main__ import main
    parts = {"products": fx.products(spark, [{"product_id": "P1"}]),
             "customers": fx.customers(spark, [{"customer_id": "C1"}])}
    unknown = fx.events(spark, [{"event_id": "E1", "event_type": "gift", "customer_id": "C1",
                                 "product_id": "P1"}])
    paths = {n: os.path.join(scratch, "in", n) for n in ("events", "products", "customers")}
    for name, df in {"events": unknown, **parts}.items():
        write_csv(df, paths[name])
    call = ["build", *[x for n, p in paths.items() for x in (f"--{n}", p)],
            "--lake", os.path.join(scratch, "lake")]
    assert main(call) == 1 and main([*call, "--warn"]) == 0
    twice = fx.events(spark, [{"event_id": "E1"}, {"event_id": "E1"}])
    with pytest.raises(ValueError, match="event ids"):
        materialize({"events": twice, **parts}, Layout(spark, os.path.join(scratch, "again")))


def test_materialize_stops_on_duplicate_dimension_keys(spark, scratch):
    raw = {"events": fx.events(spark, fx.orders_for("C1", 2, product_id="P1")),
           "products": fx.products(spark, [{"product_id": "P1"}, {"product_id": "P1"}]),
           "customers": fx.customers(spark, [{"customer_id": "C1"}])}
    with pytest.raises(ValueError, match="duplicate dimension keys"):
        materialize(raw, Layout(spark, scratch), threshold=2)


def test_headers_are_found_without_sorting_lines(spark, scratch):
    rows = fx.products(spark, [{"product_id": f"P{i}"} for i in range(5)])
    write_csv(rows, os.path.join(scratch, "a"))
    write_csv(rows.withColumnRenamed("vendor", "maker"), os.path.join(scratch, "b"))
    headers = Q.file_headers(spark, os.path.join(scratch, "*"))
    ns = nodes(headers)
    assert "ObjectHashAggregate" in ns
    assert not {"Sort", "SortAggregate"} & set(ns[ns.index("ObjectHashAggregate"):])
    found = {os.path.basename(os.path.dirname(r.file)): r.columns for r in headers.collect()}
    assert found["a"] == rows.columns
    assert found["b"] == ["maker" if c == "vendor" else c for c in rows.columns]


def test_exported_files_are_compressed_and_bounded(spark, scratch, monkeypatch):
    monkeypatch.setitem(raw.CSV_EXPORT_OPTIONS, "maxRecordsPerFile", 4)
    ids = [f"E{i}" for i in range(10)]
    events = fx.events(spark, [{"event_id": i, "refund_reason": ' a "b", '} for i in ids]).coalesce(1)
    path = os.path.join(scratch, "events")
    write_csv(events, path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    back = read_raw(spark, "events", path).collect()
    assert sorted(r.event_id for r in back) == ids
    assert {r.refund_reason for r in back} == {' a "b", '}


def test_layers_are_written_with_the_smaller_codec(spark, scratch):
    Layout(spark, scratch).write(fx.events(spark, [{"event_id": "E1"}]), "bronze", "events")
    write_csv(fx.events(spark, [{"event_id": "E2"}]), os.path.join(scratch, "landing", "b1"))
    ingest_raw_stream(spark, "events", os.path.join(scratch, "landing", "*"),
                      os.path.join(scratch, "streamed"),
                      os.path.join(scratch, "ckpt")).awaitTermination(120)
    names = [f for _, _, fs in os.walk(scratch) for f in fs if f.endswith(".parquet")]
    assert len(names) >= 2 and all(".zstd." in f for f in names)

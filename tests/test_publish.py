"""Releases of the lake: versioned writes, audits before publication, layer
names, views, lenient casts, and the command line over them."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemark.operators import quality as Q
from tidemark.operators import staging as S
from tidemark.plans.build import (
    INTERMEDIATE, MARTS, STAGING, ChecksFailed, Models, materialize, stored_models,
)
from tidemark.sources.raw import load_bronze, read_raw, write_csv
from tidemark.sources.sinks import Layout, ReleaseConflict


def raw_of(spark, event_rows, products=("P1",), customers=("C1", "C2")):
    return {"events": fx.events(spark, event_rows),
            "products": fx.products(spark, [{"product_id": p} for p in products]),
            "customers": fx.customers(spark, [{"customer_id": c} for c in customers])}


def good(spark, n=3):
    return raw_of(spark, [dict(customer_id="C1", product_id="P1", event_id=f"G{i}")
                          for i in range(n)])


def orders_in(layout, release=None):
    return layout.read("gold", "mart_channel_performance", release).first().total_orders


# --------------------------------------------------------------------------- releases

def test_a_build_that_dies_changes_nothing(spark, scratch):
    layout = Layout(spark, scratch)
    materialize(good(spark), layout, threshold=2)
    before = layout.release()
    build = layout.begin()
    build.write(spark.range(3), "gold", "mart_channel_performance")  # and then it dies
    assert layout.release() == before and orders_in(layout) == 3
    # a failing write in the middle of a build as well
    broken = raw_of(spark, [dict(event_id="X", quantity="many", customer_id="C1",
                                 product_id="P1")])
    with pytest.raises(Exception, match="CAST"):
        materialize(broken, layout, threshold=2)
    assert layout.release() == before and orders_in(layout) == 3
    assert stored_models(layout).mart_channel_performance.count() == 1


def test_releases_switch_all_tables_at_once_and_stay_readable(spark, scratch):
    layout = Layout(spark, scratch)
    materialize(good(spark, 3), layout, threshold=2)
    first = layout.release()
    held = layout.read("gold", "mart_channel_performance")
    materialize(good(spark, 5), layout, threshold=4)
    second = layout.release()
    assert second.number == first.number + 1
    assert set(first.tables) == set(second.tables)
    assert all(first.tables[t] != second.tables[t] for t in first.tables)
    assert (orders_in(layout, first), orders_in(layout)) == (3, 5)
    assert held.first().total_orders == 3  # a reader's scan outlives the switch
    assert (stored_models(layout, first).threshold, stored_models(layout).threshold) == (2, 4)


def test_writers_of_other_tables_meet_and_of_one_table_conflict(spark, scratch):
    layout = Layout(spark, scratch)
    layout.write(spark.range(1), "gold", "t")
    one, two, three = layout.begin(), layout.begin(), layout.begin()
    one.write(spark.range(2), "gold", "t")
    two.write(spark.range(3), "silver", "u")
    three.write(spark.range(4), "gold", "t")
    one.publish()
    two.publish(note="kept")
    with pytest.raises(ReleaseConflict, match="gold.t"):
        three.publish()
    assert layout.read("gold", "t").count() == 2 and layout.read("silver", "u").count() == 3
    assert layout.release().settings == {"note": "kept"}
    # a taken number is never written over
    path = layout._release_path(layout.release().number)
    text = layout.files.read(path)
    assert layout.files.create(path, "{}") is False and layout.files.read(path) == text


def test_appends_and_vacuum(spark, scratch):
    layout = Layout(spark, scratch)
    for n in (1, 2):
        build = layout.begin()
        build.append(spark.range(n), "bronze", "t")
        build.publish()
    assert layout.read("bronze", "t").count() == 3
    layout.write(spark.range(5), "bronze", "t")
    layout.begin().write(spark.range(9), "bronze", "t")  # never published
    assert layout.vacuum() == []  # all are young
    gone = layout.vacuum(keep=1, older_than=dt.timedelta(0))
    assert len(gone) == 3 and layout.read("bronze", "t").count() == 5
    assert layout.releases() == [3]
    with pytest.raises(LookupError):
        layout.read("gold", "t")


def test_layer_names(spark, scratch):
    layout = Layout(spark, scratch, {"gold": " tm_marts ", "silver": ""})
    assert layout.path("gold", "x") == os.path.join(scratch, "tm_marts", "x")
    assert layout.path("silver", "x") == os.path.join(scratch, "silver", "x")
    materialize(good(spark), layout, threshold=2, register=True)
    assert spark.table("tm_marts.mart_channel_performance").first().total_orders == 3
    materialize(good(spark, 4), layout, threshold=2, register=True)
    assert spark.table("tm_marts.mart_channel_performance").first().total_orders == 4
    for bad in ({"copper": "x"}, {"gold": "one", "silver": "one"}):
        with pytest.raises(ValueError):
            Layout(spark, scratch, bad)


# --------------------------------------------------------------------------- audit

def test_blocked_build_publishes_only_its_audit(spark, scratch):
    layout = Layout(spark, scratch)
    materialize(good(spark), layout, threshold=2)
    before = layout.release()
    twice = raw_of(spark, [dict(event_id="E1", customer_id="C1", product_id="P1"),
                           dict(event_id="E1", customer_id="C1", product_id="P1"),
                           dict(event_id="E2", customer_id=None, product_id="P1"),
                           dict(event_id="E3", event_type="gift", customer_id="C1",
                                product_id="P1")])
    with pytest.raises(ChecksFailed, match="stg_events"):
        materialize(twice, layout, threshold=2)
    now = layout.release()
    changed = {t for t in now.tables if now.tables[t] != before.tables.get(t)}
    assert changed == {"silver.quarantine", "silver.data_checks"}
    assert layout.read("silver", "stg_events").count() == 3 and orders_in(layout) == 3
    rows = {tuple(r) for r in layout.read("silver", "quarantine").collect()}
    assert rows == {("unique", "stg_events", "event_id", "E1", "E1", 2),
                    ("not_null", "stg_events", "customer_id", "E2", None, 1),
                    ("accepted_values", "stg_events", "event_type", "E3", "gift", 1)}
    # other checks block where they are asked to
    null = raw_of(spark, [dict(event_id="E2", customer_id=None, product_id="P1")])
    materialize(null, layout, threshold=2)
    with pytest.raises(ChecksFailed):
        materialize(null, layout, threshold=2, blocking=("unique", "not_null"))


def test_audit_counts_what_the_checks_count(spark, scratch):
    ev = [dict(event_id=f"E{i % 7}", customer_id=None if i % 3 else "C1",
               product_id=None if i % 4 == 0 else "P1",
               event_type=("order", "invoice", "GIFT", "gift", "ORDER")[i % 5])
          for i in range(23)]
    raw = raw_of(spark, ev, products=("P1", "P1", "P2"), customers=("C1", "C1", "C1"))
    m = Models(raw)
    tables = {**{f"raw.{k}": v for k, v in raw.items() if k != "events"}, **m.staged()}
    found = Q.violations(tables)
    got = {tuple(r) for r in Q.check_results(found, list(tables)).collect()}
    assert got == {tuple(r) for r in m.checks().collect()} and len(got) == 14
    df, seen = Q.audited("stg_events", m.stg_events)
    df.write.parquet(os.path.join(scratch, "seen"))
    counts = seen.get
    assert counts["rows"] == 23 and counts["accepted_values:event_type"] == 13
    assert counts["not_null:customer_id"] == sum(1 for e in ev if e["customer_id"] is None)


# --------------------------------------------------------------------------- views, casts

def test_staging_as_views_gives_the_same_marts(spark, scratch):
    raw = good(spark, 4)
    tables, views = (Layout(spark, os.path.join(scratch, x), {"bronze": f"tm_b_{x}",
                                                              "silver": f"tm_s_{x}",
                                                              "gold": f"tm_g_{x}"})
                     for x in ("tables", "views"))
    a, _ = materialize(load_bronze(raw, tables), tables, threshold=2)
    b, _ = materialize(load_bronze(raw, views), views, threshold=2, staging="view", register=True)
    for n in MARTS:
        assert sorted(map(tuple, a[n].collect()), key=str) == \
            sorted(map(tuple, b[n].collect()), key=str)
    other = spark.newSession()
    assert other.table("tm_s_views.stg_events").count() == 4
    assert other.table("tm_s_views.stg_events").dtypes == tables.read("silver", "stg_events").dtypes
    names = {t.name: t.tableType for t in spark.catalog.listTables("tm_s_views")}
    assert {names[n] for n in STAGING} == {"VIEW"} and {names[n] for n in INTERMEDIATE} == {"EXTERNAL"}
    assert "silver.stg_events" not in views.release().tables
    assert stored_models(views).stg_events.count() == 4


BAD = dict(event_id="B", customer_id="C1", product_id="P1", quantity="two", event_date="soon",
           net_revenue_usd="1,5", latitude="  ", fx_rate_to_usd="12345678.1")


def test_lenient_build_lists_what_it_rejects(spark, scratch):
    layout = Layout(spark, scratch)
    raw = raw_of(spark, [BAD, dict(event_id="G", customer_id="C1", product_id="P1"),
                         dict(BAD, event_id=None)])
    with pytest.raises(Exception, match="CAST"):
        materialize(raw, layout, threshold=2)
    materialize(raw, layout, threshold=2, lenient=True)
    rows = {tuple(r) for r in layout.read("silver", "rejects").collect()}
    assert rows == {
        ("stg_events", "B", "quantity", "two", "int"),
        ("stg_events", "B", "event_date", "soon", "timestamp_ntz"),
        ("stg_events", "B", "net_revenue_usd", "1,5", "decimal(12,4)"),
        ("stg_events", "B", "fx_rate_to_usd", "12345678.1", "decimal(10,6)")}
    b = layout.read("silver", "stg_events").where("event_id = 'B'").first()
    assert (b.quantity, b.event_date, b.order_month, b.net_revenue_usd, b.latitude) == (None,) * 5
    assert b.discount_local == 0  # the rest of the row stays
    assert S.rejects(good(spark)).count() == 0


def test_cells_with_line_feeds(spark, scratch):
    rows = [{"product_id": "P1", "product_name": 'two\nlines "quoted", comma'}, {"product_id": "P2"}]
    path = os.path.join(scratch, "products")
    write_csv(fx.products(spark, rows), path)
    back = read_raw(spark, "products", path, "csv", {"multiLine": True})
    assert {r.product_id: r.product_name for r in back.collect()}["P1"] == rows[0]["product_name"]
    assert back.count() == 2


def test_command_line_options(spark, scratch, capsys):
    from tidemark.__main__ import main
    raw = raw_of(spark, [dict(event_id="G", customer_id="C1", product_id="P1"),
                         dict(BAD, refund_reason="line\nfeed")])
    paths = {n: os.path.join(scratch, "in", n) for n in raw}
    for name, df in raw.items():
        write_csv(df, paths[name])
    lake = os.path.join(scratch, "lake")
    call = ["build", *[x for n, p in paths.items() for x in (f"--{n}", p)], "--lake", lake,
            "--schema", "gold=tm_cli_gold", "--schema", "silver=tm_cli_silver"]
    with pytest.raises(Exception):
        main(call)  # the line feed breaks a row
    with pytest.raises(Exception, match="CAST"):
        main([*call, "--multiline"])
    assert main([*call, "--multiline", "--lenient"]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert json.loads(out[-1])["release"] == 3  # bronze twice, and the build
    assert spark.table("tm_cli_gold.mart_channel_performance").first().total_orders == 2
    assert spark.table("tm_cli_silver.stg_events").where(
        F.col("refund_reason") == "line\nfeed").count() == 1
    schemas = [x for x in call if "=" in x]
    assert main(["vacuum", "--lake", lake, "--keep", "1", "--hours", "0", "--schema", schemas[0],
                 "--schema", schemas[1]]) == 0
    assert "bronze/events/v=" in capsys.readouterr().out
    assert spark.table("tm_cli_gold.mart_channel_performance").first().total_orders == 2

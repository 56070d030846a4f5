"""Files that nothing reads any more do not stay until the session ends."""

import glob
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemark.plans import catalog as C
from tidemark.plans.build import Models, materialize
from tidemark.session import scratch_folder
from tidemark.sources.sinks import Layout


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirs() for f in glob.glob(f"{d}/*/shuffle_*.data")}


def _gone(files, within=10):
    """Files are removed in the background."""
    until = time.time() + within
    while files() and time.time() < until:
        time.sleep(0.1)
    return not files()


def _raw(spark):
    orders = [o for c in ("C1", "C2", None) for o in fx.orders_for(c, 3, product_id="P1")]
    return {"events": fx.events(spark, [*orders, {"event_type": "invoice", "customer_id": "C1"}]),
            "products": fx.products(spark, [{"product_id": "P1"},
                                            {"product_id": "P2", "category": "Add-on"}]),
            "customers": fx.customers(spark, [{"customer_id": "C1"}, {"customer_id": "C2"}])}


def test_build_leaves_no_shuffle_files(spark, scratch):
    before = _shuffle_files(spark)
    raw = _raw(spark)
    raw["events"] = raw["events"].repartition(3, "event_id")
    gold, _ = materialize(raw, Layout(spark, scratch), 2)
    assert gold["mart_channel_performance"].count() == 1
    assert _gone(lambda: _shuffle_files(spark) - before)


def test_a_frame_still_runs_twice(spark):
    before = _shuffle_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().orderBy("k")
    first = counts.collect()
    assert _gone(lambda: _shuffle_files(spark) - before)
    assert counts.collect() == first


@pytest.mark.parametrize("query", [C.q_stream_ingest_events, C.q_inc_customer_orders,
                                   C.q_dq_file_drift])
def test_raw_copies_go_when_they_have_landed(spark, query):
    folder = urlparse(scratch_folder(spark, "raw")).path.rsplit("/", 1)[0]
    before = set(glob.glob(f"{folder}/raw-*"))
    assert query(Models(_raw(spark), 2)).count()
    assert set(glob.glob(f"{folder}/raw-*")) <= before

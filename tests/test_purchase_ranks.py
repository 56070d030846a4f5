"""All purchase ranks without a task that holds a whole customer."""

import datetime as dt
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.operators import intermediate as I

COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def test_hot_customer_is_ranked_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(I, "RANKS_PER_ROW", 3)
    start = dt.datetime(2025, 1, 1)
    rows = [("HOT", start + dt.timedelta(seconds=k * 37 % 900)) for k in range(2000)]
    rows += [(None, start + dt.timedelta(seconds=k % 400)) for k in range(700)]
    rows += [(None, None)] * 20 + [("B", None)] * 2
    rows += [(f"C{k % 50}", start + dt.timedelta(days=k % 7)) for k in range(300)]
    rows += [("ONE", start)] * 40
    events = spark.createDataFrame([("order", *r) for r in rows] + [("invoice", "HOT", start)],
                                   "event_type string, customer_id string, event_date timestamp")
    was = spark.conf.get(COALESCE)
    spark.conf.set(COALESCE, "false")
    try:
        ranks = I.all_purchase_ranks(events)
        got = ranks.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(COALESCE, was)
    dates = defaultdict(list)
    for customer, date in rows:
        dates[customer].append(date)
    want = [(c, d, k) for c, all_of in dates.items()
            for k, d in enumerate(sorted(all_of, key=lambda d: (d is None, d or start)), 1)]
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:3]) for r in got)
    for customer in ("HOT", None):
        assert len({r["part"] for r in got if r["customer_id"] == customer}) > 1
    plan = ranks._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"\], \[customer_id#\d+\], \[event_date", plan)


def test_no_orders(spark):
    events = spark.createDataFrame([("invoice", "A", None)], "event_type string, "
                                   "customer_id string, event_date timestamp")
    assert I.all_purchase_ranks(events).count() == 0

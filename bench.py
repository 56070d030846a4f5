"""Benchmark: run the registered queries on $BENCH_SF_DIR and print one JSON line.

Each query is run once cold, then three times warm; the reported time is the
median of the warm runs. The action is a ``noop`` write, so the whole plan
executes without collecting rows to the driver. ``full_build`` times the
production path (staging written to silver, data checks, seven marts written
to gold) into a fresh scratch folder.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import intermediate as I  # noqa: E402
from tidemark.operators.staging import orders  # noqa: E402
from tidemark.plans.build import Models, materialize  # noqa: E402
from tidemark.plans.catalog import QUERIES, THRESHOLD, WRITING  # noqa: E402
from tidemark.session import get_session  # noqa: E402
from tidemark.sources.sinks import Layout  # noqa: E402
from tidemark.sources.testdata import raw_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SHUFFLE_PARTITIONS = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * CPUS))))


def _sf_label(path: str):
    base = os.path.basename(os.path.normpath(path))
    try:
        return float(base[2:]) if base.startswith("sf") else base
    except ValueError:
        return base


def _time(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def literal_channel(spark, sf_dir):
    """The reference's literal plan for the channel mart: every order joined to
    the loyalty table, then two different distinct counts per channel."""
    m = Models(raw_tables(spark, sf_dir), THRESHOLD)
    columns = orders(m.stg_events).select("event_id", "channel", "customer_id",
                                          "net_revenue_usd")
    o = I.with_loyalty(columns, I.loyalty_flags(m.int_customer_orders, THRESHOLD))
    return o.groupBy("channel").agg(
        F.count("event_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct(F.when(F.col("is_loyal_customer"), F.col("customer_id")))
        .alias("loyal_customers"),
        F.sum("net_revenue_usd").alias("total_revenue_usd"))


def literal_second_purchase(spark, sf_dir):
    """The literal self-join of rank-1 and rank-2 purchases."""
    ev = Models(raw_tables(spark, sf_dir), THRESHOLD).stg_events
    w = Window.partitionBy("customer_id").orderBy(F.asc_nulls_last("event_date"))
    ranked = orders(ev).select("customer_id", "event_date", F.row_number().over(w).alias("rk"))
    r1 = ranked.where("rk = 1").select("customer_id", F.col("event_date").alias("d1"))
    r2 = ranked.where("rk = 2").select("customer_id", F.col("event_date").alias("d2"))
    return r1.join(r2, "customer_id").select(
        "customer_id", F.datediff(F.col("d2").cast("date"), F.col("d1").cast("date")).alias("days"))


AB = {
    "mart_channel_performance": ("literal_channel", literal_channel),
    "op_days_to_second_purchase": ("literal_second_purchase", literal_second_purchase),
}


def main() -> None:
    spark = get_session(f"local[{CPUS}]", SHUFFLE_PARTITIONS, app_name="tidemark-bench",
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in QUERIES if n not in WRITING]
    only = os.environ.get("BENCH_QUERIES")
    if only:
        names = [n for n in names if n in only.split(",")]
    results, cold = {}, {}
    for name in names:
        def run():
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        cold[name] = round(_time(run), 3)
        results[name] = round(statistics.median(_time(run) for _ in range(RUNS)), 3)
        print(f"# {name}: cold {cold[name]}s warm {results[name]}s", file=sys.stderr)
    if not only:
        def build():
            root = tempfile.mkdtemp(prefix="tidemark-bench-")
            materialize(raw_tables(spark, SF_DIR), Layout(spark, root), THRESHOLD)
        cold["full_build"] = round(_time(build), 3)
        results["full_build"] = round(statistics.median(_time(build) for _ in range(RUNS)), 3)
        print(f"# full_build: cold {cold['full_build']}s warm {results['full_build']}s",
              file=sys.stderr)
    ab = {}
    if not only or os.environ.get("BENCH_AB"):
        for name, (label, fn) in AB.items():
            def run_literal():
                fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            run_literal()
            ab[label] = round(statistics.median(_time(run_literal) for _ in range(RUNS)), 3)
            if name in results:
                ab[name] = results[name]
        print(f"# literal vs rewritten: {ab}", file=sys.stderr)
    total = round(sum(results.values()), 3)
    print(json.dumps({
        "metric": "sum of per-query median warm seconds",
        "value": total,
        "unit": "sec",
        "queries": results,
        "cold": cold,
        "sf": _sf_label(SF_DIR),
        "cpus": CPUS,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "runs": RUNS,
        "literal_vs_rewritten": ab,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Customer models kept up to date batch by batch.

Each newly landed batch of raw events is appended to bronze, and its customer
partials (``operators.intermediate.customer_partials``) are appended to silver,
both in one release together with the batch's number. A batch that is run again
after a failure finds its number in the current release and changes nothing, so
every event counts exactly once. The customer models are then made from the
partials alone: the events of earlier batches are never read again.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.intermediate import (
    LOYALTY_THRESHOLD, customer_partials, customer_summary, int_loyal_customers, merged_partials,
)
from tidemark.operators.staging import stg_events
from tidemark.schemas import RAW_SCHEMAS
from tidemark.sources.raw import CSV_FORMAT
from tidemark.sources.sinks import Layout, ReleaseConflict

PARTIALS = "customer_partials"
MERGE_AFTER = 50  # appended versions after which a batch merges them


def apply_batch(layout: Layout, batch: DataFrame, number: int, stream: str = "events",
                lenient: bool = False) -> bool:
    """Add one batch of raw events; false where its number has been applied.

    Another writer's append in between raises ``ReleaseConflict``, and the batch
    is run again by its stream."""
    build = layout.begin()
    done = f"batch of {stream}"
    if number <= build.base.settings.get(done, -1):
        return False
    landed = build.append(batch, "bronze", "events")
    build.append(customer_partials(stg_events(landed, lenient)), "silver", PARTIALS)
    build.publish(**{done: number})
    if len(layout.release().versions("silver", PARTIALS)) > MERGE_AFTER:
        # another writer's append meanwhile leaves the merge to a later batch
        with contextlib.suppress(ReleaseConflict):
            merge_partials(layout)
    return True


def merge_partials(layout: Layout) -> None:
    """Replace the appended partials by one version with a row per customer, channel and day."""
    build = layout.begin()
    build.write(merged_partials(layout.read("silver", PARTIALS, build.base)), "silver", PARTIALS)
    build.publish()


def refresh_customers(layout: Layout, customers: DataFrame,
                      threshold: int = LOYALTY_THRESHOLD) -> dict[str, DataFrame]:
    """Rebuild and publish the customer summary and the loyal customers from the
    partials and the staged profiles."""
    build = layout.begin()
    partials = layout.read("silver", PARTIALS, build.base)
    summary = build.write(customer_summary(partials), "silver", "int_customer_orders")
    loyal = build.write(int_loyal_customers(summary, customers, threshold), "silver",
                        "int_loyal_customers")
    build.publish(threshold=int(threshold))
    return {"int_customer_orders": summary, "int_loyal_customers": loyal}


def follow_events(spark: SparkSession, landing_dir: str, layout: Layout, checkpoint_dir: str,
                  fmt: str = "csv", stream: str = "events", lenient: bool = False,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream that applies newly landed raw event files."""
    reader = spark.readStream.schema(RAW_SCHEMAS["events"])
    if fmt == "csv":
        reader = reader.options(**CSV_FORMAT, mode="FAILFAST", enforceSchema=False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def run(batch: DataFrame, number: int) -> None:
        apply_batch(layout, batch, number, stream, lenient)

    return (reader.format(fmt).load(landing_dir).writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())

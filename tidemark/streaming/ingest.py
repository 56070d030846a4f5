"""Incremental form of the bronze load.

The reference's only data movement is a bulk copy of raw files into bronze.
When raw files keep landing in a folder, the same load runs as a file-source
stream: each new file is read once with the declared all-text schema and
appended to bronze Parquet, with progress kept in a checkpoint so a restarted
or failed job neither skips nor repeats a file. ``availableNow`` processes
whatever has landed and stops, so the stream can be scheduled like a batch job
before each rebuild of silver and gold.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.schemas import RAW_SCHEMAS
from tidemark.sources.raw import CSV_FORMAT
from tidemark.sources.sinks import CODEC


def ingest_raw_stream(spark: SparkSession, name: str, landing_dir: str, bronze_dir: str,
                      checkpoint_dir: str, fmt: str = "csv",
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream loading new raw ``name`` files into bronze."""
    reader = spark.readStream.schema(RAW_SCHEMAS[name])
    if fmt == "csv":
        # a file whose header differs from the declared columns fails the load
        reader = reader.options(**CSV_FORMAT, mode="FAILFAST", enforceSchema=False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format(fmt).load(landing_dir)
    return (stream.writeStream.format("parquet")
            .option("path", bronze_dir)
            .option("compression", CODEC)
            .option("checkpointLocation", checkpoint_dir)
            .outputMode("append")
            .trigger(availableNow=True)
            .start())

"""Raw (bronze) sources: events, products and customers as all-text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.schemas import RAW_SCHEMAS

# The exporter's CSV: a header, and quotes inside a quoted cell doubled.
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"'}


def read_found(spark: SparkSession, path: str, fmt: str = "csv",
               options: dict | None = None) -> DataFrame:
    """Scan a raw table with the columns it has, undeclared ones too (CSV: all
    strings, by the names in the header)."""
    if fmt == "table":
        return spark.table(path)
    csv = CSV_FORMAT if fmt == "csv" else {}
    return spark.read.format(fmt).options(**csv, **(options or {})).load(path)


def read_raw(spark: SparkSession, name: str, path: str, fmt: str = "csv",
             options: dict | None = None) -> DataFrame:
    """Scan one raw table with its declared all-string schema.

    CSV columns are taken by the names in the file's header, in any order; a
    missing or extra column raises, and so does a later file of the path with
    another header. Quotes inside a cell are doubled; pass
    ``{"multiLine": True}`` where cells hold line feeds (such files are not
    split). A blank cell and an empty quoted cell both become null. Parquet /
    ORC / a catalog table are read as stored and projected onto the declared
    columns.
    """
    schema = RAW_SCHEMAS[name]
    if fmt == "csv":
        reader = spark.read.options(**CSV_FORMAT, **(options or {}))
        found = read_found(spark, path, "csv", options).columns
        if sorted(found) != sorted(schema.names):
            raise ValueError(
                f"{name}: header has no {sorted(set(schema.names) - set(found))}, "
                f"declares nothing as {sorted(set(found) - set(schema.names))}")
        in_file_order = T.StructType([schema[c] for c in found])
        return (reader.option("mode", "FAILFAST").option("enforceSchema", False)
                .schema(in_file_order).csv(path).select(*schema.names))
    df = read_found(spark, path, fmt, options)
    return df.select(*[df[f.name].cast("string").alias(f.name) for f in schema.fields])


def read_raw_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "csv",
                    options: dict | None = None) -> dict[str, DataFrame]:
    return {name: read_raw(spark, name, path, fmt, options) for name, path in paths.items()}


# Writing CSV like a spreadsheet export: values kept byte for byte (Spark's
# writer trims whitespace by default), header row, empty text as "". Files are
# compressed (quickly: they are read once or twice), and as a reader cannot split
# those, none holds more rows than given.
CSV_EXPORT_OPTIONS = {**CSV_FORMAT, "ignoreLeadingWhiteSpace": False,
                      "ignoreTrailingWhiteSpace": False, "compression": "gzip",
                      "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_EXPORT_OPTIONS).csv(path)


def load_bronze(raw: dict[str, DataFrame], layout) -> dict[str, DataFrame]:
    """Copy raw tables untransformed into the bronze layer (Parquet), published
    together, and return DataFrames over the written copies."""
    build = layout.begin()
    out = {name: build.write(df, "bronze", name) for name, df in raw.items()}
    build.publish()
    return out

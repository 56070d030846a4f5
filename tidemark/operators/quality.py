"""Data checks: not-null, unique, accepted values, row counts, schema drift and
orphan foreign keys. Each returns a DataFrame of findings; zero failures =
pass. All checks on one table share one aggregate pass.

``violations`` lists what fails, row by row; ``audited`` gathers the counts while
a table is being written, so that a build can be checked before it is published.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleaning import unparsable_sql
from tidemark.operators.staging import TYPES
from tidemark.schemas import RAW_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's): which columns each check covers,
# the accepted event types and the documented raw row counts.
NOT_NULL_CHECKS = {
    "raw.products": ["product_id"],
    "raw.customers": ["customer_id"],
    "stg_events": ["event_id", "event_type", "customer_id", "product_id"],
    "stg_products": ["product_id"],
    "stg_customers": ["customer_id"],
}
UNIQUE_CHECKS = {
    "raw.products": ["product_id"],
    "raw.customers": ["customer_id"],
    "stg_events": ["event_id"],
    "stg_products": ["product_id"],
    "stg_customers": ["customer_id"],
}
ACCEPTED_VALUES = {("stg_events", "event_type"): ("order", "invoice")}
DOCUMENTED_ROWS = {"raw.events": 48000, "raw.products": 101, "raw.customers": 4000}
# ---------------------------------------------------------------------------

CHECK_COLUMNS = ["check_name", "model", "column_name", "failures"]


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dq_not_null(tables: dict[str, DataFrame], checks=None) -> DataFrame:
    """One row per (model, column): number of null values."""
    frames = []
    for model, cols in (checks or NOT_NULL_CHECKS).items():
        counts = tables[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
        frames.append(counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, failures)")
                      .select(F.lit("not_null").alias("check_name"), F.lit(model).alias("model"),
                              "column_name", F.col("failures").cast("bigint").alias("failures")))
    return _union(frames)


def dq_unique(tables: dict[str, DataFrame], checks=None) -> DataFrame:
    """One row per (model, column): number of non-null values that occur more
    than once (the rows a uniqueness test would return)."""
    frames = []
    for model, cols in (checks or UNIQUE_CHECKS).items():
        for c in cols:
            dup = (tables[model].where(F.col(c).isNotNull()).groupBy(c).count()
                   .agg(F.count_if(F.col("count") > 1).alias("failures")))
            frames.append(dup.select(F.lit("unique").alias("check_name"), F.lit(model).alias("model"),
                                     F.lit(c).alias("column_name"),
                                     F.col("failures").cast("bigint").alias("failures")))
    return _union(frames)


def dq_accepted_values(tables: dict[str, DataFrame], checks=None) -> DataFrame:
    """One row per checked column: number of distinct values outside the
    accepted list (nulls are not checked)."""
    frames = []
    for (model, c), accepted in (checks or ACCEPTED_VALUES).items():
        bad = (tables[model].where(F.col(c).isNotNull() & ~F.col(c).isin(*accepted))
               .agg(F.count_distinct(c).alias("failures")))
        frames.append(bad.select(F.lit("accepted_values").alias("check_name"),
                                 F.lit(model).alias("model"), F.lit(c).alias("column_name"),
                                 F.col("failures").cast("bigint").alias("failures")))
    return _union(frames)


def dq_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each raw table next to the documented size (a profile,
    not a pass/fail test)."""
    frames = [tables[m].agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(m).alias("model"), "row_count",
                      F.lit(expected).cast("bigint").alias("documented_rows"))
              for m, expected in DOCUMENTED_ROWS.items()]
    return _union(frames)


def dq_schema_drift(tables: dict[str, DataFrame], declared=None) -> DataFrame:
    """Declared versus found raw columns: 'ok', 'added' (found, not declared)
    or 'missing' (declared, not found), with the non-null values found in each
    present column. Drift is reported, never dropped."""
    declared = declared or {f"raw.{k}": v for k, v in RAW_COLUMNS.items()}
    frames = []
    for model, cols in declared.items():
        df = tables[model]
        found = list(df.columns)
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in found])
        pairs = ", ".join(f"'{c}', `{c}`" for c in found)
        rows = counts.selectExpr(f"stack({len(found)}, {pairs}) AS (column_name, non_null_rows)")
        status = F.when(F.col("column_name").isin(*cols), F.lit("ok")).otherwise(F.lit("added"))
        frames.append(rows.select(F.lit(model).alias("model"), "column_name", status.alias("status"),
                                  F.col("non_null_rows").cast("bigint").alias("non_null_rows")))
        missing = [c for c in cols if c not in found]
        if missing:
            frames.append(df.agg(F.count(F.lit(1)).alias("_n")).select(
                F.lit(model).alias("model"),
                F.explode(F.array(*[F.lit(c) for c in missing])).alias("column_name"),
                F.lit("missing").alias("status"), F.lit(None).cast("bigint").alias("non_null_rows")))
    return _union(frames)


def dq_castability(raw: dict[str, DataFrame]) -> DataFrame:
    """Per typed raw column the rows with text and those whose text cannot be
    cast: (model, column_name, wanted_type, filled_rows, unparsable_rows), from
    one aggregate pass per table."""
    frames = []
    for name, types in TYPES.items():
        counts = raw[name].selectExpr(*[x for c, t in types.items() for x in (
            f"count(nullif(trim(`{c}`), '')) AS `{c}`",
            f"count_if({unparsable_sql(c, t)}) AS `bad {c}`")])
        cells = ", ".join(f"'{c}', '{t}', `{c}`, `bad {c}`" for c, t in types.items())
        frames.append(counts.selectExpr(
            f"stack({len(types)}, {cells}) AS "
            "(column_name, wanted_type, filled_rows, unparsable_rows)")
            .select(F.lit(f"raw.{name}").alias("model"), "*"))
    return _union(frames)


# a comma outside of quoted cells
_CELL_END = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, columns): the header of each CSV file under a path. The first
    lines are picked on the executors, from the blocks that files begin with.
    Spark hashes groups with a text buffer only next to an object buffer (the
    set, one number a file); alone the text would have every line sorted."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start",
                                         F.monotonically_increasing_id().alias("at"))
    first = (lines.where("file_block_start = 0").groupBy(F.col("file_path").alias("file"))
             .agg(F.min_by("value", "at").alias("header"),
                  F.collect_set("file_block_start").alias("starts"))
             .where(F.size("starts") == 1))
    cells = F.split(F.rtrim("header"), _CELL_END)
    return first.select("file", F.transform(cells, lambda c: F.regexp_replace(
        F.regexp_replace(c, '^"|"$', ""), '""', '"')).alias("columns"))


def _marked(columns: Column, status: str) -> Column:
    return F.transform(columns, lambda c: F.struct(c.alias("column_name"),
                                                   F.lit(status).alias("status")))


def dq_file_drift(spark: SparkSession, paths: dict[str, str], declared=None) -> DataFrame:
    """Declared versus found columns of every CSV file: (model, file,
    column_name, status), 'ok', 'added' or 'missing'. A folder may hold files of
    different headers; each is named with its path."""
    frames = []
    for name, path in paths.items():
        cols = F.array(*[F.lit(c) for c in (declared or RAW_COLUMNS)[name]])
        found = F.col("columns")
        pairs = F.concat(_marked(F.array_intersect(cols, found), "ok"),
                         _marked(F.array_except(found, cols), "added"),
                         _marked(F.array_except(cols, found), "missing"))
        frames.append(file_headers(spark, path).select(
            F.lit(f"raw.{name}").alias("model"), "file", F.inline(pairs)))
    return _union(frames)


def dq_orphans(events: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Events whose (non-null) customer_id / product_id is not in its
    dimension: number of distinct orphan keys and of events carrying them.
    Events are counted per key first, so the anti-join runs at key grain and a
    hot key cannot skew it."""
    frames = []
    for fk, dim in (("customer_id", customers), ("product_id", products)):
        per_key = events.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("n"))
        orphans = per_key.join(dim.select(fk), fk, "left_anti")
        frames.append(orphans.agg(F.count(F.lit(1)).alias("orphan_keys"),
                                  F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_events"))
                      .select(F.lit(fk).alias("foreign_key"),
                              F.col("orphan_keys").cast("bigint").alias("orphan_keys"),
                              F.col("orphan_events").cast("bigint").alias("orphan_events")))
    return _union(frames)


def _single_pass_checks(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Not-null and accepted-values checks of each table in one aggregate pass."""
    frames = []
    models = list(dict.fromkeys([*NOT_NULL_CHECKS, *[m for m, _ in ACCEPTED_VALUES]]))
    for model in models:
        aggs, labels = [], []
        for c in NOT_NULL_CHECKS.get(model, []):
            aggs.append(F.count_if(F.col(c).isNull()).cast("bigint"))
            labels.append(("not_null", c))
        for (m, c), accepted in ACCEPTED_VALUES.items():
            if m == model:
                bad = F.when(F.col(c).isNotNull() & ~F.col(c).isin(*accepted), F.col(c))
                aggs.append(F.count_distinct(bad).cast("bigint"))
                labels.append(("accepted_values", c))
        row = tables[model].agg(*[a.alias(f"_c{i}") for i, a in enumerate(aggs)])
        pairs = ", ".join(f"'{chk}', '{c}', _c{i}" for i, (chk, c) in enumerate(labels))
        frames.append(row.selectExpr(
            f"stack({len(labels)}, {pairs}) AS (check_name, column_name, failures)")
            .select("check_name", F.lit(model).alias("model"), "column_name", "failures"))
    return frames


def run_checks(raw: dict[str, DataFrame], stg: dict[str, DataFrame]) -> DataFrame:
    """All 14 pass/fail checks as one (check_name, model, column_name, failures)
    table: per table one aggregate pass for not-null and accepted values, plus
    one grouping per uniqueness test."""
    tables = {f"raw.{k}": v for k, v in raw.items()} | stg
    return _union([*_single_pass_checks(tables), dq_unique(tables)])


# --------------------------------------------------------------------------- audit of staged tables

# Business key of each checked table, by which its rows are named.
ROW_KEYS = {"raw.products": "product_id", "raw.customers": "customer_id",
            "stg_events": "event_id", "stg_products": "product_id",
            "stg_customers": "customer_id"}
VIOLATION_COLUMNS = "check_name string, model string, column_name string, row_key string, " \
                    "bad_value string, n_rows bigint"


def _row_rules(model: str) -> list[tuple[str, str, str]]:
    """(check, column, SQL condition that a failing row meets) of a table."""
    rules = [("not_null", c, f"`{c}` IS NULL") for c in NOT_NULL_CHECKS.get(model, [])]
    for (m, c), accepted in ACCEPTED_VALUES.items():
        if m == model:
            values = ", ".join(f"'{v}'" for v in accepted)
            rules.append(("accepted_values", c, f"`{c}` IS NOT NULL AND `{c}` NOT IN ({values})"))
    return rules


def row_violations(model: str, df: DataFrame) -> DataFrame:
    """Rows that fail a not-null or accepted-values check, counted by row key
    and offending value: one scan, and only failing rows are grouped."""
    key = ROW_KEYS[model]
    failed = ", ".join(f"IF({cond}, named_struct('check_name', '{check}', 'column_name', '{c}', "
                       f"'bad_value', CAST(`{c}` AS string)), NULL)"
                       for check, c, cond in _row_rules(model))
    rows = df.selectExpr(f"CAST(`{key}` AS string) AS row_key",
                         f"inline(filter(array({failed}), x -> x IS NOT NULL))")
    return rows.groupBy("check_name", F.lit(model).alias("model"), "column_name", "row_key",
                        "bad_value").agg(F.count(F.lit(1)).alias("n_rows"))


def key_violations(model: str, df: DataFrame) -> DataFrame:
    """Keys on more than one row with their number of rows. Rows are counted per
    key with map-side partials, so a key on very many rows makes no hot task."""
    frames = []
    for c in UNIQUE_CHECKS.get(model, []):
        keys = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_rows"))
        frames.append(keys.where("n_rows > 1").select(
            F.lit("unique").alias("check_name"), F.lit(model).alias("model"),
            F.lit(c).alias("column_name"), F.col(c).cast("string").alias("row_key"),
            F.col(c).cast("string").alias("bad_value"), "n_rows"))
    return _union(frames)


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """What the data checks find in the given tables: one row per check, table,
    column, row key and offending value, with the number of such rows."""
    frames = [row_violations(m, df) for m, df in tables.items() if _row_rules(m)]
    frames += [key_violations(m, df) for m, df in tables.items() if m in UNIQUE_CHECKS]
    return _union(frames)


def audited(model: str, df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its rows and of the rows that fail each
    not-null and accepted-values check, filled when ``df`` has been written."""
    seen = Observation()
    counts = [F.expr(f"count_if({cond})").alias(f"{check}:{c}")
              for check, c, cond in _row_rules(model)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def check_results(found: DataFrame, models: list[str]) -> DataFrame:
    """The pass/fail checks of the given tables from their violations, in the
    form of ``run_checks``: null rows, repeated keys, distinct unaccepted values."""
    wanted = [(check, m, c) for m in models for check, c, _ in _row_rules(m)]
    wanted += [("unique", m, c) for m in models for c in UNIQUE_CHECKS.get(m, [])]
    checks = found.sparkSession.createDataFrame(
        wanted, "check_name string, model string, column_name string")
    failures = found.groupBy("check_name", "model", "column_name").agg(
        F.sum("n_rows").alias("_rows"), F.count_distinct("bad_value").alias("_values"))
    counted = F.when(F.col("check_name") == "not_null", F.col("_rows")).otherwise(F.col("_values"))
    return (checks.join(failures, ["check_name", "model", "column_name"], "left")
            .select("check_name", "model", "column_name",
                    F.coalesce(counted, F.lit(0)).cast("bigint").alias("failures")))

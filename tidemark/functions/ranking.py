"""Distributed global ranks and row positions without an unpartitioned window.

An unpartitioned ``Window.orderBy`` moves every row into one task. Here a rank
(SQL ``rank()`` over the whole table) is "1 + number of rows ordered before this
value", and all ranks of a table come from one sort:

1. the measures are stacked to (measure, value, rows) and counted per distinct
   value, with partial aggregation, so a value on very many rows is one row;
2. the values are sorted (range partitioning keeps equal ones together and
   partitions in order) and written down with the partition that each landed in;
3. rows are totalled per partition and measure, and a window over those turns
   them into offsets (bounded by partitions times measures, not by the data, so
   broadcasting them is safe);
4. inside each partition, a running sum gives the preceding values' rows.

rank = offset + rows before the value in its partition + 1, joined back on the
value (null-safe, nulls ordered last as in ``rank()``). Row positions use the
same offsets, with a row number inside each partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written


def _order(col, descending: bool) -> Column:
    return F.desc_nulls_last(col) if descending else F.asc_nulls_last(col)


def _offsets(ordered: DataFrame, rows: Column, by: list[str]) -> DataFrame:
    """Rows in earlier partitions, per partition (and ``by``)."""
    per_part = ordered.groupBy("_part", *by).agg(rows.alias("_part_rows"))
    before = (Window.partitionBy(*by) if by else Window).orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(*by, "_part", F.coalesce(
        F.sum("_part_rows").over(before), F.lit(0)).alias("_offset"))


def _frozen(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` in order, with the partition each row landed in, written down."""
    return written(df.orderBy(*order).withColumn("_part", F.spark_partition_id()), "ordered")


def value_ranks(df: DataFrame, columns: list[str], descending: bool = True) -> DataFrame:
    """(_measure, one column per measure, _rank): one row per distinct value of
    each measure, in that measure's column, with its SQL ``rank()``."""
    names = [f"_v{i}" for i in range(len(columns))]
    types = dict(df.dtypes)

    def one(i):
        cells = [F.col(f"`{c}`") if j == i else F.lit(None).cast(types[c])
                 for j, c in enumerate(columns)]
        return F.struct(F.lit(i).alias("_measure"), *[x.alias(n) for x, n in zip(cells, names)])

    counts = (df.select(F.inline(F.array(*map(one, range(len(columns))))))
              .groupBy("_measure", *names).agg(F.count(F.lit(1)).alias("_rows")))
    order = [_order(n, descending) for n in names]
    ordered = _frozen(counts, F.asc("_measure"), *order)
    offsets = _offsets(ordered, F.sum("_rows"), ["_measure"])
    before = (Window.partitionBy("_part", "_measure").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (ordered.join(F.broadcast(offsets), ["_measure", "_part"])
            .select("_measure", *names,
                    (F.col("_offset") + F.coalesce(F.sum("_rows").over(before), F.lit(0))
                     + F.lit(1)).cast("bigint").alias("_rank")))


def with_global_ranks(df: DataFrame, specs: list[tuple[str, str]],
                      descending: bool = True) -> DataFrame:
    """``df`` plus one ``rank()`` column per (column, rank column) in ``specs``,
    nulls last, all from one sort. ``df`` is read twice, for the ranks and for
    the result: give a stored one."""
    ranks = value_ranks(df, [c for c, _ in specs], descending)
    for i, (column, name) in enumerate(specs):
        own = ranks.where(F.col("_measure") == i).select(F.col(f"_v{i}").alias("_value"),
                                                         F.col("_rank").alias(name))
        df = df.join(own, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")
    return df


def with_global_rank(df: DataFrame, col: str, rank_col: str,
                     descending: bool = True) -> DataFrame:
    """``df`` plus ``rank_col`` = rank() over (order by col [desc] nulls last)."""
    return with_global_ranks(df, [(col, rank_col)], descending)


def with_positions(df: DataFrame, order: list[Column], position: str = "position") -> DataFrame:
    """``df`` plus the place of each row, from 1, in the given order; rows that it
    leaves equal come in the order of all columns. The rows of the result are
    in order, and stay findable by position however they are stored."""
    ties = [F.asc_nulls_last(c) for c in df.columns]
    ordered = _frozen(df, *order, *ties)
    offsets = _offsets(ordered, F.count(F.lit(1)), [])
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order, *ties))
    return (ordered.join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_offset") + place).cast("bigint").alias(position)))

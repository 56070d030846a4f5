"""Join helpers: null keys spread out, hot keys split.

A hash join sends all rows of a key to one task. Null keys are spread by a
synthetic key. A key that holds a large share of the rows is *hot*: it is found
by a mergeable frequency sketch, its rows are dealt over several salts, and only
that key's row on the other side is repeated per salt. Nothing of this needs
settings of adaptive execution.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Prefix of the synthetic keys given to null keys; no real key starts with it.
_NULL_KEY_PREFIX = "\u0000null:"


def left_join_skipping_null_keys(left: DataFrame, right: DataFrame, key: str,
                                 salt: str) -> DataFrame:
    """``left.join(right, key, "left")`` for a string key, in one pass, with
    null keys spread out.

    A null key never matches, but in a sort-merge join every null-key row
    would hash to the same reducer. Each such row gets a synthetic key (a hash
    of its ``salt`` column behind a prefix no real key has), so they spread over
    all partitions and still match nothing; the original key column is kept.
    """
    row_hash = F.xxhash64(F.col(salt)).cast("string")
    join_key = F.when(F.col(key).isNull(), F.concat(F.lit(_NULL_KEY_PREFIX), row_hash)) \
        .otherwise(F.col(key))
    salted = left.withColumn("_join_key", join_key)
    keyed = right.withColumnRenamed(key, "_join_key")
    return salted.join(keyed, "_join_key", "left").drop("_join_key")


SKETCH_ITEMS = 8192  # keys that a task's sketch tracks


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> dict[str, float]:
    """Non-null keys that hold at least ``share`` of the rows, with their share.

    Each task keeps a sketch of at most ``SKETCH_ITEMS`` keys and sketches are
    merged, so nothing grows with the number of keys. A key is missed only where
    its share is within the sketch's error (a few rows in ``SKETCH_ITEMS``) of the
    limit, which costs balance and no row; at most ``1 / share`` keys come back.
    """
    most = int(1 / share) + 1
    found = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {most}, {SKETCH_ITEMS})").alias("top"),
        F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return {}
    return {r["item"]: r["count"] / found["n"] for r in found["top"]
            if r["count"] >= share * found["n"]}


def left_join_splitting_hot_keys(left: DataFrame, right: DataFrame, key: str, salt: str,
                                 share: float = 0.01, hot: dict[str, float] | None = None,
                                 parts: int | None = None) -> DataFrame:
    """``left.join(right, key, "left")`` for a string key, with null keys spread
    out and hot keys split.

    Each hot key is dealt over four salts for every task's worth of rows that it
    has (``parts`` tasks, by default the shuffle partitions), by a hash of the
    ``salt`` column; its rows in ``right`` are repeated for each. ``hot`` gives the
    keys where they are known already; otherwise one pass over ``left``'s key
    finds them.
    """
    if hot is None:
        hot = hot_keys(left, key, share)
    if not hot:
        return left_join_skipping_null_keys(left, right, key, salt)
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.create_map(*[x for k, s in hot.items()
                           for x in (F.lit(k), F.lit(max(2, math.ceil(4 * s * parts))))])
    of_left = F.coalesce(F.try_element_at(salts, F.col(key)), F.lit(1))
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(salt), of_left).cast("int"))
    of_right = F.coalesce(F.try_element_at(salts, F.col(key)), F.lit(1))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), of_right - 1)))

    def salted(name: str):
        return F.concat_ws("\u0000", F.col(name), F.col("_salt").cast("string"))

    spread = spread.withColumn("_hot_key", F.when(F.col(key).isNotNull(), salted(key)))
    repeated = repeated.withColumn("_hot_key", F.when(F.col(key).isNotNull(), salted(key)))
    return left_join_skipping_null_keys(
        spread.drop("_salt"), repeated.drop("_salt", key), "_hot_key", salt).drop("_hot_key")

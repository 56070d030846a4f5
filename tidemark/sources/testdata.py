"""Adapter: the driver's TPC-H-style tables -> raw events, products, customers.

The three raw tables of the commerce build are derived row by row from
lineitem, orders, part, customer and nation, as all-text columns, deliberately
dirty enough to exercise every cleaning rule (blank and padded values, flags in
odd spellings, 'N/A' codes, orphan products, customers without a profile,
null customers and padding rows). Everything is a Spark join + projection, so
the raw tables grow with the input and Catalyst prunes the columns a model
does not read.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import RAW_EVENTS_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values of the adapter (our own test design, indexed as noted).
# Indexed by nation key % 11:
COUNTRIES = ("United States", "Canada", "Australia", "Philippines", "Germany", "France",
             "United Kingdom", "Netherlands", "Spain", "Brazil", "Japan")
RAW_REGIONS = ("", "  ", "APAC", "APAC", "EU", "EU", "EU", "EU", "EU", "LATAM", None)
CURRENCIES = ("USD", "CAD", "AUD", "PHP", "EUR", "EUR", "GBP", "EUR", "EUR", "BRL", "JPY")
# Rate to USD per currency, written as six-decimal text.
FX_TO_USD = {"USD": "1.000000", "CAD": "0.730000", "AUD": "0.650000", "PHP": "0.017500",
             "EUR": "1.080000", "GBP": "1.270000", "BRL": "0.185000", "JPY": "0.006700"}
# Indexed by the digit of o_orderpriority, 1..5:
RAW_CHANNELS = (" Website ", "Marketplace", "Direct Sales", "Partner", "Reseller")
# Indexed by 100 * l_discount, 0..8; anything higher gets DISCOUNT_OTHER.
RAW_DISCOUNT_CODES = ("N/A", "n/a", "", None, " WELCOME10 ", "NEWCUSTOMER10", "BFCM10",
                      "BFCM20", "STUDENT15")
DISCOUNT_OTHER = "VIP25"
# Products, by p_size % 5 and p_size % 3:
BILLING_CYCLES = ("One-time", "Monthly", "Monthly", "Annual", "Annual")
RESALE_MODELS = ("Direct resale", "Marketplace", "Affiliate")
ADDON_PART_TYPE = "ECONOMY"
# Customers, by c_custkey % 5 and % 6:
AGE_BANDS = ("18–24", "25–34", "35–44", "45–54", "55+")
ACQUISITION_CHANNELS = ("Organic", "Paid Search", "Email", "Social", "Referral", "Affiliate")
# Key rules: orders of every 97th customer key carry no customer, line items of
# every 50th part key point at a product that does not exist, and every 41st
# customer's profile carries an id that no order has.
NULL_CUSTOMER_MOD = 97
MISSING_PRODUCT_MOD = 50
NO_PROFILE_MOD = 41
# ---------------------------------------------------------------------------

TABLES = ("lineitem", "orders", "part", "customer", "nation")


def _sql(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pick(values, index_sql: str) -> str:
    """values[index] for a small fixed tuple, as one array-literal lookup."""
    return f"try_element_at(array({', '.join(_sql(v) for v in values)}), cast({index_sql} AS int) + 1)"


_schemas: dict[tuple, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a driver table. Its schema is inferred (a Spark job) once for a
    path, its length and its time of change; the data is never cached."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(file)
    key = (path, status.getLen(), status.getModificationTime())
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in names}


def _events_sql() -> list[str]:
    disc_codes = _pick(RAW_DISCOUNT_CODES, "disc_idx")
    return [
        "concat_ws('-', cast(l_orderkey AS string), cast(l_linenumber AS string), "
        "cast(l_partkey AS string), cast(l_suppkey AS string), cast(to_date(l_shipdate) AS string)) AS event_id",
        "CASE WHEN o_orderstatus = 'P' THEN 'invoice' ELSE 'order' END AS event_type",
        f"CASE WHEN o_custkey % {NULL_CUSTOMER_MOD} = 0 THEN NULL "
        "ELSE concat('CUST', cast(o_custkey AS string)) END AS customer_id",
        f"CASE WHEN l_partkey % {MISSING_PRODUCT_MOD} = 0 THEN 'PROD-MISSING' "
        "ELSE concat('PROD', cast(l_partkey AS string)) END AS product_id",
        "cast(o_orderdate AS string) AS event_date",
        "CASE WHEN l_returnflag = 'R' THEN cast(l_shipdate AS string) ELSE '' END AS refund_datetime",
        f"{_pick(COUNTRIES, 'nat_idx')} AS country",
        "cast(cast(n_nationkey AS decimal(10,4)) AS string) AS latitude",
        "cast(cast(-n_nationkey AS decimal(10,4)) AS string) AS longitude",
        f"{_pick(RAW_REGIONS, 'nat_idx')} AS region",
        f"{_pick(RAW_CHANNELS, 'cast(substring(o_orderpriority, 1, 1) AS int) - 1')} AS channel",
        "CASE l_linestatus WHEN 'F' THEN ' Card ' WHEN 'O' THEN 'PayPal' END AS payment_method",
        f"{_pick(CURRENCIES, 'nat_idx')} AS currency",
        "cast(cast(l_quantity AS int) AS string) AS quantity",
        "cast(cast(p_retailprice AS decimal(12,2)) AS string) AS unit_price_local",
        "cast(cast(net_local AS decimal(12,4)) AS string) AS net_revenue_local",
        "cast(cast(price * disc AS decimal(12,4)) AS string) AS discount_local",
        "cast(cast(net_local * tax AS decimal(12,4)) AS string) AS tax_local",
        "fx_text AS fx_rate_to_usd",
        "cast(cast(net_local * cast(fx_text AS decimal(10,6)) AS decimal(12,4)) AS string) AS net_revenue_usd",
        f"CASE WHEN disc_idx < {len(RAW_DISCOUNT_CODES)} THEN {disc_codes} "
        f"ELSE {_sql(DISCOUNT_OTHER)} END AS discount_code",
        "CASE l_returnflag WHEN 'R' THEN ' TRUE' WHEN 'A' THEN 'False ' ELSE 'maybe' END AS is_refunded",
        "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN ' Defective ' "
        "WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN '  ' ELSE '' END AS refund_reason",
    ]


def raw_events(t: dict[str, DataFrame]) -> DataFrame:
    """One raw event per line item (with its order and customer; the country
    index is the customer's nation key), plus one all-null padding row per nation.

    Orders get their customer and line items their part price before the two
    meet, each while its rows are few or narrow; a line item is shuffled at most
    twice, never with its order's columns. Priced line items are hash-partitioned
    on the order key. On a cluster this is the shuffle that the line item / order
    sort-merge join needs anyway (same key, same partition count), so the join
    reuses it; when the orders side is small enough to broadcast it still spreads
    the per-row text building over all cores instead of the few tasks a large
    Parquet row group yields. The partition count is the session's shuffle
    partition count, which on a cluster is sized for the largest shuffle (adaptive
    execution coalesces the smaller ones); a fixed count keeps coalescing from
    folding this stage back onto a few cores when the input is small. The key
    cannot be skewed: an order carries only a handful of line items (at most 17 in
    the driver's data at every scale), so no partition can hold a large share of
    the rows.
    """
    li, o, p, c, n = t["lineitem"], t["orders"], t["part"], t["customer"], t["nation"]
    parts = int(li.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The part price is only read by unit_price_local: a left join to a table
    # unique on the part key lets the optimizer drop the join (and, on a
    # cluster, its shuffle of all line items) whenever a model does not read it.
    price = p.groupBy("p_partkey").agg(F.min("p_retailprice").alias("p_retailprice"))
    priced = (li.join(price, li.l_partkey == price.p_partkey, "left")
              .repartition(parts, "l_orderkey"))
    placed = o.join(c, o.o_custkey == c.c_custkey)
    joined = (priced.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
              .withColumnRenamed("c_nationkey", "n_nationkey"))
    fx_text = _pick([FX_TO_USD[cur] for cur in CURRENCIES], "n_nationkey % 11")
    prepared = joined.selectExpr(
        "*",
        "n_nationkey % 11 AS nat_idx",
        "cast(l_extendedprice AS decimal(12,2)) AS price",
        "cast(l_discount AS decimal(4,2)) AS disc",
        "cast(l_tax AS decimal(4,2)) AS tax",
        "cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2))) AS net_local",
        "cast(cast(l_discount AS decimal(4,2)) * 100 AS int) AS disc_idx",
        f"{fx_text} AS fx_text",
    )
    events = prepared.selectExpr(*_events_sql())
    padding = n.selectExpr(*[f"CAST(NULL AS string) AS {c}" for c in RAW_EVENTS_COLUMNS])
    return events.unionByName(padding)


def raw_products(t: dict[str, DataFrame]) -> DataFrame:
    cycle = _pick(BILLING_CYCLES, "p_size % 5")
    price = "cast(cast(p_retailprice AS decimal(12,2)) AS string)"
    return t["part"].selectExpr(
        "concat('PROD', cast(p_partkey AS string)) AS product_id",
        "concat('  ', p_name, ' ') AS product_name",
        f"CASE WHEN p_type = {_sql(ADDON_PART_TYPE)} THEN 'Add-on' ELSE p_type END AS category",
        f"CASE WHEN {cycle} = 'One-time' THEN 'False' ELSE 'True' END AS is_subscription",
        f"{cycle} AS billing_cycle",
        f"{price} AS base_price_usd",
        "'2024-02-01 00:00:00' AS first_release_date",
        "p_brand AS vendor",
        f"{_pick(RESALE_MODELS, 'p_size % 3')} AS resale_model",
        "concat_ws(' ', p_name, p_brand) AS brand_safe_name",
        "p_name AS product_name_orig",
        f"{price} AS base_price_usd_orig",
        "lower(p_name) AS base_key",
        "'v4.0' AS product_version",
    )


def raw_customers(t: dict[str, DataFrame]) -> DataFrame:
    c, n = t["customer"], t["nation"]
    joined = c.join(n, c.c_nationkey == n.n_nationkey)
    idx = "n_nationkey % 11"
    return joined.selectExpr(
        f"concat(CASE WHEN c_custkey % {NO_PROFILE_MOD} = 0 THEN 'NOORDER' ELSE 'CUST' END, "
        "cast(c_custkey AS string)) AS customer_id",
        "concat('2023-', lpad(cast(c_custkey % 12 + 1 AS string), 2, '0'), '-01 00:00:00') AS signup_date",
        f"concat(' ', {_pick(COUNTRIES, idx)}, ' ') AS country",
        "cast(cast(n_nationkey AS decimal(10,4)) AS string) AS country_latitude",
        "cast(cast(-n_nationkey AS decimal(10,4)) AS string) AS country_longitude",
        f"{_pick(RAW_REGIONS, idx)} AS region",
        "concat(' ', c_mktsegment) AS segment",
        f"{_pick(AGE_BANDS, 'c_custkey % 5')} AS age_band",
        f"{_pick(ACQUISITION_CHANNELS, 'c_custkey % 6')} AS acquisition_channel",
        f"{_pick(CURRENCIES, idx)} AS currency_preference",
    )


class RawTables(Mapping):
    """The three raw tables, each built on first access (lazy DataFrames)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._built = spark, sf_dir, {}
        self._inputs: dict[str, DataFrame] = {}

    def _input(self, name: str) -> DataFrame:
        if name not in self._inputs:
            self._inputs[name] = read_table(self._spark, self._dir, name)
        return self._inputs[name]

    def _view(self, names) -> dict[str, DataFrame]:
        return {n: self._input(n) for n in names}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._built:
            if key == "events":
                self._built[key] = raw_events(self._view(TABLES))
            elif key == "products":
                self._built[key] = raw_products(self._view(("part",)))
            elif key == "customers":
                self._built[key] = raw_customers(self._view(("customer", "nation")))
            else:
                raise KeyError(key)
        return self._built[key]

    def __iter__(self):
        return iter(("events", "products", "customers"))

    def __len__(self) -> int:
        return 3


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The three raw tables derived from ``sf_dir``'s Parquet files (lazy)."""
    return RawTables(spark, sf_dir)

"""Compare each registered Spark query with its DuckDB oracle statement.

Checks column names, mapped column types, row count and the multiset of rows
(decimals compared with their scale, so 1.2 and 1.20 differ). Usable from
pytest and as a script: ``python tests/oracle_check.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
                  "timestamp_ntz": "TIMESTAMP", "date": "DATE", "double": "DOUBLE"}


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, float):
        return ("f", round(v, 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    return (type(v).__name__, v)


def _key(row):
    return tuple((x is None, x) for x in row)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    d_types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall() and
               [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]]
    out = {"name": name, "rows_spark": len(s_rows), "rows_oracle": len(d_rows)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    type_issues = []
    if out["columns_match"]:
        dt_map = dict(zip(d_cols, d_types))
        for c, t in zip(s_cols, s_types):
            want = _SPARK_TO_DUCK.get(t, t.upper())
            if dt_map[c] != want:
                type_issues.append((c, t, dt_map[c]))
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
        dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
        out["values_match"] = sc == dc
        if sc != dc:
            only_s = list((sc - dc).elements())[:3]
            only_d = list((dc - sc).elements())[:3]
            out["diff"] = {"columns": order, "spark_only": only_s, "oracle_only": only_d,
                           "n_spark_only": sum((sc - dc).values())}
    else:
        out["values_match"] = False
        out["diff"] = {"spark_columns": s_cols, "oracle_columns": d_cols}
    out["type_issues"] = type_issues
    out["ok"] = (out["columns_match"] and out["values_match"]
                 and out["rows_spark"] == out["rows_oracle"] and not type_issues)
    return out


def main(argv):
    from tidemark.session import get_session
    from tidemark.plans.catalog import QUERIES
    from tidemark.plans.oracle import ORACLE_SQL
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    keys = [k for k in argv[1:] if k in QUERIES] or list(QUERIES)
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    bad = 0
    for k in keys:
        if k not in ORACLE_SQL:
            print(f"{k}: no oracle")
            continue
        try:
            r = compare(spark, con, k, QUERIES[k], ORACLE_SQL[k], sf_dir)
        except Exception as e:  # report and continue with the next key
            bad += 1
            print(f"{k}: ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        status = "OK " if r["ok"] else "BAD"
        bad += 0 if r["ok"] else 1
        print(f"{status} {k}: rows {r['rows_spark']}/{r['rows_oracle']} types {r['type_issues']}"
              + ("" if r["ok"] else f" diff {r.get('diff')}"))
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

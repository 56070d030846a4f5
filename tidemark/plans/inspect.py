"""Plan inspection helpers: read the physical plan Spark chose for a DataFrame."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "ArrowEvalPythonUDTF", "BatchEvalPythonUDTF",
                "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInPandas",
                "FlatMapCoGroupsInArrow", "MapInPandas", "MapInArrow", "PythonMapInArrow",
                "WindowInPandas", "ArrowWindowPython", "AggregateInPandas", "ArrowAggregatePython",
                "PythonUDF")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


@contextlib.contextmanager
def _untruncated(spark):
    """Plans print whole schemas and filters in here."""
    wide = {"spark.sql.maxMetadataStringLength": "100000",
            "spark.sql.debug.maxToStringFields": "1000"}
    before = {k: spark.conf.get(k) for k in wide}
    for k, v in wide.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf), _untruncated(df.sparkSession):
        df.explain(mode)
    return buf.getvalue()


def nodes(df: DataFrame) -> list[str]:
    """Operator names of the physical plan, top-down."""
    out = []
    for line in plan_text(df).splitlines():
        m = re.match(r"^[\s:+\-|]*([A-Z][A-Za-z]+)", line)
        if m:
            out.append(m.group(1))
    return out


def read_schemas(df: DataFrame) -> list[str]:
    """The columns that each file scan reads, whole."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


def columns_read(df: DataFrame) -> dict[str, set[str]]:
    """Columns read per scanned file or folder name, over all its scans."""
    out: dict[str, set[str]] = {}
    for path, schema in re.findall(
            r"Location: \w+\(\d+ paths\)\[([^\]]*)\].*?ReadSchema: struct<([^\n]*)>", plan_text(df)):
        name = path.split(",")[0].rstrip("/").rsplit("/", 1)[-1]
        depth, at, cells = 0, 0, []
        for i, c in enumerate(schema + ","):
            depth += (c in "(<") - (c in ")>")
            if c == "," and depth == 0:
                cells.append(schema[at:i])
                at = i + 1
        out.setdefault(name, set()).update(x.split(":")[0] for x in cells if x)
    return out


def exchanges(df: DataFrame) -> int:
    return sum(1 for n in nodes(df) if n == "Exchange")

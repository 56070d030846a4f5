"""URL filters by a trie over reversed host labels and path segments (operator 11).

A rule is (host, path, verdict). It fits its host and all subdomains, where the
url's path starts with the rule's path. The trie goes down the host's labels
from the last to the first; each node that ends a rule's host has a second trie
over path segments, whose nodes hold the rules that end there by their last,
perhaps partial, segment. The longest match wins: more host labels first, then
the longer path; where a host and path are both allowed and blocked, block wins.
A url that no rule fits gets ``default``.

The trie of at most ``TRIE_BYTES`` of rules is broadcast. A larger rule table is
dealt into shards of that size by hash, and each shard is one pass over the
urls that keeps the longer match; so what is broadcast is bounded and every rule
counts. Only the url's host and path go through Python.

Defined results: a null url, or one without ``://``, has empty host and path
(only a rule with an empty host fits it); repeated pages keep their rows; an
empty rule table gives every page the default; columns of the pages named like
a result column are replaced by it.
"""

from __future__ import annotations

import dataclasses
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import written

TRIE_BYTES = 16 << 20
DEFAULT = "allow"
RESULT = ("host", "path", "rule", "verdict")
MATCH = "struct<labels:int,size:int,block:boolean,rule:string>"

# --- fixed values: the rules as (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# ---


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


@dataclasses.dataclass
class PathNode:
    """Rules that end here by the last piece of their path, and whole segments further down."""

    ends: dict[str, tuple] = dataclasses.field(default_factory=dict)
    sizes: list[int] = dataclasses.field(default_factory=list)
    below: dict[str, PathNode] = dataclasses.field(default_factory=dict)


@dataclasses.dataclass
class HostNode:
    paths: PathNode | None = None
    below: dict[str, HostNode] = dataclasses.field(default_factory=dict)


class Trie:
    def __init__(self, rules):
        self.root = HostNode()
        for host, path, verdict in rules:
            labels = host.split(".")[::-1] if host else []
            node = self.root
            for label in labels:
                node = node.below.setdefault(label, HostNode())
            if node.paths is None:
                node.paths = PathNode()
            *whole, last = path.split("/")
            at = node.paths
            for segment in whole:
                at = at.below.setdefault(segment, PathNode())
            match = (len(labels), len(path), verdict == "block", host + path)
            at.ends[last] = max(match, at.ends.get(last, match))
            if len(last) not in at.sizes:
                at.sizes = sorted([*at.sizes, len(last)], reverse=True)

    def chain(self, host: str) -> list[PathNode]:
        """Path tries of the host and its parents that have rules, the longest first."""
        node, found = self.root, []
        if node.paths:
            found.append(node.paths)
        for label in host.split(".")[::-1] if host else []:
            node = node.below.get(label)
            if node is None:
                break
            if node.paths:
                found.append(node.paths)
        return found[::-1]

    @staticmethod
    def longest(at: PathNode, path: str) -> tuple | None:
        best, pieces = None, path.split("/")
        for i, piece in enumerate(pieces):
            for size in at.sizes:
                match = at.ends.get(piece[:size]) if size <= len(piece) else None
                if match:
                    best = match
                    break
            at = at.below.get(piece) if i + 1 < len(pieces) else None
            if at is None:
                break
        return best

    def match(self, hosts: list[str], paths: list[str]) -> list[tuple | None]:
        chains: dict[str, list[PathNode]] = {}
        out = []
        for host, path in zip(hosts, paths):
            chain = chains.get(host)
            if chain is None:
                chain = chains[host] = self.chain(host)
            out.append(next(filter(None, (self.longest(p, path) for p in chain)), None))
        return out


def _match(trie, host: Column, path: Column) -> Column:
    kind = pa.struct([("labels", pa.int32()), ("size", pa.int32()), ("block", pa.bool_()),
                      ("rule", pa.string())])

    @F.arrow_udf(MATCH)
    def run(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = trie.value.match(hosts.to_pylist(), paths.to_pylist())
        return pa.array([f and dict(zip(kind.names, f)) for f in found], kind)
    return run(host, path)


def rule_table(spark: SparkSession, rules) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def tries(rules: DataFrame, trie_bytes: int = TRIE_BYTES):
    """The trie of each shard; one shard's rules are on the driver at a time.
    Hosts are lower-cased; rules without host, path or another verdict than
    allow and block are an error."""
    bad = rules.where("host IS NULL OR path IS NULL OR verdict IS NULL "
                      "OR verdict NOT IN ('allow', 'block')").limit(1).collect()
    if bad:
        raise ValueError(f"not a rule: {bad[0].asDict()}")
    rows = rules.select(F.lower("host").alias("host"), "path", "verdict").distinct()
    size = rows.agg(F.sum(F.octet_length("host") + F.octet_length("path") + F.lit(64))).first()[0]
    shards = max(1, -(-(size or 0) // trie_bytes))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("host", "path"), F.lit(shards)))
    for shard in range(shards):
        yield Trie([(r["host"], r["path"], r["verdict"])
                    for r in rows.where(F.col("shard") == shard).collect()])


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT,
          trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``pages`` with host, path, rule (null where none fits) and verdict."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(f"`{url}`"))
    kept = [F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(pages.columns)]
    frame = pages.select(*kept, host.alias("host"), path.alias("path"))
    best = None
    for trie in tries(rules, trie_bytes):
        found = _match(spark.sparkContext.broadcast(trie), F.col("host"), F.col("path"))
        if best is not None:
            frame = written(frame, "url-matches")
            found = F.greatest(F.col("best"), found)
        frame = frame.withColumn("best", found)
        best = True
    verdict = (F.when(F.col("best").isNull(), F.lit(default))
               .when(F.col("best.block"), F.lit("block")).otherwise(F.lit("allow")))
    own = [F.col(f"in_{i}").alias(c) for i, c in enumerate(pages.columns) if c not in RESULT]
    return frame.select(*own, "host", "path", F.col("best.rule").alias("rule"),
                        verdict.alias("verdict"))


def allowed(pages: DataFrame, rules: DataFrame, url: str = "url",
            default: str = DEFAULT) -> DataFrame:
    """The pages that are not blocked, with their own columns."""
    marked = judge(pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page"),
                                F.col(f"`{url}`").alias("url")), rules, default=default)
    return marked.where("verdict = 'allow'").select("page.*")


def page_verdicts(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url"), rule_table(pages.sparkSession, RULES)) \
        .drop("url")


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE_SQL = rf"""
WITH rules(h, p, v) AS (VALUES {', '.join('(' + ', '.join(map(_sql, r)) + ')' for r in RULES)}),
u AS (SELECT page_id, CASE WHEN contains(url, '://')
                           THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1),
                            '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(r, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u),
matched AS (
  SELECT page_id, host, path,
         (SELECT arg_max({{'rule': h || p, 'verdict': v}}, length(h) * 10000 + length(p)) FROM rules
          WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)) AS m
  FROM parts)
SELECT page_id, host, path, m.rule AS rule, coalesce(m.verdict, '{DEFAULT}') AS verdict
FROM matched
"""

"""Secret scans with an incremental blob ledger (operator 9, native).

Every historical version of a file is addressed by the digest of its content.
The ledger is a table of (blob, rule, rule_version, matches), one row per blob
and rule version already scanned, found or not, in folders by rule and version.
A scan takes the distinct blobs of the given versions, drops the pairs that the
ledger has, scans the rest, appends the new rows, and joins the findings of all
current rules back to every path and version. A second commit therefore scans
only new contents, and a changed rule scans each content once more.

All of it is DataFrame expressions. Java regular expressions give strings but
no positions, so the ledger keeps lengths: a text is split at a rule's matches
into the pieces between them, and each match is a row of (length of the piece
before it, its own length, its value's length). Starts, in code points, are
running sums of those: matches are exploded and a window adds them up per blob
and rule, so a text with very many matches costs in proportion. A cheap
substring test keeps blobs without a rule's fixed parts away from it. A scan's
ledger rows are dealt by rule into files of about ``FILE_ROWS`` blobs, instead
of a file per task and rule: a local file system starts a process (``chmod``)
for each file and folder made.

Contents are picked per digest by the smallest path key and only joined by
digests, so a blob on a third of all paths is scanned once; where several rows
have that key, one is taken after partial aggregation. What is joined back to
all paths is one short row per blob with findings, and adaptive execution may
split the partition of a hot digest.

Defined results: a null content counts as empty and has no findings; repeated
rows keep their own row in the result; an empty table gives an empty result and
appends nothing; other columns are not read.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_path


@dataclasses.dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` has one group for the value (or none: the
    match is the value); matches whose value is shorter than ``least`` are
    dropped after matching. ``hints``: each match has one of these substrings,
    tested on the lower-cased text if ``fold``; ``probe`` is a cheaper pattern
    that every kept match contains."""

    kind: str
    version: int
    pattern: str
    least: int
    grouped: bool = False
    hints: tuple[str, ...] = ()
    fold: bool = False
    probe: str | None = None


# --- fixed values: the base rules, in the order in which kinds are listed
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
RULES = (
    Rule("assign", 1, ASSIGN, 6, grouped=True, fold=True,
         hints=("password", "passwd", "secret", "token", "api_key", "apikey")),
    # a run is matched from its first character on, so a bounded repetition
    # keeps the runs of `+` that are long enough
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 20, hints=("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 24, probe=r"[0-9a-f]{24}"),
)
# ---

MATCHES = "array<struct<skip:int,size:int,value:int>>"
FILE_ROWS = 50_000
LEDGER = f"blob string, matches {MATCHES}, rule string, rule_version int"


def _matches(text: Column, rule: Rule) -> Column:
    """Lengths of a rule's matches, in order, dropped ones too: the code points
    skipped since the match before, its own and its value's."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    matched = F.regexp_extract_all(text, pattern, F.lit(0))
    # a match matches the same way when it stands alone
    value = (lambda m: F.regexp_extract(m, rule.pattern, 2)) if rule.grouped else (lambda m: m)
    return F.zip_with(
        F.slice(between, F.lit(1), F.size(matched)), matched,
        lambda skip, m: F.struct(F.length(skip).alias("skip"), F.length(m).alias("size"),
                                 F.length(value(m)).alias("value")))


def _hint(text: Column, rule: Rule) -> Column:
    seen = F.lit(False) if rule.hints else F.lit(True)
    where = F.lower(text) if rule.fold else text
    for hint in rule.hints:
        seen = seen | F.contains(where, F.lit(hint))
    return seen & F.rlike(text, F.lit(rule.probe)) if rule.probe else seen


def rule_matches(text: Column, rule: Rule) -> Column:
    return F.when(_hint(text, rule), _matches(text, rule)).otherwise(F.array().cast(MATCHES))


def read_ledger(spark: SparkSession, path: str, rules: tuple[Rule, ...]) -> DataFrame:
    """The ledger's rows of these rules' versions; a folder without a ledger has none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    if not there:
        return spark.createDataFrame([], LEDGER)
    wanted = [(F.col("rule") == r.kind) & (F.col("rule_version") == r.version) for r in rules]
    return spark.read.schema(LEDGER).parquet(path).where(reduce(lambda a, b: a | b, wanted))


def blob_id(content: Column) -> Column:
    return F.sha2(F.coalesce(content, F.lit("")).cast("binary"), 256)


def _unseen(rows: DataFrame, seen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(_blob, _pairs, _text): each blob for which the ledger lacks some rule,
    once, with the rules it has."""
    known = (seen.groupBy("blob").agg(F.collect_set("rule").alias("_pairs"))
             .withColumnRenamed("blob", "_known"))
    # one key per blob to fetch it by, with the number of its rows that have that key
    keyed = rows.groupBy("_blob", "_key").agg(F.count(F.lit(1)).alias("_n"))
    one = keyed.groupBy("_blob").agg(F.min(F.struct("_key", "_n")).alias("_one"))
    new = (one.join(known, F.col("_blob") == F.col("_known"), "left")
           .where(F.coalesce(F.size("_pairs"), F.lit(0)) < len(rules))
           .select(F.col("_blob").alias("_new"), "_one._n", F.col("_one._key").alias("_new_key"),
                   "_pairs"))
    fetched = (rows.join(new, F.col("_key").eqNullSafe(F.col("_new_key"))
                         & (F.col("_blob") == F.col("_new")))
               .select("_blob", "_pairs", "_n", F.coalesce("_content", F.lit("")).alias("_text")))
    single = fetched.where("_n = 1").drop("_n")
    several = fetched.where("_n > 1").groupBy("_blob").agg(
        F.first("_pairs").alias("_pairs"), F.first("_text").alias("_text"))
    return single.unionByName(several)


def _located(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, spans): blobs with findings, their spans as <start, kind, end> in
    order, where ``kind`` is the rule's place in ``rules``."""
    place = reduce(lambda c, i: c.when(F.col("rule") == rules[i].kind, i),
                   range(1, len(rules)), F.when(F.col("rule") == rules[0].kind, 0))
    least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), F.col("kind") + 1)
    # two scans at once may both have scanned a blob: one row counts
    rows = (ledger.where(F.size("matches") > 0).withColumn("kind", place)
            .groupBy("blob", "kind").agg(F.first("matches").alias("matches"))
            .select("blob", "kind", F.posexplode("matches").alias("at", "match")))
    so_far = Window.partitionBy("blob", "kind").orderBy("at") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("match.skip") + F.col("match.size")).cast("bigint")).over(so_far)
    spans = (rows.withColumn("end", end).where(F.col("match.value") >= least)
             .select("blob", F.struct((F.col("end") - F.col("match.size")).alias("start"), "kind",
                                      "end").alias("span")))
    return spans.groupBy("blob").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def scan(versions: DataFrame, ledger: str, key: str, content: str,
         rules: tuple[Rule, ...] = RULES, file_rows: int = FILE_ROWS) -> DataFrame:
    """Scan what the ledger has not seen, append it, and return (key, blob,
    spans): a row per row of ``versions``, with all spans of the rules (null
    where there are none) as <start, kind, end>, ``kind`` being the rule's place."""
    spark = versions.sparkSession
    rows = versions.select(F.col(key).alias("_key"), F.col(content).alias("_content"),
                           blob_id(F.col(content)).alias("_blob"))
    unseen = _unseen(rows, read_ledger(spark, ledger, rules), rules)
    pairs = F.array(*[
        F.when(F.coalesce(~F.array_contains("_pairs", r.kind), F.lit(True)),
               F.struct(rule_matches(F.col("_text"), r).alias("matches"),
                        F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version")))
        for r in rules])
    found = unseen.select(F.col("_blob").alias("blob"),
                          F.inline(F.filter(pairs, lambda x: x.isNotNull())))
    files = 1 + versions.count() // file_rows  # of a rule
    (found.repartition(len(rules) * files, "rule", F.pmod(F.xxhash64("blob"), F.lit(files)))
     .write.mode("append").partitionBy("rule", "rule_version").parquet(ledger))
    located = _located(read_ledger(spark, ledger, rules), rules)
    located = located.withColumnRenamed("blob", "_found")
    return (versions.select(F.col(key).alias("key"), blob_id(F.col(content)).alias("blob"))
            .join(located.hint("merge"), F.col("blob") == F.col("_found"), "left").drop("_found"))


def secret_digests(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Per document the number of spans of each base kind, the digest of the
    base spans and all spans (``kind:start:end`` by start, then kind as listed)."""
    kinds = [r.kind for r in RULES]
    found = scan(docs, ledger or scratch_path(docs.sparkSession, "secret-ledger"), "doc_id", "text")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    names = F.array(*map(F.lit, kinds))
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

    def count(i: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == i)).cast("long")

    return (found.select(F.col("key").alias("doc_id"),
                         *[count(i).alias(f"n_{k}") for i, k in enumerate(kinds)],
                         text.alias("spans"))
            .select("doc_id", *[f"n_{k}" for k in kinds],
                    F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans"))


# DuckDB over `documents`: the same matches by the same running sums.
def _oracle_kind(rule: Rule) -> str:
    pattern = "(?s)(.*?)(" + rule.pattern.replace("'", "''") + ")"
    value = 4 if rule.grouped else 2
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {[r.kind for r in RULES].index(rule.kind)} AS ord,
         unnest(list_transform(generate_series(1, len(m)), lambda k:
           list_sum(list_transform(s[1:k], lambda x: length(x)))
           + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0))) AS a,
         unnest(list_transform(m, lambda x: length(x))) AS size,
         unnest(list_transform(v, lambda x: length(x))) AS vsize, {rule.least} AS least
  FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 1) AS s,
               regexp_extract_all(text, '{pattern}', 2) AS m,
               regexp_extract_all(text, '{pattern}', {value}) AS v
        FROM documents WHERE text IS NOT NULL)"""


ORACLE_SQL = f"""
WITH hits AS ({' UNION ALL '.join(map(_oracle_kind, RULES))}),
kept AS (SELECT doc_id, kind, ord, CAST(a AS BIGINT) AS a, CAST(a + size AS BIGINT) AS b
         FROM hits WHERE vsize >= least),
joined AS (
  SELECT doc_id,
         count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, ord) AS spans
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined USING (doc_id)
"""

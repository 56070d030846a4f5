"""Centroid clustering with PCA-rotated filtering (operator 13).

Vectors become integers, so assignments and updates are exact. The table is
rotated once into its principal axes: a row stores its integers, its ``LEAD``
leading rotated coordinates and the norm of the rest. With x = (lead, rest) and
a centroid's (lead_c, rest_c), the triangle inequality gives

    |x - c|^2 >= |lead - lead_c|^2 + (rest - rest_c)^2

and centroids whose bound is above the integer distance to the most promising
one are skipped; every survivor is verified in integers. A slack for the
rounding of the rotation only lets more centroids survive.

Each round is one pass: tasks add up their rows per cluster, Spark adds up the
tasks, and the driver gets ``k * dim`` sums. Nothing is shuffled by vector or by
cluster, so equal vectors or one huge cluster make no hot task. The rotated
table is written to the shared folder, and the rounds read it from there.

Defined results: vectors of another length than ``dim``, null ones and those
with a null or non-finite component are left out; repeated rows count as often
as they are there; rows with equal digests seed in the order of their
components, rows without vec_id last; with fewer than ``k`` vectors there are as
many centroids as vectors; an empty table gives an empty result; other columns
are not read. A component beyond 2^27 after scaling raises, as its distance
would not fit a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.vectors import matrix, moments, packed_rows, scaled, unpacked_rows, usable

DIM = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
LEAD = 16
SLACK = 1e-9  # of the squared norms, for rounding in the rotation


class Rotation:
    """Principal axes of a table of integer vectors."""

    def __init__(self, n: int, sums: np.ndarray, products: np.ndarray, lead: int):
        self.mean = sums / max(n, 1)
        covariance = products / max(n, 1) - np.outer(self.mean, self.mean)
        _, axes = np.linalg.eigh(covariance)
        self.axes = np.ascontiguousarray(axes[:, ::-1][:, :lead])

    def apply(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of what they leave out."""
        centred = m - self.mean
        lead = centred @ self.axes
        rest = (centred * centred).sum(1) - (lead * lead).sum(1)
        return lead, np.sqrt(np.maximum(rest, 0))


class Centroids:
    """Integer centroids with their rotated forms."""

    def __init__(self, vectors: np.ndarray, rotation: Rotation):
        self.vectors = vectors
        self.lead, self.rest = rotation.apply(vectors.astype(np.float64))

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, rows x centroids."""
        rows, own = (lead * lead).sum(1), (self.lead * self.lead).sum(1)
        gap = rows[:, None] - 2 * lead @ self.lead.T + own
        size = (rows + rest * rest)[:, None] + own + self.rest * self.rest + 1
        return gap + (rest[:, None] - self.rest) ** 2 - SLACK * size

    def nearest(self, m: np.ndarray, lead: np.ndarray,
                rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance) per row, the smaller cluster on ties,
        and how many distances were computed."""
        bound = self.bounds(lead, rest)
        who = bound.argmin(1)
        gap = m - self.vectors[who]
        best = (gap * gap).sum(1)
        alive = bound <= best[:, None]
        alive[np.arange(len(m)), who] = False
        for j in range(len(self.vectors)):
            rows = np.flatnonzero(alive[:, j])
            if not len(rows):
                continue
            gap = m[rows] - self.vectors[j]
            d = (gap * gap).sum(1)
            better = (d < best[rows]) | ((d == best[rows]) & (j < who[rows]))
            best[rows[better]], who[rows[better]] = d[better], j
        return who, best, len(m) + int(alive.sum())


def _rotated(rotation: Rotation, dim: int):
    def run(batches):
        for batch in batches:
            m = matrix(batch.column(1), dim)
            lead, rest = rotation.apply(m.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), packed_rows(m, "<i4"), packed_rows(lead, "<f8"), pa.array(rest)],
                names=["vec_id", "ints", "lead", "rest"])
    return run


def _decoded(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lead = unpacked_rows(batch.column(2), -1, "<f8") if batch.num_rows else np.zeros((0, 1))
    return (unpacked_rows(batch.column(1), dim, "<i4").astype(np.int64), lead,
            batch.column(3).to_numpy())


def _added(shared, dim: int):
    """Per task: rows and component sums of each cluster, position -1 for the rows."""
    def run(batches):
        centroids = shared.value
        k = len(centroids.vectors)
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            m, lead, rest = _decoded(batch, dim)
            who, _, _ = centroids.nearest(m, lead, rest)
            for j in np.unique(who):
                rows = m[who == j]
                total[j, 0] += len(rows)
                total[j, 1:] += rows.sum(0)
        at = np.flatnonzero(np.repeat(total[:, 0] > 0, dim + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array((at // (dim + 1)).astype(np.int32)),
             pa.array((at % (dim + 1) - 1).astype(np.int32)), pa.array(total.ravel()[at])],
            names=["cluster", "position", "total"])
    return run


def _assigned(shared, dim: int):
    def run(batches):
        centroids = shared.value
        for batch in batches:
            who, best, _ = centroids.nearest(*_decoded(batch, dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(who.astype(np.int32)), pa.array(best)],
                names=["vec_id", "cluster", "distance"])
    return run


def seeds(kept: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of ``1:<vec_id>``, in order."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.select(digest.alias("_d"), "v").orderBy(F.asc_nulls_last("_d"), "v").limit(k)
    return np.array([r["v"] for r in rows.collect()], np.int64)


def updated(centroids: np.ndarray, rows: list) -> np.ndarray:
    """floor(sum / count) of each non-empty cluster; empty ones stay."""
    counts = {r["cluster"]: int(r["total"]) for r in rows if r["position"] < 0}
    out = centroids.copy()
    for r in rows:
        if r["position"] >= 0:
            out[r["cluster"], r["position"]] = int(r["total"]) // counts[r["cluster"]]
    return out


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM,
            scale: int = SCALE, lead: int = LEAD) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) per usable vector, and the final centroids."""
    spark = vectors.sparkSession
    kept = vectors.where(usable(F.col("embedding")) & (F.size("embedding") == dim)).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding"), scale).alias("v"))
    centres = seeds(kept, k)
    if not len(centres):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), \
            np.zeros((0, dim), np.int64)
    rotation = Rotation(*moments(kept.select("v"), dim), min(lead, dim))
    table = written(kept.mapInArrow(_rotated(rotation, dim),
                                    "vec_id long, ints binary, lead binary, rest double"),
                    "rotated-vectors")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Centroids(centres, rotation))
        sums = (table.mapInArrow(_added(shared, dim), "cluster int, position int, total long")
                .groupBy("cluster", "position")
                .agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")))
        centres = updated(centres, sums.collect())  # k * (dim + 1) rows
        shared.unpersist()
    shared = spark.sparkContext.broadcast(Centroids(centres, rotation))
    assigned = table.mapInArrow(_assigned(shared, dim), "vec_id long, cluster int, distance long")
    return assigned, centres


def cluster_digests(vectors: DataFrame) -> DataFrame:
    """Per vector its cluster and squared distance, the sums of distances over
    its cluster and over all, and the digest of its centroid."""
    spark = vectors.sparkSession
    assigned, centres = cluster(vectors)
    assigned = written(assigned, "clusters")
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}  # k rows
    total = sum(sums.values())
    about = [(j, sums[j], total,
              hashlib.sha256(",".join(map(str, centres[j].tolist())).encode()).hexdigest())
             for j in sorted(sums)]
    facts = spark.createDataFrame(
        about, "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(facts), F.col("cluster") == F.col("_cluster"))
            .drop("_cluster"))


def _oracle() -> str:
    """The rounds written out in DuckDB; floor division of negative sums by hand."""
    nearest = """
{name} AS MATERIALIZED (
  SELECT id, v, c, d FROM (
    SELECT r.id, r.v, {centres}.c,
           list_sum(list_transform(list_zip(r.v, {centres}.v),
                                   lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM rows r, {centres})
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, c) = 1)"""
    update = """
{name} AS MATERIALIZED (
  SELECT c, list(m ORDER BY p) AS v FROM (
    SELECT c, p, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
    FROM (SELECT c, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
          FROM (SELECT c, unnest(v) AS x, unnest(generate_series(1, len(v))) AS p
                FROM {assigned}) GROUP BY c, p)) GROUP BY c
  UNION ALL SELECT c, v FROM {before} WHERE c NOT IN (SELECT c FROM {assigned}))"""
    steps = [f"""
rows AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM})""", f"""
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, v
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM rows ORDER BY h LIMIT {CLUSTERS}))"""]
    for i in range(ROUNDS + 1):
        steps.append(nearest.format(name=f"a{i}", centres=f"c{i}"))
        if i < ROUNDS:
            steps.append(update.format(name=f"c{i + 1}", assigned=f"a{i}", before=f"c{i}"))
    last = ROUNDS
    return f"""
WITH {','.join(steps)}
SELECT rows.vec_id, a.c AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a{last} a JOIN rows ON rows.id = a.id JOIN c{last} k ON k.c = a.c
"""


ORACLE_SQL = _oracle()

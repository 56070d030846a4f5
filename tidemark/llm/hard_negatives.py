"""Hard negatives from STR-packed R-trees (operator 12).

Index: every usable vector, as integers, is range-partitioned by its first
coordinate (Spark's part of sort-tile-recursive packing, ties broken by id, so a
very common vector is dealt over partitions too). Each task packs its rows into
trees of at most ``TREE_ROWS`` vectors by tiling further coordinates into leaves
of ``LEAF`` vectors, each with its minimum bounding box; a tree is one row of a
table written to the shared folder.

Search: an inner product q.x with lo <= x <= hi lies in
[q+.lo + q-.hi, q+.hi + q-.lo] (q+ and q- are q's positive and negative parts),
so a box gives an interval of scores. A best-first queue of boxes, keyed by the
highest upper bound of the queries that still need them, is worked off for a
group of queries together: a box is dropped for a query whose score window does
not meet the interval, or whose k-th best score is strictly above its upper
bound (an equal one may still win by a smaller id). Scores are integers.

Queries (anchors, a stated set) are taken in blocks of at most ``BLOCK_BYTES``,
each broadcast to one pass over all trees; a task keeps its k best per query
over all its trees and Spark merges the tasks' lists. First pass: the best
positives of each anchor; second pass: for each of them the best rows of other
labels in its score window.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; rows equal in vec_id, label and integers count once;
rows of the anchor's own vec_id are not its positives; a row without vec_id is
no anchor, and sorts last where it is a positive or negative; vectors of another
length than the anchor's are not compared with it; positives with a negative
score have an empty window; an empty table gives an empty result; other columns
are not read. A component beyond 2^27 after scaling raises.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_path, shuffle_partitions, shuffles_removed
from tidemark.llm.vectors import matrix, scaled, usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10
LOW, HIGH = 30, 90  # percent of the positive's score
LEAF = 64
FAN = 16
TREE_ROWS = 4096
TREES_PER_PART = 8
BLOCK_BYTES = 8 << 20
GROUP = 256  # queries' anchors searched together
NO_ID = (1 << 63) - 1  # stands for a missing vec_id, sorted last
FLOOR = -(1 << 62)  # below any score

TREE = "dim int, rows int, starts binary, lo binary, hi binary, " \
       "vectors binary, ids binary, labels binary"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, " \
         "positive_score long, negative_score long"


# --------------------------------------------------------------------------- packing

def tiles(m: np.ndarray, rows: np.ndarray, axis: int, leaf: int) -> list[np.ndarray]:
    """Row groups of at most ``leaf`` by sort-tile-recursive from ``axis`` on."""
    if len(rows) <= leaf or axis >= m.shape[1]:
        return [rows[i: i + leaf] for i in range(0, len(rows), leaf)]
    pages = -(-len(rows) // leaf)
    left = max(1, min(m.shape[1] - axis, 3))  # coordinates that the rest is tiled by
    slabs = int(np.ceil(pages ** (1 / left)))
    rows = rows[np.argsort(m[rows, axis], kind="stable")]
    size = leaf * -(-pages // slabs)
    out: list[np.ndarray] = []
    for i in range(0, len(rows), size):
        part = rows[i: i + size]
        out += [part[j: j + leaf] for j in range(0, len(part), leaf)] if left == 1 \
            else tiles(m, part, axis + 1, leaf)
    return out


def pack(m: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> list:
    groups = tiles(m, np.arange(len(m)), min(1, max(m.shape[1] - 1, 0)), LEAF)
    order = np.concatenate(groups)
    starts = np.cumsum([0] + [len(g) for g in groups])
    m = m[order]
    lo = np.minimum.reduceat(m, starts[:-1], axis=0) if m.shape[1] else m[:len(groups)]
    hi = np.maximum.reduceat(m, starts[:-1], axis=0) if m.shape[1] else m[:len(groups)]
    return [m.shape[1], len(m), starts.astype("<i8").tobytes(), lo.astype("<i4").tobytes(),
            hi.astype("<i4").tobytes(), m.astype("<i4").tobytes(),
            ids[order].astype("<i8").tobytes(), labels[order].astype("<i8").tobytes()]


TREE_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
TREE_NAMES = ["dim", "rows", "starts", "lo", "hi", "vectors", "ids", "labels"]


def _packed(batches):
    """Trees of the rows as they come, sorted by length and first coordinate."""
    held: list[tuple] = []
    count = 0

    def out():
        m, ids, labels = (np.concatenate(x) for x in zip(*held))
        return pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(pack(m, ids, labels), TREE_TYPES)], names=TREE_NAMES)

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        dims = batch.column(2).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(dims)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(dims)]):
            while lo < hi:
                dim = int(dims[lo])
                if held and (count == TREE_ROWS or held[0][0].shape[1] != dim):
                    yield out()
                    held, count = [], 0
                end = min(hi, lo + TREE_ROWS - count)
                m = matrix(batch.column(3).slice(lo, end - lo), dim)
                held.append((m, ids[lo:end], labels[lo:end]))
                count, lo = count + end - lo, end
    if held:
        yield out()


class Tree:
    """An R-tree: leaves' rows in order, and levels of boxes from the leaves up."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.vectors = np.frombuffer(row["vectors"], "<i4").reshape(row["rows"], dim)
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.labels = np.frombuffer(row["labels"], "<i8")
        self.starts = np.frombuffer(row["starts"], "<i8")
        leaves = len(self.starts) - 1
        boxes = [(np.frombuffer(row["lo"], "<i4").reshape(leaves, dim),
                  np.frombuffer(row["hi"], "<i4").reshape(leaves, dim))]
        while len(boxes[-1][0]) > 1:
            lo, hi = boxes[-1]
            at = np.arange(0, len(lo), FAN)
            boxes.append((np.minimum.reduceat(lo, at, axis=0) if dim else lo[at],
                          np.maximum.reduceat(hi, at, axis=0) if dim else hi[at]))
        # inner products stay exact in doubles below 2^53, else integers are used
        most = max(int(np.abs(self.vectors, dtype=np.int64).max(initial=0)), 1)
        self.most = most * max(dim, 1)
        self.boxes = boxes

    def number(self, q: np.ndarray) -> type:
        return np.float64 if int(np.abs(q).max(initial=0)) * self.most < 1 << 53 else np.int64


class Best:
    """The k best (score, id) of each query, the smaller id first on equal scores."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), FLOOR, np.int64)
        self.id = np.full((queries, k), NO_ID, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        k = self.score.shape[1]
        touched, at = np.unique(query, return_inverse=True)
        who = np.concatenate([np.repeat(np.arange(len(touched)), k), at])
        scores = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.id[touched].ravel(), ident])
        order = np.lexsort((ids, -scores, who))
        first = np.searchsorted(who[order], np.arange(len(touched)))
        order = order[np.arange(len(order)) - first[who[order]] < k].reshape(-1, k)
        self.score[touched], self.id[touched] = scores[order], ids[order]

    @property
    def kth(self) -> np.ndarray:
        return self.score[:, -1]


class Queries:
    """Score windows over a block of anchors: query i belongs to anchor
    ``owner[i]`` and takes rows of the anchor's label (``same``) or of others
    with ``low[i] <= score <= high[i]``."""

    def __init__(self, vectors, ids, labels, owner, low, high, k, same):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        self.owner, self.low, self.high, self.k, self.same = owner, low, high, k, same

    def group(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of anchors lo..hi, and of their queries."""
        a, b = np.searchsorted(self.owner, [lo, hi])
        return np.arange(lo, hi), np.arange(a, b)

    def search(self, tree: Tree, anchors: np.ndarray, mine: np.ndarray, best: Best) -> int:
        """Work off the tree for some anchors' queries; returns the leaves read."""
        if not len(mine):
            return 0
        q = self.vectors[anchors]
        number = tree.number(q)
        q = q.astype(number)
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        own = self.owner[mine] - anchors[0]
        low, high = self.low[mine], self.high[mine]
        queue: list[tuple[int, int, int, np.ndarray]] = []
        read = 0

        def push(level: int, first: int, last: int) -> None:
            lo, hi = (b[first:last].astype(number).T for b in tree.boxes[level])
            upper = (plus @ hi + minus @ lo).astype(np.int64)
            lower = (plus @ lo + minus @ hi).astype(np.int64)
            meets = (upper[own] >= low[:, None]) & (lower[own] <= high[:, None])
            for n in range(last - first):
                if meets[:, n].any():
                    bound = np.where(meets[:, n], upper[own, n], FLOOR)
                    heapq.heappush(queue, (-int(bound.max()), level, first + n, bound))

        push(len(tree.boxes) - 1, 0, len(tree.boxes[-1][0]))
        while queue:
            _, level, node, bound = heapq.heappop(queue)
            needed = (bound > FLOOR) & (bound >= best.kth[mine])
            if not needed.any():
                continue
            if level:
                push(level - 1, node * FAN, min((node + 1) * FAN, len(tree.boxes[level - 1][0])))
                continue
            read += 1
            a, b = tree.starts[node], tree.starts[node + 1]
            needed = np.flatnonzero(needed)
            of = own[needed]
            rows, back = np.unique(of, return_inverse=True)
            score = (q[rows] @ tree.vectors[a:b].astype(number).T).astype(np.int64)
            same = self.labels[anchors[rows]][:, None] == tree.labels[a:b]
            if self.same:
                fits = same & (self.ids[anchors[rows]][:, None] != tree.ids[a:b])
            else:
                fits = ~same
            score = np.where(fits, score, FLOOR)[back]
            ok = (score >= np.maximum(low[needed], best.kth[mine[needed]])[:, None]) \
                & (score <= high[needed][:, None]) & (score > FLOOR)
            who, row = np.nonzero(ok)
            if len(who):
                best.add(mine[needed[who]], score[who, row], tree.ids[a:b][row])
        return read


def _searched(shared):
    def run(batches):
        queries = shared.value
        best, anchors = Best(len(queries.owner), queries.k), len(queries.vectors)
        for batch in batches:
            for i in range(batch.num_rows):
                tree = Tree(batch.slice(i, 1).to_pylist()[0])
                for lo in range(0, anchors, GROUP):
                    queries.search(tree, *queries.group(lo, min(lo + GROUP, anchors)), best)
        who, place = np.nonzero(best.score > FLOOR)
        yield pa.RecordBatch.from_arrays(
            [pa.array(who), pa.array(best.score[who, place]), pa.array(best.id[who, place])],
            names=["query", "score", "id"])
    return run


# --------------------------------------------------------------------------- Spark

def usable_rows(embeddings: DataFrame) -> DataFrame:
    """(id, label, dim, v) of the rows that take part, repeated ones once."""
    label = F.col("label").cast("long")
    relabelled = F.when(F.col("vec_id") % RELABEL_EVERY == 0,
                        (label + 1) % LABELS).otherwise(label)
    return (embeddings.where(F.col("label").isNotNull() & usable(F.col("embedding")))
            .select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"),
                    relabelled.alias("label"), F.size("embedding").alias("dim"),
                    scaled(F.col("embedding"), SCALE).alias("v")).distinct())


def build_index(rows: DataFrame, folder: str) -> DataFrame:
    """The rows as packed trees, written under ``folder``."""
    spark = rows.sparkSession
    total = rows.count()
    parts = max(shuffle_partitions(spark), -(-total // (TREE_ROWS * TREES_PER_PART)))
    keys = ["dim", F.try_element_at("v", F.lit(1)), "id", F.xxhash64("v")]
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    with shuffles_removed(spark):
        ordered.mapInArrow(_packed, TREE).write.option("compression", "zstd").parquet(
            f"{folder}/trees")
    return spark.read.schema(TREE).parquet(f"{folder}/trees")


def anchor_blocks(anchors: DataFrame, block_bytes: int):
    """The anchors in blocks by hash of at most about ``block_bytes`` each; one
    block is on the driver at a time. A block holds vectors of one length."""
    sizes = anchors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()  # lengths in use
    for dim, n in sorted((r["dim"], r["n"]) for r in sizes):
        blocks = max(1, -(-n * 8 * (dim + 2) // block_bytes))
        own = F.pmod(F.xxhash64("id", "v"), F.lit(blocks))
        for block in range(blocks):
            rows = anchors.where((F.col("dim") == dim) & (own == block))
            got = sorted((r["id"], r["label"], r["v"])
                         for r in rows.select("id", "label", "v").collect())
            if got:
                yield (np.array([r[0] for r in got], np.int64),
                       np.array([r[1] for r in got], np.int64),
                       np.array([r[2] for r in got], np.int64).reshape(len(got), dim))


def _best_rows(trees: DataFrame, dim: int, queries: Queries) -> DataFrame:
    """(query, rank, score, id): each query's ``k`` best over all trees."""
    shared = trees.sparkSession.sparkContext.broadcast(queries)
    found = trees.where(F.col("dim") == dim).mapInArrow(
        _searched(shared), "query long, score long, id long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.select("query", place.alias("rank"), "score", "id").where(
        F.col("rank") <= queries.k)


def windows(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score with LOW * p <= 100 * score <= HIGH * p."""
    return -(-LOW * score // 100), HIGH * score // 100


def mine(embeddings: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per anchor and positive the best rows of other labels in its window."""
    spark = embeddings.sparkSession
    folder = scratch_path(spark, "hard-negatives")
    rows = usable_rows(embeddings)
    with shuffles_removed(spark):
        rows.write.option("compression", "zstd").parquet(f"{folder}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    trees = build_index(rows, folder)
    anchors = rows.where((F.col("id") % ANCHOR_EVERY == 0) & (F.col("id") != NO_ID))
    known = F.when(F.col("id") != NO_ID, F.col("id"))
    spark.createDataFrame([], RESULT).write.parquet(f"{folder}/found/block=-1")
    for block, (ids, labels, vectors) in enumerate(anchor_blocks(anchors, block_bytes)):
        n, dim = vectors.shape
        any_score = np.full(n, 1 << 62, np.int64)
        first = Queries(vectors, ids, labels, np.arange(n), FLOOR + any_score * 0, any_score,
                        POSITIVES, True)
        # at most POSITIVES rows for each anchor of the block
        positives = np.array(sorted((r["query"], r["rank"], r["score"], r["id"])
                                    for r in _best_rows(trees, dim, first).collect()
                                    if r["score"] >= 0), np.int64).reshape(-1, 4)
        low, high = windows(positives[:, 2])
        second = Queries(vectors, ids, labels, positives[:, 0], low, high, NEGATIVES, False)
        of = spark.createDataFrame(pa.table({
            "query": pa.array(np.arange(len(positives))), "anchor_id": pa.array(ids[positives[:, 0]]),
            "positive": pa.array(positives[:, 3]), "positive_score": pa.array(positives[:, 2])}))
        found = (_best_rows(trees, dim, second).join(F.broadcast(of), "query")
                 .select("anchor_id",
                         F.when(F.col("positive") != NO_ID, F.col("positive")).alias("positive_id"),
                         "rank", known.alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score")))
        with shuffles_removed(spark):
            found.write.parquet(f"{folder}/found/block={block}")
    return spark.read.schema(RESULT).parquet(f"{folder}/found").drop("block")


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END
           AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM scored WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                               ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score
  AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""

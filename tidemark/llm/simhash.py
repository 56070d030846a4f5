"""SimHash near-deduplication (operator 6): a binary trie self-join.

Fingerprints are made in one pass over the texts, and only distinct ones go on.
The self-join descends a binary trie of fingerprints with *pairs* of nodes: a
pair's differing bits are accumulated on the way down, and a pair is dropped as
soon as they exceed the budget. The trie is implicit: a node is a range of the
sorted fingerprints, and all node pairs of a level advance together in numpy.

Partitioning: 64 bits are cut into ``BLOCKS`` blocks. Fingerprints within
``BUDGET`` = 4 bits agree on at least two of six blocks, so for each of the 15
choices of two blocks the bits are permuted to put these first, and the tries
below one value of them are joined separately. The choices together meet every
link. A task joins all tries of its partition at once.

Only connectivity is asked for, so a task unites found links as it goes and drops
node pairs whose fingerprints are all united already: a dense group of near copies
costs about its size, not its square, and what leaves a task is a spanning forest.
A trie of more than ``MAX_BUCKET`` fingerprints is not joined in one task: its
fingerprints are dealt into pieces, and every pair of pieces is joined on its own.

Components come from alternating large-star and small-star steps over the forest
edges; each step's table is written to the shared folder.

Defined results: a null text counts as empty; a text without words has the
fingerprint zero, linked like any other; fewer words than a shingle make one
shingle; null doc_ids never name a component unless it has no other; repeated
rows keep a row each; an empty table gives an empty result; only doc_id and text
are read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import U64, flat, in_few_files, shuffle_partitions, written

SHINGLE = 4
BUDGET = 4
SEED = 42
BLOCKS = (11, 11, 11, 11, 10, 10)  # widths, from the highest bit on
MAX_BUCKET = 200_000
FRONTIER = 1 << 18
JOIN_ROWS = 1 << 18
FILE_PRINTS = 100_000


# --------------------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles of a lower-cased text."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_digest
    h = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last)])
    bits = np.unpackbits(np.frombuffer(h, np.uint8).reshape(n, 8), axis=1)
    major = 2 * bits.sum(0, dtype=np.int64) > n
    return int.from_bytes(np.packbits(major).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            raw, at = data.tobytes().lower(), offsets.tolist()
            values = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(at, at[1:])], U64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _fingerprints(shingle), "doc_id long, fp long")


# --------------------------------------------------------------------------- permuted tries

STARTS = tuple(64 - sum(BLOCKS[: i + 1]) for i in range(len(BLOCKS)))
CHOICES = tuple(itertools.combinations(range(len(BLOCKS)), 2))


def _layout(choice: tuple[int, int]) -> list[tuple[int, int, int]]:
    """(block's lowest bit, width, lowest bit after the permutation), chosen blocks first."""
    out, top = [], 64
    for b in (*choice, *(b for b in range(len(BLOCKS)) if b not in choice)):
        top -= BLOCKS[b]
        out.append((STARTS[b], BLOCKS[b], top))
    return out


LAYOUTS = tuple(_layout(c) for c in CHOICES)
KEY_BITS = tuple(sum(BLOCKS[b] for b in c) for c in CHOICES)


def permute(fp: np.ndarray, table: int) -> np.ndarray:
    out = np.zeros_like(fp)
    for low, width, to in LAYOUTS[table]:
        out |= (fp >> U64(low) & U64((1 << width) - 1)) << U64(to)
    return out


def restore(value: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.zeros_like(value)
    for t in np.unique(table):
        mine = table == t
        v, x = value[mine], np.zeros(int(mine.sum()), U64)
        for low, width, to in LAYOUTS[t]:
            x |= (v >> U64(to) & U64((1 << width) - 1)) << U64(low)
        out[mine] = x
    return out


def _deal(batches):
    """Each fingerprint once per choice of blocks: (trie, permuted value)."""
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for t in range(len(CHOICES)):
            value = permute(fp, t)
            trie = (value >> U64(64 - KEY_BITS[t])) | U64(t << 32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(trie.view(np.int64)), pa.array(value.view(np.int64))],
                names=["trie", "value"])


class Forest:
    """Components of positions, labelled by their smallest position."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self._bounds()

    def _bounds(self) -> None:
        change = np.zeros(len(self.label), np.int64)
        change[1:] = np.cumsum(self.label[1:] != self.label[:-1])
        self.change = change

    def unite(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up
        self._bounds()

    def united(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether all positions of a range have one label."""
        return self.change[hi - 1] == self.change[lo]


def trie_join(tries: np.ndarray, values: np.ndarray,
              budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within each trie, as positions (child, root).

    The arrays are sorted together, by trie and then by value.
    """
    n = len(values)
    forest = Forest(n)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], tries[1:] != tries[:-1]]))
    last = np.append(first[1:], n)
    many = last - first > 1
    first, last = first[many], last[many]
    # ones before each position, per bit, made when a level is first reached
    ones: dict[int, np.ndarray] = {}

    def middle(lo, hi, bit):
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum(values >> U64(bit) & U64(1),
                                                       dtype=np.int64)])
        return hi - (ones[bit][hi] - ones[bit][lo])

    stack = [(63, first, last, first, last, np.zeros(len(first), np.int64))]
    while stack:
        bit, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            stack.append((bit, *(x[half:] for x in (alo, ahi, blo, bhi, err))))
            alo, ahi, blo, bhi, err = (x[:half] for x in (alo, ahi, blo, bhi, err))
            stack.append((bit, alo, ahi, blo, bhi, err))
            continue
        # what is one component already needs no further look
        idle = forest.united(alo, ahi) & forest.united(blo, bhi) & (
            forest.label[alo] == forest.label[blo])
        alo, ahi, blo, bhi, err = (x[~idle] for x in (alo, ahi, blo, bhi, err))
        # two single fingerprints, or nodes at the bottom: compare directly
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            forest.unite(i[near], j[near])
            alo, ahi, blo, bhi, err = (x[~single] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        am, bm = middle(alo, ahi, bit), middle(blo, bhi, bit)
        own = alo == blo  # a node paired with itself
        parts = []
        for a0, a1, b0, b1, differ, mask in (
                (alo, am, blo, bm, 0, None), (am, ahi, bm, bhi, 0, None),
                (alo, am, bm, bhi, 1, None), (am, ahi, blo, bm, 1, ~own)):
            e = err + differ
            keep = (a1 > a0) & (b1 > b0) & (e <= budget)
            if mask is not None:
                keep &= mask
            if differ == 0:
                keep &= ~(own & (a1 - a0 == 1))
            parts.append((a0[keep], a1[keep], b0[keep], b1[keep], e[keep]))
        # pairs that differ less go first: what they unite spares the rest
        for group in (parts[2:], parts[:2]):
            rows = [np.concatenate(x) for x in zip(*group)]
            if not len(rows[0]):
                continue
            if bit:
                stack.append((bit - 1, *rows))
            else:
                forest.unite(rows[0], rows[2])
    child = np.flatnonzero(forest.label != np.arange(n))
    return child, forest.label[child]


EDGE = "u long, v long, trie long"


def _edges(tries: np.ndarray, values: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    child, root = trie_join(tries, values)
    fp = restore(values, table).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(fp[child]), pa.array(fp[root]), pa.array([None] * len(child), pa.int64())],
        names=["u", "v", "trie"])


def _join_tries(max_bucket: int | None):
    """Join the tries of rows sorted by trie; rows of a trie over
    ``max_bucket`` leave as they are: (null, value, trie)."""
    def overflow(trie: int, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([None] * len(values), pa.int64()), pa.array(values),
             pa.array(np.full(len(values), trie, np.int64))], names=["u", "v", "trie"])

    def joined(trie: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        values = value.view(np.uint64)
        order = np.lexsort((values, trie))
        return _edges(trie[order], values[order], trie[order] >> 32 & 0xFF)

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows, large = 0, None
        for batch in batches:
            trie, value = (batch.column(i).to_numpy() for i in range(2))
            if large is not None:  # the rest of a trie that is too large
                end = int(np.searchsorted(trie, large, side="right"))
                if end:
                    yield overflow(large, value[:end])
                trie, value = trie[end:], value[end:]
                if len(trie):
                    large = None
            if len(trie):
                held.append((trie, value))
                rows += len(trie)
            if rows >= JOIN_ROWS:
                trie, value = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(trie, trie[-1]))  # the last trie may go on
                if max_bucket is not None and len(trie) - cut > max_bucket:
                    large = int(trie[-1])
                    yield overflow(large, value[cut:])
                    held = []
                else:
                    held = [(trie[cut:], value[cut:])]
                yield from complete(trie[:cut], value[:cut])
                rows = sum(len(t) for t, _ in held)
        if held:
            yield from complete(*(np.concatenate(x) for x in zip(*held)))

    def complete(trie: np.ndarray, value: np.ndarray):
        """Whole tries: those that are too large leave as they are."""
        if max_bucket is not None and len(trie):
            start = np.flatnonzero(np.concatenate([[True], trie[1:] != trie[:-1]]))
            size = np.diff(np.append(start, len(trie)))
            for s, n in zip(start[size > max_bucket].tolist(), size[size > max_bucket].tolist()):
                yield overflow(int(trie[s]), value[s: s + n])
            small = np.repeat(size <= max_bucket, size)
            trie, value = trie[small], value[small]
        if len(trie):
            yield joined(trie, value)
    return run


def _join_pieces(batches):
    """Join rows (trie, value, pair) sorted by pair: one pair of pieces at a time."""
    held, current = [], None

    def out():
        values = np.sort(np.array([v for _, v in held], np.int64).view(np.uint64))
        values = np.unique(values)
        tries = np.zeros(len(values), np.int64)
        return _edges(tries, values, np.full(len(values), held[0][0] >> 32 & 0xFF))

    for batch in batches:
        for trie, value, pair in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if pair != current:
                if held:
                    yield out()
                held, current = [], pair
            held.append((trie, value))
    if held:
        yield out()


def links(distinct: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(u, v): forest edges whose components are those of all links within the budget."""
    spark = distinct.sparkSession
    parts = shuffle_partitions(spark)
    dealt = distinct.select("fp").mapInArrow(_deal, "trie long, value long")
    first = (dealt.repartition(parts, "trie").sortWithinPartitions("trie")
             .mapInArrow(_join_tries(max_bucket), EDGE))
    first = written(in_few_files(first, distinct.count() // FILE_PRINTS), "simhash-edges")
    edges = first.where("u IS NOT NULL").select("u", "v")
    large = first.where("u IS NULL").select("trie", F.col("v").alias("value"))
    if large.isEmpty():
        return edges
    sizes = (large.groupBy("trie").agg(F.ceil(F.count(F.lit(1)) / max_bucket).alias("_pieces"))
             .withColumnRenamed("trie", "_trie"))
    own = F.pmod(F.xxhash64("value"), F.col("_pieces"))
    pieces = (large.join(sizes, F.col("trie") == F.col("_trie"))
              .select("trie", "value", own.alias("_own"),
                      F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1))
                      .alias("_other"))
              .select("trie", "value", F.concat_ws(
                  ":", "trie", F.least("_own", "_other"), F.greatest("_own", "_other"))
                  .alias("pair")))
    more = (pieces.repartition(parts, "pair").sortWithinPartitions("pair")
            .mapInArrow(_join_pieces, EDGE).select("u", "v"))
    return edges.unionByName(more)


# --------------------------------------------------------------------------- components

def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` plus ``m``, the smallest v of each u. The minima are written
    first, so the join shuffles both sides itself and adaptive execution may
    split a u that very many edges share."""
    least = written(in_few_files(
        edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))), "star")
    return edges.join(least.hint("merge"), F.col("u") == F.col("_u")).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that is not the smallest of its component, and the smallest."""
    edges = written(in_few_files(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()), "edges")
    summary = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))) \
            .first()
        if tuple(state) == summary or state[0] == 0:
            return edges
        summary = tuple(state)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = written(in_few_files(large), "large-star")
        least = _with_least(large)
        small = (least.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(large.groupBy("u").agg(F.min("v").alias("v"))))
        edges = written(in_few_files(small.distinct()), "small-star")


def _members(docs: DataFrame, shingle: int, max_bucket: int) -> DataFrame:
    """(doc_id, fp, root, component_id) of every document; a component is named
    by its root fingerprint and by its smallest doc_id."""
    prints = written(fingerprints(docs, shingle), "simhash-prints")
    distinct = written(in_few_files(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))),
                       "simhash-distinct")
    tree = components(links(distinct, max_bucket))
    # fingerprint -> root fingerprint -> smallest doc_id under the root
    rooted = (distinct.join(tree.hint("merge"), F.col("fp") == F.col("u"), "left")
              .select("fp", "rep", F.coalesce("v", "fp").alias("root")))
    rooted = written(in_few_files(rooted), "simhash-rooted")
    smallest = written(in_few_files(rooted.groupBy(F.col("root").alias("_root"))
                                    .agg(F.min("rep").alias("component_id"))), "simhash-smallest")
    named = rooted.join(smallest.hint("merge"), F.col("root") == F.col("_root"))
    named = written(in_few_files(named.select(F.col("fp").alias("_fp"), "root", "component_id")),
                    "simhash-named")
    return (prints.join(named.hint("merge"), F.col("fp") == F.col("_fp"))
            .select("doc_id", "fp", "root", "component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    return _members(docs, shingle, max_bucket).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _with_fingerprint(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows`` of (_id, _text, _row) with the text's fingerprint as ``_own_fp``
    in the text's place."""
    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            raw, ends = data.tobytes().lower(), offsets.tolist()
            fp = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(ends, ends[1:])], U64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fp.view(np.int64)), batch.column(2)],
                names=["_id", "_own_fp", "_row"])
    return rows.select("_id", "_text", "_row").mapInArrow(run, T.StructType([
        rows.schema["_id"], T.StructField("_own_fp", T.LongType()), rows.schema["_row"]]))


def representatives(docs: DataFrame, shingle: int = SHINGLE,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest
    doc_id, or one without a doc_id where there is no other.

    A doc_id on one row only is decided by a join on doc_id. Rows that share a
    doc_id (or have none) are told apart by their fingerprints, and repeated
    rows are thinned to one.
    """
    members = written(in_few_files(_members(docs, shingle, max_bucket)), "simhash-members")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp"))
    kept = members.groupBy("root").agg(best.alias("best"))
    kept = written(in_few_files(kept.select(F.col("best.doc_id").alias("_kept_id"),
                                            F.col("best.fp").alias("_fp"))), "simhash-kept")
    ids = (members.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_rows")))
    kept = kept.join(ids.hint("merge"), F.col("_kept_id").eqNullSafe(F.col("_id")))
    kept = written(in_few_files(kept.select("_kept_id", "_fp", "_rows")), "simhash-kept-rows")
    # all columns in one, so that none has the name of a helper
    whole = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"),
                        F.struct("*").alias("_row"))
    same = F.col("_id").eqNullSafe(F.col("_kept_id"))
    once = whole.join(kept.where("_rows = 1"), same).select("_row.*")
    shared = kept.where("_rows > 1")
    if shared.isEmpty():
        return once
    rows = whole.join(shared.select("_kept_id").distinct(), same, "left_semi")
    repeated = (_with_fingerprint(rows, shingle)
                .join(shared, same & (F.col("_own_fp") == F.col("_fp")), "left_semi")
                .dropDuplicates(["_id", "_own_fp"]))
    return once.unionByName(repeated.select("_row.*"))

"""Exact deduplication by Grace hash partitioning (operator 3).

1. Every map task holds the distinct texts of its batches in an open-addressing
   table that compares complete contents, and sends one record per distinct
   text (content, number of copies, largest doc_id): a text copied to a third
   of all rows arrives as one record per batch, not as its rows.
2. The records are hash-partitioned into blocks of bounded size (Spark's shuffle
   files are the spill files). Per block an open-addressing table of at most
   ``table_bytes`` of content resolves texts. A content that finds no room is
   spilled: it goes to the written table of the level, and the next level
   partitions the spilled records anew by other hash bits. A content in the
   table meets all its copies of the block, so every level is exact, and each
   block resolves at least one text per level, so the recursion ends.
3. The documents meet their group by content digest; two different contents of
   one digest in a table stop the job instead of being merged.

Defined results: a null text counts as empty, empty texts are equal to each
other; a null doc_id counts as smaller than any other and its row stays only
where the whole group has none; repeated rows with the same doc_id and text
are copies of each other, and those with the largest doc_id are all marked
kept (``deduplicated`` returns one of them); an empty table gives an empty
result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (FILE_BYTES, flat, in_few_files, shuffle_partitions, text_bytes,
                                 written)

TABLE_BYTES = 48 << 20
BLOCK_BYTES = 16 << 20
SEND_BYTES = 4 << 20

RECORD = "part long, digest binary, content binary, keep_id long, group_size long, spilled boolean"


class OpenTable:
    """Open addressing with linear probing; a slot holds an entry number, an
    entry its hash and complete content."""

    def __init__(self, slots: int = 1024):
        self.slot = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> tuple[int, int]:
        """(entry or -1, slot where the probe ended)."""
        mask = len(self.slot) - 1
        at = h & mask
        while (entry := self.slot[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry, at
            at = (at + 1) & mask
        return -1, at

    def add(self, at: int, h: int, content: bytes) -> int:
        entry = len(self.hashes)
        self.slot[at] = entry
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.hashes) > len(self.slot):
            self.slot = [-1] * (2 * len(self.slot))
            mask = len(self.slot) - 1
            for e, x in enumerate(self.hashes):
                at = x & mask
                while self.slot[at] >= 0:
                    at = (at + 1) & mask
                self.slot[at] = e
        return entry


def _larger(a, b):
    return a if b is None or (a is not None and a > b) else b


def _pieces(contents: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``limit`` bytes (one content where it is longer)."""
    lo = room = 0
    for i, content in enumerate(contents):
        room += len(content)
        if room > limit and i > lo:
            yield lo, i
            lo, room = i, len(content)
    yield lo, len(contents)


def _records(table: OpenTable, keep: list, size: list, level: int, parts: int,
             with_content: bool) -> Iterator[pa.RecordBatch]:
    """The table's entries; contents leave ``SEND_BYTES`` at a time, so neither
    this process nor the JVM holds the table a second time."""
    digests = [hashlib.sha256(c).digest() for c in table.contents]
    if len(set(digests)) < len(digests):
        raise ValueError("two different contents have one digest")
    n = len(digests)
    for lo, hi in _pieces(table.contents, SEND_BYTES) if with_content else [(0, n)]:
        part = [xxhash.xxh64_intdigest(d, seed=level) % parts for d in digests[lo:hi]]
        yield pa.RecordBatch.from_arrays([
            pa.array(part, pa.int64()), pa.array(digests[lo:hi], pa.binary()),
            pa.array(table.contents[lo:hi] if with_content else [None] * n, pa.binary()),
            pa.array(keep[lo:hi], pa.int64()), pa.array(size[lo:hi], pa.int64()),
            pa.array([False] * (hi - lo), pa.bool_())],
            names=["part", "digest", "content", "keep_id", "group_size", "spilled"])


def _combine(table_bytes: int, parts: int):
    """Map side: the distinct contents of a task, sent on when the table is full."""
    def run(batches):
        table, keep, size = OpenTable(), [], []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = (text.as_py() or "").encode().lower()
                h = xxhash.xxh64_intdigest(content)
                entry, at = table.find(h, content)
                if entry < 0:
                    if table.bytes + len(content) > table_bytes and table.hashes:
                        yield from _records(table, keep, size, 0, parts, True)
                        table, keep, size = OpenTable(), [], []
                        at = table.find(h, content)[1]
                    table.add(at, h, content)
                    keep.append(doc_id)
                    size.append(1)
                else:
                    keep[entry] = _larger(keep[entry], doc_id)
                    size[entry] += 1
        if table.hashes:
            yield from _records(table, keep, size, 0, parts, True)
    return run


def _resolve(table_bytes: int, level: int, parts: int):
    """Reduce side: records sorted by block; resolved groups leave without
    content, contents beyond the table's room leave spilled for the next level."""
    names = ["part", "digest", "content", "keep_id", "group_size", "spilled"]

    def run(batches):
        table, keep, size, part = OpenTable(), [], [], None
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            ids, digests = columns[0].to_pylist(), columns[1].to_pylist()
            keeps, sizes = columns[3].to_pylist(), columns[4].to_pylist()
            spill = []
            for i, p in enumerate(ids):
                if p != part:
                    if table.hashes:
                        yield from _records(table, keep, size, level, parts, False)
                    table, keep, size, part = OpenTable(), [], [], p
                content = columns[2][i].as_py()
                h = xxhash.xxh64_intdigest(content)
                entry, at = table.find(h, content)
                if entry >= 0:
                    keep[entry] = _larger(keep[entry], keeps[i])
                    size[entry] += sizes[i]
                elif table.hashes and table.bytes + len(content) > table_bytes:
                    spill.append((xxhash.xxh64_intdigest(digests[i], seed=level + 1) % parts,
                                  digests[i], content, keeps[i], sizes[i], True))
                else:
                    table.add(at, h, content)
                    keep.append(keeps[i])
                    size.append(sizes[i])
            if spill:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*spill), (
                        pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(),
                        pa.bool_()))], names=names)
        if table.hashes:
            yield from _records(table, keep, size, level, parts, False)
    return run


def duplicate_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(digest, keep_id, group_size), one row per distinct normalised text."""
    spark = docs.sparkSession
    size = text_bytes(docs)
    parts = max(shuffle_partitions(spark), -(-size // block_bytes))
    records = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(_combine(table_bytes, parts), RECORD)
    done, level = [], 0
    while True:
        blocks = records.repartition(parts, "part").sortWithinPartitions("part")
        out = blocks.mapInArrow(_resolve(table_bytes, level, parts), RECORD)
        out = written(in_few_files(out, size // FILE_BYTES), f"grace-level{level}")
        done.append(out.where("NOT spilled").select("digest", "keep_id", "group_size"))
        spilled = out.where("spilled")
        if spilled.isEmpty():
            break
        records, level = spilled, level + 1
    groups = done[0]
    for more in done[1:]:
        groups = groups.unionByName(more)
    return groups


def _digests(batches):
    for batch in batches:
        data, offsets = flat(batch.column(1))
        raw, at = data.tobytes().lower(), offsets.tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([hashlib.sha256(raw[a:b]).digest()
                                        for a, b in zip(at, at[1:])], pa.binary())],
            names=["doc_id", "digest"])


def exact_duplicates(docs: DataFrame, table_bytes: int = TABLE_BYTES,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document with the row that stays: (doc_id, keep_id, group_size,
    kept, text_sha256).

    The last join is at document grain on the digest; the side of the groups
    is shuffled for the join itself, so adaptive execution may split the
    partition of a digest that a third of the rows share.
    """
    groups = duplicate_groups(docs, table_bytes, block_bytes)
    checked = groups.withColumnRenamed("digest", "_digest")
    members = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(_digests, "doc_id long, digest binary")
    return (members.join(checked.hint("merge"), F.col("digest") == F.col("_digest"))
            .select("doc_id", "keep_id", "group_size",
                    F.coalesce(F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(False))
                    .alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def deduplicated(docs: DataFrame, table_bytes: int = TABLE_BYTES,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    A doc_id on one row only is decided by a join on doc_id. Rows that share a
    doc_id are told apart by their digest and thinned to one row per text.
    """
    rows = exact_duplicates(docs, table_bytes, block_bytes)
    ids = (rows.groupBy(F.col("doc_id").alias("_kept_id"))
           .agg(F.count(F.lit(1)).alias("_rows"), F.max("kept").alias("_kept"))
           .where("_kept"))
    ids = written(in_few_files(ids), "exact-kept-ids")
    # all columns in one, so that none has the name of a helper
    whole = docs.select(F.col("doc_id").alias("_id"), F.struct("*").alias("_row"))
    joined = whole.join(ids.hint("merge"), F.col("_id").eqNullSafe(F.col("_kept_id")))
    once = joined.where("_rows = 1").select("_row.*")
    if ids.where("_rows > 1").isEmpty():
        return once
    digest = F.sha2(F.translate(F.coalesce("_row.text", F.lit("")), string.ascii_uppercase,
                                string.ascii_lowercase).cast("binary"), 256)
    kept = rows.where("kept").select(F.col("doc_id").alias("_same_id"),
                                     F.col("text_sha256").alias("_same_text")).distinct()
    repeated = (joined.where("_rows > 1").withColumn("_text", digest)
                .join(kept, F.col("_id").eqNullSafe(F.col("_same_id"))
                      & (F.col("_text") == F.col("_same_text")), "left_semi")
                .dropDuplicates(["_id", "_text"]))
    return once.unionByName(repeated.select("_row.*"))

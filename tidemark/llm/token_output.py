"""Token-id output in a binary file format (operator 8).

Ids are replaced by their rank in the corpus (0 for the most frequent id) and
written byte-aligned with separate control bytes: a control byte holds the
lengths (1 to 4 bytes) of four ranks in two bits each, the data bytes follow in
a stream of their own, low byte first. A decoder looks each control byte up in
a table of lengths and offsets and gathers all values of a block with numpy.

A folder has ``files`` (blocks in ascending doc_id order: one row per block with
its place and its binary image) and ``ranks`` (the id of each rank). A block's
image, all numbers little-endian:

    "TMV1" | documents u32 | tokens u64 | control bytes of the documents u64
    doc_ids i64 each, null flags u8 each, tokens of each document u32
    control bytes, data bytes of all ranks of the block

Three passes. Documents are tokenised where they are read: of a slice of texts
the distinct words are looked up once and their ids gathered by numpy. Only ids
are dealt to ranges of doc_ids (taken from the doc_ids alone; a doc_id that is on
more rows than a range holds gets several, by a hash of the text) and stored as
raw ids; ids are counted per task and summed (the vocabulary bounds what reaches
the driver); blocks are encoded where they lie. Each block knows the ids before
it in its range, so global starts need one total per range only.

Memory beside the executors' heaps: texts and ids meet Python in batches of 4 MB,
and the blocks' tables have row groups of a few blocks, which is what writers and
readers hold. So a file may hold many blocks, and there are few files.

Defined results: a null text counts as empty and has the end id only; a null
doc_id comes first; rows of one doc_id follow each other, in the order of a hash
of their text; of equally frequent ids the smaller has the lower rank; an empty table gives empty files; only doc_id and text are read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_symbols
from tidemark.llm.common import (U64, Words, flat, in_few_files, ranges, scratch_path,
                                 shuffle_partitions, shuffles_removed, slices, small_batches,
                                 text_bytes, word_hashes)

END_ID = 1
BLOCK_TOKENS = 1 << 19
FILE_TOKENS = 32 * BLOCK_TOKENS
PART_CHARS = 32 << 20
CACHE_WORDS = 2_000_000  # words that a Python worker keeps, in about 40 bytes each
CACHE_PARTS = 400_000    # and parts of words, in about 150
NO_ID = -(1 << 63)  # stands for a missing doc_id, which comes first
MAGIC = b"TMV1"
HEAD = struct.Struct("<4sIQQ")

RAW = "part long, block long, before long, n_tokens long, doc_ids array<long>, " \
      "sizes array<int>, ids binary"
FILE = "part long, block long, before long, n_tokens long, image binary"
# a writer looks at the sizes of its row group and page after each block, not after 100
ROW_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.block.size.row.check.min": "1",
              "parquet.page.size.row.check.min": "1"}


# --------------------------------------------------------------------------- ids by the library

class LibraryWords:
    """Ids from the tokenizers library, by word where the file drops white
    space between words. Each distinct word is encoded when it is first met, and
    its ids are kept in one array, found by 128 bits of hashes. Ids of words are
    bytes from the start, two an id where the file's ids fit, else four.

    The common shape, letters (ASCII or Latin-1) and marks after them, is cut by
    the file's pattern between the two and nowhere else, so both go straight to
    the library's model; any other word takes the library's whole way. That
    holds for one normalizer and pattern, which are verified; the words of other
    files that drop white space take the whole way too, and files that do not
    have their whole texts encoded."""

    # --- fixed values: the steps for which the common shape is cut as said
    steps = ["NFC", "Replace", "Lowercase"]
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
    # ---
    shape = re.compile(rb"^((?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+)([.,!#$%&*]*)$|^(.+)$", re.M)

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_word = (split.get("behavior"), split.get("invert")) == ("Removed", True)
        steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_shape = self.by_word and steps == self.steps \
            and split.get("pattern", {}).get("Regex") == self.pattern
        self.symbols = {b: x for b, x in enumerate(byte_symbols()) if b != 10}
        self.most = max(self.library.get_vocab(with_added_tokens=True).values(), default=0)
        self.code = "H" if self.most < 1 << 16 else "I"
        self.parts: dict[bytes, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, U64)           # hashes of known words, sorted
        self.check = np.zeros(0, U64)           # the other hash of each
        self.at = np.zeros(0, np.int64)         # where its ids begin
        self.size = np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, self.code)
        self.used = 0

    def of_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word; the words go through each step together."""
        if not self.by_shape:
            return [self.packed(w) for w in words]
        cut = self.shape.findall(b"\n".join(words).lower())  # no word has a line feed
        parts = self.parts
        new = list({p for m in cut for p in m[:2] if p and p not in parts})
        if new:
            text = b"\n".join(new).decode("latin-1").translate(self.symbols)
            for part, tokens in zip(new, map(self.model.tokenize, text.split("\n"))):
                parts[part] = array(self.code, [t.id for t in tokens]).tobytes()
        return [self.packed(w) if other else parts[a] + parts[b] if b else parts[a]
                for (a, b, other), w in zip(cut, words)]

    def whole(self, text: bytes) -> list[int]:
        return self.library.encode(text.decode(), add_special_tokens=False).ids

    def packed(self, word: bytes) -> bytes:
        return array(self.code, self.whole(word)).tobytes()

    def _learn(self, codes: np.ndarray, checks: np.ndarray, words: list[bytes]) -> None:
        """Add words by their hashes, which are sorted and not known."""
        ids = self.of_words(words)
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // self.pool.itemsize
        more = int(size.sum())
        if self.used + more > len(self.pool):
            pool = np.empty(len(self.pool) + max(len(self.pool) // 2, more), self.code)
            pool[: self.used] = self.pool[: self.used]
            self.pool = pool
        self.pool[self.used: self.used + more] = np.frombuffer(b"".join(ids), self.code)
        place = np.searchsorted(self.known, codes)
        self.known = np.insert(self.known, place, codes)
        self.check = np.insert(self.check, place, checks)
        self.at = np.insert(self.at, place, self.used + np.cumsum(size, dtype=np.int64) - size)
        self.size = np.insert(self.size, place, size)
        self.used += more

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a slice, and how many each has."""
        if not self.by_word:
            raw, at = data.tobytes(), offsets.tolist()
            ids = [self.whole(raw[a:b]) for a, b in zip(at, at[1:])]
            return (np.array([i for x in ids for i in x], np.uint32),
                    np.array([len(x) for x in ids], np.int64))
        if len(self.known) > CACHE_WORDS:
            self.clear()
        if len(self.parts) > CACHE_PARTS:
            self.parts.clear()
        words = Words(data, offsets)
        high, low = word_hashes(words)
        codes, first, which = np.unique(high, return_index=True, return_inverse=True)
        slot = np.searchsorted(self.known, codes)
        new = np.ones(len(codes), bool)
        inside = slot < len(self.known)
        new[inside] = self.known[slot[inside]] != codes[inside]
        if new.any():
            raw, at = data.tobytes(), first[new]
            self._learn(codes[new], low[at], [raw[a:b] for a, b in zip(
                words.start[at].tolist(), words.end[at].tolist())])
            slot = np.searchsorted(self.known, codes)
        slot = slot[which]
        if not np.array_equal(self.check[slot], low):
            raise RuntimeError("two words agree in 64 bits of hash")  # never seen; not passed over
        size = self.size[slot].astype(np.int64)
        ids = self.pool[ranges(self.at[slot], size)]
        total = np.concatenate([[0], np.cumsum(size)])[words.first]
        return ids, np.diff(total)


def id_type(path: str, end_id: int) -> str:
    """Raw ids are kept in two bytes where the file's ids fit, else in four."""
    return "<u2" if max(library_words(path).most, end_id) < 1 << 16 else "<u4"


@functools.lru_cache(maxsize=2)
def library_words(path: str) -> LibraryWords:
    return LibraryWords(path)


# --------------------------------------------------------------------------- variable-length coding

CODES = np.arange(256)
LENGTHS = np.stack([(CODES >> 2 * k & 3) + 1 for k in range(4)], 1)  # of the four values of a code
OFFSETS = np.cumsum(LENGTHS, 1) - LENGTHS                            # of their first bytes
TOTALS = LENGTHS.sum(1)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    size = 1 + (v > 0xFF).astype(np.int8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.ones(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = size
    quad = padded.reshape(-1, 4) - 1
    control = quad[:, 0] | quad[:, 1] << 2 | quad[:, 2] << 4 | quad[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of control and data bytes, by table lookup."""
    if not n:
        return np.zeros(0, np.uint32)
    first = np.concatenate([[0], np.cumsum(TOTALS[control])[:-1]])
    at = (first[:, None] + OFFSETS[control]).ravel()[:n]
    size = LENGTHS[control].ravel()[:n]
    data = np.concatenate([data, np.zeros(4, np.uint8)])
    out = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def image(doc_ids: list[int | None], sizes: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    ids = np.array([0 if i is None else i for i in doc_ids], "<i8")
    nulls = np.array([i is None for i in doc_ids], np.uint8)
    return b"".join([HEAD.pack(MAGIC, len(doc_ids), len(ranks), len(control)), ids.tobytes(),
                     nulls.tobytes(), sizes.astype("<u4").tobytes(), control, data])


def read_image(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, tokens per document, ranks) of a block's image."""
    magic, docs, tokens, controls = HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    at = HEAD.size
    ids = np.frombuffer(raw, "<i8", docs, at)
    nulls = np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
    sizes = np.frombuffer(raw, "<u4", docs, at + 9 * docs).astype(np.int64)
    at += 13 * docs
    ranks = unpack(np.frombuffer(raw, np.uint8, controls, at),
                   np.frombuffer(raw, np.uint8, -1, at + controls), tokens)
    return [None if z else int(i) for i, z in zip(ids, nulls)], sizes, ranks


# --------------------------------------------------------------------------- passes

class Ranges:
    """Ranges of doc_ids of about equally many rows: ``top[i]`` is the largest
    doc_id of range i, which is dealt over ``width[i]`` parts."""

    def __init__(self, docs: DataFrame, parts: int):
        ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"))
        counts = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        rows = counts.agg(F.sum("n")).first()[0] or 0
        fair = max(1, rows // parts)
        # at most ``parts`` doc_ids have more rows than that, and as many ranges are made
        hot = {r["id"]: r["n"] for r in counts.where(F.col("n") > fair).collect()}
        tops = (counts.repartitionByRange(parts, "id").groupBy(F.spark_partition_id())
                .agg(F.max("id").alias("top")).collect())
        top = {r["top"] for r in tops} | {i for h in hot for i in (h - 1, h) if i >= NO_ID}
        self.top = np.array(sorted(top), np.int64)
        self.width = np.array([-(-hot.get(t, 1) // fair) if t in hot else 1
                               for t in self.top.tolist()], np.int64)
        self.first = np.cumsum(self.width) - self.width
        self.parts = max(1, int(self.width.sum()))

    def of(self, ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The part of each row; within a range in the order of its mark (63 bits)."""
        i = np.searchsorted(self.top, ids)
        deep = (marks.astype(np.float64) / 2.0 ** 63 * self.width[i]).astype(np.int64)
        return self.first[i] + np.minimum(deep, self.width[i] - 1)


def _tokenised(path: str, end_id: int, dtype: str, shared):
    """(part, doc_id, mark, ids): each text's ids with the end id."""
    def run(batches):
        words, placed = library_words(path), shared.value
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                rows = batch.slice(lo, hi - lo)
                ids, size = words.encode(*flat(rows.column(1)))
                ends = np.cumsum(size + 1)
                out = np.full(ends[-1], end_id, dtype)
                inside = np.ones(len(out), bool)
                inside[ends - 1] = False
                out[inside] = ids
                offsets = np.concatenate([[0], out.itemsize * ends]).astype(np.int64)
                blobs = pa.Array.from_buffers(pa.large_binary(), len(rows), [
                    None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.binary())
                doc_ids = rows.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                part = placed.of(doc_ids, rows.column(2).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), rows.column(0), rows.column(2), blobs],
                    names=["part", "doc_id", "mark", "ids"])
    return run


def _raw_blocks(width: int):
    return functools.partial(_blocks_of, width)


def _blocks_of(width: int, batches):
    """Blocks of the rows of a part, which come in order."""
    docs, sizes, ids = [], [], []
    part = block = before = held = 0

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (part, block, before, held)]
            + [pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
               pa.array([b"".join(ids)], pa.binary())],
            names=["part", "block", "before", "n_tokens", "doc_ids", "sizes", "ids"])

    for batch in batches:
        for own, doc_id, blob in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            n = len(blob) // width
            if held and (own != part or held + n > BLOCK_TOKENS):
                yield out()
                block, before = (block + 1, before + held) if own == part else (0, 0)
                docs, sizes, ids, held = [], [], [], 0
            part = own
            docs.append(doc_id)
            sizes.append(n)
            ids.append(blob)
            held += n
    if docs:
        yield out()


def _counts(dtype: str):
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                n = np.bincount(np.frombuffer(blob.as_buffer(), dtype))
                if len(n) > len(total):
                    total = np.pad(total, (0, len(n) - len(total)))
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])],
                                         names=["id", "n"])
    return run


def _to_images(rank_of: np.ndarray, dtype: str):
    def run(batches):
        for batch in batches:
            head = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(6)[i].as_buffer(), dtype)
                raw = image(batch.column(4)[i].as_py(), np.array(batch.column(5)[i].as_py()),
                            rank_of[ids])
                yield pa.RecordBatch.from_arrays(
                    [c.slice(i, 1) for c in head] + [pa.array([raw], pa.binary())],
                    names=["part", "block", "before", "n_tokens", "image"])
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> str:
    """Write ``docs`` as token files under ``folder`` and return it."""
    with small_batches(docs.sparkSession):
        return _written_files(docs, folder, tokenizer, end_id)


def _written_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> str:
    spark, size = docs.sparkSession, text_bytes(docs)
    placed = Ranges(docs, max(shuffle_partitions(spark), -(-size // PART_CHARS)))
    mark = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", mark.alias("mark"))
    shared, dtype = spark.sparkContext.broadcast(placed), id_type(tokenizer, end_id)
    ordered = (rows.mapInArrow(_tokenised(tokenizer, end_id, dtype, shared),
                               "part int, doc_id long, mark long, ids binary")
               .repartitionById(placed.parts, "part")
               .sortWithinPartitions("part", F.asc_nulls_first("doc_id"), "mark"))
    raw_path = f"{folder}/raw"
    with shuffles_removed(spark):
        in_few_files(ordered, size // PART_CHARS) \
            .mapInArrow(_raw_blocks(np.dtype(dtype).itemsize), RAW) \
            .write.options(compression="zstd", **ROW_GROUPS).parquet(raw_path)
    raw = spark.read.schema(RAW).parquet(raw_path)
    counts = (raw.select("ids").mapInArrow(_counts(dtype), "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")))
    # one row per id in use: at most the tokenizer's vocabulary
    used = sorted(counts.collect(), key=lambda r: (-r["n"], r["id"]))
    by_rank = [r["id"] for r in used]
    rank_of = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    spark.createDataFrame(list(enumerate(by_rank)), "rank long, id long") \
        .coalesce(1).write.parquet(f"{folder}/ranks")
    in_few_files(raw, sum(r["n"] for r in used) // FILE_TOKENS) \
        .mapInArrow(_to_images(rank_of, dtype), FILE) \
        .write.options(compression="none", **ROW_GROUPS).parquet(f"{folder}/files")
    return folder


def _read(id_of: np.ndarray, start_of: dict[int, int], full: bool):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, sizes, ranks = read_image(batch.column(3)[i].as_py())
                ids = id_of[ranks]
                ends = np.cumsum(sizes)
                start = start_of[batch.column(0)[i].as_py()] + batch.column(2)[i].as_py() \
                    + ends - sizes
                columns = [pa.array(doc_ids, pa.int64()), pa.array(start, pa.int64()),
                           pa.array(sizes, pa.int64())]
                if full:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]), pa.int32()),
                        pa.array(ids, pa.int32())))
                else:
                    raw, at = ids.astype("<u4").tobytes(), (4 * ends).tolist()
                    columns.append(pa.array([zlib.crc32(raw[a:b]) for a, b in
                                             zip([0, *at], at)], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "n_tokens", "ids" if full else "ids_crc32"])
    return run


def read_token_files(spark: SparkSession, folder: str, full: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a folder; with ``full=False`` the
    unsigned crc32 of the ids' little-endian 32-bit bytes instead of them."""
    files = spark.read.schema(FILE).parquet(f"{folder}/files")
    ranks = spark.read.parquet(f"{folder}/ranks").collect()  # bounded by the vocabulary
    id_of = np.zeros(len(ranks), np.int32)
    for r in ranks:
        id_of[r["rank"]] = r["id"]
    # one row per partition of the files
    totals = sorted(files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    start_of, start = {}, 0
    for part, n in totals:
        start_of[part], start = start, start + n
    last = "ids array<int>" if full else "ids_crc32 long"
    blocks = files.select("part", "block", "before", "image")
    if not full:
        blocks = in_few_files(blocks, start // FILE_TOKENS)
    return blocks.mapInArrow(
        _read(id_of, start_of, full), f"doc_id long, start long, n_tokens long, {last}")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = END_ID,
                  folder: str | None = None) -> DataFrame:
    """Write ``docs`` as token files and read each document's place, length and
    crc32 back from them."""
    spark = docs.sparkSession
    folder = write_token_files(docs, folder or scratch_path(spark, "token-files"), tokenizer,
                               end_id)
    return read_token_files(spark, folder, full=False)

"""Helpers shared by the text operators: table access, shared scratch tables,
vectorised words over Arrow string columns, and hashing.

Texts are handled as flat UTF-8 bytes with document offsets, so word bounds,
word hashes and counts come from a few numpy operations per slice of about a
megabyte; a text is never cut, a longer one makes a longer slice.
"""

from __future__ import annotations

import contextlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_folder

SLICE_BYTES = 1 << 20
FILE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------- shared scratch tables

def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a written table beside the cluster's shared checkpoints,
    removed with all others of the application when the driver ends."""
    return scratch_folder(spark, f"llm/{name}")


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession):
    """Writes in here remove their shuffle files when they end, instead of
    leaving them until the driver collects its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_batches(spark: SparkSession):
    """What runs in here sends Python batches of about ``BATCH_BYTES``: the JVM
    and a worker hold several batches each beside the executor's heap."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends
    there, so a lost executor costs tasks of the current step only."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_few_files(df: DataFrame, at_least: int = 0) -> DataFrame:
    """``df`` in at most two partitions a core, for tables of a few numbers a
    row that come from an aggregate or a join of unique keys; where a partition
    holds more, ``at_least`` is the number that the input calls for. A written
    file costs a local file system about three processes (``chmod`` of the
    folder, the file and its checksum), however short the file is."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, at_least))


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Total characters of a text column (one partial-aggregated row)."""
    return df.select(F.sum(F.length(column)).alias("n")).first()["n"] or 0


def block_count(df: DataFrame, per_block: int, at_least: int) -> int:
    """Number of hash blocks so that a block holds about ``per_block``
    characters of text; it grows with the table."""
    return max(at_least, -(-text_bytes(df) // per_block))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --------------------------------------------------------------------------- flat text

def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string (or binary) array and its document offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, pa.scalar("" if pa.types.is_string(texts.type) else b"",
                                              texts.type))
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    if not len(texts) or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[
        texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row where a text is longer)."""
    _, offsets = flat(texts)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def byte_class(members: bytes | range | list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


# words of the whitespace contracts: every byte but space and \x09-\x0D
NOT_SPACE = ~byte_class([0x20, *range(0x09, 0x0E)])
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


class Words:
    """Word bounds of a slice: ``start``/``end`` byte positions, and ``first``,
    the index of each document's first word (documents + 1 entries)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE):
        inside = is_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[edge[:-1]] = False
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[edge[1:]] = False
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


# --------------------------------------------------------------------------- hashing

_BYTE_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, U64), np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to ``n``."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * SLICE_BYTES)
        steps = np.full((2, size), U64(1))
        steps[0, 1:], steps[1, 1:] = U64(_BASE), U64(_INVERSE)
        _powers = np.cumprod(steps[0]), np.cumprod(steps[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64's)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class ByteHashes:
    """64-bit hashes of any byte ranges of a slice, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        self.power, self.inverse = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE_CODES[data] * self.power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        code = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(code + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


SHORT_WORD = 64  # bytes up to which words are hashed together, eight bytes at a time


def word_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each word's bytes, mixed apart from the length on.

    Eight bytes are taken in at a time, and each step goes through a mixer that
    no byte position scales, so words that agree in one polynomial do not agree
    here. Longer words are hashed one by one by the xxhash library (128 bits).
    """
    size = words.end - words.start
    high, low = (mix(size.astype(U64) + U64(seed))
                 for seed in (0x51ED270B4D2A5A17, 0xC3A5C85C97CB3127))
    data = np.concatenate([words.data, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.as_strided(data, (len(words.data) + 1, 8), (1, 1))
    long = size > SHORT_WORD
    for at in range(0, SHORT_WORD, 8):
        on = np.flatnonzero((size > at) & ~long)
        if not len(on):
            break
        lane = lanes[words.start[on] + at].view("<u8").ravel()
        left = size[on] - at
        part = left < 8
        lane[part] &= (U64(1) << (8 * left[part]).astype(U64)) - U64(1)
        high[on] = mix(high[on] ^ lane)
        low[on] = mix((low[on] + lane) * U64(_BASE) ^ (low[on] >> U64(29)))
    raw = words.data
    for i in np.flatnonzero(long):
        code = xxhash.xxh3_128_digest(raw[words.start[i]: words.end[i]].tobytes())
        high[i], low[i] = np.frombuffer(code, "<u8")
    return high, low


def rolling(codes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of every ``n`` consecutive codes (len - n + 1 values)."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    step = int(mix(np.array([seed], U64))[0]) | 1
    total, weight = np.zeros(m, U64), 1
    for k in range(n):
        total += codes[k: k + m] * U64(weight)
        weight = weight * step % (1 << 64)
    return mix(total)


def crc32_text(ids: pa.Array) -> np.ndarray:
    """Unsigned crc32 of each id written as decimal text."""
    return np.array([zlib.crc32(str(i).encode()) for i in ids.to_pylist()], np.int64)


def crc32_mod(column: str, n: int):
    """The same on the JVM: crc32(id as text) mod n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start[i], start[i] + length[i])``."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)

"""Benchmark decontamination (operator 5): a generalised suffix automaton of the
normalised test items, through which document words are streamed.

Items are normalised (A-Z lower-cased, words of digits, letters a-z and
characters above ASCII) and put into one automaton. Streaming a document's words
keeps the state and the length of the longest match that ends at each word:

* a match of ``window`` words or more means that the last ``window`` words are a
  window of some item; the state that holds exactly these words knows all items
  with that window;
* an item shorter than a window is one window: its state is marked, and marked
  states are found along the suffix links of the current state.

Before the automaton, numpy keeps only runs of words whose neighbours are
neighbours in some item (hashes; no run with a window can be lost), so the
per-word loop sees little of a clean text. The loop itself compares words.

An automaton is built from at most about ``SHARD_CHARS`` of items, so its size is
bounded. A benchmark of that size is one automaton, broadcast, and one pass over
the documents. The distinct items of a larger one are cut into shards by a hash:

1. the words and neighbours of all items are marked in one bitmap of at most
   ``FILTER_BITS`` bits, and one pass over the documents emits the runs that may
   hold a window, by the digest of their text (a fuller bitmap lets more runs
   through, never fewer);
2. a run is sent to the shards that have one of its windows, by a join on window
   hashes, and streamed through the shard's automaton, which compares words;
   a shard that very many runs meet is repeated over several tasks;
3. the spans and items per text are joined back to the documents.

So the documents are read twice and never written, whatever the number of shards.

Defined results: a null or empty text has no words and no hits; a null, empty or
wordless item has no window; items that repeat an item_id count as one item, a
null item_id counts as the empty id; without items nothing is hit; repeated
rows are judged one by one; other columns pass through ``cleaned`` unread.
"""

from __future__ import annotations

import dataclasses
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (LOWER_ASCII, U64, ByteHashes, Words, byte_class, flat, mix,
                                 rolling, shuffle_partitions, slices, text_bytes, word_hashes,
                                 written)

WINDOW = 10
SHARD_CHARS = 1 << 20
FILTER_BITS = 1 << 29   # bits that mark words and neighbours of a large benchmark
SHARD_RUNS = 100_000    # runs that one task streams through a shard's automaton
MAX_COVERAGE = 0.5  # of a document's words; above it ``cleaned`` drops the document

WORD = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])

def normalised(texts: pa.Array) -> Words:
    data, offsets = flat(texts)
    return Words(LOWER_ASCII[data], offsets, WORD)


def item_words(text: str | None) -> list[bytes]:
    words = normalised(pa.array([text or ""], pa.string()))
    raw = words.data.tobytes()
    return [raw[a:b] for a, b in zip(words.start.tolist(), words.end.tolist())]


class Automaton:
    """Generalised suffix automaton of items, with what the search needs."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.items = [(i, w) for i, w in items if w]
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in self.items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self._find_items()
        self._hash_vocabulary()

    def _new(self, length: int, link: int, edges: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.length) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """The state of the longest string that ends p + w, cut off q if q has longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:
            return self._split(last, w, self.next[last][w])
        new = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new

    def _find_items(self) -> None:
        """Items per state of ``window`` words or more; short items by the state of their end."""
        self.of_state: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, words in self.items:
            state, seen = 0, set()
            for w in words:
                state = self.next[state][w]
                up = state
                while self.length[up] >= self.window and up not in seen:
                    seen.add(up)
                    self.of_state.setdefault(up, set()).add(item)
                    up = self.link[up]
            if len(words) < self.window:
                self.short.setdefault(state, []).append((len(words), item))
        self.least = min([self.window, *(n for v in self.short.values() for n, _ in v)])
        # the nearest state with a short item at or above each state
        self.marked = [-1] * len(self.length)
        for state in sorted(range(len(self.length)), key=self.length.__getitem__):
            up = self.link[state]
            self.marked[state] = state if state in self.short else \
                (self.marked[up] if up >= 0 else -1)

    def _hash_vocabulary(self) -> None:
        vocabulary = sorted({w for _, words in self.items for w in words})
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        ends = np.cumsum([0, *map(len, vocabulary)])
        codes = ByteHashes(data).of(ends[:-1], ends[1:])
        self.codes = np.unique(codes)
        number = {w: int(np.searchsorted(self.codes, c)) for w, c in zip(vocabulary, codes)}
        self.pairs = np.unique(np.array(
            [number[a] * len(self.codes) + number[b]
             for _, words in self.items for a, b in zip(words, words[1:])], np.int64))

    def runs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First and last+1 word of runs in which every pair of neighbours is
        one of some item, of a document each and as long as a window at least."""
        if not len(self.codes) or not len(words.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = ByteHashes(words.data).of(words.start, words.end)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[at] == code
        joined = known[:-1] & known[1:]
        first = words.first[1:-1]
        first = first[(first > 0) & (first < len(code))]
        joined[first - 1] = False
        where = np.flatnonzero(joined)
        pair = at[where] * len(self.codes) + at[where + 1]
        if len(self.pairs):
            p = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[where] = self.pairs[p] == pair
        else:
            joined[where] = False
        starts = np.flatnonzero(known & ~np.concatenate([[False], joined]))
        ends = np.flatnonzero(known & ~np.concatenate([joined, [False]])) + 1
        enough = ends - starts >= self.least
        return starts[enough], ends[enough]

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans (first, last + 1) of windows in ``words``, and the items they are of."""
        spans, items = [], set()
        state = length = 0
        for t, w in enumerate(words, 1):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w not in self.next[state]:
                state = length = 0
                continue
            state = self.next[state][w]
            length += 1
            if length >= self.window:
                exact = state
                while self.length[self.link[exact]] >= self.window:
                    exact = self.link[exact]
                spans.append((t - self.window, t))
                items |= self.of_state[exact]
            up = self.marked[state]
            while up >= 0:
                for n, item in self.short[up]:
                    if n <= length:
                        spans.append((t - n, t))
                        items.add(item)
                up = self.marked[self.link[up]] if self.link[up] >= 0 else -1
        return spans, items

    def search(self, words: Words) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """Per document with hits: united spans of its words, and items."""
        out: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        starts, ends = self.runs(words)
        docs = np.searchsorted(words.first, starts, side="right") - 1
        for lo, hi, doc in zip(starts.tolist(), ends.tolist(), docs.tolist()):
            run = [words.data[a:b].tobytes()
                   for a, b in zip(words.start[lo:hi].tolist(), words.end[lo:hi].tolist())]
            spans, items = self.stream(run)
            if spans:
                base = lo - int(words.first[doc])
                had, of = out.setdefault(doc, ([], set()))
                had += [(a + base, b + base) for a, b in spans]
                of |= items
        return {doc: (united(spans), items) for doc, (spans, items) in out.items()}


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


# --------------------------------------------------------------------------- Spark

def _items(benchmark: DataFrame, shard_chars: int) -> tuple[DataFrame, int]:
    """(item, text, shard) of the distinct items, and the number of shards."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.coalesce("text", F.lit("")).alias("text")).distinct()
    shards = max(1, -(-text_bytes(rows) // shard_chars))
    shard = F.pmod(F.xxhash64("item", "text"), F.lit(shards)).cast("int")
    return rows.withColumn("shard", shard), shards


def automaton_of(rows: list, window: int = WINDOW) -> Automaton:
    items = sorted((r["item"], r["text"]) for r in rows)
    return Automaton([(i, item_words(text)) for i, text in items], window)


# ---- filter and routes of a large benchmark

def _marks(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and of all words with their next (of the same text or not)."""
    code, _ = word_hashes(words)
    return mix(code), rolling(code, 2, 5)


def _window_hashes(code: np.ndarray, size: int) -> np.ndarray:
    return rolling(code, size, 100 + size).view(np.int64)


def _filter_bits(bits: int):
    """Bit numbers, from 1 on, of the words and neighbours of items."""
    def run(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                words = normalised(batch.column(1).slice(lo, hi - lo))
                one, two = _marks(words)
                inside = np.ones(max(len(one) - 1, 0), bool)
                edge = words.first[1:-1]
                inside[edge[(edge > 0) & (edge < len(one))] - 1] = False
                at = np.unique(np.concatenate([one, two[inside]]) % U64(bits)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at + 1)], names=["bit"])
    return run


def _item_windows(window: int):
    """(shard, size, hash) of every window of every item."""
    def run(batches):
        for batch in batches:
            for text, shard in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = normalised(pa.array([text], pa.string()))
                size = min(window, len(words.start))
                if size:
                    h = np.unique(_window_hashes(word_hashes(words)[0], size))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(h), shard, np.int32)),
                         pa.array(np.full(len(h), size, np.int32)), pa.array(h)],
                        names=["shard", "size", "hash"])
    return run


@dataclasses.dataclass(frozen=True)
class Filter:
    """Marks of all items' words and neighbours, and the sizes of their windows."""

    marks: np.ndarray   # bits, packed
    sizes: list[int]

    def _has(self, h: np.ndarray) -> np.ndarray:
        at = h % U64(8 * len(self.marks))
        return (self.marks[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 > 0

    def runs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First and last+1 word of runs of marked neighbours, of one text each
        and as long as the smallest window."""
        one, two = _marks(words)
        known = self._has(one)
        joined = known[:-1] & known[1:]
        edge = words.first[1:-1]
        joined[edge[(edge > 0) & (edge < len(one))] - 1] = False
        at = np.flatnonzero(joined)
        joined[at] = self._has(two[at])
        starts = np.flatnonzero(known & ~np.concatenate([[False], joined])[:len(known)])
        ends = np.flatnonzero(known & ~np.concatenate([joined, [False]])[:len(known)]) + 1
        enough = ends - starts >= min(self.sizes)
        return starts[enough], ends[enough]


RUN = "key string, start int, words string, hashes array<long>"


def _candidates(shared):
    """(key, text) -> runs that may hold a window, with their windows' hashes."""
    def run(batches):
        marked = shared.value
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                words = normalised(batch.column(1).slice(lo, hi - lo))
                if not len(words.start):
                    continue
                starts, ends = marked.runs(words)
                if not len(starts):
                    continue
                code, _ = word_hashes(words)
                of = {n: _window_hashes(code, n) for n in marked.sizes}
                docs = np.searchsorted(words.first, starts, side="right") - 1
                raw = words.data.tobytes()
                a, b = words.start.tolist(), words.end.tolist()
                spans = list(zip(starts.tolist(), ends.tolist()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(docs + lo)),
                    pa.array((starts - words.first[docs]).astype(np.int32)),
                    pa.array([b" ".join([raw[a[t]:b[t]] for t in range(x, y)]).decode()
                              for x, y in spans], pa.string()),
                    pa.array([np.unique(np.concatenate([h[x: max(x, y - n + 1)]
                                                        for n, h in of.items()])).tolist()
                              for x, y in spans], pa.list_(pa.int64()))],
                    names=["key", "start", "words", "hashes"])
    return run


FOUND_IN = "key string, spans array<int>, items array<string>"


def _streamed(window: int):
    """Rows sorted by (shard, salt, kind): build a shard's automaton of its items
    (kind 0) and stream its runs (kind 1) through it."""
    def run(batches):
        current, items, automaton = None, [], None
        for batch in batches:
            found = []
            for shard, salt, kind, name, start, text in zip(
                    *(batch.column(i).to_pylist() for i in range(6))):
                if (shard, salt) != current:
                    current, items, automaton = (shard, salt), [], None
                if kind == 0:
                    items.append((name, item_words(text)))
                    continue
                if automaton is None:
                    automaton = Automaton(sorted(items), window)
                spans, names = automaton.stream(text.encode().split(b" "))
                if spans:
                    found.append((name, [x + start for s in united(spans) for x in s],
                                  sorted(names)))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (
                        pa.string(), pa.list_(pa.int32()), pa.list_(pa.string())))],
                    names=["key", "spans", "items"])
    return run


def _key(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def large_findings(texts: DataFrame, items: DataFrame, shards: int, window: int,
                   filter_bits: int = FILTER_BITS, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """(key, spans, items): per text digest with hits its spans (flat, word
    positions) and items, for a benchmark of many shards. ``texts``: (text)."""
    spark = texts.sparkSession
    items = written(items, "benchmark-items")
    windows = written(items.select("item", "text", "shard").mapInArrow(
        _item_windows(window), "shard int, size int, hash long").distinct(), "benchmark-windows")
    # at most ``window`` different sizes
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    if not sizes:
        return spark.createDataFrame([], FOUND_IN)
    bits = 1 << 15
    while bits < filter_bits and bits < 32 * text_bytes(items):
        bits *= 2
    found = (items.select("item", "text").mapInArrow(_filter_bits(bits), "bit long")
             .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map")))
    marks = np.zeros(bits // 8, np.uint8)
    for r in found.collect():  # the bitmap: at most FILTER_BITS bits
        at = (r["bucket"] - 1) * 4096
        marks[at: at + 4096] = np.frombuffer(r["map"], np.uint8)
    shared = spark.sparkContext.broadcast(Filter(marks, sizes))
    runs = written(texts.select(_key("text").alias("key"), "text").mapInArrow(
        _candidates(shared), RUN).dropDuplicates(["key", "start"]), "candidate-runs")
    routes = (runs.select("key", "start", F.explode("hashes").alias("hash"))
              .join(windows.select("hash", "shard"), "hash")
              .select("key", "start", "shard").distinct())
    routed = written(runs.select("key", "start", "words").join(routes, ["key", "start"]),
                     "routed-runs")
    # a row per shard that runs are sent to
    counts = {r["shard"]: r["count"] for r in routed.groupBy("shard").count().collect()}
    if not counts:
        return spark.createDataFrame([], FOUND_IN)
    salts = spark.createDataFrame([(k, -(-n // shard_runs)) for k, n in counts.items()],
                                  "_shard int, salts int")
    met = F.col("shard") == F.col("_shard")
    own = items.join(F.broadcast(salts), met).select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(0).alias("kind"), F.col("item").alias("name"), F.lit(0).alias("start"), "text")
    salt = F.pmod(F.xxhash64("key", "start"), F.col("salts")).cast("int")
    sent = routed.join(F.broadcast(salts), met).select(
        "shard", salt.alias("salt"), F.lit(1).alias("kind"), F.col("key").alias("name"), "start",
        F.col("words").alias("text"))
    parts = max(shuffle_partitions(spark), sum(-(-n // shard_runs) for n in counts.values()))
    streamed = (own.unionByName(sent).repartition(parts, "shard", "salt")
                .sortWithinPartitions("shard", "salt", "kind")
                .mapInArrow(_streamed(window), FOUND_IN))
    # what is gathered per text are its own runs' findings
    return written(streamed.groupBy("key").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")), "findings")


# ---- passes

def _searched(docs: DataFrame, benchmark: DataFrame, schema: T.StructType, finish,
              window: int, shard_chars: int) -> DataFrame:
    """``finish(rows, words, found)`` makes the output from each slice's findings."""
    spark = docs.sparkSession
    names, text = docs.columns, docs.columns.index("text")
    items, shards = _items(benchmark, shard_chars)
    if shards == 1:
        # at most about ``shard_chars`` characters
        shared = spark.sparkContext.broadcast(automaton_of(items.collect(), window))
        return _pass(docs, names, text, schema, finish, shared)
    found = large_findings(docs.select("text"), items, shards, window)
    found = found.select(F.col("key").alias("_found"), "spans", "items")
    rows = docs.select(_key("text").alias("_key"),
                       *[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(names)])
    joined = rows.join(found, F.col("_key") == F.col("_found"), "left").select(
        *[f"in_{i}" for i in range(len(names))], "spans", "items")
    return _pass(joined, names, text, schema, finish)


def _pass(frame: DataFrame, names: list[str], text: int, schema, finish, shared=None) -> DataFrame:
    """One pass: findings by the broadcast automaton, or from the last two columns."""
    width = len(names)

    def run(batches):
        search = shared.value.search if shared else None
        for batch in batches:
            for lo, hi in slices(batch.column(text)):
                rows = batch.slice(lo, hi - lo)
                words = normalised(rows.column(text))
                if search:
                    hits = search(words)
                    found = [hits.get(d, ([], set())) for d in range(rows.num_rows)]
                else:
                    found = [(united(list(zip(s[::2], s[1::2]))) if s else [], set(i or ()))
                             for s, i in zip(rows.column(width).to_pylist(),
                                             rows.column(width + 1).to_pylist())]
                yield finish(pa.RecordBatch.from_arrays(rows.columns[:width], names=names),
                             words, found)
    return frame.mapInArrow(run, schema)


DIGEST = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType())])


def _digest(rows: pa.RecordBatch, words: Words, found: list) -> pa.RecordBatch:
    hit = [sum(b - a for a, b in spans) for spans, _ in found]
    return pa.RecordBatch.from_arrays([
        rows.column(0), pa.array(words.counts, pa.int64()), pa.array(hit, pa.int64()),
        pa.array([len(items) for _, items in found], pa.int64()),
        pa.array([hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
                  for _, items in found]),
        pa.array([h > 0 for h in hit])], names=DIGEST.names)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Per document: words, hit words, items with occurring windows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _searched(rows, benchmark, DIGEST, _digest, window, shard_chars)


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
            max_coverage: float = MAX_COVERAGE, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``docs`` without hit spans: each span is cut out of the text, from its
    first word to its last; a document of whose words more than
    ``max_coverage`` are hit goes as a whole. ``n_chars``, where it is a
    column, follows the text."""
    text = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(rows: pa.RecordBatch, words: Words, found: list) -> pa.RecordBatch:
        if not any(spans for spans, _ in found):
            return rows
        texts, keep = rows.column(text).to_pylist(), np.ones(rows.num_rows, bool)
        sizes = rows.column(count).to_pylist() if count is not None else None
        for d, (spans, _) in enumerate(found):
            if not spans:
                continue
            n, first = int(words.counts[d]), int(words.first[d])
            if sum(b - a for a, b in spans) > max_coverage * n:
                keep[d] = False
                continue
            raw, base, at, out = texts[d].encode(), int(words.offsets[d]), 0, []
            for a, b in spans:
                out.append(raw[at: int(words.start[first + a]) - base])
                at = int(words.end[first + b - 1]) - base
            texts[d] = b"".join([*out, raw[at:]]).decode()
            if sizes is not None:
                sizes[d] = len(texts[d])
        columns = list(rows.columns)
        columns[text] = pa.array(texts, rows.schema.field(text).type)
        if sizes is not None:
            columns[count] = pa.array(sizes, rows.schema.field(count).type)
        return pa.RecordBatch.from_arrays(columns, names=rows.schema.names).filter(pa.array(keep))

    return _searched(docs, benchmark, docs.schema, cut, window, shard_chars)

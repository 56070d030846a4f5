"""Substring deduplication by difference-cover anchors (operator 2).

A window is ``WINDOW`` = 13 consecutive words. The residues {0, 1, 3} modulo 7
are a difference cover: for any two positions some shift of 0 to 6 puts both on
a covered residue. So only the ``ANCHOR`` = 13 - 6 = 7 words at covered
positions are hashed, 3 of 7 positions, and any two equal windows, wherever they
start, have an equal anchor at one and the same place inside them.

1. Anchors: hashes of all documents go to blocks by hash (packed arrays, one row
   per block and batch). A hash in two documents makes its positions survive;
   they go back, packed by shards of doc_ids, and become one row per document.
2. Extension: the windows around surviving positions, and only these, are hashed
   with 128 bits, from two separate 64-bit hashes of each word, and sent to blocks by hash; the smallest
   doc_id of each window decides. A window of a larger doc_id is removed.
3. The removed windows of each document are united over its words.

Both exchanges combine within a batch of documents first: of equal hashes only
the one of the smallest doc_id travels, the others are decided where they are
(they survive; they are removed). A passage or text that a third of all rows
share reaches a block once per batch. The number of blocks follows the size of
the table, so a block stays bounded; nothing is collected or broadcast.

Defined results: a null text has no words; texts of fewer than 13 words are kept
whole; windows of rows with the same doc_id do not remove each other, and rows of
one doc_id with different texts are judged one by one (positions carry the crc32
of their text); a row without a doc_id has no smaller one: it is kept whole and
removes nothing; kept text of no words is empty; an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (U64, Words, block_count, flat, mix, ranges, rolling,
                                 shuffle_partitions, slices, word_hashes, written)

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
BLOCK_CHARS = 4 << 20
PLACE = "<u8"  # crc32 of the text, then the word's position, 32 bits each

# block: hashes of one block (kind 0), or decided positions of a document (kind 1)
PACKED = "block long, kind int, doc_id long, ids binary, positions binary, high binary, low binary"
NAMES = ["block", "kind", "doc_id", "ids", "positions", "high", "low"]
SHARDED = "shard long, ids binary, positions binary"
DECIDED = "doc_id long, positions binary"
HELD = 1 << 20  # decided positions that a task holds
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _marks(words: Words) -> np.ndarray:
    """The crc32 of each text, in the high half of a place."""
    raw, at = words.data.tobytes(), words.offsets.tolist()
    return np.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])], U64) << U64(32)


def _starts(words: Words, length: int) -> np.ndarray:
    """Word indexes where ``length`` words of one document start."""
    n = np.maximum(words.counts - length + 1, 0)
    return ranges(words.first[:-1], n)


def _blobs(groups: np.ndarray, *arrays: np.ndarray):
    """Arrays sorted by group -> (group, bytes of its part of each array)."""
    if not len(groups):
        return
    cut = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(groups)]):
        yield (int(groups[a]), *(x[a:b].tobytes() for x in arrays))


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(),
             pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=NAMES)


def _packed(hashes: tuple[np.ndarray, ...], ids: np.ndarray, doc: np.ndarray,
            position: np.ndarray, blocks: int, keep_least: bool):
    """Combine a batch: the occurrences in the document of the smallest doc_id
    of each hash go to the hash's block; the others are decided.
    ``keep_least``: only those of a larger doc_id are decided (removed windows);
    otherwise all occurrences of a hash that two documents of the batch share
    (surviving anchors)."""
    order = np.lexsort((position, ids, *reversed(hashes)))
    hashes = tuple(h[order] for h in hashes)
    ids, doc, position = ids[order], doc[order], position[order]
    new = np.ones(len(ids), bool)
    if len(ids):
        new[1:] = np.any([h[1:] != h[:-1] for h in hashes], axis=0)
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    least = ids[first][group] if len(ids) else ids
    larger = ids > least
    if keep_least:
        decided = larger
    else:
        decided = np.bincount(group, larger, len(first)).astype(bool)[group] if len(ids) else larger
    rows = []
    d = np.flatnonzero(decided)
    d = d[np.argsort(doc[d], kind="stable")]
    owner = dict(zip(doc[d].tolist(), ids[d].tolist()))
    for at, blob in _blobs(doc[d], position[d].astype(PLACE)):
        doc_id = owner[at]
        rows.append((hash((doc_id, at)) % blocks, 1, doc_id, None, blob, None, None))
    again = np.zeros(len(ids), bool)  # repeated rows
    again[1:] = ~new[1:] & (ids[1:] == ids[:-1]) & (position[1:] == position[:-1])
    own = np.flatnonzero(~larger & ~again)
    block = (hashes[0][own] % U64(blocks)).astype(np.int64)
    by = np.argsort(block, kind="stable")
    own, block = own[by], block[by]
    sent = [h[own].astype("<u8") for h in hashes]
    for b, i, p, *h in _blobs(block, ids[own], position[own].astype(PLACE), *sent):
        rows.append((b, 0, None, i, p, h[0], h[1] if len(h) > 1 else None))
    return rows


def _anchors(blocks: int):
    covered = np.zeros(PERIOD, bool)
    covered[list(COVER)] = True

    def run(batches):
        for batch in batches:
            ids = _ids(batch.column(0))
            named = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            found = []
            for lo, hi in slices(batch.column(1)):
                words = Words(*flat(batch.column(1).slice(lo, hi - lo)))
                # an anchor lies in some window: texts of fewer words have none
                n = np.where((words.counts >= WINDOW) & named[lo:hi],
                             words.counts - ANCHOR + 1, 0)
                at = ranges(words.first[:-1], n)
                doc = np.repeat(np.arange(hi - lo), n)
                place = at - words.first[doc]
                on = covered[place % PERIOD]
                if on.any():
                    code = rolling(word_hashes(words)[0], ANCHOR, 1)
                    found.append((code[at[on]], doc[on] + lo,
                                  place[on].astype(U64) | _marks(words)[doc[on]]))
            if found:
                code, doc, place = (np.concatenate(x) for x in zip(*found))
                yield _emit(_packed((code,), ids[doc], doc, place, blocks, False))
    return run


def _blocks(decide, shards: int):
    """Rows sorted by (block, kind): decide each block's hashes, and send all
    decided positions on by shards of doc_ids."""
    def decided(held):
        ids, position = (np.concatenate([np.frombuffer(h[k], t) for h in held])
                         for k, t in ((0, np.int64), (1, PLACE)))
        hashes = tuple(np.concatenate([np.frombuffer(h[k], "<u8") for h in held])
                       for k in (2, 3) if held[0][k] is not None)
        order = np.lexsort((ids, *reversed(hashes)))
        hashes = tuple(h[order] for h in hashes)
        ids, position = ids[order], position[order]
        new = np.ones(len(ids), bool)
        new[1:] = np.any([h[1:] != h[:-1] for h in hashes], axis=0)
        group = np.cumsum(new) - 1
        chosen = decide(ids, group, np.flatnonzero(new))
        return ids[chosen], position[chosen]

    def sharded(found):
        ids, position = (np.concatenate(x) for x in zip(*found))
        shard = (mix(ids.astype(U64)) % U64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        rows = list(_blobs(shard[by], ids[by], position[by].astype(PLACE)))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()),
                                            (pa.int64(), pa.binary(), pa.binary()))],
            names=["shard", "ids", "positions"])

    def run(batches):
        held, current, found, n = [], None, [], 0
        for batch in batches:
            blocks, kinds = (batch.column(i).to_pylist() for i in range(2))
            ids = _ids(batch.column(2))
            for r, (block, kind) in enumerate(zip(blocks, kinds)):
                if kind == 1:
                    position = np.frombuffer(batch.column(4)[r].as_py(), PLACE)
                    found.append((np.full(len(position), ids[r]), position))
                    n += len(position)
                    continue
                if block != current:
                    if held:
                        found.append(decided(held))
                        n += len(found[-1][0])
                    held, current = [], block
                held.append(tuple(batch.column(k)[r].as_py() for k in (3, 4, 5, 6)))
                if n > HELD:
                    yield sharded(found)
                    found, n = [], 0
        if held:
            found.append(decided(held))
        if found:
            yield sharded(found)
    return run


def _gather(batches):
    """Rows sorted by shard -> one row per document with its decided positions."""
    def documents(held):
        ids = np.concatenate([np.frombuffer(i, np.int64) for i, _ in held])
        position = np.concatenate([np.frombuffer(p, PLACE) for _, p in held])
        order = np.lexsort((position, ids))
        rows = list(_blobs(ids[order], position[order]))
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows], pa.int64()),
             pa.array([p for _, p in rows], pa.binary())], names=["doc_id", "positions"])

    held, current = [], None
    for batch in batches:
        for r, shard in enumerate(batch.column(0).to_pylist()):
            if shard != current:
                if held:
                    yield documents(held)
                held, current = [], shard
            held.append((batch.column(1)[r].as_py(), batch.column(2)[r].as_py()))
    if held:
        yield documents(held)


def _survive(ids, group, first):
    larger = ids > ids[first][group]
    return np.bincount(group, larger, len(first)).astype(bool)[group]


def _remove(ids, group, first):
    return ids > ids[first][group]


def _positions(blob: bytes | None, mark: int) -> np.ndarray:
    """Decided positions of the text of this mark."""
    place = np.frombuffer(blob or b"", PLACE)
    own = place[place >> U64(32) == U64(mark >> 32)]
    return np.unique(own & U64(0xFFFFFFFF)).astype(np.int64)


def _windows(blocks: int):
    """Hash the windows around surviving anchors."""
    shift = np.arange(-(PERIOD - 1), 1)

    def run(batches):
        for batch in batches:
            ids, marks = _ids(batch.column(0)), batch.column(2)
            found = []
            for lo, hi in slices(batch.column(1)):
                words = Words(*flat(batch.column(1).slice(lo, hi - lo)))
                text_mark = _marks(words)
                doc, at = [], []
                for d in range(hi - lo):
                    anchors = _positions(marks[lo + d].as_py(), int(text_mark[d]))
                    if len(anchors):
                        windows = np.unique((anchors[:, None] + shift).ravel())
                        last = int(words.counts[d]) - WINDOW
                        windows = windows[(windows >= 0) & (windows <= last)]
                        at.append(windows)
                        doc.append(np.full(len(windows), d))
                if at:
                    doc, at = np.concatenate(doc), np.concatenate(at)
                    high, low = word_hashes(words)
                    place = at + words.first[doc]
                    found.append((rolling(high, WINDOW, 2)[place],
                                  rolling(low, WINDOW, 3)[place], doc + lo,
                                  at.astype(U64) | text_mark[doc]))
            if found:
                high, low, doc, at = (np.concatenate(x) for x in zip(*found))
                if len(doc):
                    yield _emit(_packed((high, low), ids[doc], doc, at, blocks, True))
    return run


def removed_words(windows: np.ndarray, n: int) -> np.ndarray:
    """Mask of the words that windows starting at ``windows`` cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, windows, 1)
    np.add.at(edge, windows + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _kept(batches):
    for batch in batches:
        data, offsets = flat(batch.column(1))
        raw, at, marks = data.tobytes(), offsets.tolist(), batch.column(2)
        n_words, n_removed, digest = [], [], []
        for d, (a, b) in enumerate(zip(at, at[1:])):
            words = raw[a:b].split()
            removed = 0
            blob = marks[d].as_py()
            windows = _positions(blob, zlib.crc32(raw[a:b]) << 32 if blob else 0)
            n_words.append(len(words))
            if len(windows):
                gone = removed_words(windows, len(words))
                removed = int(gone.sum())
                words = [words[i] for i in np.flatnonzero(~gone).tolist()]
            n_removed.append(removed)
            digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(digest)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _kept_text(batches):
    for batch in batches:
        texts = []
        for text, marks in zip(batch.column(1).to_pylist(), batch.column(2)):
            blob = marks.as_py()
            windows = _positions(blob, zlib.crc32(text.encode()) << 32 if blob and text else 0)
            if len(windows):
                words = text.encode().split()
                gone = removed_words(windows, len(words))
                text = b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()]).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                         names=["doc_id", "text"])


def _marked(rows: DataFrame, decided: DataFrame, keep_all: bool) -> DataFrame:
    """(doc_id, text, marks): each row with the decided positions of its doc_id."""
    marks = decided.select(F.col("doc_id").alias("_id"), F.col("positions").alias("marks"))
    return (rows.join(marks.hint("merge"), F.col("doc_id") == F.col("_id"),
                      "left" if keep_all else "inner").select("doc_id", "text", "marks"))


def _decide(packed: DataFrame, blocks: int, decide, name: str) -> DataFrame:
    """(doc_id, positions), one row per document with decided positions."""
    parts = min(blocks, max(shuffle_partitions(packed.sparkSession), blocks // 8))
    sharded = (packed.repartition(parts, "block").sortWithinPartitions("block", "kind")
               .mapInArrow(_blocks(decide, parts), SHARDED))
    return written(sharded.repartition(parts, "shard").sortWithinPartitions("shard")
                   .mapInArrow(_gather, DECIDED), name)


def removed_windows(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, positions): starts of windows to remove, as packed places,
    one row per document that has some."""
    rows = _rows(docs)
    blocks = block_count(docs, block_chars, 4 * shuffle_partitions(docs.sparkSession))
    anchors = _decide(rows.mapInArrow(_anchors(blocks), PACKED), blocks, _survive, "anchors")
    near = _marked(rows, anchors, keep_all=False)
    return _decide(near.mapInArrow(_windows(blocks), PACKED), blocks, _remove, "windows")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def repeated_passages(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document the words, the removed words and the digest of the kept ones."""
    return _marked(_rows(docs), removed_windows(docs, block_chars), keep_all=True) \
        .mapInArrow(_kept, RESULT)


def without_repeats(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, text): texts with removed words are their kept words joined by
    one space, other texts are unchanged."""
    return _marked(_rows(docs), removed_windows(docs, block_chars), keep_all=True) \
        .mapInArrow(_kept_text, "doc_id long, text string")

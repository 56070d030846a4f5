"""Quality classifier (operator 4): histogram gradient-boosted trees over
document statistics.

Statistics come from whole texts with a few numpy passes per slice. A bounded
sample of labelled rows (``SAMPLE_ROWS``) trains the trees on the driver: every
statistic is cut into at most 64 quantile bins, a level of a tree is grown from
histograms of gradients over (leaf, bin), and the trees are flattened into
arrays (feature, threshold, children, value) that all documents of a batch walk
together. Scoring is one pass over the documents without a shuffle; only the
flat arrays travel to the tasks.

Defined results: a null or empty text has all statistics zero and is scored like
any other; without labelled rows every score is the prior 0.5; rows of a
repeated doc_id are scored one by one, and a label repeated for a doc_id counts
once; a null doc_id's fold is that of the text "None", and it is never learned
from; other columns pass through ``accepted`` unread.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (ByteHashes, Words, byte_class, crc32_mod, crc32_text, flat, mix,
                                 slices)
from tidemark.llm.labelled import sample, with_text

SAMPLE_ROWS = 12_000
HELD_OUT_OF = 5
ACCEPT = 0.3
BINS = 64

# byte classes whose share of a text is a statistic
CLASSES = tuple(byte_class(c) for c in (
    range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A), b".,;:", b"!?", b"|<>{}[]\\/",
    b"#$%&*@^~+=_`", b"\"'()-", b"\n", b" \t\r\f\v", range(0x80, 0x100)))
N_FEATURES = len(CLASSES) + 17


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive positions."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _distinct(doc: np.ndarray, codes: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the number of distinct codes and the largest count of one."""
    order = np.lexsort((codes, doc))
    d, c = doc[order], codes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (c[1:] != c[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(d)))
    most = np.zeros(docs)
    np.maximum.at(most, d[at], runs)
    return np.bincount(d[at], minlength=docs).astype(np.float64), most


def statistics(texts: pa.Array) -> np.ndarray:
    """Document statistics (rows x N_FEATURES) of whole texts."""
    parts = [_statistics(*flat(texts.slice(lo, hi - lo))) for lo, hi in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))


def _statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    docs = len(offsets) - 1
    words = Words(data, offsets)
    hashes = ByteHashes(data)
    n_bytes, n_words = np.diff(offsets).astype(np.float64), words.counts.astype(np.float64)
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    out = [np.log1p(n_bytes), np.log1p(n_words)]
    out += [_sums(c[data], offsets) / per_byte for c in CLASSES]
    size = (words.end - words.start).astype(np.float64)
    mean = _sums(size, words.first) / per_word
    out += [mean, np.sqrt(np.maximum(_sums(size * size, words.first) / per_word - mean**2, 0))]
    code = hashes.of(words.start, words.end)
    doc = words.doc
    distinct, most = _distinct(doc, code, docs)
    out += [distinct / per_word, most / per_word]
    same = np.zeros(len(code))
    same[1:] = (code[1:] == code[:-1]) & (doc[1:] == doc[:-1])
    out.append(_sums(same, words.first) / per_word)
    pair = np.zeros(len(code), np.uint64)
    pair[1:] = mix(code[1:] + code[:-1] * np.uint64(0x9E3779B97F4A7C15))
    out.append(_distinct(doc, pair, docs)[0] / per_word)
    last, begin = data[words.end - 1], data[words.start]
    out += [_sums(c[last], words.first) / per_word
            for c in (CLASSES[3], CLASSES[4], CLASSES[6])]
    out.append(_sums(CLASSES[0][begin], words.first) / per_word)
    out.append(_sums(size == 1, words.first) / per_word)
    out.append(_sums(size <= 3, words.first) / per_word)
    out.append(_sums(size >= 14, words.first) / per_word)
    lines = Words(data, offsets, ~byte_class(b"\n"))
    n_lines = np.maximum(lines.counts, 1).astype(np.float64)
    line_code = hashes.of(lines.start, lines.end)
    different, _ = _distinct(lines.doc, line_code, docs)
    out += [different / n_lines, np.log1p(n_bytes / n_lines)]
    return np.stack(out, 1)


# --------------------------------------------------------------------------- trees

@dataclasses.dataclass(frozen=True)
class FlatTrees:
    """All trees in flat arrays: node i tests ``x[feature] <= threshold`` and
    goes to ``left`` or ``right``; a leaf goes to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                below = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
        l2: float = 1.0, least: float = 4.0) -> FlatTrees:
    """Boost trees on the logistic loss from gradient histograms."""
    n, k = x.shape
    prior = (y.sum() + 1) / (n + 2)
    base = float(np.log(prior / (1 - prior)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) if n else np.zeros(0)
            for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], 1) \
        if n else np.zeros((0, k), int)
    nodes: list[list] = []  # feature, threshold, left, right, value

    def leaf() -> int:
        nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
        return len(nodes) - 1

    roots, margin = [], np.full(n, base)
    for _ in range(trees if n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        root = leaf()
        roots.append(root)
        at = np.full(n, root)
        level = [root]
        for _ in range(depth):
            index = {node: i for i, node in enumerate(level)}
            place = np.full(len(nodes), -1)
            place[level] = range(len(level))
            slot = place[at]
            live = slot >= 0
            best = [(1e-6, 0, 0)] * len(level)
            for j in range(k):
                key = slot[live] * BINS + binned[live, j]
                gs = np.bincount(key, g[live], len(level) * BINS).reshape(-1, BINS)
                hs = np.bincount(key, h[live], len(level) * BINS).reshape(-1, BINS)
                gl, hl = np.cumsum(gs, 1), np.cumsum(hs, 1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl)**2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(hl < least / 4) | (ht - hl < least / 4)] = 0
                gain[:, len(cuts[j]):] = 0
                b = gain.argmax(1)
                for i in range(len(level)):
                    if gain[i, b[i]] > best[i][0]:
                        best[i] = (gain[i, b[i]], j, int(b[i]))
            following = []
            for node, i in index.items():
                gain, j, b = best[i]
                if gain <= 1e-6:
                    continue
                low, high = leaf(), leaf()
                nodes[node][:4] = [j, cuts[j][b], low, high]
                mine = at == node
                at[mine] = np.where(binned[mine, j] <= b, low, high)
                following += [low, high]
            if not following:
                break
            level = following
        gs, hs = np.bincount(at, g, len(nodes)), np.bincount(at, h, len(nodes))
        value = -rate * gs / (hs + l2)
        for node in np.unique(at):
            nodes[node][4] = value[node]
        margin += value[at]
    flat_nodes = np.array(nodes, float).reshape(-1, 5)
    return FlatTrees(flat_nodes[:, 0].astype(np.int64), flat_nodes[:, 1],
                     flat_nodes[:, 2].astype(np.int64), flat_nodes[:, 3].astype(np.int64),
                     flat_nodes[:, 4], np.array(roots, np.int64), depth, base)


# --------------------------------------------------------------------------- Spark

def _sample_statistics(batches):
    for batch in batches:
        rows = [x.tobytes() for x in statistics(batch.column(2)).astype("<f8")]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.binary())],
                                         names=["label", "x"])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> FlatTrees:
    """Trees from at most ``rows`` labelled documents outside the held-out fold."""
    chosen = sample(labels, "quality", rows, crc32_mod("_id", HELD_OUT_OF) != 0)
    got = with_text(docs, chosen).mapInArrow(_sample_statistics, "label int, x binary").collect()
    # order of arrival must not matter
    got = sorted((bytes(r["x"]), r["label"]) for r in got)
    x = np.frombuffer(b"".join(b for b, _ in got), "<f8").reshape(-1, N_FEATURES)
    return fit(x, np.array([y for _, y in got], float))


def _score(trees: FlatTrees):
    def run(batches):
        for batch in batches:
            score = trees.score(statistics(batch.column(1)))
            held = crc32_text(batch.column(0)) % HELD_OUT_OF == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(held), pa.array(score),
                 pa.array((score >= ACCEPT).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, trees: FlatTrees) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score(trees), "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, trees: FlatTrees) -> DataFrame:
    """``docs`` without the documents whose score is below the threshold; all
    columns pass through."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(trees.score(statistics(batch.column(at))) >= ACCEPT))
    return docs.mapInArrow(run, docs.schema)


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    return score(docs, train(docs, labels, rows))

"""Toxicity by cumulative-link ordinal regression (operator 1).

Features are sparse: hashes of lower-cased words and of their four- and five-byte
beginnings, with the logarithm of their count. A bounded sample of labelled rows
(``SAMPLE_ROWS``) trains on the driver:

* all features whose rows are surely toxic more often than not are selected (as
  many as the sample has), and get no negative weight: what is usual in clean
  texts cannot make up for what is not;
* severity grades come from the labels and the texts: 0 for a clean row, 1 to 3
  for a toxic one by the tercile of its amount of wording that is clearly tied
  to the toxic class (sum of log counts);
* one weight vector is shared by all ordered thresholds:
  P(grade > k) = sigmoid(w x - theta_k) with theta_0 < theta_1 < theta_2, fitted
  with an L2 penalty; the gaps between thresholds are exponentials, so their
  order cannot break.

The expected severity is the sum of P(grade > k). Scoring is one pass over whole
texts without a shuffle; only the selected features and weights travel.

Defined results: a null or empty text has no features and the severity of the
thresholds alone; without labelled rows of both classes nothing is toxic
(severity 0); rows of a repeated doc_id are scored one by one; a null doc_id's
fold is that of the text "None", and it is never learned from; other columns are
not read.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (LOWER_ASCII, U64, ByteHashes, Words, byte_class, crc32_mod,
                                 crc32_text, flat, mix, slices)
from tidemark.llm.labelled import sample, with_text

SAMPLE_ROWS = 8_000
GRADES = 4
HELD_OUT_OF = 5
TOXIC = 0.5           # P(grade > 0) from which a document counts as toxic
L2 = 0.02
STEPS = 250
BEGINNINGS = (4, 5)   # bytes
SURE = 2.0            # standard errors of the bound on a feature's share of toxic rows
TIED = 0.9            # share of toxic rows among a feature's rows that ties it to the class

WORD = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every word and beginning."""
    data = LOWER_ASCII[data]
    words = Words(data, offsets, WORD)
    of, doc = ByteHashes(data).of, words.doc
    docs, codes = [doc], [of(words.start, words.end)]
    for n in BEGINNINGS:
        long = words.end - words.start > n
        start = words.start[long]
        docs.append(doc[long])
        codes.append(mix(of(start, start + n) + U64(n)))
    return np.concatenate(docs), np.concatenate(codes)


def counted(doc: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, code) pairs and their counts."""
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(new)
    return doc[at], code[at], np.diff(np.append(at, len(doc)))


@dataclasses.dataclass(frozen=True)
class Ordinal:
    codes: np.ndarray       # sorted feature hashes
    weights: np.ndarray
    thresholds: np.ndarray  # increasing

    def above(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) per text and threshold."""
        if not len(self.thresholds):
            return np.zeros((len(texts), GRADES - 1))
        seen = np.zeros(1 << 20, bool)
        seen[(self.codes >> U64(44)).astype(np.int64)] = True
        margins = []
        for lo, hi in slices(texts):
            doc, code = features(*flat(texts.slice(lo, hi - lo)))
            maybe = seen[(code >> U64(44)).astype(np.int64)]
            doc, code = doc[maybe], code[maybe]
            margin = np.zeros(hi - lo)
            if len(code) and len(self.codes):
                at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                hit = self.codes[at] == code
                d, f, n = counted(doc[hit], at[hit])
                margin = np.bincount(d, np.log1p(n) * self.weights[f], hi - lo)
            margins.append(margin)
        z = np.concatenate(margins) if margins else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds[None, :], -40, 40)))


def _selected(row: np.ndarray, code: np.ndarray, toxic: np.ndarray):
    """Codes whose rows are surely toxic more often than not (the lower bound
    of Wilson's interval), and those clearly tied to the toxic class."""
    codes, index, rows = np.unique(code, return_inverse=True, return_counts=True)
    share = np.bincount(index, toxic[row], len(codes)) / rows
    wide = SURE * SURE / rows
    sure = (share + wide / 2 - SURE * np.sqrt(share * (1 - share) / rows + wide / rows / 4)) \
        / (1 + wide)
    best = np.flatnonzero(sure >= 0.5)
    return codes[best], codes[best[share[best] >= TIED]]


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Ordinal:
    """``rows``: (toxic, distinct codes, counts)."""
    toxic = np.array([r[0] for r in rows], float)
    nothing = Ordinal(np.zeros(0, U64), np.zeros(0), np.zeros(0))
    if not rows or toxic.min() == toxic.max():
        return nothing
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    code = np.concatenate([r[1] for r in rows])
    count = np.concatenate([r[2] for r in rows])
    codes, tied = _selected(row, code, toxic)
    if not len(codes):
        return nothing
    # severity: terciles of how much tied wording a toxic row has
    amount = np.bincount(row, np.log1p(count) * np.isin(code, tied), len(rows))
    cuts = np.quantile(amount[toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, amount, side="left"), 0)
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    mine = codes[at] == code
    r, f, v = row[mine], at[mine], np.log1p(count[mine])
    weights, theta = _descend(r, f, v, grade, len(rows), len(codes))
    return Ordinal(codes, weights, theta)


def _thresholds(cut: np.ndarray) -> np.ndarray:
    """Thresholds from the first one and the logarithms of the gaps."""
    return cut[0] + np.concatenate([[0], np.cumsum(np.exp(cut[1:]))])


def _slopes(r, f, v, grade, n, k, w, cut) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the mean penalised log-likelihood by the weights and by ``cut``."""
    m = GRADES - 1
    gaps, theta = np.exp(cut[1:]), _thresholds(cut)
    z = np.bincount(r, v * w[f], n)
    above = 1 / (1 + np.exp(-np.clip(z[:, None] - theta[None, :], -30, 30)))
    # P(grade) = P(> grade - 1) - P(> grade); its log-likelihood's slopes
    edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], 1)
    p = np.maximum(edges[np.arange(n), grade] - edges[np.arange(n), grade + 1], 1e-9)
    slope = above * (1 - above) / p[:, None]
    sign = np.zeros((n, m))
    lower, upper = grade > 0, grade < m
    sign[lower, grade[lower] - 1] = 1
    sign[upper, grade[upper]] -= 1
    d = slope * sign / n                       # dL / d(z - theta_k)
    gw = np.bincount(f, v * d.sum(1)[r], k) - L2 * w / n
    gt = -d.sum(0)
    return gw, np.concatenate([[gt.sum()], gaps * np.cumsum(gt[::-1])[::-1][1:]])


def _descend(r, f, v, grade, n, k) -> tuple[np.ndarray, np.ndarray]:
    """Adam on the cumulative-link likelihood; parameters are the weights, the
    first threshold and the logarithms of the gaps."""
    m = GRADES - 1
    w, cut = np.zeros(k), np.concatenate([[2.0], np.zeros(m - 1)])
    moments = [np.zeros(k), np.zeros(k), np.zeros(m), np.zeros(m)]
    for step in range(1, STEPS + 1):
        gw, gc = _slopes(r, f, v, grade, n, k, w, cut)
        for param, grad, i, rate in ((w, gw, 0, 0.1), (cut, gc, 2, 0.05)):
            moments[i] = 0.9 * moments[i] + 0.1 * grad
            moments[i + 1] = 0.99 * moments[i + 1] + 0.01 * grad * grad
            param += rate * moments[i] / (1 - 0.9**step) / (
                np.sqrt(moments[i + 1] / (1 - 0.99**step)) + 1e-8)
        np.maximum(w, 0, out=w)
    return w, _thresholds(cut)


# --------------------------------------------------------------------------- Spark

def _sample_features(batches):
    for batch in batches:
        for lo, hi in slices(batch.column(2)):
            rows = batch.slice(lo, hi - lo)
            doc, code = features(*flat(rows.column(2)))
            doc, code, count = counted(doc, code)
            at = np.searchsorted(doc, np.arange(hi - lo + 1)).tolist()
            code, count = code.astype("<u8"), count.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1),
                 pa.array([code[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                 pa.array([count[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())],
                names=["id", "label", "codes", "counts"])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Ordinal:
    """A model from at most ``rows`` labelled documents outside the held-out fold."""
    chosen = sample(labels, "toxic", rows, crc32_mod("_id", HELD_OUT_OF) != 0)
    got = with_text(docs, chosen).mapInArrow(
        _sample_features, "id long, label int, codes binary, counts binary").collect()
    got = sorted((r["id"], r["label"], bytes(r["codes"]), bytes(r["counts"]))
                 for r in got)
    return fit([(label, np.frombuffer(codes, "<u8"), np.frombuffer(counts, "<u4"))
                for _, label, codes, counts in got])


SCHEMA = "doc_id long, held_out boolean, severity double, grade int, score double, " \
         "predicted int, toxic boolean"


def _score(model):
    def run(batches):
        for batch in batches:
            above = model.value.above(batch.column(1))
            held = crc32_text(batch.column(0)) % HELD_OUT_OF == 0
            toxic = above[:, 0] >= TOXIC
            # the most likely grade among 0 and, for a toxic text, 1 and up
            edges = np.concatenate([np.ones((len(above), 1)), above,
                                    np.zeros((len(above), 1))], 1)
            grade = np.where(toxic, 1 + (edges[:, 1:-1] - edges[:, 2:]).argmax(1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(held), pa.array(above.sum(1)),
                 pa.array(grade.astype(np.int32)), pa.array(above[:, 0]),
                 pa.array(toxic.astype(np.int32)), pa.array(toxic)],
                names=["doc_id", "held_out", "severity", "grade", "score", "predicted", "toxic"])
    return run


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """Expected severity, grade and toxicity of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(_score(shared), SCHEMA)


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    return score(docs, train(docs, labels, rows))

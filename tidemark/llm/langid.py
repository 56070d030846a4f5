"""Language identification (operator 7): interpolated Kneser-Ney character models.

Per language a model of order ``ORDER`` is estimated from the whole texts of all
labelled documents outside the held-out fold. Counts of the highest order are
summed by Spark, and the model keeps every n-gram. Lower orders count distinct left neighbours (Kneser-Ney), each order has its own
discount, and the interpolated log-probabilities and backoff weights of all
languages are stored beside sorted arrays of n-gram hashes. A text position is
found by binary search; where no language knows the n-gram, its context's
backoff weight is added and the next lower order is searched.

The language of the lowest cross-entropy per character wins. On a sixth of these
documents, kept out of the counts, the sharpness of the score is fitted, and each
language's rejection limit is a high quantile of the cross-entropy of its own
texts: a text above it is still assigned, but flagged not ``accepted``.

Texts are lower-cased; everything but letters counts as one space. Scoring is
one pass over whole texts without a shuffle while the model's n-grams times its
languages are at most ``DENSE_CELLS``, so that the broadcast is bounded; a larger
model stays in tables and scores by joins (``langid_tables``), with equal results.

Defined results: a null text, and one without a letter, is ``und`` with score 0;
equal cross-entropies take the language that sorts first; without any labelled
document every text is ``und``; a language of fewer than ``CALIBRATE_OF`` rows,
or of one doc_id, may have no calibration row, and then rejects nothing; repeated
rows are counted and scored one by one and other columns are not read; a null
doc_id's fold is that of the text "None", and it is never learned from.
"""

from __future__ import annotations

import dataclasses
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import U64, crc32_mod, crc32_text, mix, slices, written
from tidemark.llm.langid_tables import (TableModel, cut_windows, entropies, estimate_tables, losses,
                                        predictions)

ORDER = 4
DENSE_CELLS = 4_000_000   # n-grams x languages up to which the model is broadcast
TASK_GRAMS = 1 << 20      # and that a task holds while it counts
CALIBRATE_OF = 6          # one learnable document in so many is kept out of the counts
REJECT_QUANTILE = 0.995
REJECT_MARGIN = 0.25      # nats per character beyond the quantile
HELD_OUT_OF, HELD_OUT = 4, 2
UNKNOWN = "und"


# --------------------------------------------------------------------------- characters

@functools.lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, with a run of everything else as one space;
    each text has ORDER - 1 spaces before it and one after it. Returns the codes
    and each text's index of its first character after these spaces (plus the
    end): text k is scored from ``first[k]`` up to ``first[k + 1] - ORDER + 1``."""
    low = [(t or "").lower() for t in texts]
    pad = " " * (ORDER - 1)
    codes = np.frombuffer((pad + f"\x00{pad}".join(low) + f"\x00{pad}").encode(
        "utf-32-le", "surrogatepass"), "<u4")
    letter = _is_letter()[codes]
    length = np.fromiter(map(len, low), np.int64, len(low)) + ORDER
    begin = ORDER - 1 + np.concatenate([[0], np.cumsum(length)])
    # an other character stays, as a space, right after a letter, and in the padding
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    for k in range(1, ORDER):
        keep[begin - k] = True
    # a text that ends with a letter keeps its end mark as the space after it
    out = np.where(letter, codes, 32)[keep].astype(np.uint32)
    first = np.concatenate([[0], np.cumsum(keep)])[begin]
    return out, first


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` characters ending at each position from n - 1 on."""
    total = np.zeros(len(codes) - n + 1, U64)
    for k in range(n):
        total = total * U64(0x100000001B3) + codes[k: len(codes) - n + 1 + k].astype(U64) + U64(1)
    return mix(total + U64(n << 56))


# --------------------------------------------------------------------------- the model

@dataclasses.dataclass
class Tables:
    """Sorted hashes of one order's n-grams and contexts with, per language,
    log-probabilities and log backoff weights."""

    grams: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


@dataclasses.dataclass
class Model:
    languages: list[str]
    orders: list[Tables]          # from 1 on
    floor: float                  # log-probability of a character never seen
    sharpness: float = 20.0
    limit: np.ndarray | None = None

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts x languages), and characters."""
        codes, first = characters(texts)
        n = len(codes)
        stop = first[1:] - (ORDER - 1)
        size = np.maximum(stop - first[:-1], 0)
        langs = len(self.languages)
        total = np.zeros((n, langs), np.float32)
        scored = np.zeros(n + 1, np.int64)
        np.add.at(scored, first[:-1], 1)
        np.add.at(scored, np.maximum(stop, first[:-1]), -1)
        left = np.flatnonzero(np.cumsum(scored[:-1]) > 0)
        for k in range(ORDER, 0, -1):
            table = self.orders[k - 1]
            h = hashes(codes, k)[left - (k - 1)]
            at = np.minimum(np.searchsorted(table.grams, h), len(table.grams) - 1)
            hit = table.grams[at] == h
            total[left[hit]] += table.logp[at[hit]]
            left = left[~hit]
            if not len(left):
                break
            if k > 1:
                h = hashes(codes, k - 1)[left - 1 - (k - 2)]
                at = np.minimum(np.searchsorted(table.contexts, h), len(table.contexts) - 1)
                hit = table.contexts[at] == h
                total[left[hit]] += table.backoff[at[hit]]
            else:
                total[left] += self.floor
        sums = np.concatenate([np.zeros((1, langs)), np.cumsum(total, 0, dtype=np.float64)])
        ends = np.maximum(stop, first[:-1])
        return -(sums[ends] - sums[first[:-1]]) / np.maximum(size, 1)[:, None], size

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and acceptance of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        entropy, size = self.entropies(texts)
        known = size > 0
        best = entropy.argmin(1)
        lowest = entropy[np.arange(len(best)), best]
        score = 1 / np.exp(-self.sharpness * (entropy - lowest[:, None])).sum(1)
        accepted = known & (lowest <= self.limit[best])
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)]
        return names, np.where(known, score, 0.0), accepted


def _groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and each row's number among them."""
    if not rows.shape[1]:
        return rows[:1], np.zeros(len(rows), np.int64)
    distinct, inverse = np.unique(rows, axis=0, return_inverse=True)
    return distinct, inverse.ravel()


def estimate(languages: list[str], lang: np.ndarray, grams: np.ndarray, count: np.ndarray) -> Model:
    """Kneser-Ney tables from n-grams of the highest order (rows of code points)
    with their language and count."""
    langs = len(languages)
    alphabet = max(2, len(np.unique(grams)))
    floor = float(-np.log(alphabet + 1))
    # per order: (language, n-gram) rows with raw or continuation counts
    levels = [None] * (ORDER + 1)
    rows, weight = np.column_stack([lang, grams]).astype(np.int64), count.astype(float)
    for k in range(ORDER, 0, -1):
        levels[k] = rows, weight
        if k > 1:
            rows, inverse = _groups(np.delete(rows, 1, axis=1))
            weight = np.bincount(inverse).astype(float)
    orders: list[Tables] = []
    lower = None  # (n-grams of the order below, probability per language)
    for k in range(1, ORDER + 1):
        rows, weight = levels[k]
        ctx, member = _groups(rows[:, :-1])
        total, kinds = np.bincount(member, weight), np.bincount(member)
        ones, twos = (weight == 1).sum(), (weight == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        weight_of = discount * kinds / total
        own, index = _groups(rows[:, 1:])
        context, at = _groups(own[:, :-1])
        backoff = np.ones((len(context), langs))
        for m in range(langs):
            mine = ctx[:, 0] == m
            where = _find(context, ctx[mine, 1:])
            backoff[where, m] = weight_of[mine]
        if lower is None:
            below = np.full((len(own), langs), 1 / (alphabet + 1))
        else:
            # the suffix of every n-gram is an n-gram of the order below
            below = lower[1][_find(lower[0], own[:, 1:])]
        prob = backoff[at] * below
        prob[index, rows[:, 0]] += np.maximum(weight - discount, 0) / total[member]
        lower = own, prob
        g, c = _codes(own), _codes(context) if k > 1 else np.zeros(1, U64)
        by, cy = np.argsort(g), np.argsort(c)
        orders.append(Tables(g[by], np.log(prob[by]).astype(np.float32), c[cy],
                             np.log(backoff[cy]).astype(np.float32)))
    # a character unknown to every language has the same share of each
    return Model(languages, orders, floor, limit=np.full(langs, np.inf))


def _find(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Index of each row in a sorted table of distinct rows that has it."""
    if not table.shape[1]:
        return np.zeros(len(rows), np.int64)
    key, want = _codes(table), _codes(rows)
    order = np.argsort(key)
    return order[np.searchsorted(key[order], want)]


def _codes(rows: np.ndarray) -> np.ndarray:
    n = rows.shape[1]
    return hashes(np.ascontiguousarray(rows).ravel(), n)[::n] if n and len(rows) \
        else np.zeros(len(rows), U64)


# --------------------------------------------------------------------------- Spark

def learnable(docs: DataFrame) -> DataFrame:
    """(text, _lang, _calibrate): every labelled row with a letter outside the
    held-out fold. Rows of one doc_id are on the same side. Of each language the
    id of the smallest hash is counted and, from CALIBRATE_OF rows on with two
    ids, that of the largest is a calibration row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"),
                       F.col("lang").cast("string").alias("_lang"), "text")
    rows = rows.where((crc32_mod("_id", HELD_OUT_OF) != HELD_OUT) & F.col("_lang").isNotNull()
                      & F.col("_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("text", "_lang", F.xxhash64("_id").alias("_h"))
    ends = rows.groupBy("_lang").agg(F.min("_h").alias("_least"), F.max("_h").alias("_most"),
                                     F.count(F.lit(1)).alias("_rows"))
    drawn = F.pmod("_h", F.lit(CALIBRATE_OF)) == 0
    last = (F.col("_h") == F.col("_most")) & (F.col("_rows") >= CALIBRATE_OF)
    return (rows.join(F.broadcast(ends), "_lang")  # one row per language
            .select("text", "_lang", ((F.col("_h") != F.col("_least")) & (drawn | last))
                    .alias("_calibrate")))


def _merged(parts: list) -> list:
    """One part (hashes, n-grams, counts) of several."""
    h, at, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_index=True,
                               return_inverse=True)
    count = np.zeros(len(h), np.int64)
    np.add.at(count, inverse.ravel(), np.concatenate([p[2] for p in parts]))
    return [(h, np.concatenate([p[1] for p in parts])[at], count)]


def _count(batches):
    """(lang, gram, n) of a task's rows: counts are merged in the task and handed
    on when they are more than TASK_GRAMS."""
    held, limit = {}, {}

    def out():
        for lang in sorted(held):
            (_, grams, count), = _merged(held[lang])
            text = np.ascontiguousarray(grams).tobytes().decode("utf-32-le", "surrogatepass")
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(count), pa.string()),
                 pa.array([text[i: i + ORDER] for i in range(0, len(text), ORDER)], pa.string()),
                 pa.array(count, pa.int64())], names=["lang", "gram", "n"])
        held.clear()
        limit.clear()

    for batch in batches:
        for lo, hi in slices(batch.column(0)):
            rows = batch.slice(lo, hi - lo)
            langs = np.array(rows.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                codes, _ = characters([t for t, x in zip(rows.column(0).to_pylist(), langs)
                                       if x == lang])
                n = len(codes) - ORDER + 1
                grams = np.lib.stride_tricks.sliding_window_view(codes, ORDER)[:n]
                h = hashes(codes, ORDER)
                h, at, count = np.unique(h, return_index=True, return_counts=True)
                grams = grams[at]
                real = grams[:, -1] != 32  # a space is counted after a letter only
                real |= grams[:, -2] != 32
                parts = held.setdefault(lang, [])
                parts.append((h[real], grams[real], count[real]))
                if sum(len(p[0]) for p in parts) > limit.get(lang, 1 << 17):
                    held[lang] = _merged(parts)
                    limit[lang] = max(1 << 17, 2 * len(held[lang][0][0]))
            if sum(len(p[0]) for parts in held.values() for p in parts) > TASK_GRAMS:
                yield from out()
    yield from out()


def train(docs: DataFrame, dense_cells: int = DENSE_CELLS) -> Model | TableModel:
    """A model from all labelled documents outside the held-out fold."""
    texts = learnable(docs)
    counts = written(texts.where("NOT _calibrate").select("text", "_lang")
                     .mapInArrow(_count, "lang string, gram string, n long")
                     .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid")
    held_back = texts.where("_calibrate").select("text", F.col("_lang").alias("lang"))
    size = counts.agg(F.count_distinct("lang").alias("langs"),
                      F.count(F.lit(1)).alias("rows")).first()
    if not size["rows"]:
        return Model([], [], 0.0)
    if size["rows"] * size["langs"] > dense_cells:
        model = estimate_tables(counts, ORDER)
        none = F.lit(None).cast("long").alias("doc_id")
        found = entropies(model, held_back.select("text", none, "lang"), CUT)
        _fit(model, losses(found, model.languages, SHARPNESS, BINS, LOSS_UNIT))
        return model
    counts = counts.toPandas().sort_values(["lang", "gram"])
    languages = sorted(set(counts["lang"]))
    grams = np.frombuffer("".join(counts["gram"]).encode("utf-32-le", "surrogatepass"),
                          "<u4").reshape(-1, ORDER)
    number = {x: i for i, x in enumerate(languages)}
    model = estimate(languages, counts["lang"].map(number).to_numpy(np.int64), grams,
                     counts["n"].to_numpy())
    names = [f"loss{k}" for k in range(len(SHARPNESS))]
    _fit(model, held_back.mapInArrow(_losses(model), "lang string, bin long, "
                                     + ", ".join(f"{x} long" for x in names))
         .groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("rows"),
                                     *[F.sum(x).alias(x) for x in names]))
    return model


SHARPNESS = (2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
BINS, LOSS_UNIT = 1024, 1 << 16  # a nat of cross-entropy, and one of loss, in whole numbers


def _losses(model: Model):
    """(lang, own cross-entropy, loss at each sharpness) of calibration texts, in
    whole numbers: their sums do not depend on the order of the rows."""
    def run(batches):
        number = {x: i for i, x in enumerate(model.languages)}
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                rows = batch.slice(lo, hi - lo)
                entropy, size = model.entropies(rows.column(0).to_pylist())
                truth = np.array([number.get(x, -1) for x in rows.column(1).to_pylist()])
                keep = (size > 0) & (truth >= 0)
                entropy, truth = entropy[keep], truth[keep]
                own = entropy[np.arange(len(truth)), truth]
                above = entropy - entropy.min(1, keepdims=True)
                mine = above[np.arange(len(truth)), truth]
                losses = [np.log(np.exp(-s * above).sum(1)) + s * mine for s in SHARPNESS]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(1).filter(pa.array(keep)),
                     pa.array(np.floor(own * BINS).astype(np.int64)),
                     *[pa.array(np.rint(x * LOSS_UNIT).astype(np.int64)) for x in losses]],
                    names=["lang", "bin", *[f"loss{k}" for k in range(len(SHARPNESS))]])
    return run


def _fit(model: Model | TableModel, sums: DataFrame) -> None:
    """Fit the score's sharpness and the rejection limits on the texts that were
    not counted. A row per language and 1/BINS nat comes to the driver."""
    names = [f"loss{k}" for k in range(len(SHARPNESS))]
    rows = sums.collect()
    if not rows:
        return
    best = np.inf
    total = sum(r["rows"] for r in rows)
    for sharpness, x in zip(SHARPNESS, names):
        loss = sum(r[x] for r in rows) / LOSS_UNIT / total
        if loss < best - 1e-6:
            best, model.sharpness = loss, sharpness
    for m, lang in enumerate(model.languages):
        own = sorted((r["bin"], r["rows"]) for r in rows if r["lang"] == lang)
        if own:
            upto = np.cumsum([n for _, n in own])
            at = np.searchsorted(upto, REJECT_QUANTILE * (upto[-1] - 1), side="right")
            model.limit[m] = (own[at][0] + 1) / BINS + REJECT_MARGIN


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"


def _predict(model):
    def run(batches):
        predict = model.value.predict
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                rows = batch.slice(lo, hi - lo)
                names, score, accepted = predict(rows.column(1).to_pylist())
                held = crc32_text(rows.column(0)) % HELD_OUT_OF == HELD_OUT
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(held), pa.array(names, pa.string()),
                     pa.array(score, pa.float64()), pa.array(accepted)],
                    names=["doc_id", "held_out", "lang_pred", "score", "accepted"])
    return run


CUT = cut_windows(ORDER, characters, hashes, (HELD_OUT_OF, HELD_OUT))


def identify(docs: DataFrame, model: Model | TableModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if isinstance(model, TableModel):
        none = F.lit(None).cast("string").alias("lang")
        return predictions(model, entropies(model, rows.select("text", "doc_id", none), CUT),
                           UNKNOWN)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by DENSE_CELLS
    return rows.mapInArrow(_predict(shared), SCHEMA)


def identify_languages(docs: DataFrame, dense_cells: int = DENSE_CELLS) -> DataFrame:
    return identify(docs, train(docs, dense_cells))

"""Kneser-Ney character models of any size, as tables (operator 7).

``langid`` broadcasts its model where that is small. Beyond its limit the same
model is kept here as one table of log-probabilities and one of backoff weights
per order, rows by language and n-gram, so nothing of it reaches the driver but
the languages and one discount per order. A text's cross-entropy depends on its
windows of ORDER characters only: documents are cut into distinct windows with
counts, each distinct window of the corpus gets its log-probability in each
language by joins with the tables, and a join and a sum bring these back to the
documents. Results equal the broadcast model's up to the rounding of floats.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc32_text, slices, written

ROW = "rid long, doc_id long, held_out boolean, lang string, gram string, n long"


@dataclasses.dataclass
class TableModel:
    languages: list[str]
    grams: list[DataFrame]        # from order 1 on: (lang, gram, logp)
    contexts: list[DataFrame]     # (lang, context, backoff)
    floor: float                  # log-probability of a character never seen
    sharpness: float = 20.0
    limit: np.ndarray | None = None


def estimate_tables(counts: DataFrame, order: int) -> TableModel:
    """The model of (lang, gram, n): counts of the highest order."""
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    letters = counts.select(F.explode(F.split("gram", "")).alias("c")).where("c <> ''")
    alphabet = max(2, letters.distinct().count())
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        # continuation counts: the different characters seen before an n-gram
        levels[k] = written(levels[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram"))
                            .agg(F.count(F.lit(1)).alias("n")), f"langid-{k}")
    grams, contexts, below = [], [], None
    for k in range(1, order + 1):
        rows = levels[k].withColumn("context", F.substring("gram", 1, k - 1))
        ones, twos = rows.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        context = rows.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        context = written(context.withColumn(
            "weight", F.lit(discount) * F.col("kinds") / F.col("total")), f"langid-c{k}")
        own = rows.join(context, ["lang", "context"])
        if below is None:
            own = own.withColumn("below", F.lit(1 / (alphabet + 1)))
        else:
            lower = below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
            own = own.withColumn("suffix", F.substring("gram", 2, k - 1)) \
                .join(lower, ["lang", "suffix"])
        p = F.greatest(F.col("n") - F.lit(discount), F.lit(0.0)) / F.col("total") \
            + F.col("weight") * F.col("below")
        below = written(own.select("lang", "gram", p.alias("p")), f"langid-p{k}")
        grams.append(below.select("lang", "gram", F.log("p").alias("logp")))
        contexts.append(context.select("lang", "context", F.log("weight").alias("backoff")))
    return TableModel(languages, grams, contexts, -math.log(alphabet + 1),
                      limit=np.full(len(languages), np.inf))


def window_logs(model: TableModel, windows: DataFrame) -> DataFrame:
    """(gram, logs): per distinct window its log-probability in each language,
    in the languages' order."""
    order = len(model.grams)
    rows = windows.select("gram", F.explode(F.array(*map(F.lit, model.languages))).alias("lang"))

    def known(rows: DataFrame, table: DataFrame, key: str, value: str, piece: Column,
              name: str) -> DataFrame:
        other = table.select(F.col("lang").alias("_lang"), F.col(key).alias("_key"),
                             F.col(value).alias(name))
        return rows.join(other, (F.col("lang") == F.col("_lang")) & (piece == F.col("_key")),
                         "left").drop("_lang", "_key")

    for k in range(order, 0, -1):
        suffix = F.substring("gram", order - k + 1, k)
        rows = known(rows, model.grams[k - 1], "gram", "logp", suffix, f"p{k}")
        rows = known(rows, model.contexts[k - 1], "context", "backoff",
                     F.substring("gram", order - k + 1, k - 1), f"b{k}")
    letters = model.grams[0].select(F.col("gram").alias("_letter")).distinct()
    rows = rows.join(letters, F.substring("gram", order, 1) == F.col("_letter"), "left")
    # a character that no language knows has the same share of each
    log = F.coalesce("p1", F.when(F.col("_letter").isNotNull(),
                                  F.coalesce("b1", F.lit(0.0)) + F.lit(model.floor))
                     .otherwise(F.lit(model.floor)))
    for k in range(2, order + 1):
        log = F.coalesce(f"p{k}", F.coalesce(f"b{k}", F.lit(0.0)) + log)
    pairs = F.array_sort(F.collect_list(F.struct("lang", log.alias("log"))))
    return rows.groupBy("gram").agg(F.transform(pairs, lambda x: x["log"]).alias("logs"))


def cut_windows(order: int, characters, hashes, held_of: tuple[int, int]):
    """(text, doc_id, lang) -> a row per document with its length, and one per
    document and distinct window with its count."""
    def run(batches):
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                rows = batch.slice(lo, hi - lo)
                codes, first = characters(rows.column(0).to_pylist())
                stop = np.maximum(first[1:] - (order - 1), first[:-1])
                size = stop - first[:-1]
                doc = np.repeat(np.arange(len(rows)), size)
                at = np.arange(len(doc)) + np.repeat(first[:-1] - (np.cumsum(size) - size), size)
                h = hashes(codes, order)[at - (order - 1)]
                by = np.lexsort((h, doc))
                new = np.ones(len(by), bool)
                new[1:] = (h[by][1:] != h[by][:-1]) | (doc[by][1:] != doc[by][:-1])
                begin = np.flatnonzero(new)
                count = np.diff(np.append(begin, len(by)))
                one = by[begin]
                grams = codes[at[one][:, None] + np.arange(1 - order, 1)]
                text = np.ascontiguousarray(grams, "<u4").tobytes().decode("utf-32-le",
                                                                           "surrogatepass")
                held = crc32_text(rows.column(1)) % held_of[0] == held_of[1]
                own = np.arange(len(rows))
                both = np.concatenate([own, doc[one]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(rid + both), rows.column(1).take(pa.array(both)),
                    pa.array(held[both]), rows.column(2).take(pa.array(both)),
                    pa.array([None] * len(rows) + [text[i: i + order]
                                                   for i in range(0, len(text), order)],
                             pa.string()),
                    pa.array(np.concatenate([size, count]))],
                    names=["rid", "doc_id", "held_out", "lang", "gram", "n"])
                rid += len(rows)
    return run


def entropies(model: TableModel, docs: DataFrame, cut) -> DataFrame:
    """(rid, doc_id, held_out, lang, size, entropy): cross-entropies per
    character in the languages' order, null for a text without a letter."""
    pieces = written(docs.select("text", "doc_id", "lang").mapInArrow(cut, ROW), "langid-windows")
    windows = pieces.where("gram IS NOT NULL").select("rid", F.col("gram").alias("window"), "n")
    logs = written(window_logs(model, windows.select(F.col("window").alias("gram")).distinct()),
                   "langid-logs")
    places = range(len(model.languages))
    sums = (windows.join(logs, F.col("window") == F.col("gram")).groupBy("rid")
            .agg(*[F.sum(F.col("n") * F.col("logs")[i]).alias(f"s{i}") for i in places])
            .withColumnRenamed("rid", "_rid"))
    heads = pieces.where("gram IS NULL").withColumnRenamed("n", "size").drop("gram")
    entropy = F.when(F.col("s0").isNotNull(), F.array(
        *[-F.col(f"s{i}") / F.col("size") for i in places]))
    return (heads.join(sums, F.col("rid") == F.col("_rid"), "left")
            .select("rid", "doc_id", "held_out", "lang", "size", entropy.alias("entropy")))


def losses(found: DataFrame, languages: list[str], sharpness: tuple[float, ...], bins: int,
           unit: int) -> DataFrame:
    """Calibration sums per (lang, bin): rows, and the loss at each sharpness."""
    place = F.array_position(F.array(*map(F.lit, languages)), F.col("lang"))
    rows = found.where(F.col("entropy").isNotNull() & (place > 0)).select(
        "lang", "entropy", F.element_at("entropy", place.cast("int")).alias("own"),
        F.array_min("entropy").alias("low"))

    def loss(s: float) -> Column:
        total = F.aggregate("entropy", F.lit(0.0),
                            lambda a, e: a + F.exp(F.lit(-s) * (e - F.col("low"))))
        return F.rint((F.log(total) + F.lit(s) * (F.col("own") - F.col("low"))) * unit) \
            .cast("long")
    return rows.groupBy("lang", F.floor(F.col("own") * bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(loss(s)).alias(f"loss{k}") for k, s in enumerate(sharpness)])


def predictions(model: TableModel, found: DataFrame, unknown: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) from cross-entropies."""
    low = F.array_min("entropy")
    place = F.array_position("entropy", low).cast("int")  # the first of equal ones
    names, limits = F.array(*map(F.lit, model.languages)), F.array(*map(F.lit, model.limit.tolist()))
    total = F.aggregate("entropy", F.lit(0.0),
                        lambda a, e: a + F.exp(F.lit(-model.sharpness) * (e - low)))
    known = F.col("entropy").isNotNull()
    return found.select(
        "doc_id", "held_out",
        F.when(known, F.element_at(names, place)).otherwise(F.lit(unknown)).alias("lang_pred"),
        F.when(known, 1 / total).otherwise(F.lit(0.0)).alias("score"),
        F.when(known, low <= F.element_at(limits, place)).otherwise(F.lit(False))
        .alias("accepted"))

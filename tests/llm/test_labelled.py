"""Samples stay within their bound where doc_ids repeat."""

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity
from tidemark.llm.labelled import sample, with_text
from tidemark.session import ship_package


def test_one_text_per_sampled_pair(spark):
    ship_package(spark)
    rows = [(1, f"text {k % 3}") for k in range(500)] + [(1, None), (2, "b"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 0)] * 300 + [(2, 1), (3, 1), (3, 0)],
                                   "doc_id long, toxic int")
    pairs = sample(labels, "toxic", 4)
    assert sorted(map(tuple, pairs.collect())) == [(1, 0), (2, 1), (3, 0), (3, 1)]
    got = sorted(((r["_id"], r["_label"], r["text"]) for r in with_text(docs, pairs).collect()),
                 key=str)
    least = docs.where("doc_id = 1 AND text IS NOT NULL").orderBy(F.xxhash64("text")).first()
    assert got == [(1, 0, least["text"]), (2, 1, "b"), (3, 0, None), (3, 1, None)]


def test_repeated_documents_train_the_same_models(spark):
    ship_package(spark)
    rows = [(i, f"word{i % 7} " * (5 + i % 11) + ("foul" if i % 3 == 0 else "fair"))
            for i in range(90)]
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(90)],
                                   "doc_id long, quality int, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame(rows + rows[:9] * 40, "doc_id long, text string")
    a, b = (toxicity.train(d, labels) for d in (once, often))
    assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()
    a, b = (quality.train(d, labels) for d in (once, often))
    x = quality.statistics(pa.array([t for _, t in rows], pa.string()))
    assert (a.score(x) == b.score(x)).all()

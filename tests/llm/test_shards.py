"""Benchmarks of many shards: copies of an item, random texts, small bitmaps."""

import numpy as np
import pytest

from tidemark.llm import decontaminate
from tidemark.session import ship_package

ITEM = "item_id long, text string"


def digests(docs, bench, **kw):
    return sorted((tuple(r) for r in decontaminate.contamination(docs, bench, **kw).collect()),
                  key=str)


def test_copies_of_an_item_are_one_item(spark):
    ship_package(spark)
    items = [(k, " ".join(f"w{k}x{j}" for j in range(12))) for k in range(12)]
    once = [*items, (None, "tail words"), (99, None), (99, "")]
    often = once + [items[3]] * 400 + [(None, "tail words")] * 100
    limit = 300
    few, many = (decontaminate._items(spark.createDataFrame(x, ITEM), limit)
                 for x in (once, often))
    assert few[1] > 1 and many[1] == few[1] and many[0].count() == few[0].count()
    docs = spark.createDataFrame([(1, "a " + items[3][1]), (2, "tail words"), (3, "none"),
                                  (4, None)], "doc_id long, text string")
    got = [digests(docs, spark.createDataFrame(x, ITEM), shard_chars=n)
           for x in (once, often) for n in (limit, decontaminate.SHARD_CHARS)]
    assert all(g == got[0] for g in got) and [r[2] for r in got[0]] == [12, 2, 0, 0]


def texts(seed):
    """Items and documents over few words, so that windows overlap and nearly match."""
    rng = np.random.default_rng(seed)
    words = np.array([f"v{i}" for i in range(9)] + ["\u00e9t\u00e9", "Zwei"])
    items = [(int(i % 23), " ".join(rng.choice(words, int(rng.choice([1, 3, 7, 10, 11, 25])))))
             for i in range(60)]
    items = [(i, t) for i, t in items if len(t.split()) > 2] + [(None, ""), (5, None)]
    docs = []
    for i in range(80):
        parts = [" ".join(rng.choice(words, int(rng.integers(1, 15)))) for _ in range(3)]
        if i % 2 == 0:
            parts.insert(1, items[int(rng.integers(0, len(items) - 2))][1].upper())
        docs.append((i, " - ".join(parts)))
    return items, docs + [(200, None), (201, ""), (202, docs[0][1]), (202, docs[0][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_many_shards_equal_one(spark, seed):
    ship_package(spark)
    items, rows = texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, ITEM)
    want = digests(docs, bench)
    assert sum(r[5] for r in want) > 10
    assert digests(docs, bench, shard_chars=150) == want
    whole, cut = (sorted((tuple(r) for r in decontaminate.cleaned(docs, bench, shard_chars=n)
                          .collect()), key=str) for n in (decontaminate.SHARD_CHARS, 150))
    assert whole == cut


def test_small_bitmaps_and_busy_shards_lose_nothing(spark):
    ship_package(spark)
    items, rows = texts(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, ITEM)
    shard, shards = decontaminate._items(bench, 150)
    got = [sorted((r.key, tuple(sorted(zip(r.spans[::2], r.spans[1::2]))), tuple(sorted(r.items)))
                  for r in decontaminate.large_findings(
                      docs.select("text"), shard, shards, decontaminate.WINDOW, **kw).collect())
           for kw in ({}, {"filter_bits": 1, "shard_runs": 2})]
    assert got[0] and [(k, i) for k, _, i in got[0]] == [(k, i) for k, _, i in got[1]]
    united = [[decontaminate.united(list(s)) for _, s, _ in g] for g in got]
    assert united[0] == united[1]


def test_nothing_to_find(spark):
    ship_package(spark)
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    apart = spark.createDataFrame([(i, f"other{i} words{i} here{i}") for i in range(40)], ITEM)
    assert [r[2] for r in digests(docs, apart, shard_chars=100)] == [0, 0]
    blank = spark.createDataFrame([(i, "... " * 20) for i in range(40)], ITEM)
    assert [r[2] for r in digests(docs, blank, shard_chars=20)] == [0, 0]
    assert digests(docs.limit(0), apart, shard_chars=100) == []

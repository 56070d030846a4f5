"""What the language models are estimated from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.session import ship_package

SCHEMA = "doc_id long, text string, lang string"
WORDS = {"en": "the quick brown fox jumps over lazy dogs while rain falls".split(),
         "de": "der schnelle braune fuchs springt ueber faule hunde waehrend".split()}


def _texts(lang, ids, n=40, seed=3):
    rng = np.random.default_rng(seed)
    return [(int(i), " ".join(rng.choice(WORDS[lang], n)), lang) for i in ids]


def _counted(docs):
    rows = langid.learnable(docs).where("NOT _calibrate")
    return {(r["lang"], r["gram"]): r["s"] for r in
            rows.select("text", "_lang").mapInArrow(langid._count,
                                                    "lang string, gram string, n long")
            .groupBy("lang", "gram").sum("n").toDF("lang", "gram", "s").collect()}


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def test_one_long_text_ends_nothing(spark):
    """A text of 7 M characters, first by hash: every other row is still learned from."""
    rows = _texts("de", range(2000, 2040)) + _texts("en", range(40))
    first = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "doc_id", "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 AS held").where(
        "doc_id < 2000 AND NOT held").orderBy(F.xxhash64("doc_id")).first()["doc_id"]
    rows = [(i, "omega " * 1_170_000 if i == first else t, x) for i, t, x in rows]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model = langid.train(docs)
    assert model.languages == ["de", "en"] and np.isfinite(model.limit).all()
    texts = [t for i, t, x in rows if x == "en" and i != first]
    assert set(model.predict(texts)[0]) == {"en"}
    counted = _counted(docs)
    assert all(("en", f"{w} "[-langid.ORDER:]) in counted for w in WORDS["en"])


def test_counts_grow_with_the_input(spark):
    """More rows than the former sample of 1,000: each is counted or a calibration
    row, however often a task hands its counts on, and the model keeps all n-grams."""
    docs = spark.createDataFrame(_texts("en", range(4000), 6), SCHEMA).repartition(3)
    rows = langid.learnable(docs)
    held = sum(r["n"] for r in docs.selectExpr(
        "int(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2) AS n").collect())
    calibrate = rows.where("_calibrate").count()
    assert rows.count() == 4000 - held and 0 < calibrate < 1000
    want = {}
    for r in rows.where("NOT _calibrate").collect():
        codes = f"   {r['text']} "
        for k in range(len(codes) - langid.ORDER + 1):
            gram = codes[k: k + langid.ORDER]
            if gram[-2:] != "  ":
                want["en", gram] = want.get(("en", gram), 0) + 1
    assert _counted(docs) == want
    model = langid.train(docs)
    kept = {tuple(g) for g in langid._groups(np.array([list(map(ord, g)) for _, g in want]))[0]}
    assert len(model.orders[-1].grams) == len(kept) and min(want.values()) >= 1


def plain_model(counts):
    """Interpolated Kneser-Ney probabilities by dictionaries: a function of
    (language, window)."""
    level = {(x, g): n for (x, g), n in counts.items()}
    alphabet = max(2, len({c for _, g in counts for c in g}))
    levels = {langid.ORDER: level}
    for k in range(langid.ORDER - 1, 0, -1):
        level = {}
        for x, g in levels[k + 1]:
            level[x, g[1:]] = level.get((x, g[1:]), 0) + 1
        levels[k] = level
    discounts = {}
    for k, level in levels.items():
        ones, twos = (sum(n == i for n in level.values()) for i in (1, 2))
        discounts[k] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(lang, g):
        k = len(g)
        if not k:
            return 1 / (alphabet + 1)
        own = {h: n for (x, h), n in levels[k].items() if x == lang and h[:-1] == g[:-1]}
        if not own:
            return p(lang, g[1:])
        total = sum(own.values())
        return max(own.get(g, 0) - discounts[k], 0) / total \
            + discounts[k] * len(own) / total * p(lang, g[1:])
    return p


def _small_counts():
    counts = {}
    for _, t, x in _texts("en", range(3), 12) + _texts("de", range(3), 9, 4):
        text = f"   {t} "
        for k in range(len(text) - 3):
            if text[k: k + 4][-2:] != "  ":
                counts[x, text[k: k + 4]] = counts.get((x, text[k: k + 4]), 0) + 1
    return counts


def test_probabilities_against_dictionaries(spark):
    counts = _small_counts()
    p = plain_model(counts)
    langs = ["de", "en"]
    keys = sorted(counts)
    model = langid.estimate(langs, np.array([langs.index(x) for x, _ in keys]),
                            np.array([list(map(ord, g)) for _, g in keys], np.uint32),
                            np.array([counts[k] for k in keys]))
    texts = ["the quick fox", "der braune fuchs", "zebra qq the", "hund"]
    got, size = model.entropies(texts)
    for t, row, n in zip(texts, got, size):
        padded = f"   {t} "
        windows = [padded[i: i + 4] for i in range(len(padded) - 3)]
        assert n == len(windows)
        for lang, e in zip(langs, row):
            want = -sum(np.log(p(lang, w)) for w in windows) / n
            assert e == pytest.approx(want, abs=1e-4)
    # what may follow a context has probabilities that add up to 1 (one is left for the unknown)
    letters = sorted({c for _, g in counts for c in g})
    for lang in langs:
        for context in ("   ", "the", "er ", "fuc", "xyz"):
            total = sum(p(lang, context + c) for c in letters)
            assert total < 1 and total + p(lang, context + "\u0416") == pytest.approx(1)


def test_a_model_in_tables_gives_the_same_result(spark):
    rows = _texts("en", range(90), 12) + _texts("de", range(1000, 1090), 9)
    rows += [(5000, None, None), (5001, "", "en"), (5002, "123", "de"), (None, "the fox", None),
             (5003, "\u0416\u0416 \u0416", None), (5004, "the lazy der faule " * 300, None),
             (5005, "quick", None), (5005, "quick", None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    dense, tables = langid.train(docs), langid.train(docs, dense_cells=10)
    assert isinstance(tables, langid.TableModel) and tables.languages == dense.languages
    assert tables.sharpness == dense.sharpness
    assert tables.limit == pytest.approx(dense.limit, abs=2 / langid.BINS)
    a, b = (sorted(langid.identify(docs, m).collect(), key=lambda r: (str(r.doc_id), r.score))
            for m in (dense, tables))
    assert len(a) == len(b) == len(rows)
    for x, y in zip(a, b):
        assert (x.doc_id, x.held_out, x.lang_pred, x.accepted) == \
            (y.doc_id, y.held_out, y.lang_pred, y.accepted)
        assert x.score == pytest.approx(y.score, abs=1e-3)


def test_many_languages_stay_off_the_driver(spark):
    """200 languages: the model's n-grams times its languages are beyond the limit."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    own = {f"l{i:03d}": ["".join(rng.choice(letters, 6)) for _ in range(12)] for i in range(200)}
    rows = [(i, " ".join(rng.choice(own[f"l{i % 200:03d}"], 10)), f"l{i % 200:03d}")
            for i in range(1200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    model = langid.train(docs, dense_cells=1_000_000)
    assert isinstance(model, langid.TableModel) and len(model.languages) == 200
    got = langid.identify(docs, model).collect()
    right = {i: x for i, _, x in rows}
    held = [r for r in got if r.held_out]
    assert len(got) == 1200
    assert sum(r.lang_pred == right[r.doc_id] for r in held) >= 0.95 * len(held)


def test_counts_handed_on_often(monkeypatch):
    import pyarrow as pa
    texts = [t for _, t, _ in _texts("en", range(30)) + _texts("de", range(30))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array(["en"] * 30 + ["de"] * 30)], names=["text", "_lang"])

    def total():
        out = {}
        for part in langid._count([batch.slice(k, 7) for k in range(0, 60, 7)]):
            for r in part.to_pylist():
                out[r["lang"], r["gram"]] = out.get((r["lang"], r["gram"]), 0) + r["n"]
        return out

    whole = total()
    monkeypatch.setattr(langid, "TASK_GRAMS", 10)
    assert total() == whole


def test_repeated_rows_count_once_each(spark):
    """k copies of a labelled row count k times, not k * k times, and are either
    all counted or all calibration rows."""
    copies = [(1, t, x) for _, t, x in _texts("en", [1])] * 50
    docs = spark.createDataFrame(copies + _texts("en", range(100, 140)), SCHEMA).repartition(4)
    rows = langid.learnable(docs)
    sides = rows.where(F.col("text") == copies[0][1]).groupBy("_calibrate").count().collect()
    assert [r["count"] for r in sides] == [50]
    held = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2").count()
    assert rows.count() == len(copies) + 40 - held
    assert langid.identify_languages(docs).count() == len(copies) + 40

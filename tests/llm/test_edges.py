"""Rows without a doc_id, doc_ids on rows of different texts, null labels and
items: every text operator has a defined result."""

import hashlib

import public_tokenizers
import pytest

import corpus_pipeline
from tidemark.llm import (bpe, decontaminate, exact_dedup, langid, quality, secret_scan, simhash,
                          substring_dedup, token_output, toxicity)
from tidemark.session import ship_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PASSAGE = " ".join(f"w{i}" for i in range(40))
ROWS = [(1, PASSAGE, "en"), (2, "a b " + PASSAGE, "en"), (None, PASSAGE + " x", None),
        (None, "q " * 30 + PASSAGE, "en"), (None, "short", "de"), (None, None, None),
        (3, None, "de"), (4, PASSAGE, "en"), (4, "tiny", "en"), (4, "other " * 9 + PASSAGE, "de"),
        (5, "", "en")]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(3)


def test_substring_judges_each_text(docs):
    want = []
    for i, t, _ in ROWS:
        words = (t or "").split()
        at = " ".join(words).find(PASSAGE)
        gone = 40 if i in (2, 4) and at >= 0 else 0
        kept = " ".join(words).replace(PASSAGE, "").strip() if gone else " ".join(words)
        want.append((i, len(words), gone, hashlib.sha256(kept.encode()).hexdigest()))
    key = str
    assert sorted(map(tuple, substring_dedup.repeated_passages(docs).collect()), key=key) == \
        sorted(want, key=key)
    texts = [(r.doc_id, r.text) for r in substring_dedup.without_repeats(docs).collect()]
    assert len(texts) == len(ROWS) and (2, "a b") in texts and (None, None) in texts


def test_one_representative_of_each_component(docs):
    prints = [simhash.fingerprint((t or "").lower().encode()) for _, t, _ in ROWS]
    group = list(range(len(ROWS)))
    for _ in ROWS:
        for a in range(len(ROWS)):
            for b in range(len(ROWS)):
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    group[a] = group[b] = min(group[a], group[b])
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(group))
    of_text = {t or "": g for (_, t, _), g in zip(ROWS, group)}
    assert sorted(of_text[t or ""] for _, t in got) == sorted(set(group))
    least = {}
    for (i, _, _), g in zip(ROWS, group):
        least[g] = min(least.get(g, 99), 99 if i is None else i)
    assert all((99 if i is None else i) == least[of_text[t or ""]] for i, t in got)


def test_exact_rows(docs):
    got = exact_dedup.deduplicated(docs).collect()
    assert sorted(r.text or "" for r in got) == sorted({t or "" for _, t, _ in ROWS})


def test_no_operator_loses_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 1, 1), (4, 0, None)],
                                   "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, PASSAGE[:60]), (None, "other other"), (2, None)],
                                  "item_id long, text string")
    for df in (toxicity.score_toxicity(docs, labels), exact_dedup.exact_duplicates(docs),
               quality.score_quality(docs, labels), decontaminate.contamination(docs, bench),
               simhash.near_duplicates(docs), langid.identify_languages(docs),
               token_output.token_digests(docs, TOKENIZER), secret_scan.secret_digests(docs),
               bpe.round_trip(docs, TOKENIZER)):
        assert df.count() == len(ROWS)


def test_pipeline_against_plain_steps(spark, tmp_path):
    """All five stages on a small table, against the same steps over plain lists."""
    ship_package(spark)
    words = [f"word{i}" for i in range(400)]
    texts = {i: " ".join(words[(i * 37 + k * (i % 7 + 1)) % 400] for k in range(60))
             for i in range(1, 21)}
    item = " ".join(words[i] for i in range(0, 24, 2))
    texts[21], texts[22] = texts[5].upper(), texts[6] + " tail"
    texts[23], texts[24] = texts[7] + " " + item + " end", item
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in texts], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("t", item)], "item_id string, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")

    left = dict(texts)                                     # all labelled good: nothing goes
    last = {t.lower(): i for i, t in sorted(left.items())}  # exact copies: the largest doc_id
    left = {i: left[i] for i in last.values()}
    prints = {i: simhash.fingerprint(t.lower().encode()) for i, t in left.items()}
    root = {i: i for i in left}
    for _ in left:
        for a in left:
            for b in left:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    left = {i: t for i, t in left.items() if root[i] == i}
    want = {}
    window = item.split()
    for i, t in left.items():
        w, hit = t.lower().split(), set()
        for a in range(len(w) - 9):
            if any(w[a:a + 10] == window[b:b + 10] for b in range(len(window) - 9)):
                hit.update(range(a, a + 10))
        if 2 * len(hit) > len(w):
            continue
        own = t.split()
        want[i] = " ".join(x for k, x in enumerate(own) if k not in hit)
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(TOKENIZER)
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids)
                   for i, t in want.items()}
    assert 24 not in got and 5 not in got and 21 in got

"""Very long texts through every text operator, columns named like helpers
through the pipeline's stages, and words that a weak hash would confuse."""

import glob
import hashlib
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (bpe, decontaminate, exact_dedup, quality, secret_scan, simhash,
                          substring_dedup, token_output, toxicity)
from tidemark.llm.common import Words, flat, word_hashes
from tidemark.session import ship_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COUNTED = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
MANY = " ".join(f"w{i % 5003}x{i % 89}" for i in range(250_000))   # 2 MB of words
ONE = "a" * 2_000_000                                              # a word of 2 MB
ROWS = [(1, MANY), (2, ONE), (3, "short"), (4, MANY + " end"), (5, ONE), (6, COUNTED)]


@pytest.fixture(scope="module")
def long_docs(spark):
    ship_package(spark)
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)


def test_long_texts(spark, long_docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 7)],
                                   "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(long_docs, labels).count() == 6
    assert quality.score_quality(long_docs, labels).count() == 6
    exact = {r.doc_id: r for r in exact_dedup.exact_duplicates(long_docs).collect()}
    assert (exact[2].keep_id, exact[2].group_size, exact[1].group_size) == (5, 2, 1)
    near = {r.doc_id: r.component_id for r in simhash.near_duplicates(long_docs).collect()}
    assert near[1] == near[4] == 1 and near[2] == near[5] == 2
    removed = {r.doc_id: (r.n_words, r.n_removed)
               for r in substring_dedup.repeated_passages(long_docs).collect()}
    assert removed[1] == (250_000, 0) and removed[4] == (250_001, 250_000)
    assert removed[2] == (1, 0)
    bench = spark.createDataFrame([("i", COUNTED)], "item_id string, text string")
    hits = {r.doc_id: r.n_hit for r in decontaminate.contamination(long_docs, bench).collect()}
    assert hits == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 14}


def test_long_texts_as_tokens(long_docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(TOKENIZER)
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in ROWS if i not in (2, 5)}
    texts = long_docs.where("doc_id NOT IN (2, 5)")
    tokens = {r.doc_id: r.n_tokens for r in token_output.token_digests(texts, TOKENIZER).collect()}
    assert tokens == {i: len(x) + 1 for i, x in want.items()}
    got = {r.doc_id: r.ids_sha256 for r in bpe.round_trip(texts, TOKENIZER).collect()}
    assert got == {i: hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()
                   for i, x in want.items()}


def test_very_many_secrets_in_one_text(spark):
    ship_package(spark)
    n = 64_000
    docs = spark.createDataFrame([(1, "token=abcdef " * n), (2, "AKIA" + "Z" * 500_000),
                                  (3, "token=abc " * n)], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r for r in secret_scan.secret_digests(docs).collect()}
    assert time.time() - began < 60
    assert (got[1].n_assign, got[2].n_access, got[3].n_assign) == (n, 1, 0)
    assert got[1].spans.startswith("assign:0:12,assign:13:25,")
    assert got[1].spans.endswith(f"assign:{13 * n - 13}:{13 * n - 1}")


def test_copies_are_scanned_once(spark, scratch):
    ship_package(spark)
    text = "token: abcdefg " + "0a" * 15
    docs = spark.createDataFrame([(7, text)] * 50 + [(8, text), (9, None), (9, "")],
                                 "doc_id long, text string").repartition(6)
    ledger = f"{scratch}/ledger"
    got = secret_scan.secret_digests(docs, ledger).collect()
    assert len(got) == 53 and {r.spans for r in got if r.doc_id < 9} == {"assign:0:14,hex:15:45"}
    assert spark.read.parquet(ledger).count() == 2 * len(secret_scan.RULES)


def test_ledger_files_do_not_grow_with_tasks(spark, scratch):
    ship_package(spark)
    rows = [(i, f"token: abcdef{i} " + "0a" * (15 + i)) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        for name, room, most in (("few", {}, 1), ("more", {"file_rows": 20}, 4)):
            got = secret_scan.scan(docs, f"{scratch}/{name}", "doc_id", "text", **room)
            assert {r.key: [tuple(s) for s in r.spans] for r in got.collect()} == {
                i: [(0, 0, 13 + len(str(i))), (14 + len(str(i)), 2, len(t))] for i, t in rows}
            files = glob.glob(f"{scratch}/{name}/rule=*/rule_version=*/*.parquet")
            assert len(files) <= most * len(secret_scan.RULES)
            assert spark.read.parquet(f"{scratch}/{name}").count() == 64 * len(secret_scan.RULES)
    finally:
        spark.conf.set(key, before)


def test_component_tables_have_few_files(spark):
    ship_package(spark)
    few = 2 * spark.sparkContext.defaultParallelism
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": str(8 * few)}
    before = {k: spark.conf.get(k) for k in keys}
    nodes = [(10 * i + j + 1, 10 * i + j) for i in range(200) for j in range(2)]
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = simhash.components(spark.createDataFrame(nodes, "u long, v long"))
        assert sorted(map(tuple, got.collect())) == sorted((u, u // 10 * 10) for u, _ in nodes)
        assert len(got.inputFiles()) <= few
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_exact_dedup_has_few_files(spark):
    ship_package(spark)
    few = 2 * spark.sparkContext.defaultParallelism
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": str(4 * few)}
    before = {k: spark.conf.get(k) for k in keys}
    rows = [(i, f"text {i // 2}") for i in range(1000)] + [(1000, "TEXT 3"), (1000, "text 3"),
                                                           (1000, "other"), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4 * few)
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        for room in (exact_dedup.TABLE_BYTES, 40):  # the small table spills to further levels
            groups = exact_dedup.duplicate_groups(docs, table_bytes=room)
            sizes = sorted(r.group_size for r in groups.collect())
            assert sizes == [1, 1] + [2] * 499 + [4]
        files = exact_dedup.duplicate_groups(docs).inputFiles()
        assert 0 < len(files) <= few
        kept = corpus_pipeline.exact_stage(spark, docs, "")
        assert kept.rdd.getNumPartitions() <= few
        got = sorted((r.doc_id or -1, r.text.lower()) for r in kept.collect())
        assert got == sorted([(i, f"text {i // 2}") for i in range(1, 1000, 2) if i != 7]
                             + [(1000, "text 3"), (1000, "other"), (-1, "none")])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_texts_leave_a_table_in_pieces():
    table = exact_dedup.OpenTable()
    texts = [b"a" * (3 << 20), b"b" * (3 << 20), b"c" * (9 << 20), b"", b"d"]
    for h, text in enumerate(texts):
        table.add(table.find(h, text)[1], h, text)
    got = list(exact_dedup._records(table, [1, 2, 3, 4, 5], [1] * 5, 0, 7, True))
    assert [x.num_rows for x in got] == [1, 1, 1, 2]
    assert [t for x in got for t in x.column("content").to_pylist()] == texts
    assert [i for x in got for i in x.column("keep_id").to_pylist()] == [1, 2, 3, 4, 5]


def test_token_files_are_few(spark, scratch):
    from tokenizers import Tokenizer
    ship_package(spark)
    library = Tokenizer.from_file(TOKENIZER)
    few = 2 * spark.sparkContext.defaultParallelism
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    rows = [(i, f"Some word{i} of {i * i} texts!") for i in range(-20, 40 * few)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(few)
    spark.conf.set(key, str(4 * few))
    try:
        digests = token_output.token_digests(docs, TOKENIZER, folder=f"{scratch}/tokens")
        for name in ("raw", "files"):
            assert 0 < len(glob.glob(f"{scratch}/tokens/{name}/*.parquet")) <= few
        assert digests.rdd.getNumPartitions() <= few
        at = 0
        for r in sorted(digests.collect(), key=lambda r: r.start):
            text = dict(rows)[r.doc_id] or ""
            ids = [*library.encode(text, add_special_tokens=False).ids, token_output.END_ID]
            assert (r.start, r.n_tokens, r.ids_crc32) == (
                at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += len(ids)
        assert digests.count() == len(rows)
    finally:
        spark.conf.set(key, before)


def test_token_passes_hold_little(spark, scratch, monkeypatch):
    import pyarrow.parquet as pq
    ship_package(spark)
    keys = {"spark.sql.shuffle.partitions": "1", "spark.sql.execution.arrow.maxBytesPerBatch": "60m"}
    before = {k: spark.conf.get(k) for k in keys}
    docs = spark.createDataFrame([(i, MANY) for i in range(12)], "doc_id long, text string")
    made = token_output._tokenised

    def watched(*args):
        run = made(*args)

        def small(batches):
            for batch in batches:
                assert batch.nbytes < 9 << 20, "a batch of many texts"
                yield batch
        return lambda batches: run(small(batches))

    monkeypatch.setattr(token_output, "_tokenised", watched)
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        folder = token_output.write_token_files(docs.coalesce(1), f"{scratch}/tokens", TOKENIZER)
        assert {k: spark.conf.get(k) for k in keys} == keys
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder}/files/*.parquet")]
        assert sum(f.num_rows for f in files) == 12
        sizes = [f.row_group(i).total_byte_size for f in files for i in range(f.num_row_groups)]
        assert sum(sizes) > 12 << 20 and max(sizes) < 8 << 20
        assert {r.n_tokens for r in token_output.read_token_files(spark, folder).collect()} == {
            len(token_output.library_words(TOKENIZER).whole(MANY.encode())) + 1}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("code", ["H", "I"])
def test_kept_words_are_packed(code):
    import pyarrow as pa
    words = token_output.LibraryWords(TOKENIZER)
    assert words.code == "H"  # ids of this file fit in two bytes
    words.code = code
    words.clear()
    texts = ["Hello, world!", None, "", "\u00c9t\u00e9 o'clock 3.14 \u6f22\u5b57", MANY, "\u200b", "hello world"]
    for part in (texts[1:3], texts, texts[::-1]):  # nothing to learn, all, nothing new
        ids, size = words.encode(*flat(pa.array(part, pa.string())))
        want = [words.whole((t or "").encode()) for t in part]
        assert ids.tolist() == [i for x in want for i in x] and size.tolist() == list(map(len, want))
    assert words.pool.itemsize == {"H": 2, "I": 4}[code]
    assert len(words.pool) < 1 << 16 or len(words.pool) <= 2 * words.used
    assert all(type(x) is bytes for x in words.parts.values())


def thue_morse(n, a, b):
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


def test_words_that_one_polynomial_confuses(spark):
    ship_package(spark)
    one, other = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    head = " ".join(f"h{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{head} {one}"), (2, f"{head} {other}"),
                                  (3, f"{head} {other}")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.repeated_passages(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 13}


def test_word_hashes_see_every_byte():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    words = ["x" * n for n in range(1, 140)]
    for n in (1, 7, 8, 9, 16, 63, 64, 65, 130):
        base = bytearray(rng.integers(97, 123, n, dtype=np.uint8).tobytes())
        for i in range(n):
            other = bytearray(base)
            other[i] = 48 + i % 10
            words.append(other.decode())
    words = sorted(set(words))
    rng.shuffle(words)
    high, low = word_hashes(Words(*flat(pa.array([" ".join(words), "  ", words[0]]))))
    assert len(set(high.tolist())) == len(set(low.tolist())) == len(words)
    assert high[-1] == high[0] and low[-1] == low[0]  # equal words, wherever they are


def test_columns_named_like_helpers(spark):
    ship_package(spark)
    names = ["_rows", "_kept", "_kept_id", "_fp", "_tm_fp", "_id", "_row", "_text", "_best",
             "keep_id", "rule", "verdict", "part", "mark"]
    base = [(1, "alpha beta gamma delta epsilon"), (2, "ALPHA beta gamma delta epsilon"),
            (3, "something else entirely here now"), (3, "something else entirely here now"),
            (3, "a third text of the same id"), (None, "no id here"), (None, None)]
    docs = spark.createDataFrame(base, "doc_id long, text string").select(
        "*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for stage in (exact_dedup.deduplicated, simhash.representatives):
        kept = stage(docs)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert all([r[n] for n in names] == list(range(len(names))) for r in rows)
        texts = [(r.doc_id, (r.text or "").lower()) for r in rows]
        assert len(texts) == len(set(texts)) and (3, "a third text of the same id") in texts
        assert sum(t.startswith("alpha") for _, t in texts) == 1
    assert [n for n, _ in corpus_pipeline.STAGES][:3] == [
        "quality classifier", "exact dedup", "simhash near-dedup"]

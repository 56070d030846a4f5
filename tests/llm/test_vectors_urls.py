"""URL filters, hard negatives and centroid clustering against plain versions
over awkward inputs: nulls, empty and very long values, ties, repeated rows, one
very common vector, empty tables, extra columns."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import centroids, hard_negatives, url_filter
from tidemark.session import ship_package

EMBEDDINGS = "vec_id long, embedding array<float>, label int, extra string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# --------------------------------------------------------------------------- urls

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("net", "", "block"),
         ("a.net", "/x/y", "allow"), ("a.net", "/x/yz/", "block"), ("twice.io", "/", "allow"),
         ("twice.io", "/", "block")]
URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/148.html", "http://notexample.org/es/",
        "http://example.org", "http://example.org?x=/es/", "http://example.org/es",
        "http://b.com/fr/", "http://b.com/fr", "x://com/de/?q", "http://u.net", "http://a.net/x/yz",
        "http://a.net/x/yz/k", "http://q.a.net/x/", "http://twice.io/1", "no scheme", "", None, "://",
        "http://" + "l." * 3000 + "org/" + "s/" * 20000, "http://example.org:80/es/",
        "http://example.org./es/", "http://a.example.org/es/1", "http://ÄB.com/de/ü#f"]


def plain_verdict(url, rules, default):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:] if rest[cut:cut + 1] == "/" else ""
        path = path.split("?")[0].split("#")[0]
    fits = [(len(h.split(".")) if h else 0, len(p), v == "block", h + p) for h, p, v in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    best = max(fits)
    return host, path, best[3], "block" if best[2] else "allow"


@pytest.mark.parametrize("trie_bytes", [1 << 20, 150])
def test_urls_against_every_rule(spark, trie_bytes):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)],
                                  "page_id long, url string, path string").repartition(3)
    got = url_filter.judge(pages, url_filter.rule_table(spark, RULES), default="allow",
                           trie_bytes=trie_bytes)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert {r.page_id: tuple(r)[2:] for r in got.collect()} == {
        i: plain_verdict(u, RULES, "allow") for i, u in enumerate(URLS)}


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/"), (1, "http://a.b/")], "page_id long, url string")
    none = url_filter.rule_table(spark, [])
    assert [r.verdict for r in url_filter.judge(pages, none, default="block").collect()] == \
        ["block", "block"]
    assert url_filter.judge(pages.limit(0), none).count() == 0
    with pytest.raises(ValueError, match="not a rule"):
        url_filter.judge(pages, url_filter.rule_table(spark, [("a", None, "allow")]))


def test_allowed_pages_keep_their_columns(spark):
    pages = spark.createDataFrame([(1, "http://x.com/de/", "a"), (2, "http://x.com/fr/", "b"),
                                   (3, None, None)], "page_id long, url string, verdict string")
    kept = url_filter.allowed(pages, url_filter.rule_table(spark, RULES))
    assert kept.columns == pages.columns
    assert sorted(map(tuple, kept.collect()), key=str) == [(2, "http://x.com/fr/", "b"),
                                                           (3, None, None)]


# --------------------------------------------------------------------------- hard negatives

def awkward_embeddings(n=900, dim=6):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-4, 5, dim) / 8).tolist(), int(rng.integers(0, 10)), "x")
            for i in range(n)]
    common = [0.5] * dim
    rows += [(n + i, common, i % 10, "x") for i in range(n // 2)]          # one very common vector
    rows += [rows[0], rows[100], rows[101]]                                # repeated rows
    rows += [(700, [0.25] * dim, 3, "x"), (200, common, 4, "x")]           # ids on other vectors
    rows += [(5000, None, 1, "x"), (5100, [1.0] * dim, None, "x"), (5200, [None] * dim, 1, "x"),
             (5300, [float("nan")] * dim, 1, "x"), (5400, [float("inf")] * dim, 1, "x"),
             (None, [0.75] * dim, 2, "x"), (5500, [1.0, 0.5], 2, "x"), (5501, [1.0, 0.5], 2, "x"),
             (5503, [0.5, 0.5], 3, "x"), (5600, [], 1, "x"), (5601, [], 1, "x")]
    return rows


def plain_negatives(rows):
    kept = set()
    for i, v, label, _ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        kept.add((i, label, tuple(math.floor(256 * x) for x in v)))
    last = (1 << 63) - 1
    out = []
    for a, la, va in kept:
        if a is None or a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), last if i is None else i, label)
                        for i, label, v in kept if len(v) == len(va))
        for ps, p, _ in [s for s in scored if s[2] == la and s[1] != a][:5]:
            fits = [s for s in scored if s[2] != la and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:10]
            out += [(a, None if p == last else p, rank + 1, None if i == last else i, -ps, -ns)
                    for rank, (ns, i, _) in enumerate(fits)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [8 << 20, 300])
def test_negatives_against_all_scores(spark, block_bytes):
    rows = awkward_embeddings()
    got = hard_negatives.mine(spark.createDataFrame(rows, EMBEDDINGS).repartition(5), block_bytes)
    assert sorted(map(tuple, got.collect()), key=str) == plain_negatives(rows)


def test_negatives_of_an_empty_table(spark):
    assert hard_negatives.mine(spark.createDataFrame([], EMBEDDINGS)).count() == 0
    some = spark.createDataFrame([(1, [0.5], 1, "x"), (None, [0.5], 1, "x")], EMBEDDINGS)
    assert hard_negatives.mine(some).count() == 0


def test_boxes_hold_their_rows_and_prune():
    rng = np.random.default_rng(1)
    m = np.concatenate([rng.integers(-20, 20, (1500, 4)) + shift for shift in (0, 400, -400)])
    ids, labels = np.arange(len(m)), np.zeros(len(m), np.int64)
    tree = hard_negatives.Tree(dict(zip(hard_negatives.TREE_NAMES,
                                        hard_negatives.pack(m, ids, labels))))
    for lo, hi, a, b in zip(*tree.boxes[0], tree.starts[:-1], tree.starts[1:]):
        assert b - a <= hard_negatives.LEAF
        assert (tree.vectors[a:b] >= lo).all() and (tree.vectors[a:b] <= hi).all()
    assert sorted(map(tuple, tree.vectors)) == sorted(map(tuple, m))
    query = hard_negatives.Queries(np.array([[1, 1, 1, 1]]), np.array([-1]), labels[:1],
                                   np.zeros(1, np.int64), np.array([hard_negatives.FLOOR]),
                                   np.array([1 << 62]), 5, True)
    best = hard_negatives.Best(1, 5)
    read = query.search(tree, np.arange(1), np.arange(1), best)
    want = sorted(zip(-m.sum(1), ids))[:5]
    assert list(zip(-best.score[0], best.id[0])) == want
    assert read < len(tree.starts) / 4


def test_large_components_stay_exact(spark):
    big = float((1 << 27) // 256 - 1)
    rows = [(100, [big, 1.0], 1, "x"), (1, [big, 2.0], 1, "x"), (2, [big / 2, 1.0], 2, "x"),
            (3, [big / 2, 1.0 + 1 / 256], 2, "x")]
    got = hard_negatives.mine(spark.createDataFrame(rows, EMBEDDINGS)).collect()
    assert sorted(map(tuple, got), key=str) == plain_negatives(rows) and got
    with pytest.raises(Exception, match="beyond"):
        hard_negatives.mine(spark.createDataFrame([(1, [1e30], 1, "x")], EMBEDDINGS))


# --------------------------------------------------------------------------- clustering

def plain_clusters(rows, dim=64, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _, _ in rows
            if v is not None and len(v) == dim
            and all(x is not None and math.isfinite(x) for x in v)]
    def digest(i):
        return (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        who = [nearest(v)[1] for _, v in kept]
        centres = [[sum(col) // len(col) for col in zip(*[v for (_, v), w in zip(kept, who) if w == j])]
                   or c for j, c in enumerate(centres)]
    got = [(i, *nearest(v)) for i, v in kept]
    each = {j: sum(d for _, d, w in got if w == j) for _, _, j in got}
    return sorted(((i, j, d, each[j], sum(each.values()),
                    hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest())
                   for i, d, j in got), key=str)


def clustered(df):
    return sorted((tuple(r) for r in centroids.cluster_digests(df).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256").collect()), key=str)


def test_clusters_against_plain_rounds(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.2, 64).tolist(), 0, "x") for i in range(150)]
    rows += [(1000 + i, [0.3] * 64, 0, "x") for i in range(60)]  # one very common vector
    rows += [(2000 + i, (rng.integers(0, 2, 64) / 64).tolist(), 0, "x") for i in range(30)]
    rows += [rows[3], rows[3], (None, [0.1] * 64, 0, "x"), (7, [0.2] * 64, 0, "x"),
             (3000, [0.1] * 63, 0, "x"), (3001, None, 0, "x"), (3002, [None] + [0.0] * 63, 0, "x"),
             (3003, [float("-inf")] * 64, 0, "x"), (3004, [], 0, "x")]
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], a, b)
            for i, v, a, b in rows]
    assert clustered(spark.createDataFrame(rows, EMBEDDINGS).repartition(4)) == plain_clusters(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(i, [float(i)] * 64, 0, "x") for i in range(n)]
    assert clustered(spark.createDataFrame(rows, EMBEDDINGS)) == plain_clusters(rows)


def test_bounds_never_pass_the_distance():
    rng = np.random.default_rng(3)
    m = rng.integers(-300, 300, (400, 20)) * rng.integers(1, 40, 20)
    rotation = centroids.Rotation(len(m), m.sum(0), m.T @ m, 5)
    centres = centroids.Centroids(m[:9], rotation)
    exact = ((m[:, None] - m[None, :9]) ** 2).sum(2)
    lead, rest = rotation.apply(m.astype(float))
    assert (centres.bounds(lead, rest) <= exact).all()
    who, best, computed = centres.nearest(m, lead, rest)
    assert (who == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert computed < exact.size / 2

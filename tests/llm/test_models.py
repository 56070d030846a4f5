"""The fitted models against plain versions: the ordinal likelihood's slopes and
severity order, a walk of every tree node by node, and the first split by trying all."""

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import quality, toxicity
from tidemark.session import ship_package


def plain_likelihood(rows, grade, w, cut):
    """Mean penalised log-likelihood by loops; ``rows``: lists of (feature, value)."""
    theta = [cut[0]]
    for gap in cut[1:]:
        theta.append(theta[-1] + np.exp(gap))
    total = 0.0
    for row, g in zip(rows, grade):
        z = sum(w[f] * v for f, v in row)
        above = [1.0] + [1 / (1 + np.exp(t - z)) for t in theta] + [0.0]
        total += np.log(above[g] - above[g + 1])
    return total / len(rows) - toxicity.L2 * sum(x * x for x in w) / 2 / len(rows)


def test_slopes_of_the_ordinal_likelihood():
    rng = np.random.default_rng(4)
    rows = [[(f, rng.random() + 0.1) for f in rng.choice(7, 3, replace=False)] for _ in range(25)]
    grade = rng.integers(0, toxicity.GRADES, 25)
    r = np.repeat(np.arange(25), 3)
    f, v = (np.array([x[i] for row in rows for x in row]) for i in (0, 1))
    w, cut = rng.random(7), np.array([0.4, -0.3, 0.2])
    gw, gc = toxicity._slopes(r, f, v, grade, 25, 7, w, cut)
    step = 1e-5
    for params, slopes in ((w, gw), (cut, gc)):
        for i in range(len(params)):
            params[i] += step
            up = plain_likelihood(rows, grade, w, cut)
            params[i] -= 2 * step
            down = plain_likelihood(rows, grade, w, cut)
            params[i] += step
            assert slopes[i] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def worded(rng, bad, n=60):
    words = [f"plain{i}" for i in rng.integers(0, 40, n)]
    return " ".join(words + [f"nasty{i}" for i in rng.integers(0, 6, bad)])


def test_severity_follows_the_amount_of_toxic_wording(spark):
    """On rows that were not learned from: clean ones below toxic ones, and more
    toxic wording above less, over the same shared weights."""
    ship_package(spark)
    rng = np.random.default_rng(6)
    bad = [0 if i % 3 else int(rng.choice([1, 4, 16])) for i in range(900)]
    docs = spark.createDataFrame([(i, worded(rng, b)) for i, b in enumerate(bad)],
                                 "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1, int(b > 0)) for i, b in enumerate(bad)],
                                   "doc_id long, quality int, toxic int")
    got = [r for r in toxicity.score_toxicity(docs, labels).collect() if r.held_out]
    by = {b: np.array([r.severity for r in got if bad[r.doc_id] == b]) for b in (0, 1, 4, 16)}
    assert all(len(x) >= 5 for x in by.values())
    assert by[0].mean() < by[1].mean() < by[4].mean() < by[16].mean()
    assert by[0].max() < by[4].min() and by[1].max() < by[16].min()
    right = sum(r.predicted == int(bad[r.doc_id] > 0) for r in got)
    assert right >= 0.97 * len(got)


def test_every_sure_feature_is_kept():
    """More surely toxic words than the former 4,096: none is dropped."""
    rng = np.random.default_rng(2)
    codes = [np.unique(rng.integers(0, 9000, 700)).astype(np.uint64) + np.uint64(10**6)
             for _ in range(300)]
    rows = [(1, c, np.ones(len(c), np.int64)) for c in codes]
    rows += [(0, np.arange(50, dtype=np.uint64), np.ones(50, np.int64)) for _ in range(300)]
    model = toxicity.fit(rows)
    assert len(model.codes) > 8000
    assert (model.above(pa.array(["", None])) > 0).all()


def walk(trees, x):
    total = trees.base
    for root in trees.roots:
        node, steps = int(root), 0
        while trees.left[node] != node:
            node = int(trees.left[node] if x[trees.feature[node]] <= trees.threshold[node]
                       else trees.right[node])
            steps += 1
        assert steps <= trees.depth
        total += trees.value[node]
    return 1 / (1 + np.exp(-total))


def data(n=400, k=5):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(n, k))
    x[:, 3] = np.round(x[:, 3])  # ties
    y = ((x[:, 0] + x[:, 1] * x[:, 2] > 0) ^ (rng.random(n) < 0.05)).astype(float)
    return x, y


def test_flat_trees_against_a_walk():
    x, y = data()
    trees = quality.fit(x[:300], y[:300], trees=20)
    got = trees.score(x[300:])
    assert got == pytest.approx([walk(trees, row) for row in x[300:]])
    assert ((got >= 0.5) == y[300:]).mean() > 0.8


def test_first_split_is_the_best_of_all():
    x, y = data()
    trees = quality.fit(x, y, trees=1, depth=1, rate=1.0, l2=1.0)
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = p - y, np.full(len(y), p * (1 - p))

    def half(mask):
        return g[mask].sum() ** 2 / (h[mask].sum() + 1.0)

    best = max((half(x[:, j] <= c) + half(x[:, j] > c), j, c)
               for j in range(x.shape[1])
               for c in np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality.BINS)[1:-1]))
               if min(h[x[:, j] <= c].sum(), h[x[:, j] > c].sum()) >= 1.0)
    root = int(trees.roots[0])
    assert (trees.feature[root], trees.threshold[root]) == (best[1], best[2])
    for child, mask in ((trees.left[root], x[:, best[1]] <= best[2]),
                        (trees.right[root], x[:, best[1]] > best[2])):
        assert trees.value[child] == pytest.approx(-g[mask].sum() / (h[mask].sum() + 1.0))

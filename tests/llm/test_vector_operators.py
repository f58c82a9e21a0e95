"""Exact top-k and hard negatives against brute force, with odd rows and skewed lengths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives, topk
from ledgerloom.llm.vectors import NONE, BestLists, products

SCHEMA = "vec_id long, embedding array<double>, label int, score int, row string"


def made(seed=0, n=240, dim=6, spread=2.0):
    """Clusters of very different lengths, exact copies and near copies."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    x = centres[rng.integers(0, 8, n)] + 0.2 * rng.normal(size=(n, dim))
    x *= np.exp(spread * rng.normal(size=(n, 1)))
    x[n // 2 : n // 2 + 60] = x[0]
    x[n // 2 + 30 : n // 2 + 60] += 0.01 * rng.normal(size=(30, dim))
    return [(i, [float(v) for v in x[i]], int(rng.integers(0, 3)), 7, "r") for i in range(n)]


ODD = [
    (1000, None, 1, 7, "r"), (1001, [1.0, None], 1, 7, "r"), (1002, [float("nan"), 1.0], 1, 7, "r"),
    (1003, [float("inf")], 1, 7, "r"), (None, [1.0, 2.0], 1, 7, "r"), (1020, [], 1, 7, "r"), (1040, [3.0], 2, 7, "r"),
    (1100, [0.0] * 6, 0, 7, "r"), (1200, [-1.0] * 6, 1, 7, "r"), (1300, [1e4] * 6, 2, 7, "r"), (40, [1.5] * 6, 2, 7, "r"),
    (1400, [1.0] * 6, None, 7, "r"),
]


def usable(data, scale):
    out = []
    for vec_id, x, label, *_ in data:
        if vec_id is not None and x is not None and all(v is not None and np.isfinite(v) for v in x):
            whole = [int(np.floor(v * scale)) for v in x]
            out.append((vec_id, np.array(whole + [0] * (6 - len(whole)), object), label))
    return out


def brute_top_k(data, k, scale):
    rows, want = usable(data, scale), []
    for i, (q, x, _) in enumerate(rows):
        if q % 20 == 0:
            found = sorted((-int(x @ y), c) for j, (c, y, _) in enumerate(rows) if j != i)[:k]
            want += [(q, r, c, -s) for r, (s, c) in enumerate(found, 1)]
    return sorted(want)


@pytest.mark.parametrize("bucket_rows, run_buckets, k", [(16, 2, 5), (1024, 16, 20), (7, 1, 3)])
def test_top_k_by_brute_force(spark, rows, bucket_rows, run_buckets, k):
    data = made() + ODD
    got = topk.top_k(rows(SCHEMA, data), F.col("vec_id") % 20 == 0, k, bucket_rows=bucket_rows, run_buckets=run_buckets)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top_k(data, k, 64)


def test_both_prunings_are_used_and_exact():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 8))
    x *= 800 / np.linalg.norm(x, axis=1, keepdims=True) * np.exp(0.03 * rng.normal(size=(4000, 1)))
    x[2000:] *= 0.2
    x[:2000:4] = x[0] + rng.normal(size=(500, 8))
    x = np.round(x).astype(np.int64)
    x = x[np.argsort(-(x.astype(float) ** 2).sum(axis=1), kind="stable")]
    lengths = np.sqrt((x.astype(float) ** 2).sum(axis=1))

    def block(at, number):
        at = np.asarray(at)
        return topk.packed(x[at], at, at) | {
            "block": number, "lengths": lengths[at].tobytes(), "floors": np.full(len(at), NONE, "<i8").tobytes()
        }

    asked = np.arange(0, 4000, 50)
    buckets = [block(np.arange(a, a + 250), a // 250) for a in range(0, 4000, 250)]
    best, rows, _, done = topk.search_cell(block(asked, 0), buckets[::-1], 5)
    s = products(x[asked], x).astype(np.int64)
    for i, q in enumerate(asked):
        order = [j for j in np.lexsort((np.arange(4000), -s[i])) if j != q][:5]
        mine = best.owner == i
        assert best.row[mine].tolist() == order and best.score[mine].tolist() == s[i][order].tolist()
    assert rows.tolist() == asked.tolist()
    # most products are never computed, and coordinates find some of the rest
    assert 0 < done["coordinate"] and done["length"] + done["coordinate"] < 0.5 * s.size


def brute_negatives(data, positives, negatives):
    rows, want = [r for r in usable(data, 256) if r[2] is not None], []
    for i, (a, x, label) in enumerate(rows):
        if a % 20:
            continue
        scored = sorted((-int(x @ y), c, lab) for j, (c, y, lab) in enumerate(rows) if j != i)
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            inside = [(t, c) for t, c, lab in scored if lab != label and -80 * s <= -100 * t <= -100 * s][:negatives]
            want += [(a, p, rank, c, -s, -t) for rank, (t, c) in enumerate(inside, 1)]
    return sorted(want)


@pytest.mark.parametrize("tree_rows, spread", [(16, 0.3), (1024, 0.3), (40, 1.5)])
def test_hard_negatives_by_brute_force(spark, rows, tree_rows, spread):
    data = made(seed=3, spread=spread) + ODD
    got = hard_negatives.mine(rows(SCHEMA, data), F.col("label"), F.col("vec_id") % 20 == 0, tree_rows=tree_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(data, 5, 5)
    assert sorted(map(tuple, got.collect())) == want and want


def test_cover_tree_covers_and_separates():
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(500, 5)) * 300).astype(np.int64)
    x[100:300] = x[0]
    norm2 = float((x.astype(float) ** 2).sum(axis=1).max())
    at = np.arange(500)
    tree = hard_negatives.CoverTree.build(x, at, at, at % 3, norm2)
    tree = hard_negatives.CoverTree.unpack(tree.pack())
    more = np.sqrt(norm2 - (tree.x.astype(float) ** 2).sum(axis=1))
    points = np.column_stack([tree.x, more])
    assert sorted(tree.rows.tolist()) == at.tolist()
    for i in range(len(tree.radius)):
        own = points[tree.first[i] : tree.last[i]]
        assert np.linalg.norm(own - points[tree.centre[i]], axis=1).max() <= tree.radius[i] + 1e-3
        children = np.arange(tree.child[i], tree.child[i] + tree.children[i])
        if len(children):
            assert tree.first[children].min() == tree.first[i] and tree.last[children].max() == tree.last[i]
            assert (tree.radius[children] <= tree.radius[i] / hard_negatives.BASE + 1e-3).all()
            centres = points[tree.centre[children]]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(children)) * 1e9
            assert apart.min() >= tree.radius[i] / hard_negatives.BASE - 1e-3


def test_descent_skips_nodes_outside_the_windows():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 4)) * 400
    x = np.round(centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 4)) * 4).astype(np.int64)
    norm2 = float((x.astype(float) ** 2).sum(axis=1).max())
    at = np.arange(3000)
    trees = [hard_negatives.CoverTree.build(x[i::3], at[i::3], at[i::3], at[i::3] % 2, norm2) for i in range(3)]
    high = np.array([[int(x[i] @ x[i])] for i in range(20)])
    search = hard_negatives.Descent(x[:20], at[:20], at[:20] % 2, high, high * 8 // 10, norm2, 5, same_label=False)
    best = search.run(trees)
    for i in range(20):
        s = x @ x[i]
        inside = [j for j in np.lexsort((at, -s)) if j % 2 != i % 2 and high[i, 0] * 8 // 10 <= s[j] <= high[i, 0]][:5]
        assert best.row[best.owner == i].tolist() == inside
    assert search.verified < 0.2 * 20 * 3000


def test_empty_tables(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 20 == 0, 5).collect() == []
    assert hard_negatives.mine(empty, F.col("label"), F.col("vec_id") % 20 == 0).collect() == []
    alone = rows(SCHEMA, [(0, [1.0, 2.0], 1, 7, "r")], 1)
    assert topk.top_k(alone, F.col("vec_id") % 20 == 0, 5).collect() == []
    assert hard_negatives.mine(alone, F.col("label"), F.col("vec_id") % 20 == 0).collect() == []


def test_products_are_exact_at_every_size():
    for most in (3, 3000, 2**30):
        a = np.array([[most, -most, 1]], np.int64)
        assert int(products(a, a)[0, 0]) == 2 * most * most + 1
    assert products(np.array([[2, 3]]), np.array([[5]]))[0, 0] == 10


def test_best_lists_keep_ties_by_id():
    best = BestLists(2, 2)
    last = best.offer(np.array([0, 0, 0, 1]), np.array([5, 5, 9, 1]), np.array([8, 3, 4, 1]), np.array([0, 1, 2, 3]))
    assert best.id.tolist() == [4, 3, 1] and last.tolist() == [5, NONE]
    best.offer(np.array([0]), np.array([5]), np.array([2]), np.array([4]))
    assert best.id.tolist() == [4, 2, 1]

"""The exact tree: every distinct value is a candidate, at any size; text and node table."""

import itertools
import random
import re

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerloom.plans import ml, tree


def frame(spark, rows, parts=3):
    """Rows of (features..., label) as a training table."""
    n = len(rows[0]) - 1 if rows else 1
    schema = ", ".join(f"f{i} double" for i in range(n)) + ", label double"
    df = spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)
    return df.withColumn("features", array_to_vector(F.array(*(f"f{i}" for i in range(n)))))


def brute(rows, depth, node=1):
    """Nodes of the exact tree: {id: (feature, threshold, counts)}."""
    classes = max(int(r[-1]) for r in rows) + 1 if node == 1 else brute.classes
    brute.classes = classes
    counts = [sum(r[-1] == k for r in rows) for k in range(classes)]
    gini = lambda part: 1 - sum((sum(r[-1] == k for r in part) / len(part)) ** 2 for k in range(classes))
    found = []
    if depth and sum(c > 0 for c in counts) > 1:
        for f in range(len(rows[0]) - 1):
            values = sorted({r[f] for r in rows})
            for a, b in itertools.pairwise(values):
                low, high = [r for r in rows if r[f] <= a], [r for r in rows if r[f] > a]
                gain = gini(rows) - len(low) / len(rows) * gini(low) - len(high) / len(rows) * gini(high)
                if gain > 1e-12:
                    found.append((-round(gain, 12), f, (a + b) / 2, low, high))
    if not found:
        return {node: (None, None, counts)}
    _, f, threshold, low, high = min(found, key=lambda s: s[:3])
    return {node: (f, threshold, counts), **brute(low, depth - 1, 2 * node), **brute(high, depth - 1, 2 * node + 1)}


@pytest.mark.parametrize("seed, classes", [(1, 2), (2, 4)])
def test_nodes_by_brute_force(spark, seed, classes):
    rng = random.Random(seed)
    rows = [(float(rng.randint(0, 9)), rng.random(), -0.0 if i % 2 else 0.0, float(rng.randint(0, classes - 1))) for i in range(150)]
    # a value and a whole row that most rows share
    rows += [(3.0, 0.5, 0.0, 1.0)] * 120 + [(3.0, rng.random(), 0.0, 0.0) for _ in range(60)]
    model = ml.fit_tree(frame(spark, rows), max_depth=3)
    want = brute(rows, 3)
    assert {i: (n.feature, n.threshold, n.counts) for i, n in model.nodes.items()} == want
    table = {r["node"]: r for r in ml.model_rows(model, spark).collect()}
    assert set(table) == set(want)
    for i, r in table.items():
        assert (r["left_node"], r["right_node"]) == ((None, None) if r["feature"] is None else (2 * i, 2 * i + 1))
        assert r["rows"] == sum(r["counts"]) and r["depth"] == i.bit_length() - 1
    scored = model.transform(frame(spark, rows)).collect()
    for r in scored:
        node = 1
        while want[node][0] is not None:
            f, threshold, _ = want[node]
            node = 2 * node + (r[f"f{f}"] > threshold)
        assert r["prediction"] == float(want[node][2].index(max(want[node][2])))


@pytest.mark.parametrize("n", [9_000, 400_000])
def test_a_rare_band_is_found_at_every_size(spark, n):
    """20 rows have their own value and label; a sample of candidates would miss the split between them and the rest."""
    df = spark.range(n).select(
        F.when(F.col("id") < 20, 5.5).otherwise((F.col("id") % 5).cast("double")).alias("f0"),
        (F.col("id") < 20).cast("double").alias("label"),
    )
    train = df.withColumn("features", array_to_vector(F.array("f0")))
    model = ml.fit_tree(train, max_depth=2)
    assert (model.nodes[1].feature, model.nodes[1].threshold) == (0, 4.75)
    assert model.transform(train).where("label = 1 AND prediction = 1").count() == 20


def test_many_distinct_values_are_all_candidates(spark):
    """The best threshold lies between two of 50,000 values."""
    df = spark.range(50_000).select(F.col("id").cast("double").alias("f0"), (F.col("id") >= 31_415).cast("double").alias("label"))
    train = df.withColumn("features", array_to_vector(F.array("f0")))
    model = ml.fit_tree(train)
    assert set(model.nodes) == {1, 2, 3} and model.nodes[1].threshold == 31_414.5
    assert ml.accuracy_frame(model.transform(train)).first()["accuracy"] == 1.0


def test_text_equals_the_binned_tree(spark):
    """On few distinct values both trainers see all candidates."""
    rows = [(float(a), float(b), float((a > 3) ^ (b > 1)) if a != 7 else 0.0) for a in range(8) for b in range(4)]
    train = frame(spark, rows)
    exact, binned = ml.fit_tree(train, max_depth=3), ml.fit_tree(train, max_depth=3, max_bins=32)
    text = ml.model_text(exact)
    body = lambda t: [re.sub(r"[{}]", "", line) for line in t.splitlines()[1:]]
    assert text.startswith("DecisionTreeClassificationModel: depth=")
    assert f"numNodes={len(exact.nodes)}, numClasses=2, numFeatures=2" in text
    # the binned tree joins sibling leaves of one prediction; their lines are in both
    assert set(body(binned.toDebugString)) <= {*body(text), *(b[1:] for b in body(text))} | {line[2:] for line in body(text)}
    assert ml.accuracy_frame(exact.transform(train)).first() == ml.accuracy_frame(binned.transform(train)).first()


def test_exact_text(spark):
    rows = [(0.0, 1.0, 0.0), (0.0, 2.0, 1.0), (1.0, 1.0, 1.0), (1.0, 2.0, 1.0), (1.0, 3.0, 1.0)]
    assert ml.model_text(ml.fit_tree(frame(spark, rows), max_depth=2)) == (
        "DecisionTreeClassificationModel: depth=2, numNodes=5, numClasses=2, numFeatures=2\n"
        "  If (feature 0 <= 0.5)\n   If (feature 1 <= 1.5)\n    Predict: 0.0\n   Else (feature 1 > 1.5)\n    Predict: 1.0\n"
        "  Else (feature 0 > 0.5)\n   Predict: 1.0\n"
    )


def test_edges(spark):
    one = ml.fit_tree(frame(spark, [(1.0, 0.0)] * 3))
    assert set(one.nodes) == {1} and one.nodes[1].prediction == 0.0
    empty = ml.fit_tree(frame(spark, []))
    assert empty.nodes[1].prediction == 0.0 and "Predict: 0.0" in empty.text()
    assert empty.transform(frame(spark, [(1.0, 1.0)])).first()["prediction"] == 0.0
    tie = ml.fit_tree(frame(spark, [(1.0, 1.0), (1.0, 0.0)]))
    assert tie.nodes[1].prediction == 0.0 and len(tie.nodes) == 1
    inf = float("inf")
    odd = ml.fit_tree(frame(spark, [(-inf, 0.0), (1.0, 0.0), (inf, 1.0), (float("nan"), 1.0)]))
    assert odd.nodes[1].threshold == 1.0
    assert [r["prediction"] for r in odd.transform(frame(spark, [(5.0, 0.0), (1.0, 0.0)], 1)).sort("f0").collect()] == [0.0, 1.0]
    # two neighbouring doubles have no number between them
    a = 1.0 + 2**-52
    near = ml.fit_tree(frame(spark, [(1.0, 0.0), (a, 1.0)]))
    assert near.nodes[1].threshold == 1.0
    # the two gains are equal: the smaller feature wins
    both = ml.fit_tree(frame(spark, [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)]))
    assert both.nodes[1].feature == 0
    for bad in ([(1.0, 0.5)], [(1.0, -1.0)], [(1.0, None)], [(1.0, 1e6)]):
        with pytest.raises(ValueError):
            tree.fit(frame(spark, bad))
    assert ml.fit_tree(frame(spark, [(0.0, 0.0), (1.0, 1.0)]), min_info_gain=0.6).nodes.keys() == {1}


def test_small_blocks_give_the_same_tree(spark, monkeypatch):
    """Blocks far smaller than a value's rows, and nodes that skip blocks."""
    rng = random.Random(7)
    rows = [(float(rng.randint(0, 40)), round(rng.random(), 2), float(rng.randint(0, 2))) for _ in range(900)]
    rows += [(7.0, rng.random(), float(rng.randint(0, 1))) for _ in range(900)]
    want = {i: (n.feature, n.threshold, n.counts) for i, n in ml.fit_tree(frame(spark, rows), max_depth=4).nodes.items()}
    assert want == brute(rows, 4)
    packer = tree._packer
    monkeypatch.setattr(tree, "BLOCK_BYTES", 1)
    made = []
    monkeypatch.setattr(tree, "_packer", lambda width: made.append(width) or packer(width))
    found = ml.fit_tree(frame(spark, rows), max_depth=4)
    assert made == [2] and {i: (n.feature, n.threshold, n.counts) for i, n in found.nodes.items()} == want


def test_a_level_shuffles_no_rows(spark, monkeypatch):
    """Only node and block sums are shuffled: the plan of a level has no exchange above the cells but those of the sums."""
    from ledgerloom.operators.layout import plan_rows

    blocks, sides, kept = [], [], tree.written_side
    monkeypatch.setattr(tree, "written_side", lambda df, path: sides.append(df) or kept(df, path))
    packed = tree._blocks
    monkeypatch.setattr(tree, "_blocks", lambda cells, width: blocks.append(packed(cells, width)) or blocks[-1])
    df = spark.range(60_000).select((F.col("id") * 7 % 60_000).cast("double").alias("f0"), (F.col("id") % 3).cast("double").alias("label"))
    ml.fit_tree(df.withColumn("features", array_to_vector(F.array("f0"))), max_depth=2)
    assert blocks[0].count() < 60 and blocks[0].agg(F.sum("rows")).first()[0] == 60_000
    ran = [r["operator"] for r in plan_rows(sides[1]).sort("position").collect()]
    below = ran[max(i for i, name in enumerate(ran) if name == "Exchange") :]
    assert any("Arrow" in name for name in below), ran

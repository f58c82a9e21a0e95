"""An exact decision tree for classification, fitted level by level with DataFrame jobs.

Every distinct value of every feature is a split candidate at any table size; nothing is
sampled or binned.

* The training rows become distinct (features, label) rows with their counts, once for
  each feature, range-partitioned by (feature, value, row), sorted, and written as packed
  blocks of at most ``BLOCK_BYTES``: the only shuffle of rows.  A value held by a third of
  the rows spans several blocks.
* A level reads the blocks twice and shuffles no row: class counts per node and block, one
  row each, whose running sums are what lies before a block; then the gains of all
  candidates of a block from running sums inside it.  No task needs a whole node, feature
  or value.
* The best split of each node comes back to the driver, at most ``2 ** level`` rows.

Impurity is Gini.  A split is kept if its gain is over 1e-12 and at least
``min_info_gain``; gains that agree in 12 digits are a tie, which goes to the smaller
feature number, then the smaller threshold.  The threshold is the middle of two
neighbouring values, or the lower one where no number lies between; a value at the
threshold goes left.  A leaf predicts its most frequent label, the smallest on ties.
Equal predictions of two sibling leaves are not merged.

Labels are whole numbers from 0, at most ``MOST_CLASSES``.  NaN sorts as the greatest
value.  A null feature or label makes the fit fail.  An empty table gives one leaf that
predicts 0.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.layout import broadcast_if_small, written_side
from ledgerloom.session import scratch_path

# counts of all classes travel with every value
MOST_CLASSES = 100
# at most 2 ** (MOST_DEPTH + 1) nodes on the driver
MOST_DEPTH = 12
LEAST_GAIN = 1e-12
# gains are compared in 12 digits: the best one is among those this near to the greatest
NEAR_GAIN = 1e-11
# cells of a block, over all features
BLOCK_BYTES = 512 * 1024
# row groups of some tens of MB: a task holds one of them
BLOCK_WRITER = {"parquet.block.size": str(32 * 1024 * 1024), "parquet.enable.dictionary": "false"}
BLOCK_COLUMNS = ["block", "feature", "rows", "cells", "labels", "n"]
BLOCK_SCHEMA = "block long, feature int, rows int, cells binary, labels binary, n binary"
COUNT_SCHEMA = "block long, feature int, node long, counts array<long>, first_x double"
SPLIT_SCHEMA = "node long, feature int, x double, next_x double, left array<long>, all array<long>"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
BLOCK_ARROW, COUNT_ARROW, SPLIT_ARROW = (
    pa.schema([(name, _ARROW[kind]) for name, kind in (field.split(" ") for field in schema.split(", "))])
    for schema in (BLOCK_SCHEMA, COUNT_SCHEMA, SPLIT_SCHEMA)
)

NODE_SCHEMA = (
    "node long, depth int, feature int, threshold double, gain double, left_node long, right_node long, "
    "rows long, counts array<long>, prediction double"
)


@dataclass
class Node:
    """Node ``id`` has the children ``2 * id`` and ``2 * id + 1``; a leaf has no feature."""

    id: int
    counts: list[int]
    feature: int | None = None
    threshold: float | None = None
    gain: float | None = None

    @property
    def depth(self) -> int:
        return self.id.bit_length() - 1

    @property
    def prediction(self) -> float:
        return float(self.counts.index(max(self.counts))) if self.counts else 0.0


@dataclass
class TreeModel:
    """A fitted tree: scores tables, prints as text, and reads as a table of nodes."""

    nodes: dict[int, Node]
    features: str = "features"
    n_features: int = 0

    def _expression(self, values: Column, leaf, node: int = 1) -> Column:
        n = self.nodes[node]
        if n.feature is None:
            return leaf(n)
        below = F.get(values, F.lit(n.feature)) <= F.lit(n.threshold)
        return F.when(below, self._expression(values, leaf, 2 * node)).otherwise(self._expression(values, leaf, 2 * node + 1))

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """Append the predicted label (a double)."""
        values = vector_to_array(self.features)
        return df.withColumn(prediction, self._expression(values, lambda n: F.lit(n.prediction)))

    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node, the root is 1; leaves have null feature, threshold, gain and children."""
        rows = [
            (n.id, n.depth, n.feature, n.threshold, n.gain, *((None, None) if n.feature is None else (2 * n.id, 2 * n.id + 1)),
             sum(n.counts), n.counts, n.prediction)
            for n in sorted(self.nodes.values(), key=lambda n: n.id)
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def text(self) -> str:
        """The tree as nested conditions, one line each."""
        depth = max(n.depth for n in self.nodes.values())
        lines = [f"DecisionTreeClassificationModel: depth={depth}, numNodes={len(self.nodes)}, "
                 f"numClasses={max(2, len(self.nodes[1].counts))}, numFeatures={self.n_features}"]  # fmt: skip

        def add(node: int, indent: int) -> None:
            n, pad = self.nodes[node], " " * indent
            if n.feature is None:
                lines.append(f"{pad}Predict: {n.prediction}")
                return
            for sign, child in (("If", 2 * node), ("Else", 2 * node + 1)):
                lines.append(f"{pad}{sign} (feature {n.feature} {'<=' if sign == 'If' else '>'} {n.threshold})")
                add(child, indent + 1)

        add(1, 2)
        return "\n".join(lines) + "\n"

    @property
    def toDebugString(self) -> str:  # noqa: N802 - the name that Spark's own models have
        return self.text()


def _written(df: DataFrame, label: str, **options: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _total(columns: list) -> Column | np.ndarray:
    return sum(columns[1:], columns[0])


def _impurity(squares: str, n: str) -> Column:
    """Gini impurity from the sum of the squared class counts and the count of all."""
    return F.lit(1.0) - F.col(squares) / (F.col(n) * F.col(n))


def _packer(width: int):
    """Packs cells sorted by value into blocks of one feature each."""
    most = max(256, BLOCK_BYTES // (8 * width + 9))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a partition is a range of (feature, value): few of them hold more than one feature
        held: dict[int, list[tuple]] = {}
        rows: dict[int, int] = {}
        number = itertools.count()
        part = 0

        def block(feature: int) -> pa.RecordBatch:
            values, labels, n = (np.concatenate(c) for c in zip(*held.pop(feature), strict=True))
            return pa.RecordBatch.from_pylist([{
                "block": (part << 32) + next(number), "feature": feature, "rows": rows.pop(feature),
                "cells": np.ascontiguousarray(values.T).tobytes(), "labels": labels.tobytes(), "n": n.tobytes(),
            }], schema=BLOCK_ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            features = batch.column("feature").to_numpy(zero_copy_only=False)
            columns = (
                batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, width),
                batch.column("label").to_numpy(zero_copy_only=False).astype(np.int8),
                batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64),
            )
            for feature in np.unique(features).tolist():
                at, start = np.flatnonzero(features == feature), 0
                while start < len(at):
                    to = min(len(at), start + most - rows.get(feature, 0))
                    held.setdefault(feature, []).append(tuple(c[at[start:to]] for c in columns))
                    rows[feature], start = rows.get(feature, 0) + to - start, to
                    if rows[feature] == most:
                        yield block(feature)
        for feature in sorted(held):
            yield block(feature)

    return pack


def _blocks(cells: DataFrame, n_features: int) -> DataFrame:
    """The cells once per feature, in the order of (feature, value), packed; the ``block`` numbers of a feature ascend."""
    each = F.explode(F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)), lambda f: F.struct(
        f.alias("feature"), F.get("values", f).alias("x"))))
    long = cells.select("values", "label", "n", each.alias("e")).select("values", "label", "n", "e.feature", "e.x")
    # the cell is part of the order, so that a frequent value can span ranges
    ranged = long.repartitionByRange("feature", "x", F.xxhash64("values", "label")).sortWithinPartitions("x")
    named = ranged.select("values", "label", "n", "feature", F.spark_partition_id().alias("part"))
    return _written(named.mapInArrow(_packer(n_features), BLOCK_SCHEMA), "tree-blocks", **BLOCK_WRITER)


@dataclass
class _Placing:
    """The nodes of a level that are still to be split, for tasks: rows of a block by their node."""

    feature: np.ndarray
    threshold: np.ndarray
    is_open: np.ndarray
    totals: dict[int, list[int]]
    depth: int
    classes: int

    @classmethod
    def of(cls, model: TreeModel, open_nodes: set[int], depth: int, classes: int) -> "_Placing":
        size = 2 << depth
        feature, threshold, is_open = np.full(size, -1), np.zeros(size), np.zeros(size, dtype=bool)
        for n in model.nodes.values():
            if n.feature is not None:
                feature[n.id], threshold[n.id] = n.feature, n.threshold
        is_open[list(open_nodes)] = True
        return cls(feature, threshold, is_open, {i: model.nodes[i].counts for i in open_nodes}, depth, classes)

    def rows(self, block: dict) -> tuple[np.ndarray, ...]:
        """(node, value, label, n) of the rows in open nodes, by node and value."""
        cells = np.frombuffer(block["cells"]).reshape(-1, block["rows"])
        at, row = np.ones(block["rows"], dtype=np.int16), np.arange(block["rows"])
        for _ in range(self.depth):
            feature = self.feature[at]
            # NaN is never below a threshold
            above = ~(cells[np.maximum(feature, 0), row] <= self.threshold[at])
            at = np.where(feature >= 0, 2 * at + above, at).astype(np.int16)
        kept = np.flatnonzero(self.is_open[at])
        # the block is sorted by value and the sort keeps that order inside a node
        kept = kept[np.argsort(at[kept], kind="stable")]
        labels, n = np.frombuffer(block["labels"], dtype=np.int8), np.frombuffer(block["n"], dtype=np.int64)
        return at[kept], cells[block["feature"]][kept], labels[kept], n[kept]

    def count(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Class counts and the first value of every node in a block."""
        for batch in batches:
            found: list[dict] = []
            for block in batch.to_pylist():
                node, x, label, n = self.rows(block)
                starts = np.flatnonzero(np.diff(node, prepend=0))
                for start, end in zip(starts, [*starts[1:], len(node)], strict=True):
                    counts = np.zeros(self.classes, dtype=np.int64)
                    np.add.at(counts, label[start:end], n[start:end])
                    found.append({"block": block["block"], "feature": block["feature"], "node": int(node[start]),
                                  "counts": counts.tolist(), "first_x": float(x[start])})
            yield pa.RecordBatch.from_pylist(found, schema=COUNT_ARROW)

    def search(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best splits of every node in a block: all whose gain is within ``NEAR_GAIN`` of the block's best."""
        for batch in batches:
            found: list[dict] = []
            for block in batch.to_pylist():
                found += self._splits(block)
            yield pa.RecordBatch.from_pylist(found, schema=SPLIT_ARROW)

    def _splits(self, block: dict) -> list[dict]:
        node, x, label, n = self.rows(block)
        # blocks come with the sides of their nodes: there is at least one row
        starts = np.flatnonzero(np.diff(node, prepend=0))
        sides = {s["node"]: s for s in block["sides"]}
        ordered = [sides[int(i)] for i in node[starts]]
        ends = np.append(starts[1:], len(node)) - 1
        following = np.append(x[1:], np.nan)
        has_next = np.ones(len(x), dtype=bool)
        following[ends] = [np.nan if s["following_x"] is None else s["following_x"] for s in ordered]
        has_next[ends] = [s["following_x"] is not None for s in ordered]
        # the same value may go on in the next block: only its last row is a candidate
        greater = (following > x) | (np.isnan(following) & ~np.isnan(x))
        at = np.flatnonzero(has_next & greater)
        if not len(at):
            return []
        segment = np.searchsorted(starts, at, side="right") - 1
        before = np.array([s["before"] for s in ordered], dtype=np.int64)
        alls = np.array([self.totals[s["node"]] for s in ordered], dtype=np.int64)
        left = np.empty((self.classes, len(at)), dtype=np.int64)
        for k in range(self.classes):
            running = np.cumsum(np.where(label == k, n, 0))
            earlier = np.where(starts > 0, running[starts - 1], 0)
            left[k] = running[at] + (before[:, k] - earlier)[segment]
        lefts, totals = list(left.astype(np.float64)), list(alls.astype(np.float64).T[:, segment])
        rights = [a - b for a, b in zip(totals, lefts, strict=True)]
        n_left, n_right, n_all = (_total(c) for c in (lefts, rights, totals))
        impurity = lambda c, of: 1.0 - _total([v * v for v in c]) / (of * of)
        gain = impurity(totals, n_all) - n_left / n_all * impurity(lefts, n_left) - n_right / n_all * impurity(rights, n_right)
        best = np.full(len(starts), -np.inf)
        np.maximum.at(best, segment, gain)
        near = np.flatnonzero((gain >= best[segment] - NEAR_GAIN) & (gain > LEAST_GAIN))
        return [
            {"node": int(node[at[i]]), "feature": block["feature"], "x": float(x[at[i]]), "next_x": float(following[at[i]]),
             "left": left[:, i].tolist(), "all": alls[segment[i]].tolist()}
            for i in near
        ]


def _best_splits(blocks: DataFrame, placing: _Placing) -> list:
    """The best split of every node that has one, with the class counts on its left."""
    classes = placing.classes
    # one row per node and block, at most a row per row of the block
    counted = blocks.select(*BLOCK_COLUMNS).mapInArrow(placing.count, COUNT_SCHEMA)
    group = Window.partitionBy("node", "feature").orderBy("block")
    before = group.rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        "block", "node",
        F.array(*(F.coalesce(F.sum(F.get("counts", F.lit(k))).over(before), F.lit(0)) for k in range(classes))).alias("before"),
        F.lead("first_x").over(group).alias("following_x"),
    )
    sides = offsets.groupBy("block").agg(F.collect_list(F.struct("node", "before", "following_x")).alias("sides"))
    sides, size = written_side(sides, scratch_path(blocks.sparkSession, "tree-sides"))
    searched = blocks.join(broadcast_if_small(sides, size=size)[0], "block").select(*BLOCK_COLUMNS, "sides")
    split = searched.mapInArrow(placing.search, SPLIT_SCHEMA)
    lefts, alls = ([F.get(side, F.lit(k)).cast("double") for k in range(classes)] for side in ("left", "all"))
    rights = [x - y for x, y in zip(alls, lefts, strict=True)]
    parts = {"left": lefts, "right": rights, "all": alls}
    middle = (F.col("x") + F.col("next_x")) / 2
    threshold = F.when((middle >= F.col("x")) & (middle < F.col("next_x")), middle).otherwise(F.col("x"))
    summed = split.select(
        "node", "feature", threshold.alias("threshold"), "left",
        *(F.nullif(_total(c), F.lit(0.0)).alias(f"n_{side}") for side, c in parts.items()),
        *(_total([v * v for v in c]).alias(f"squares_{side}") for side, c in parts.items()),
    )
    part = lambda side: F.col(f"n_{side}") / F.col("n_all") * _impurity(f"squares_{side}", f"n_{side}")
    gain = F.round(_impurity("squares_all", "n_all") - part("left") - part("right"), 12)
    ranked = summed.select("node", "feature", "threshold", "left", gain.alias("gain"))
    first = F.min_by(F.struct("feature", "threshold", "gain", "left"), F.struct(-F.col("gain"), "feature", "threshold"))
    best = ranked.groupBy("node").agg(first.alias("s")).collect()
    return [r for r in best if r["s"]["gain"] > LEAST_GAIN]


def fit(train: DataFrame, max_depth: int = 5, min_info_gain: float = 0.0,
        features: str = "features", label: str = "label") -> TreeModel:
    """The exact Gini tree of ``train`` (a vector column and a label column)."""
    if not 0 <= max_depth <= MOST_DEPTH:
        raise ValueError(f"max_depth must be between 0 and {MOST_DEPTH}")
    values = vector_to_array(features)
    cells = _written(
        train.select(
            # -0.0 and 0.0 are one value
            F.transform(values, lambda v: v + F.lit(0.0)).alias("values"),
            F.col(label).cast("double").alias("label"),
        ).groupBy("values", "label").agg(F.count(F.lit(1)).alias("n")),
        "tree-cells",
    )
    shape = cells.agg(
        F.max(F.size("values")).alias("widest"), F.min(F.size("values")).alias("least"), F.max("label").alias("top"),
        F.count_if(F.col("label").isNull() | F.col("values").isNull() | (F.col("label") < 0) | (F.col("label") % 1 != 0)).alias("bad"),
    ).first()
    if shape["bad"]:
        raise ValueError("labels must be whole numbers from 0, features and labels not null")
    if shape["top"] is None:
        return TreeModel({1: Node(1, [])}, features)
    classes = int(shape["top"]) + 1
    if classes > MOST_CLASSES:
        raise ValueError(f"{classes} classes, at most {MOST_CLASSES} expected")
    if shape["widest"] != shape["least"]:
        raise ValueError("feature vectors of different sizes")
    totals = {int(r["label"]): r["n"] for r in cells.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    model = TreeModel({1: Node(1, [totals.get(k, 0) for k in range(classes)])}, features, shape["widest"])
    if not max_depth or not shape["widest"]:
        return model
    blocks = _blocks(cells, shape["widest"])
    for depth in range(max_depth):
        # a node of one class has nothing to split
        open_nodes = {n.id for n in model.nodes.values() if n.depth == depth and sum(c > 0 for c in n.counts) > 1}
        if not open_nodes:
            break
        for row in _best_splits(blocks, _Placing.of(model, open_nodes, depth, classes)):
            split, parent = row["s"], model.nodes[row["node"]]
            if split["gain"] < min_info_gain:
                continue
            parent.feature, parent.threshold, parent.gain = split["feature"], split["threshold"], split["gain"]
            left = list(split["left"])
            model.nodes[2 * parent.id] = Node(2 * parent.id, left)
            model.nodes[2 * parent.id + 1] = Node(2 * parent.id + 1, [a - b for a, b in zip(parent.counts, left, strict=True)])
    return model

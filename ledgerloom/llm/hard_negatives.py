"""Hard negatives by inner product, from cover trees over norm-augmented candidates.

Every candidate x gets one more component, sqrt(M^2 - |x|^2) with M the greatest
length, so that all lie on a sphere of radius M; a query gets a zero there and keeps
its inner products.  A tree node has a centre c and a covering radius, the greatest
distance of its points from c; the children of a node lie at most 1 / ``BASE`` of its
radius from their own centres, which are farther than that from each other.  A chord of
length r on the sphere is an angle phi = 2 asin(r / 2M), so the products of a query q
with all points of a node lie between |q| M cos(angle(q, c) + phi) and
|q| M cos(angle(q, c) - phi).

A window asks for the first k candidates with scores from ``floor`` to ``high``.  The
descent opens the node with the highest possible score first, for all queries of a
block together; it skips a query's nodes whose bounds lie outside all its windows, and
each window's floor rises to its k-th score as it fills.  Points of leaves are
verified by their exact integer products.

On Spark: candidates go to the nearest of at most ``MOST_PIVOTS`` pivots (rows with the
smallest hashes: a bounded sample that only decides which rows share a tree), and a
pivot's rows are dealt by row hash into trees of about ``TREE_ROWS``, so neither a
repeated vector nor a crowded pivot makes a large tree.  The trees are a written table.
(anchor block, run of trees) cells are searched independently, each returns at most k
rows a window, and one window function per window joins them.  The first search finds
the positives, the second one the negatives under their scores.

Rows with a null id, label or vector or a null or non-finite component take no part.
Shorter vectors count as filled with zeros.  A row that repeats an id is a row of its
own; only the anchor's own row is not its positive.  Ties go to the smaller id.  An
empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepare, shuffle_partitions, staged
from ledgerloom.llm.vectors import (
    BLOCK_SCHEMA,
    NONE,
    BestLists,
    block_number,
    blocks_of,
    integer_vectors,
    matrix,
    packed,
    products,
    unpacked,
)

# a child's radius is at most its parent's divided by this
BASE = 1.5
# a node of no more points, or of radius 0, is a leaf
LEAF_ROWS = 16
TREE_ROWS = 1024
# pivots that share out the candidates: a bounded sample
MOST_PIVOTS = 1024
ANCHOR_ROWS = 128
# trees that one cell searches together, best node first
RUN_TREES = 16
# room for rounding in the bounds, relative to the largest product
SLACK = 1e-7

TREE_FIELDS = ("centre", "radius", "first", "last", "child", "children")
PACKED_FIELDS = [("n", pa.int32()), ("dim", pa.int32()), ("kind", pa.string()), ("rows", pa.binary()), ("ids", pa.binary()),
                 ("vectors", pa.binary()), ("labels", pa.binary())]


class CoverTree:
    """Nodes as arrays; the points of a node are neighbours in ``x[first:last]``."""

    def __init__(self, x, rows, ids, labels, nodes: dict[str, np.ndarray]):
        self.x, self.rows, self.ids, self.labels = x, rows, ids, labels
        self.centre, self.radius, self.first, self.last, self.child, self.children = (nodes[f] for f in TREE_FIELDS)

    @classmethod
    def build(cls, x, rows, ids, labels, norm2: float, base: float = BASE, leaf_rows: int = LEAF_ROWS) -> CoverTree:
        """A tree over the rows of ``x``, of at most ``norm2`` squared length."""
        points = x.astype(np.float64)
        squares = (points**2).sum(axis=1)
        more = np.sqrt(np.maximum(0.0, norm2 - squares))
        # sums of whole numbers: exactly 0 between equal vectors
        distance = squares[:, None] + squares - 2 * (points @ points.T) + (more[:, None] - more) ** 2
        distance = np.sqrt(np.maximum(0.0, distance))
        np.fill_diagonal(distance, 0.0)
        order = np.arange(len(x))
        root = int(distance.max(axis=1).argmin()) if len(x) else 0
        nodes: list[list] = [[root, float(distance[root].max(initial=0.0)), 0, len(x), 0, 0]]
        at = 0
        while at < len(nodes):
            centre, radius, first, last, _, _ = nodes[at]
            if last - first > leaf_rows and radius > 0:
                members = order[first:last]
                centres, near, owner = [centre], distance[centre, members], np.zeros(last - first, np.int64)
                while near[far := int(near.argmax())] > radius / base:
                    centres.append(int(members[far]))
                    reach = distance[members[far], members]
                    closer = reach < near
                    owner[closer], near = len(centres) - 1, np.minimum(near, reach)
                by_owner = np.argsort(owner, kind="stable")
                order[first:last] = members[by_owner]
                ends = first + np.cumsum(np.bincount(owner, minlength=len(centres)))
                widest = np.zeros(len(centres))
                np.maximum.at(widest, owner, near)
                nodes[at][4:] = len(nodes), len(centres)
                starts = [first, *ends[:-1]]
                nodes += [[c, float(w), int(a), int(b), 0, 0] for c, w, a, b in zip(centres, widest, starts, ends, strict=True)]
            at += 1
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        columns = [np.array(c) for c in zip(*nodes, strict=True)]
        columns[0] = place[columns[0]] if len(x) else columns[0]
        kinds = ("<i4", "<f8", "<i4", "<i4", "<i4", "<i4")
        made = {f: c.astype(kind) for f, c, kind in zip(TREE_FIELDS, columns, kinds, strict=True)}
        return cls(x[order], rows[order], ids[order], labels[order], made)

    def pack(self) -> dict:
        nodes = {f: getattr(self, f).tobytes() for f in TREE_FIELDS}
        return packed(self.x, self.rows, self.ids) | {"labels": self.labels.astype("<i8").tobytes()} | nodes

    @classmethod
    def unpack(cls, block: dict) -> CoverTree:
        nodes = {f: np.frombuffer(block[f], "<f8" if f == "radius" else "<i4") for f in TREE_FIELDS}
        return cls(*unpacked(block), np.frombuffer(block["labels"], "<i8"), nodes)


class Descent:
    """Best-first search of several trees for the windows of a block of queries.

    ``high`` and ``floor`` hold a row of windows for each query; a window whose floor is
    above its high asks for nothing.
    """

    def __init__(self, x, rows, labels, high, floor, norm2: float, k: int, same_label: bool):
        self.x, self.rows, self.labels, self.k, self.same_label = x, rows, labels, k, same_label
        self.high, self.given = high, floor
        self.floor = floor.copy()
        self.scale = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * np.sqrt(norm2)
        self.norm = np.sqrt(norm2)
        self.best = BestLists(high.size, k)
        self.opened = self.verified = 0

    def bounds(self, s: np.ndarray, radius: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest products with any point of nodes whose centres' products are ``s``."""
        scale = self.scale[queries][:, None]
        angle = np.arccos(np.clip(s / np.maximum(scale, 1e-300), -1.0, 1.0))
        phi = 2 * np.arcsin(np.minimum(1.0, radius / max(2 * self.norm, 1e-300)))
        slack = SLACK * (scale + 1)
        return scale * np.cos(np.minimum(np.pi, angle + phi)) - slack, scale * np.cos(np.maximum(0.0, angle - phi)) + slack

    def wanted(self, low: np.ndarray, top: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Whether scores from ``low`` to ``top`` can be in any window of the query (rows: queries)."""
        out = np.zeros(low.shape, bool)
        for w in range(self.high.shape[1]):
            out |= (low <= self.high[queries, w][:, None]) & (top >= self.floor[queries, w][:, None])
        return out

    def run(self, trees: list[CoverTree]) -> BestLists:
        queue: list[tuple] = []
        everyone, at = np.arange(len(self.x)), 0

        def take(tree: CoverTree, nodes: np.ndarray, queries: np.ndarray) -> None:
            """Bound the nodes for the queries: leaves are verified at once, other nodes wait."""
            nonlocal at
            s = products(self.x[queries], tree.x[tree.centre[nodes]]).astype(np.float64)
            low, top = self.bounds(s, tree.radius[nodes], queries)
            wanted = self.wanted(low, top, queries)
            leaf = tree.children[nodes] == 0
            self.verify(tree, nodes[leaf], wanted[:, leaf], queries)
            for j in np.flatnonzero(~leaf & wanted.any(axis=0)):
                keep = wanted[:, j]
                # products of queries of different length are compared as cosines
                best = (top[keep, j] / (self.scale[queries[keep]] + 1)).max()
                heapq.heappush(queue, (-best, at, tree, nodes[j], queries[keep], low[keep, j], top[keep, j]))
                at += 1

        for tree in trees:
            take(tree, np.array([0]), everyone)
        while queue:
            _, _, tree, node, queries, low, top = heapq.heappop(queue)
            # floors may have risen while the node waited
            queries = queries[self.wanted(low[:, None], top[:, None], queries)[:, 0]]
            if not len(queries):
                continue
            self.opened += 1
            take(tree, np.arange(tree.child[node], tree.child[node] + tree.children[node]), queries)
        return self.best

    def verify(self, tree: CoverTree, leaves: np.ndarray, wanted: np.ndarray, queries: np.ndarray) -> None:
        """Exact products with the points of leaves that any query wants, offered to the windows."""
        asked = wanted.any(axis=0)
        leaves, wanted = leaves[asked], wanted[:, asked]
        if not len(leaves):
            return
        sizes = tree.last[leaves] - tree.first[leaves]
        points = np.repeat(tree.first[leaves] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        s = products(self.x[queries], tree.x[points]).astype(np.int64)
        self.verified += s.size
        allowed = np.repeat(wanted, sizes, axis=1)
        same = self.labels[queries][:, None] == tree.labels[points][None, :]
        allowed &= same if self.same_label else ~same
        if self.same_label:
            allowed &= self.rows[queries][:, None] != tree.rows[points][None, :]
        offers = []
        for w in range(self.high.shape[1]):
            high, floor = self.high[queries, w][:, None], self.floor[queries, w][:, None]
            a, b = np.nonzero(allowed & (s <= high) & (s >= floor))
            offers.append((queries[a] * self.high.shape[1] + w, s[a, b], points[b]))
        owner, score, at = (np.concatenate(c) for c in zip(*offers, strict=True))
        if len(owner):
            last = self.best.offer(owner, score, tree.ids[at], tree.rows[at]).reshape(self.floor.shape)
            self.floor = np.maximum(self.floor, last)


def _tree_builder(norm2: float):
    nodes = [(f, pa.binary()) for f in TREE_FIELDS]

    def build(table: pa.Table) -> pa.Table:
        columns = (table[c].to_numpy() for c in ("row", "id", "label"))
        tree = CoverTree.build(matrix(table["x"]), *columns, norm2)
        # a tree is known by the least row in it
        block = {"tree": int(tree.rows.min()), **tree.pack()}
        return pa.Table.from_pylist([block], schema=pa.schema([("tree", pa.int64()), *PACKED_FIELDS, *nodes]))

    return build


TREE_SCHEMA = f"tree long, {BLOCK_SCHEMA}, labels binary, " + ", ".join(f"{f} binary" for f in TREE_FIELDS)


def build_trees(vectors: DataFrame, norm2: float, tree_rows: int = TREE_ROWS) -> DataFrame:
    """A written table of cover trees, every row of ``vectors`` in one of them."""
    count = vectors.count()
    most = min(MOST_PIVOTS, blocks_of(count, tree_rows))
    sample = vectors.select("row", "x").orderBy(F.xxhash64("row"), "row").limit(most).collect()
    wide = max((len(r["x"]) for r in sample), default=0)
    pivots = np.zeros((len(sample), wide + 1))
    for i, r in enumerate(sample):
        pivots[i, : len(r["x"])] = r["x"]
        pivots[i, -1] = np.sqrt(max(0.0, norm2 - float((pivots[i, :-1] ** 2).sum())))

    def nearest(batches):
        for batch in batches:
            x = matrix(batch["x"]).astype(np.float64)
            more = np.sqrt(np.maximum(0.0, norm2 - (x**2).sum(axis=1)))
            dim = min(x.shape[1], wide)
            near = x[:, :dim] @ pivots[:, :dim].T + more[:, None] * pivots[:, -1]
            pivot = near.argmax(axis=1) if near.size else np.zeros(len(x))
            yield batch.append_column("pivot", pa.array(pivot.astype(np.int32)))

    fields = vectors.select("row", "id", "label", "x")
    schema = ", ".join(f"{n} {t}" for n, t in fields.dtypes) + ", pivot int"
    assigned = staged(fields.mapInArrow(nearest, schema), "pivots")
    # at most MOST_PIVOTS rows
    parts = assigned.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / tree_rows).alias("parts"))
    dealt = assigned.join(F.broadcast(parts), "pivot").withColumn("part", F.expr("pmod(xxhash64(row), parts)"))
    return staged(dealt.groupBy("pivot", "part").applyInArrow(_tree_builder(norm2), TREE_SCHEMA), "cover-trees")


ANCHOR_SCHEMA = f"block int, {BLOCK_SCHEMA}, labels binary, windows int, high binary, floor binary"


def _pack_anchors(table: pa.Table) -> pa.Table:
    """One block of anchors; ``high`` and ``floor`` are lists of one length."""
    table = table.sort_by("row")
    high, floor = matrix(table["high"]), matrix(table["floor"])
    # where an anchor has fewer windows, zeros were filled in: they ask for nothing
    lengths = np.diff(table["high"].combine_chunks().offsets.to_numpy())
    floor[np.arange(high.shape[1]) >= lengths[:, None]] = 1
    block = packed(matrix(table["x"]), table["row"].to_numpy(), table["id"].to_numpy())
    more = {"block": table["block"][0].as_py(), "labels": table["label"].to_numpy().astype("<i8").tobytes(),
            "windows": high.shape[1], "high": high.astype("<i8").tobytes(), "floor": floor.astype("<i8").tobytes()}
    schema = pa.schema([("block", pa.int32()), *PACKED_FIELDS, ("windows", pa.int32()), ("high", pa.binary()), ("floor", pa.binary())])
    return pa.Table.from_pylist([block | more], schema=schema)


FOUND = "anchor_row long, window int, score long, vec_id long, row long"


def _searcher(norm2: float, k: int, same_label: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        schema = pa.schema(list(zip(("anchor_row", "window", "score", "vec_id", "row"), kinds, strict=True)))
        trees = [CoverTree.unpack(t) for t in right.to_pylist()]
        tables = [schema.empty_table()]
        for block in left.to_pylist():
            x, rows, _ = unpacked(block)
            high, floor = (np.frombuffer(block[c], "<i8").reshape(block["n"], block["windows"]) for c in ("high", "floor"))
            labels = np.frombuffer(block["labels"], "<i8")
            best = Descent(x, rows, labels, high, floor, norm2, k, same_label).run(trees)
            owner, window = best.owner // max(1, high.shape[1]), (best.owner % max(1, high.shape[1])).astype(np.int32)
            tables.append(pa.table([rows[owner], window, best.score, best.id, best.row], schema=schema))
        return pa.concat_tables(tables)

    return run


def search(anchors: DataFrame, trees: DataFrame, norm2: float, k: int, same_label: bool) -> DataFrame:
    """The first ``k`` rows of every window of ``anchors`` (``row, id, label, x, high, floor``).

    Windows are numbered from 0 in the order of the anchor's lists ``high`` and ``floor``.
    """
    spark = anchors.sparkSession
    blocks = blocks_of(anchors.count(), ANCHOR_ROWS)
    runs = blocks_of(trees.count(), RUN_TREES)
    block = block_number(F.col("row"), blocks).alias("block")
    asked = anchors.select(block, "row", "id", "label", "x", "high", "floor").groupBy("block").applyInArrow(_pack_anchors, ANCHOR_SCHEMA)
    parts = min(2 * blocks * runs, 4 * shuffle_partitions(spark))
    left = asked.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))).repartition(parts, "block", "run")
    right = trees.withColumn("run", block_number(F.col("tree"), runs)).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    ).repartition(parts, "block", "run")
    cells = left.groupBy("block", "run").cogroup(right.groupBy("block", "run"))
    found = staged(cells.applyInArrow(_searcher(norm2, k, same_label), FOUND), "windows")
    order = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    df: DataFrame,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its ``positives`` best rows of the same label; for each, the
    ``negatives`` best rows of other labels whose score is at most the positive's and at
    least ``least_percent`` percent of it.  ``label`` is a number.
    """
    spark = prepare(df.sparkSession)
    kept = {"label": label.cast("long"), "asks": F.coalesce(is_anchor, F.lit(False))}
    vectors = staged(integer_vectors(df.where(label.isNotNull()), key, vector, scale, **kept), "vectors")
    norm2 = vectors.agg(F.max("norm2")).first()[0] or 0.0
    trees = build_trees(vectors, norm2, tree_rows)
    anchors = vectors.where("asks").select("row", "id", "label", "x")
    open_window = {"high": F.array(F.lit(-NONE)), "floor": F.array(F.lit(NONE))}
    found = search(anchors.withColumns(open_window), trees, norm2, positives, same_label=True)
    best = staged(found.select("anchor_row", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # ``positives`` entries an anchor at most
    lists = best.groupBy(F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list(F.struct("rank", "positive_score"))).alias("found"))
    scores = F.transform("found", lambda f: f["positive_score"])
    least = F.transform(scores, lambda s: _least_score(s, least_percent))
    asking = anchors.join(lists, "row").withColumns({"high": scores, "floor": least})
    hard = search(asking.drop("found"), trees, norm2, negatives, same_label=False)
    named = best.join(anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")), "anchor_row")
    return (
        hard.select("anchor_row", (F.col("window") + 1).alias("place"), F.col("rank").alias("negative_rank"), "vec_id", "score")
        .join(named.withColumnRenamed("rank", "place"), ["anchor_row", "place"])
        .select(
            "anchor_id", "positive_id", F.col("negative_rank").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )


def _least_score(score: Column, percent: int) -> Column:
    """The least whole number s with 100 * s >= percent * score."""
    up = score * percent + 99
    return F.call_function("div", up - F.pmod(up, F.lit(100)), F.lit(100))

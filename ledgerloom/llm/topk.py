"""Exact top-k by inner product over buckets of vectors of similar length.

Candidates are ordered by falling length and cut into buckets.  A query with a
k-th score so far, its floor, needs from a bucket whose longest vector has length
l only vectors at a cosine of floor / (|query| * l) or more, the local threshold:

* above 1, the bucket has none (length pruning of the whole bucket);
* below ``COORDINATE_COSINE``, the vectors that are long enough are a prefix of the
  bucket, and their products are computed (length pruning inside the bucket);
* else a vector's largest coordinates must lie near the query's: sorted lists of the
  bucket's coordinates give the few vectors that do (coordinate pruning), and their
  products are computed.

All products are exact integers, so pruning changes the cost and never the result.

On Spark: the index is a written table of packed buckets (bounded rows).  Blocks of
queries meet the run of longest buckets first, which gives every query a floor; then
(block, run) cells of all other runs are searched independently, each keeping at
most k rows a query, and one window per query joins them.  No block, run or cell
grows with the data, with a repeated vector or with a frequent length.

Null or non-finite components, null vectors and null ids keep a row out.  Shorter
vectors count as filled with zeros, an empty one as all zeros (score 0).  A row that
repeats an id is a row of its own; only the query's own row is not its candidate.
Ties go to the smaller id.  An empty table gives an empty result; other columns of
the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepare, shuffle_partitions, staged
from ledgerloom.llm.vectors import (
    BLOCK_ROWS,
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
from ledgerloom.operators.indexing import dense_index

# buckets that one cell searches in turn, with running floors
RUN_BUCKETS = 16
# from this local cosine threshold on, coordinates prune more than they cost
COORDINATE_COSINE = 0.9
# coordinates of a query that are looked up in sorted lists
FOCUS = 4
# room for rounding in float bounds, relative
SLACK = 1e-9

FOUND = "query_row long, query_id long, score long, vec_id long, row long"


def _pack(table: pa.Table) -> pa.Table:
    """One group as one packed block; rows in the order of ``place``."""
    table = table.sort_by("place")
    x = matrix(table["x"])
    block = packed(x, table["row"].to_numpy(), table["id"].to_numpy())
    floors = table["floor"].to_numpy() if "floor" in table.column_names else np.full(len(x), NONE)
    lengths = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    return pa.Table.from_pylist([
        {"block": table["block"][0].as_py(), **block, "lengths": lengths.tobytes(), "floors": floors.astype("<i8").tobytes()}
    ], schema=pa.schema([("block", pa.int32()), ("n", pa.int32()), ("dim", pa.int32()), ("kind", pa.string()),
                         ("rows", pa.binary()), ("ids", pa.binary()), ("vectors", pa.binary()),
                         ("lengths", pa.binary()), ("floors", pa.binary())]))


PACKED = f"block int, {BLOCK_SCHEMA}, lengths binary, floors binary"


def build_index(vectors: DataFrame, bucket_rows: int = BLOCK_ROWS, run_buckets: int = RUN_BUCKETS) -> DataFrame:
    """Packed buckets of falling length: ``block`` (0 has the longest vectors) and its ``run``."""
    placed = dense_index(vectors, "place", order_by=[F.desc("norm2"), "row"])
    rows = placed.select((F.col("place") / bucket_rows).cast("int").alias("block"), "place", "row", "id", "x")
    buckets = rows.groupBy("block").applyInArrow(_pack, PACKED)
    return staged(buckets.withColumn("run", (F.col("block") / run_buckets).cast("int")), "norm-buckets")


class _Bucket:
    def __init__(self, block: dict):
        self.x, self.rows, self.ids = unpacked(block)
        self.lengths = np.frombuffer(block["lengths"], "<f8")
        self._unit = self._lists = None

    def long_enough(self, least: float) -> int:
        """How many of the vectors, from the longest, have at least that length."""
        return int(np.searchsorted(-self.lengths, -least * (1 - SLACK), "right"))

    def near(self, q: np.ndarray, cosine: float) -> np.ndarray:
        """Positions of all vectors at ``cosine`` or more to the unit vector ``q``, and some others."""
        if self._unit is None:
            self._unit = (self.x / np.maximum(self.lengths, 1e-300)[:, None]).T.copy()
            self._lists = {}
        angle = np.arccos(min(1.0, cosine)) + 1e-7
        ranges = []
        for f in np.argsort(-np.abs(q))[:FOCUS]:
            if f not in self._lists:
                order = np.argsort(self._unit[f], kind="stable")
                self._lists[f] = order, self._unit[f][order]
            own = np.arccos(np.clip(q[f], -1, 1))
            low, high = np.cos(min(np.pi, own + angle)) - SLACK, np.cos(max(0.0, own - angle)) + SLACK
            order, values = self._lists[f]
            first, last = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            ranges.append((last - first, f, low, high, order[first:last]))
        ranges.sort(key=lambda r: r[0])
        found = ranges[0][4]
        for _, f, low, high, _ in ranges[1:]:
            values = self._unit[f][found]
            found = found[(values >= low) & (values <= high)]
        return found


def search_cell(queries: dict, buckets: list[dict], k: int) -> tuple[BestLists, np.ndarray, np.ndarray, dict]:
    """The first k of the buckets' vectors for each query, those under its floor left out.

    Returns the lists, the queries' rows and ids, and how many products each way computed.
    """
    x, rows, ids = unpacked(queries)
    lengths = np.frombuffer(queries["lengths"], "<f8")
    given = np.frombuffer(queries["floors"], "<i8")
    floors, best, done = given.copy(), BestLists(len(x), k), {"length": 0, "coordinate": 0}
    for bucket in (_Bucket(b) for b in sorted(buckets, key=lambda b: b["block"])):
        longest = lengths * bucket.lengths[0]
        # an open floor, or one that every product can reach, prunes nothing
        bound = floors > 0
        cosines = np.where(bound, floors / np.maximum(longest, 1e-300), -1.0)
        live = np.flatnonzero(cosines <= 1 + SLACK)
        by_coordinate = live[cosines[live] >= COORDINATE_COSINE]
        by_length = live[cosines[live] < COORDINATE_COSINE]
        offers = []
        if len(by_length):
            least = np.where(bound[by_length], floors[by_length] / np.maximum(lengths[by_length], 1e-300), 0.0)
            x_long = bucket.x[: bucket.long_enough(float(least.min()))]
            s = products(x[by_length], x_long)
            done["length"] += s.size
            _, qi, pi = np.intersect1d(rows[by_length], bucket.rows[: len(x_long)], return_indices=True)
            s[qi, pi] = NONE
            if s.shape[1] > k:  # no more than the k-th of these can come into the list
                kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k].astype(np.int64)
                floors[by_length] = np.maximum(floors[by_length], kth)
            a, b = np.nonzero((s >= floors[by_length].astype(s.dtype)[:, None]) & (s != NONE))
            offers.append((by_length[a], s[a, b].astype(np.int64), b))
        for q in by_coordinate:
            near = bucket.near(x[q] / max(lengths[q], 1e-300), float(cosines[q]))
            near = near[bucket.rows[near] != rows[q]]
            s = products(x[q : q + 1], bucket.x[near])[0].astype(np.int64)
            done["coordinate"] += s.size
            keep = s >= floors[q]
            offers.append((np.full(int(keep.sum()), q), s[keep], near[keep]))
        if offers:
            owner, score, at = (np.concatenate(c) for c in zip(*offers, strict=True))
            floors = np.maximum(floors, best.offer(owner, score, bucket.ids[at], bucket.rows[at]))
    return best, rows, ids, done


def _searcher(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([(n, pa.int64()) for n in ("query_row", "query_id", "score", "vec_id", "row")])
        tables = []
        for queries in left.to_pylist():
            best, rows, ids, _ = search_cell(queries, right.to_pylist(), k)
            tables.append(pa.table([rows[best.owner], ids[best.owner], best.score, best.id, best.row], schema=schema))
        return pa.concat_tables(tables) if tables else schema.empty_table()

    return run


def _search(queries: DataFrame, index: DataFrame, query_blocks: int, first_run: int, last_run: int, k: int) -> DataFrame:
    """Rows found in the cells of all query blocks with the runs from ``first_run`` to ``last_run``."""
    cells = query_blocks * (last_run - first_run + 1)
    parts = min(2 * cells, 4 * shuffle_partitions(index.sparkSession))
    asked = queries.withColumn("run", F.explode(F.sequence(F.lit(first_run), F.lit(last_run))))
    searched = index.where(F.col("run").between(first_run, last_run)).select(
        *(F.col(c) for c in index.columns), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block")
    )
    left = asked.withColumnRenamed("block", "query_block").repartition(parts, "query_block", "run")
    right = searched.repartition(parts, "query_block", "run")
    keys = ("query_block", "run")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_searcher(k), FOUND)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    bucket_rows: int = BLOCK_ROWS,
    run_buckets: int = RUN_BUCKETS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for every row where ``is_query`` holds.

    Scores are inner products of ``floor(scale * component)``; see the module's text.
    """
    spark = prepare(df.sparkSession)
    vectors = staged(integer_vectors(df, key, vector, scale, asks=F.coalesce(is_query, F.lit(False))), "vectors")
    index = build_index(vectors.drop("asks"), bucket_rows, run_buckets)
    asking = vectors.where("asks").select("row", "id", "x")
    query_blocks = blocks_of(asking.count(), bucket_rows)
    last_run = index.agg(F.max("run")).first()[0] or 0
    placed = asking.select(block_number(F.col("row"), query_blocks).alias("block"), F.col("row").alias("place"), "row", "id", "x")
    found = staged(_search(placed.groupBy("block").applyInArrow(_pack, PACKED), index, query_blocks, 0, 0, k), "top-k-first")
    if last_run:
        # the k-th score among the longest vectors is every query's floor in the other runs
        kth = found.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        floors = kth.where(F.col("n") >= k).select(F.col("query_row").alias("row"), "least")
        bounded = placed.join(floors, "row", "left").select(
            "block", "place", "row", "id", "x", F.coalesce("least", F.lit(NONE)).alias("floor")
        )
        rest = _search(bounded.groupBy("block").applyInArrow(_pack, PACKED), index, query_blocks, 1, last_run, k)
        found = found.union(staged(rest, "top-k-rest"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

"""Physical-layout helpers: partitioning, persistence, checked broadcast, plans."""

from __future__ import annotations

import contextlib
import io
import re
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.cells import fixed_row_bytes, unsafe_row_bytes

# Upper bound for a replicated (broadcast) join side.  Spark's own hard limit
# is 8 GiB per broadcast; the driver builds the relation and every executor
# holds a copy, so the effective bound is also capped at 1/8 of driver memory.
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
# What the driver holds while it builds a broadcast relation: the collected rows, the
# relation's own copy and the serialised one; per row, a slot in a hash index that is
# at most half full and doubles (the old and the new one at once), and a pointer.
BUILD_COPIES, BUILD_ROW_BYTES = 3, 112
_MEMORY_UNITS = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _driver_memory_bytes(spark) -> int:
    """``spark.driver.memory`` in bytes ("4g", "512m", "1gb", plain numbers are MiB)."""
    text = spark.sparkContext.getConf().get("spark.driver.memory", "1g").strip().lower()
    if len(text) > 1 and text.endswith("b") and text[-2] in _MEMORY_UNITS:
        text = text[:-1]
    if text[-1:] in _MEMORY_UNITS:
        return int(float(text[:-1]) * _MEMORY_UNITS[text[-1]])
    return int(float(text) * (1 << 20))


def broadcast_bound(spark, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> int:
    return min(max_bytes, _driver_memory_bytes(spark) // 8)


def partition_by_key(df: DataFrame, num_partitions: int, *keys: str) -> DataFrame:
    """Hash-partition by key (equal keys land in the same partition)."""
    return df.repartition(num_partitions, *keys)


def persist_in_memory(df: DataFrame) -> DataFrame:
    """Cache in executor memory only; evicted blocks are recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_ONLY)


def sort_with_tiebreak(df: DataFrame, cols: list[Column | str], tiebreak: list[str]) -> DataFrame:
    """Global sort on ``cols`` then ``tiebreak``.

    A unique tie-break keeps the order deterministic and lets the range
    partitioner split a hot sort key over many tasks instead of one.
    """
    return df.sort(*cols, *tiebreak)


def plan_text(df: DataFrame, mode: str = "extended") -> str:
    """The text ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


PLAN_SCHEMA = "position int, depth int, operator string, pushed_filters string, read_columns string, output_rows long"
# wrappers of code generation and of stages, not operators of their own
_WRAPPERS = ("WholeStageCodegen", "InputAdapter", "ColumnarToRow", "AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage",
             "ResultQueryStage", "AQEShuffleRead")


def _scala_items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _plan_nodes(node, depth: int = 0) -> list[tuple]:
    """(depth, node) of a physical plan from the top down, without wrappers."""
    name = node.nodeName()
    below = [node.executedPlan()] if name.startswith("AdaptiveSparkPlan") else (
        [node.plan()] if "QueryStage" in name else _scala_items(node.children()))
    wrapper = name.startswith(_WRAPPERS)
    here = [] if wrapper else [(depth, node)]
    return here + [n for child in below for n in _plan_nodes(child, depth + (not wrapper))]


def plan_rows(df: DataFrame, execute: bool = False) -> DataFrame:
    """The physical plan as a table, a row per operator from the top down.

    ``pushed_filters`` and ``read_columns`` are those of a file scan.  With ``execute``
    the plan is run once, its result dropped, and the table has the plan as it ran (with
    the changes made at run time) and the ``output_rows`` of the operators that count them.
    """
    run = df._jdf.queryExecution()
    if execute:
        run.toRdd().count()
    rows = []
    for position, (depth, node) in enumerate(_plan_nodes(run.executedPlan())):
        text = node.simpleString(10_000)
        filters = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: struct<", text)
        columns = re.search(r"ReadSchema: struct<(.*)>", text)
        names = re.findall(r"(?:^|,)([^:,<>]+):", columns.group(1)) if columns else []
        counted = node.metrics().get("numOutputRows")
        rows.append((
            position, depth, node.nodeName().split(" (")[0].strip(), filters and filters.group(1),
            ",".join(names) if columns else None, counted.get().value() if execute and counted.isDefined() else None,
        ))
    return df.sparkSession.createDataFrame(rows, PLAN_SCHEMA)


@dataclass
class SideSize:
    rows: int
    bytes: int | None  # None: not computed, the rows alone are over the bound

    def fits(self, max_bytes: int) -> bool:
        return self.bytes is not None and self.bytes <= max_bytes

    def builds_in(self, memory: int) -> bool:
        """Whether the driver can build the broadcast relation of this side in ``memory`` bytes."""
        return self.bytes is not None and BUILD_COPIES * self.bytes + BUILD_ROW_BYTES * self.rows <= memory


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df``'s plan: for a scan, the bytes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measure_bounded(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> SideSize:
    """Size of ``df`` as rows and exact in-memory bytes; no bytes if its rows rule out the bound.

    1. A count (file footers only for a bare scan, else the columns its filters
       need) times the fixed part of a row is a lower bound: over it, stop there.
    2. Otherwise one aggregation computes the exact binary-row size of the side
       (partial sums per task, one row back).
    """
    rows = df.count()
    if rows * fixed_row_bytes(len(df.schema.fields)) > max_bytes:
        return SideSize(rows=rows, bytes=None)
    total = df.agg(F.sum(unsafe_row_bytes(df.schema))).first()[0]
    return SideSize(rows=rows, bytes=int(total or 0))


def observed(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its size as a join side of ``columns`` (default: all), taken while it is computed."""
    seen = Observation()
    side = df.schema if columns is None else T.StructType([df.schema[c] for c in columns])
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(unsafe_row_bytes(side)).alias("bytes")), seen


def observed_size(seen: Observation) -> SideSize:
    """The size that an observation saw; a task that ran twice can make it larger, never smaller."""
    return SideSize(rows=seen.get["rows"], bytes=int(seen.get["bytes"] or 0))


def written_side(df: DataFrame, path: str) -> tuple[DataFrame, SideSize]:
    """``df`` written to ``path`` and read back, with its size measured by the write itself."""
    sized, seen = observed(df)
    sized.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observed_size(seen)


def broadcast_if_small(
    df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES, size: SideSize | None = None
) -> tuple[DataFrame, bool]:
    """``broadcast(df)`` when its measured size is within ``max_bytes`` (and 1/8 of driver memory).

    Short rows cost the driver many times their bytes, so the relation must also build in
    a quarter of its memory: a join has no more than two such sides alive at once.

    ``size`` is the size if it is known already (``written_side``): no job runs then.

    Beyond the bound the frame is returned unhinted: the join shuffles both
    sides (sort-merge), and AQE may still switch to a broadcast at run time if
    the measured shuffle output turns out small.
    """
    bound = broadcast_bound(df.sparkSession, max_bytes)
    size = size or measure_bounded(df, bound)
    if size.fits(bound) and size.builds_in(_driver_memory_bytes(df.sparkSession) // 4):
        return F.broadcast(df), True
    return df, False

"""Row indexes without collecting rows.

``with_row_index`` is Spark's unique, increasing, *sparse* id (partition number
in the high bits, position in the partition in the low 33 bits).
``dense_index`` turns that into 0, 1, 2, ... in partition order: one small
aggregation counts rows per partition, a running sum over those counts gives
each partition's offset (one row per partition, so it is broadcast with a
size bound equal to the partition count), and each row adds its in-partition
position.  The rows are first written once with their partition and position,
so the count reads one column, both passes see the same rows, and a lost
executor cannot renumber them between the passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path

_POSITION_BITS = 33


def with_row_index(df: DataFrame, name: str = "index") -> DataFrame:
    """Append a unique increasing long id (not dense across partitions)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def dense_index(
    df: DataFrame,
    name: str = "index",
    order_by: list[Column | str] | None = None,
    start: int = 0,
) -> DataFrame:
    """Append a dense long index ``start, start+1, ...``.

    With ``order_by`` the rows are range-sorted first.  A unique row id is
    appended as the last sort key: ties keep their input order, and the range
    partitioner can split a sort value held by a third of the rows over many
    tasks.  Without ``order_by`` the current partition order (file order for a
    scan) is numbered.
    """
    if order_by:
        ordered = (
            df.withColumn("_tie", F.monotonically_increasing_id())
            .sort(*order_by, "_tie")
            .drop("_tie")
        )
    else:
        ordered = df
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "dense-index")
    numbered = ordered.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    )
    numbered.write.parquet(path)
    tagged = spark.read.schema(numbered.schema).parquet(path)
    per_partition = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # A running sum over the per-partition counts.  The window has no
    # partitioning, but its input is one row per *input partition* (not per
    # data row): even a million partitions is a few MB in one task.
    preceding = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_partition.select(
        "_pid", F.coalesce(F.sum("_n").over(preceding), F.lit(0)).alias("_offset")
    )
    return (
        tagged.join(F.broadcast(offsets), "_pid")  # one row per partition
        .withColumn(name, (F.col("_offset") + F.col("_pos") + F.lit(start)).cast("long"))
        .drop("_pid", "_pos", "_offset")
    )

"""Row indexes: sparse unique ids and dense positions without collecting."""

from pyspark.sql import functions as F

from ledgerloom.operators.indexing import dense_index, with_row_index

from .conftest import conf_override


def test_row_index_unique_not_dense(spark):
    df = with_row_index(spark.range(0, 1000, 1, 5), "index")
    ids = [r["index"] for r in df.collect()]
    assert len(set(ids)) == 1000
    assert max(ids) > 1000  # partition number sits in the high bits


def test_dense_index_follows_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    out = dense_index(df, "pos", order_by=["v"]).collect()
    assert sorted(r["pos"] for r in out) == list(range(5000))
    assert all(r["pos"] == r["v"] for r in out)


def test_dense_index_partition_order_and_start(spark):
    df = spark.range(0, 300, 1, 3)
    out = dense_index(df, "pos", start=1).collect()
    assert sorted((r["id"], r["pos"]) for r in out) == [(i, i + 1) for i in range(300)]


def test_dense_index_hot_sort_key_spreads(spark):
    """A sort value held by a third of the rows must not land in one range partition."""
    n = 30000
    df = spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v")
    )
    # measure the range partitions themselves: AQE would merge this small input
    with conf_override(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        out = dense_index(df, "pos", order_by=["v"])
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 3 and max(sizes) < n / 3
    assert sorted(r["pos"] for r in out.select("pos").collect()) == list(range(n))

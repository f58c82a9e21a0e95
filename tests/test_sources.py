"""Delimited sources: legacy charset round trip, sizing helpers."""

import glob

from ledgerloom.operators.keyed_table import KeyedTable
from ledgerloom.plans.registry import CYRILLIC, QUERIES
from ledgerloom.session import buckets_for, partitions_for, recommended_conf, suggested_buckets
from ledgerloom.sources import delimited

from .conftest import SF_SMALL, conf_override


def test_windows_1251_round_trip(spark, scratch):
    rows = [(1, "Москва", 2.5), (2, "Київ", None), (3, "plain", 0.0)]
    df = spark.createDataFrame(rows, "id int, city string, amount double")
    path = delimited.write_delimited(df.coalesce(1), scratch("cp1251"), encoding="windows-1251")
    raw = b"".join(open(f, "rb").read() for f in glob.glob(path.replace("file:", "") + "/part-*"))
    assert "Москва".encode("cp1251") in raw and "Москва".encode("utf-8") not in raw
    back = delimited.read_typed(spark, path, schema=df.schema, encoding="windows-1251")
    assert sorted(back.collect()) == sorted(df.collect())
    inferred = delimited.read_typed(spark, path, encoding="windows-1251")
    assert dict(inferred.dtypes) == {"id": "int", "city": "string", "amount": "double"}


def test_typed_query_needs_the_charset(spark, scratch):
    """The registered typed read fails its oracle if the file is taken for UTF-8."""
    right = {r["c_segment"] for r in QUERIES["delimited_typed"](spark, SF_SMALL).collect()}
    assert all(set(x) <= set(CYRILLIC) for x in right)
    source = spark.createDataFrame([(x,) for x in sorted(right)], "c_segment string").coalesce(1)
    path = delimited.write_delimited(source, scratch("cp1251"), encoding="windows-1251")
    wrong = {r["c_segment"] for r in delimited.read_typed(spark, path, encoding="UTF-8").collect()}
    assert not wrong & right


def test_largest_suggested_bucket_count_makes_a_table(spark, scratch):
    """100 TB sizing stays under Spark's bucket limit."""
    t = KeyedTable(spark, scratch("many-buckets"), "id", buckets=suggested_buckets(100 << 40))
    schema = spark.createDataFrame([], "id long, v string").schema
    assert t._register(schema) == ["id", "v"]


def test_join_tasks_grow_with_the_input(spark, scratch):
    """Buckets, and so the tasks of a join between two tables, come from the table's size."""
    cores = spark.sparkContext.defaultParallelism
    small, large = buckets_for(spark, 1), buckets_for(spark, 2 * cores * (512 << 20))
    assert small == cores and large >= 2 * cores
    assert partitions_for(spark, 1) == cores and partitions_for(spark, 1 << 40) == 4096
    data = spark.range(0, 100).selectExpr("id", "id AS v")
    for n in (small, large):
        t = KeyedTable(spark, scratch("grow"), "id", buckets=n)
        t.append(data)
        with conf_override(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            joined = t.scan().join(t.scan().select("id"), "id")
            assert joined.rdd.getNumPartitions() == n and joined.count() == 100


def test_untyped_read_is_all_strings(spark, scratch):
    df = spark.createDataFrame([(1, None, 2.0)], "a int, b string, c double")
    path = delimited.write_delimited(df, scratch("untyped"))
    back = delimited.read_untyped(spark, path)
    assert all(t == "string" for _, t in back.dtypes)
    assert back.first()["b"] is None


def test_recommended_conf_scales_with_input():
    tb = 1 << 40
    conf = recommended_conf(100 * tb, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 204800
    small = recommended_conf(1 << 30, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert suggested_buckets(100 * tb) == 65536 and suggested_buckets(1) == 1


def test_build_session_applies_sizing(spark):
    from ledgerloom.session import build_session, recommended_conf

    keys = list(recommended_conf(1, 1)) + ["spark.sql.shuffle.partitions"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        # getOrCreate returns the running session; the sized settings are applied to it
        same = build_session(input_bytes=1 << 40, total_cores=16, shuffle_partitions=8)
        assert same.conf.get("spark.sql.files.maxPartitionBytes") in ("268435456", "256m", "256MB")
        assert same.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

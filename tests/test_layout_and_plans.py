"""Layout helpers and plan shape: pushdown, pruning, no wasted sorts, checked broadcast."""

import re

from ledgerloom.operators.layout import broadcast_if_small, measure_bounded, plan_text
from ledgerloom.plans import ledger_flow as lf
from ledgerloom.plans.registry import QUERIES

from .conftest import SF_SMALL, conf_override


def test_measure_is_exact(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a long, b string")
    size = measure_bounded(df)
    # 2 fields -> 16 bytes of slots + 8 bytes null bitmap; "abc" pads to 8
    assert size.rows == 2 and size.bytes == (24 + 8) + 24


def test_broadcast_only_when_small(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    _, small = broadcast_if_small(orders, max_bytes=64 * 1024 * 1024)
    assert small
    _, tiny_bound = broadcast_if_small(orders, max_bytes=1024)
    assert not tiny_bound


def test_replicated_join_broadcasts_checked_side(spark):
    with conf_override(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        s = lf.stage(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), lf.ORDERS)
        plain = plan_text(lf.join_left_right(s, s, lf.ORDERS), "formatted")
        hinted = plan_text(lf.join_left_right(s, s, lf.ORDERS, replicated=True), "formatted")
        assert "SortMergeJoin" in plain
        assert "BroadcastHashJoin" in hinted
        # over the bound: no hint, shuffle join
        over = plan_text(lf.join_left_right(s, s, lf.ORDERS, replicated=True, max_broadcast_bytes=10), "formatted")
        assert "SortMergeJoin" in over


def _sort_keys(text: str) -> list[str]:
    """Sort keys of every Sort node in a formatted plan (column names without ids)."""
    keys, in_sort = [], False
    for line in text.splitlines():
        if re.match(r"^\(\d+\) Sort$", line.strip()):
            in_sort = True
        elif in_sort and line.startswith("Arguments:"):
            keys.append(" ".join(re.findall(r"([A-Za-z_]+)#\d+L? (?:ASC|DESC)", line)))
            in_sort = False
    return keys


def test_flagship_plan_shape(spark):
    text = plan_text(QUERIES["avg_over_join"](spark, SF_SMALL), "formatted")
    # the only sorts are the sort-merge join's own, on the join key
    assert all(k == "o_orderkey" for k in _sort_keys(text)), _sort_keys(text)
    assert "Not(EqualTo(o_orderstatus,P))" in text
    assert "Not(EqualTo(o_orderpriority,5-LOW))" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text
    assert "partial_avg" in text


def test_sql_join_drops_subselect_sorts(spark):
    s = lf.stage(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), lf.ORDERS)
    text = plan_text(lf.sql_join(spark, s, s, lf.ORDERS, "pl", "pr"), "formatted")
    # ORDER BY o_totalprice / o_orderpriority, o_orderstatus are gone
    assert all(k == "o_orderkey" for k in _sort_keys(text)), _sort_keys(text)


def test_topk_is_bounded(spark):
    text = plan_text(QUERIES["sort_hidden_topk"](spark, SF_SMALL), "formatted")
    assert "TakeOrderedAndProject" in text


def test_sort_has_unique_tiebreak(spark):
    s = lf.stage(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), lf.ORDERS, sort=True)
    text = plan_text(s, "formatted")
    assert re.search(r"o_orderstatus#\d+ ASC NULLS FIRST, o_orderdate#\d+ ASC NULLS FIRST, "
                     r"o_orderkey#\d+L ASC NULLS FIRST", text), text


def test_driver_memory_parsing():
    from ledgerloom.operators import layout

    class Conf:
        def __init__(self, v):
            self.v = v

        def get(self, key, default=None):
            return self.v

    class SC:
        def __init__(self, v):
            self.v = v

        def getConf(self):
            return Conf(self.v)

    class S:
        def __init__(self, v):
            self.sparkContext = SC(v)

    assert layout._driver_memory_bytes(S("16g")) == 16 << 30
    assert layout._driver_memory_bytes(S("1gb")) == 1 << 30
    assert layout._driver_memory_bytes(S("512m")) == 512 << 20
    assert layout._driver_memory_bytes(S("2048")) == 2048 << 20


def test_measure_counts_wide_decimals(spark):
    df = spark.createDataFrame([(1,)], "a int").selectExpr(
        "CAST(1 AS DECIMAL(10,2)) AS narrow", "CAST(1 AS DECIMAL(30,2)) AS wide"
    )
    # 2 slots (16) + null bitmap (8) + 16 bytes for the wide decimal
    assert measure_bounded(df).bytes == 40


def test_plan_as_rows(spark):
    from pyspark.sql import functions as F

    from ledgerloom.operators import plan_rows

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    joined = orders.where("o_totalprice > 1000").join(customer, orders.o_custkey == customer.c_custkey).select("o_orderkey", "c_name")
    rows = plan_rows(joined).sort("position").collect()
    assert [r["position"] for r in rows] == list(range(len(rows)))
    scans = {r["read_columns"]: r for r in rows if r["operator"].startswith("Scan")}
    assert set(scans) == {"o_orderkey,o_custkey,o_totalprice", "c_custkey,c_name"}
    assert "GreaterThan(o_totalprice,1000.0)" in scans["o_orderkey,o_custkey,o_totalprice"]["pushed_filters"]
    assert all(r["output_rows"] is None for r in rows) and max(r["depth"] for r in rows) >= 3
    ran = plan_rows(joined, execute=True)
    join = ran.where(F.col("operator").contains("Join")).first()
    assert join["output_rows"] == joined.count()
    assert plan_rows(spark.range(3).where("id < 0"), execute=True).count() >= 1


def test_a_side_is_measured_by_its_write(spark, scratch):
    """The size that the write saw equals the measured one, and the choice runs no job."""
    from ledgerloom.operators.layout import written_side

    df = spark.range(0, 5000, 1, 4).selectExpr("id", "repeat('é', int(id % 7)) AS text", "IF(id % 3 = 0, NULL, id) AS other")
    for rows in (df, df.where("id < 0"), df.limit(1)):
        side, size = written_side(rows, scratch("side"))
        measured = measure_bounded(side)
        assert (size.rows, size.bytes) == (measured.rows, measured.bytes)
        for bound in (0, 10_000, 1 << 28):
            spark.sparkContext.setJobGroup("choice", "choice")
            _, small = broadcast_if_small(side, bound, size)
            assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("choice")) == []
            spark.sparkContext.setJobGroup("other", "other")
            assert small == broadcast_if_small(side, bound)[1]


def test_an_append_takes_the_size_of_its_keys_from_the_write(spark, scratch, monkeypatch):
    from ledgerloom.operators import KeyedTable, keyed_table

    t = KeyedTable(spark, scratch("sized"), "id")
    t.append(spark.range(100).selectExpr("id", "'a' AS v"))
    sizes = []
    choose = keyed_table.broadcast_if_small
    monkeypatch.setattr(keyed_table, "broadcast_if_small", lambda df, most, size: sizes.append(size) or choose(df, most, size))
    t.append(spark.range(50, 150).selectExpr("id", "'b' AS v"))
    assert len(sizes) == 1 and sizes[0].rows == 100 and sizes[0].bytes == measure_bounded(spark.range(100)).bytes
    assert t.count() == 150 and t.scan().where("v = 'b'").count() == 50


def test_a_broadcast_side_must_build_on_the_driver(spark, monkeypatch):
    """Nine million keys are 144 MB of rows, but about 1.4 GB while the relation is built."""
    from ledgerloom.operators import layout

    keys = layout.SideSize(rows=9_000_000, bytes=144_000_000)
    for memory, rows, small in ((1500, keys, False), (3000, keys, False), (1500, layout.SideSize(500_000, 8_000_000), True)):
        monkeypatch.setattr(layout, "_driver_memory_bytes", lambda _, memory=memory: memory << 20)
        assert broadcast_if_small(spark.range(1), size=rows)[1] == small, (memory, rows)


def test_an_append_over_the_bound_is_never_broadcast_by_file_size(spark, scratch, monkeypatch):
    """Spark's own rule takes the bytes of the key's files, which are far below its size in memory."""
    from ledgerloom.operators import KeyedTable, keyed_table

    plans, kept = [], keyed_table.persist_batch
    monkeypatch.setattr(keyed_table, "persist_batch", lambda df: plans.append(plan_text(df)) or kept(df))
    t = KeyedTable(spark, scratch("merged"), "id")
    t.append(spark.range(1000).selectExpr("id", "'a' AS v"))
    with conf_override(spark, "spark.sql.autoBroadcastJoinThreshold", str(10 << 20)):
        t.append(spark.range(500, 1500).selectExpr("id", "'b' AS v"), max_broadcast_bytes=1)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
    assert t.count() == 1500 and t.scan().where("v = 'b'").count() == 500

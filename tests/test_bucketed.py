"""Bucketed keyed tables: same semantics as plain ones, joins on the key without shuffles."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.keyed_table import KeyedTable, KeyedTableError
from ledgerloom.operators.layout import plan_text
from ledgerloom.plans import ledger_flow as lf
from ledgerloom.sources import ledger

from .conftest import conf_override

BUCKETS = 4


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(
        [(i, f"u{i % 3}", float(i)) for i in range(1, 101)], "id long, unit string, amount double"
    ).repartition(3)


@pytest.fixture()
def no_broadcast(spark):
    with conf_override(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield


def test_append_semantics(spark, scratch, rows):
    t = KeyedTable(spark, scratch("bk"), "id", buckets=BUCKETS)
    t.append(rows.where("id <= 50"))
    t.append(rows.withColumn("unit", F.lit("new")))
    t.append(rows.withColumn("unit", F.lit("newer")))
    got = {r["id"]: r["unit"] for r in t.scan().collect()}
    assert len(got) == 100
    assert all(got[i] != "new" for i in range(1, 51))
    assert all(got[i] == "new" for i in range(51, 101))
    with pytest.raises(KeyedTableError):
        t.append(spark.createDataFrame([(500, "a", 1.0), (500, "b", 2.0)], rows.schema))


def test_update_replace_and_reopen(spark, scratch, rows):
    root = scratch("bk")
    t = KeyedTable(spark, root, "id", buckets=BUCKETS)
    t.append(rows.where("id <= 50"))
    t.append(rows.where("id > 50"))
    t.update({"unit": "changed"}, F.col("id") > 75)
    t.append(rows.where("id > 95").withColumn("unit", F.lit("r")), on_conflict="replace")
    got = {r["id"]: r["unit"] for r in t.scan().collect()}
    assert len(got) == 100
    assert sum(1 for u in got.values() if u == "changed") == 20
    assert sum(1 for u in got.values() if u == "r") == 5
    # a new reader (catalog entry gone) re-registers from the log alone
    spark.sql(f"DROP TABLE {t._catalog_name()}")
    again = KeyedTable(spark, root, "id")
    assert again.count() == 100 and again.buckets == BUCKETS


def test_clone_and_bucketed_join_has_no_exchange(spark, scratch, no_broadcast):
    src = ledger.generate_ledger(spark, 2000, 4)
    tables = lf.load_left_right(spark, lf.stage(src), scratch("bk-ledger"), buckets=BUCKETS, share=True)
    assert all(s.startswith("/") or "://" in s for s in tables.right.segments())
    left, right = tables.left.scan(), tables.right.scan()
    joined = lf.join_left_right(left, right)
    text = plan_text(joined, "formatted")
    assert "SortMergeJoin" in text and "Exchange" not in text, text
    assert joined.count() == 1543
    plain = lf.avg_account_by_dept(
        lf.stage(src).where("true"), lf.stage(src).where("true")
    ).collect()
    assert sorted(lf.avg_account_by_dept(left, right).collect()) == sorted(plain)
    # right diverges from left after an update; left is untouched
    lf.update_unit(tables.right)
    assert tables.left.scan().where(F.col("BUSINESS_UNIT") == lf.UPDATE_TO_UNIT).count() == 0
    assert tables.right.scan().where(F.col("BUSINESS_UNIT") == lf.UPDATE_TO_UNIT).count() == 200
    # the rewritten segment is still correctly bucketed: the shuffle-free join finds every row
    after = lf.join_left_right(tables.left.scan(), tables.right.scan())
    assert "Exchange" not in plan_text(after, "formatted")
    assert after.count() == 1543
    both = tables.left.scan().join(tables.right.scan().select("id", "BUSINESS_UNIT"), "id")
    assert both.count() == 1800


def test_append_into_bucketed_needs_no_exchange_on_stored_side(spark, scratch, rows, no_broadcast):
    t = KeyedTable(spark, scratch("bk"), "id", buckets=BUCKETS)
    t.append(rows)
    stored = t.scan().select("id")
    text = plan_text(stored.join(t.scan().select("id"), "id", "left_anti"), "formatted")
    assert "Exchange" not in text


@pytest.mark.parametrize("buckets", [None, BUCKETS])
def test_string_keys_and_timestamps(spark, scratch, buckets):
    import datetime as dt

    df = spark.createDataFrame(
        [(f"k{i:03d}", dt.datetime(2020, 1, 1) + dt.timedelta(days=i), i * 1.5) for i in range(60)],
        "code string, at timestamp_ntz, v double",
    )
    t = KeyedTable(spark, scratch("str"), "code", buckets=buckets)
    t.append(df.where("v < 45"))
    t.append(df)
    t.update({"v": F.lit(-1.0)}, F.col("at") >= dt.datetime(2020, 2, 20))
    got = {r["code"]: (r["at"], r["v"]) for r in t.scan().collect()}
    assert len(got) == 60
    assert sum(1 for _, v in got.values() if v == -1.0) == 10
    assert t.lookup("k007").first()["v"] == 10.5
    assert dict(t.scan().dtypes)["at"] == "timestamp_ntz"


def test_catalog_database_option(spark, scratch, rows):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ledgerloom_test_db LOCATION '{scratch('test-db')}'")
    t = KeyedTable(spark, scratch("bk-db"), "id", buckets=BUCKETS, catalog_database="ledgerloom_test_db")
    t.append(rows)
    assert t.count() == 100
    assert any(tb.name.startswith("ledgerloom_kt_") for tb in spark.catalog.listTables("ledgerloom_test_db"))


def test_bucketed_lookup_reads_one_bucket_file_per_segment(spark, scratch):
    t = KeyedTable(spark, scratch("bk-lookup"), "id", buckets=8)
    data = spark.range(0, 5000).selectExpr("id", "id * 2 AS v")
    t.append(data.where("id < 2500"))
    t.append(data)
    for k in (0, 7, 2499, 2500, 4999):
        got = t.lookup(k)
        assert [r["v"] for r in got.collect()] == [2 * k]
        assert len(got.inputFiles()) <= 2  # one bucket file in each of the two segments
    assert t.lookup(123456).collect() == []


def test_a_bad_batch_never_reaches_the_buckets(spark, scratch, monkeypatch):
    """A third of the keys null, or one key in a third of the rows: rejected before the shuffle by key."""
    from pyspark.sql import functions as F

    from ledgerloom.operators import KeyedTableError, plan_rows

    t = KeyedTable(spark, scratch("bk-bad"), "id", buckets=BUCKETS)
    t.append(spark.range(100).withColumn("v", F.lit("old")))
    monkeypatch.setattr(t, "_write_segment", lambda df: pytest.fail("a bad batch was shuffled into the buckets"))
    for hot in ("NULL", "7"):
        batch = spark.range(100, 9_100, 1, 6).selectExpr(f"CASE WHEN id % 3 = 0 THEN {hot} ELSE id END AS id", "'new' AS v")
        with pytest.raises(KeyedTableError):
            t.append(batch)
        # what validation shuffles: one row per task for the hot key
        shuffled = plan_rows(batch.groupBy("id").agg(F.count(F.lit(1))), execute=True).where("operator = 'HashAggregate'").collect()
        assert shuffled[-1]["output_rows"] <= 6_000 + 6
    monkeypatch.undo()
    assert t.count() == 100 and t.append(spark.range(50, 200).withColumn("v", F.lit("new"))) and t.count() == 200

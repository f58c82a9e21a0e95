"""Keyed tables: insert-if-absent, idempotence, replace, overwrite, update, lookups, validation."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.keyed_table import KeyedTable, KeyedTableConflict, KeyedTableError


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(
        [(i, f"u{i % 3}", float(i)) for i in range(1, 101)], "id long, unit string, amount double"
    ).repartition(4)


def test_append_twice_is_idempotent(spark, scratch, rows):
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows)
    t.append(rows)
    df = t.scan()
    assert df.count() == 100
    assert df.select("id").distinct().count() == 100
    assert t.version() == 1 and len(t.segments()) == 1  # nothing new: nothing committed


def test_first_writer_wins_and_new_keys_added(spark, scratch, rows):
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows.where("id <= 50"))
    t.append(rows.withColumn("unit", F.lit("new")))
    got = {r["id"]: r["unit"] for r in t.scan().collect()}
    assert len(got) == 100
    assert all(got[i] != "new" for i in range(1, 51))
    assert all(got[i] == "new" for i in range(51, 101))


def test_replace_on_conflict(spark, scratch, rows):
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows.where("id <= 50"))
    t.append(rows.where("id > 50"))
    before = set(t.segments())
    t.append(rows.where("id > 90").withColumn("unit", F.lit("new")), on_conflict="replace")
    got = {r["id"]: r["unit"] for r in t.scan().collect()}
    assert len(got) == 100
    assert sorted(i for i, u in got.items() if u == "new") == list(range(91, 101))
    # stored segments stay; the batch is a segment of a later generation
    assert before < set(t.segments()) and len(t.segments()) == 3


def test_rejects_null_and_duplicate_keys(spark, scratch):
    t = KeyedTable(spark, scratch("kt"), "id")
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string")
    with pytest.raises(KeyedTableError, match="more than once"):
        t.append(dup)
    null = spark.createDataFrame([(None, "a")], "id long, v string")
    with pytest.raises(KeyedTableError, match="null"):
        t.append(null)
    assert not t.exists()


def test_schema_mismatch_rejected(spark, scratch, rows):
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows)
    with pytest.raises(KeyedTableError):
        t.append(rows.drop("unit"))


def test_overwrite_reading_itself(spark, scratch, rows):
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows)
    t.overwrite(t.scan().where("id % 2 = 0"))
    assert t.count() == 50
    # a reader that opens the table by path sees the latest version
    again = KeyedTable(spark, t.root, "id")
    assert again.version() == 2 and again.count() == 50


def stored_rows(spark, t, segment):
    return spark.read.parquet(t._path(segment)).count()


@pytest.mark.parametrize("buckets", [None, 4])
def test_update_writes_only_changed_rows(spark, scratch, rows, buckets):
    t = KeyedTable(spark, scratch("kt"), "id", buckets=buckets)
    t.append(rows.where("id <= 50"))
    t.append(rows.where("id > 50"))
    before = set(t.segments())
    t.update({"unit": "changed"}, F.col("id") > 75)
    (new,) = set(t.segments()) - before
    assert before <= set(t.segments()) and stored_rows(spark, t, new) == 25
    after = t.scan()
    assert after.count() == 100
    assert after.where("unit = 'changed'").count() == 25
    # a second update of some of these rows, one row only
    t.update({"unit": "again"}, F.col("id") == 100)
    (newest,) = set(t.segments()) - before - {new}
    assert stored_rows(spark, t, newest) == 1
    assert t.scan().where("unit = 'again'").count() == 1 and t.scan().where("unit = 'changed'").count() == 24
    assert [r["unit"] for r in t.lookup(100).collect()] == ["again"]
    # a fresh reader resolves the generations from the log
    assert KeyedTable(spark, t.root, "id").count() == 100
    # no match: no new version
    v = t.version()
    t.update({"unit": "x"}, "id > 1000")
    assert t.version() == v
    # overwrite folds them
    t.overwrite(t.scan())
    assert len(t.segments()) == 1 and t.scan().where("unit = 'changed'").count() == 24


def test_update_null_predicate_leaves_row(spark, scratch):
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(spark.createDataFrame([(1, None), (2, "a")], "id long, v string"))
    t.update({"v": "z"}, F.col("v") == "a")
    assert {r["id"]: r["v"] for r in t.scan().collect()} == {1: None, 2: "z"}


def test_lookups(spark, scratch, rows):
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows)
    hit = t.lookup(7).collect()
    assert len(hit) == 1 and hit[0]["amount"] == 7.0
    assert t.lookup(1000).collect() == []
    keys = spark.createDataFrame([(3,), (5,), (5,), (999,)], "k long")
    assert sorted(r["id"] for r in t.lookup_many(keys, "k").collect()) == [3, 5]


def test_lookup_prunes_row_groups(spark, scratch, rows):
    from ledgerloom.operators.layout import plan_text

    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows)
    assert "EqualTo(id,7)" in plan_text(t.lookup(7), "formatted")


def test_clone_shares_segments_and_diverges_safely(spark, scratch, rows):
    a = KeyedTable(spark, scratch("kt-a"), "id")
    b = KeyedTable(spark, scratch("kt-b"), "id")
    a.append(rows)
    b.clone_from(a)
    assert b.count() == 100
    b.update({"unit": "b-only"}, F.col("id") <= 10)
    assert a.scan().where("unit = 'b-only'").count() == 0
    assert b.scan().where("unit = 'b-only'").count() == 10
    a.append(rows.withColumn("id", F.col("id") + 1000))
    assert a.count() == 200 and b.count() == 100
    with pytest.raises(KeyedTableError):
        b.clone_from(a)


def test_lookup_many_dedups_probe(spark, scratch, rows):
    from ledgerloom.operators.layout import plan_text

    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows)
    hot = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50 + 1).alias("k"))
    found = t.lookup_many(hot, "k")
    assert sorted(r["id"] for r in found.collect()) == list(range(1, 51))
    assert "HashAggregate" in plan_text(found, "formatted")


def test_conflicts_lose_nothing_and_can_be_retried(spark, scratch, rows):
    root = scratch("kt")
    a, b = KeyedTable(spark, root, "id"), KeyedTable(spark, root, "id")
    a.append(rows.where("id <= 10"))
    assert b.version() == 1
    a.append(rows.where("id > 10 AND id <= 20"))
    # two writers on the same version: the slower one fails instead of losing rows
    with pytest.raises(KeyedTableConflict):
        b.append(rows.where("id > 30"))
    assert KeyedTable(spark, root, "id").count() == 20
    # ... and its retry builds on the newest version
    b.append(rows.where("id > 30"))
    assert b.version() == 3 and KeyedTable(spark, root, "id").count() == 90


def test_writer_in_the_middle_of_a_commit(spark, scratch, rows):
    """B loads while A's log file is there but incomplete (another tool's, or a torn copy): no row is lost."""
    import os

    root = scratch("kt")
    a, b = KeyedTable(spark, root, "id"), KeyedTable(spark, root, "id")
    a.append(rows.where("id <= 10"))
    a.append(rows.where("id > 10 AND id <= 20"))
    log = f"{root.replace('file:', '')}/_log/00000002.json"
    whole = open(log).read()
    os.remove(f"{os.path.dirname(log)}/.{os.path.basename(log)}.crc")  # Hadoop's local checksum
    with open(log, "w") as fh:
        fh.write(whole[:20])
    assert b.version() == 1
    with pytest.raises(KeyedTableConflict):
        b.append(rows.where("id > 20"))
    with open(log, "w") as fh:
        fh.write(whole)
    b.append(rows.where("id > 20"))
    assert {r["id"] for r in KeyedTable(spark, root, "id").scan().collect()} == set(range(1, 101))


def test_log_files_are_whole_and_errors_keep_their_name(spark, scratch, rows):
    import os

    from ledgerloom.operators.keyed_table import _write_once

    root = scratch("once")
    assert _write_once(spark, f"{root}/x.json", b"one")
    assert not _write_once(spark, f"{root}/x.json", b"two")
    local = root.replace("file:", "")
    assert open(f"{local}/x.json").read() == "one"
    assert [n for n in os.listdir(local) if n.endswith(".tmp")] == []
    with pytest.raises(Exception, match="(?i)not a directory|parent path"):
        _write_once(spark, f"{root}/x.json/y.json", b"under a file")


@pytest.mark.parametrize("how", ["broadcast", "shuffle", "bucketed"])
def test_append_means_the_same_on_every_path(spark, scratch, rows, how):
    t = KeyedTable(spark, scratch("kt"), "id", buckets=4 if how == "bucketed" else None)
    bound = {"max_broadcast_bytes": 1} if how == "shuffle" else {}
    t.append(rows, **bound)
    # a repeated key is rejected although the table holds it
    for batch in ([(1, "a", 1.0), (1, "b", 1.0), (500, "n", 1.0)], [(None, "a", 1.0)], [(600, "a", 1.0), (600, "a", 1.0)]):
        with pytest.raises(KeyedTableError):
            t.append(spark.createDataFrame(batch, rows.schema), **bound)
    version = t.version()
    for _ in range(3):
        t.append(rows.withColumn("unit", F.lit("new")), **bound)
    t.append(rows.where("id > 1000"), **bound)
    assert t.version() == version and len(t.segments()) == 1
    # the key's name matches in any case
    t.append(rows.select(F.col("id").alias("ID"), "unit", "amount").withColumn("ID", F.col("ID") + 50), **bound)
    assert t.count() == 150 and len(t.segments()) == 2 and t.scan().columns == rows.columns


def test_append_casts_to_stored_types(spark, scratch, rows):
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows)
    narrower = spark.createDataFrame([(500, "z", 1)], "id int, unit string, amount int")
    t.append(narrower)
    assert dict(t.scan().dtypes) == {"id": "bigint", "unit": "string", "amount": "double"}
    assert t.count() == 101


def test_bucketed_overwrite_with_new_schema(spark, scratch, rows):
    t = KeyedTable(spark, scratch("kt"), "id", buckets=4)
    t.append(rows)
    t.overwrite(rows.select("id", F.col("amount").cast("string").alias("amount_text")))
    assert t.scan().columns == ["id", "amount_text"] and t.count() == 100


def test_large_batch_path_same_semantics(spark, scratch, rows):
    """A batch over the broadcast bound takes the shuffle anti join: same result, one write."""
    t = KeyedTable(spark, scratch("kt"), "id")
    t.append(rows.where("id <= 50"))
    t.append(rows.withColumn("unit", F.lit("new")), max_broadcast_bytes=1)
    got = {r["id"]: r["unit"] for r in t.scan().collect()}
    assert len(got) == 100
    assert all(got[i] != "new" for i in range(1, 51)) and all(got[i] == "new" for i in range(51, 101))
    assert len(t.segments()) == 2
    with pytest.raises(KeyedTableError):
        t.append(spark.createDataFrame([(700, "a", 1.0), (700, "b", 2.0)], rows.schema),
                 max_broadcast_bytes=1)


@pytest.mark.parametrize("buckets", [None, 4])
def test_vacuum_removes_only_unreferenced(spark, scratch, rows, buckets):
    import os

    t = KeyedTable(spark, scratch("vac"), "id", buckets=buckets)
    t.append(rows.where("id <= 50"))
    first = t.segments()
    t.overwrite(rows)                               # first segment is now unreferenced
    clone = KeyedTable(spark, scratch("vac-clone"), "id")
    clone.clone_from(t)                             # pins t's current segment
    t.overwrite(rows.where("id > 10"))              # t's second segment: unreferenced by t, pinned
    assert t.vacuum(older_than_seconds=0) != []     # dry run lists, deletes nothing
    assert KeyedTable(spark, t.root, "id").count() == 90
    removed = t.vacuum(older_than_seconds=0, dry_run=False)
    assert len(removed) == 1 and first[0] in removed[0]
    assert t.count() == 90 and clone.count() == 100
    assert t.vacuum(older_than_seconds=0) == []
    import glob

    logs = glob.glob(t.root.replace("file:", "") + "/_log/*.json")
    assert [os.path.basename(p) for p in logs] == ["00000003.json"]
    assert KeyedTable(spark, t.root, "id").version() == 3
    # recent folders are kept whatever references them
    t.overwrite(rows.where("id > 20"))
    assert t.vacuum(dry_run=True) == []


def test_replicated_table_scans_broadcast_while_small(spark, scratch, rows):
    from ledgerloom.operators.layout import plan_text

    from .conftest import conf_override

    t = KeyedTable(spark, scratch("rep"), "id", replicated=True)
    t.append(rows)
    other = rows.select("id", F.col("amount").alias("x"))
    with conf_override(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert "BroadcastHashJoin" in plan_text(other.join(t.scan(), "id"), "formatted")
        # the layout is recorded: a fresh reader keeps it
        again = KeyedTable(spark, t.root, "id")
        assert again.replicated
        # past the bound the table joins like any other
        tight = KeyedTable(spark, t.root, "id", replicated_bytes=8)
        assert "BroadcastHashJoin" not in plan_text(other.join(tight.scan(), "id"), "formatted")
    # a new version is measured again
    v = t.version()
    t.append(rows.withColumn("id", F.col("id") + 1000))
    t.scan()
    assert t._replicated_fit[0] == v + 1


def test_a_lookup_skips_row_groups_that_lack_the_key(spark, scratch):
    """Every file spans all keys, so statistics prune nothing: the Bloom filters do."""
    from ledgerloom.operators import plan_rows

    for key_type, absent in (("long", 501), ("string", "501")):
        t = KeyedTable(spark, scratch("bloom"), "id")
        t.append(spark.range(0, 40_000, 2).selectExpr(f"CAST(id AS {key_type}) AS id", "'x' AS v").repartition(3))
        rows = {k: plan_rows(t.lookup(k), execute=True).where("operator LIKE 'Scan%'").first()["output_rows"]
                for k in (absent, type(absent)(500))}
        assert rows[absent] == 0 < rows[type(absent)(500)]
        assert t.lookup(type(absent)(500)).count() == 1 and t.lookup(absent).count() == 0

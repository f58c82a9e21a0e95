"""Line numbers from block offsets, and lookups that read one block of the source."""

import io
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import KeyedTable, load_from_source, lookup_through
from ledgerloom.operators.layout import plan_text
from ledgerloom.sources import delimited
from ledgerloom.sources.line_index import IndexedSource, block_lines, index_lines, number_rows

from .conftest import conf_override


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Three files of several small blocks, one with one header line only, one empty."""
    root = str(tmp_path_factory.mktemp("lines") / "a b%20c")
    os.mkdir(root)
    rows = []
    for name, n, end in (("part-0.csv", 400, "\n"), ("part-1.csv", 0, "\n"), ("part-2.csv", 300, "\r\n"), ("part-3.csv", 150, "\n")):
        own = [(f"r{name[5]}-{i}", "x" * (i * 7 % 90), "Ünï" if i % 3 else "") for i in range(n)]
        rows += own
        lines = ["id;filler;text", *(";".join(r) for r in own)]
        text = end.join(lines) + ("" if name == "part-3.csv" else end)
        with open(f"{root}/{name}", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    open(f"{root}/part-4.csv", "w").close()
    return root, rows


@pytest.fixture()
def small_blocks(spark):
    with conf_override(spark, "spark.sql.files.maxPartitionBytes", "2000"), conf_override(spark, "spark.sql.files.openCostInBytes", "100"):
        yield


def test_index_and_scan(spark, folder, small_blocks):
    root, rows = folder
    index = index_lines(spark, root).collect()
    assert len(index) > 10 and len({r["file"] for r in index}) == 4
    source = IndexedSource(spark, root, key="key", first=0)
    got = sorted(tuple(r) for r in source.scan().collect())
    assert got == [(i, a, b or None, c or None) for i, (a, b, c) in enumerate(rows)]


def test_lookup_reads_one_block(spark, folder, small_blocks):
    root, rows = folder
    source = IndexedSource(spark, root, key="key", first=100)
    sizes = {(r["file"], r["start"]): r["n_lines"] for r in source.index.collect()}
    assert max(sizes.values()) < 200 < len(rows)
    for i in (0, 1, 199, 399, 400, 401, 699, 700, 849):
        blocks = source.blocks_of(100 + i).collect()
        assert len(blocks) == 1
        found = source.lookup(100 + i).collect()
        assert [tuple(r) for r in found] == [(100 + i, rows[i][0], rows[i][1] or None, rows[i][2] or None)]
        # the lines that tasks read are those of that block, less a header
        read = source._rows(source.blocks_of(100 + i)).count()
        assert read == sizes[blocks[0]["file"], blocks[0]["start"]] - (blocks[0]["start"] == 0)
    for missing in (99, 100 + len(rows), -5):
        assert source.blocks_of(missing).count() == 0 and source.lookup(missing).collect() == []


def test_numbered_rows_without_a_sort(spark, folder, small_blocks):
    root, rows = folder
    numbered = number_rows(spark, root, "line", value=F.col("value"))
    plan = plan_text(numbered, "formatted")
    assert "rangepartitioning" not in plan and "Sort" not in plan
    got = sorted((r["line"], r["value"].rstrip("\r")) for r in numbered.collect())
    assert got == [(i, ";".join(r)) for i, r in enumerate(rows, 1)]
    cells = delimited.read_locale_cells(spark, root, key="key")
    assert "rangepartitioning" not in plan_text(cells, "formatted")
    ids = {r["key"]: r["cells"][0]["text"] for r in cells.collect()}
    assert ids == {i: r[0] for i, r in enumerate(rows, 1)}
    assert delimited.read_locale_cells(spark, root).count() == len(rows)


def test_without_header_and_empty(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo")
    got = number_rows(spark, str(tmp_path), "n", header=False, value=F.col("value")).collect()
    assert sorted((r["n"], r["value"]) for r in got) == [(1, "one"), (2, ""), (3, "two")]
    (tmp_path / "a.txt").write_text("")
    assert number_rows(spark, str(tmp_path), "n", value=F.col("value")).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_blocks_own_every_line_once(seed):
    rng = random.Random(seed)
    breaks = [b"\n", b"\r\n", b"\r"]
    text = b"".join(bytes(rng.choices(b"ab;", k=rng.choice([0, 1, 5, 40]))) + rng.choice(breaks) for _ in range(200)) + b"end"
    want = list(block_lines(io.BytesIO(text), 0, len(text)))
    assert b"\n".join(want) == text.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
    for size in (1, 3, 17, 64, 1000):
        cuts = range(0, len(text), size)
        for read in (1, 2, 7, 4096):
            got = [line for c in cuts for line in block_lines(io.BytesIO(text), c, min(size, len(text) - c), read)]
            # a carriage return and its line feed in two blocks end one line; only the split between them adds an empty one
            assert [g for g in got if g] == [w for w in want if w]


def test_charset_and_quotes(spark, tmp_path):
    path = str(tmp_path / "cp")
    df = spark.createDataFrame([(i, "Привет; мир" if i % 2 else "да") for i in range(20)], "n long, text string")
    delimited.write_delimited(df.coalesce(1), path, encoding="windows-1251")
    source = IndexedSource(spark, path, encoding="windows-1251")
    assert [tuple(r) for r in source.lookup(3).collect()] == [(3, "3", "Привет; мир")]
    assert {r["text"] for r in source.scan().collect()} == {"Привет; мир", "да"}


def test_read_through_stores_the_missed_row(spark, folder, scratch, small_blocks):
    root, rows = folder
    source = IndexedSource(spark, root)
    t = KeyedTable(spark, scratch("through"), "row_key")
    # an empty table: everything is a miss
    assert lookup_through(t, source, 5, store=False).first()["id"] == "r0-5" and not t.exists()
    assert lookup_through(t, source, 5).first()["id"] == "r0-5" and t.count() == 1
    load_from_source(t, source, "row_key % 10 = 0")
    version = t.version()
    assert lookup_through(t, source, 20).first()["id"] == "r0-20"
    assert lookup_through(t, source, 10_000).collect() == [] and t.version() == version
    assert lookup_through(t, source, 401).first()["id"] == "r2-1"
    assert t.version() == version + 1
    # stored rows win over the source's
    t.update({"id": "changed"}, "row_key = 401")
    assert lookup_through(t, source, 401).first()["id"] == "changed"

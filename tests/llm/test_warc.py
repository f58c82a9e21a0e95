"""Archives: exact round trips, pushdown, and skipped payloads."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import warc
from ledgerloom.llm.common import filesystem


def pages():
    same = "x" * 150
    return [
        (3, "http://a/\r\nX: 1", same), (1, None, same), (2, "http://é/%41", same), (5, "http://b", "short"), (6, "http://b", "short"),
        (7, "u", None), (8, "u", ""), (9, "u", "WARC/1.1\r\n\r\n" * 20), (10, "u", "y" * 300_000), (None, "n", "z" * 200), (11, "n", "é" * 50),
        (12, "n", "é" * 50), (1, None, same),
    ]


@pytest.fixture(scope="module")
def root(spark, rows):
    from ledgerloom.session import scratch_path

    root = scratch_path(spark, "warc")
    written = warc.write(rows("page_id long, url string, html string, digest string", [(*p, "clash") for p in pages()]), root)
    assert written.agg(F.sum("records")).first()[0] == len(pages())
    return root


def test_round_trip(spark, root):
    got = warc.read(spark, root).where("record_type <> 'warcinfo'").collect()
    assert len(got) == len(pages())
    stored = sorted((r.headers["x-page-id"], bytes(r.payload)) for r in got if r.record_type == "response")
    revisits = {r.headers["x-page-id"]: r.headers["x-refers-to-page"] for r in got if r.record_type == "revisit"}
    assert revisits == {"2": "1", "3": "1", "12": "11"}
    want = [("" if k is None else str(k), (html or "").encode()) for k, _, html in pages() if k not in (2, 3, 12)]
    assert stored == sorted(want)
    for r in got:
        if r.record_type == "response":
            assert r.payload_digest == "sha256:" + hashlib.sha256(r.payload).hexdigest()
    targets = {r.headers["x-page-id"]: r.target_uri for r in got}
    assert targets["3"] == "http://a/%0D%0AX: 1" and targets["1"] is None


def test_predicates_reach_the_reader(spark, root):
    df = warc.read(spark, root).where(F.col("record_type") == "revisit")
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("filterPushdown", "") or "record_type" not in plan.split("Filter", 1)[1]
    both = warc.read(spark, root).where((F.col("record_type").isin("response", "revisit")) & (F.col("target_uri") == "http://b"))
    assert both.count() == 2
    none = warc.read(spark, root, payload="false").where("record_type = 'response'")
    assert none.where("payload IS NOT NULL").count() == 0


def test_skipped_blocks_are_not_read(root, spark):
    uri = sorted({r.file for r in warc.read(spark, root).where("record_type = 'warcinfo'").collect()})
    for one in uri:
        store, path = filesystem(one)
        size = store.get_file_info(path).size
        buffer = warc._Buffered(store.open_input_file(path))
        buffer.skip(size - 2)
        assert buffer.take(2) == b"\r\n" and buffer.line() == b""


def test_gzip_and_broken_archives(spark, scratch):
    root = scratch("gz")
    store, path = filesystem(root)
    store.create_dir(path)
    one = warc.record({"WARC-Type": "response", "Content-Type": "application/http"}, warc.http_response(b"hello"))
    other = warc.record({"WARC-Type": "metadata"}, b"m" * 100_000)
    with open(f"{path}/a.warc.gz", "wb") as f:
        f.write(gzip.compress(other) + gzip.compress(one))
    got = warc.read(spark, root).where("record_type = 'response'").collect()
    assert [bytes(r.payload) for r in got] == [b"hello"]
    with open(f"{path}/b.warc", "wb") as f:
        f.write(b"junk\r\n")
    with pytest.raises(Exception, match="no record"):
        warc.read(spark, root).count()


def test_nothing(spark, rows, scratch):
    root = scratch("empty")
    assert warc.write(rows("page_id long, url string, html string", []), root).count() == 0
    assert warc.read(spark, root).count() == 0

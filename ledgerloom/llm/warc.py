"""Operator 9: web archives (WARC 1.1) through a PySpark Python data source.

The writer makes one archive per task: a response record per distinct payload
and a revisit record per repeat.  The reader plans partitions from the file
listing, takes predicates on record type and headers before it reads any
payload, parses each record's headers first, and jumps over the block of every
record that the predicates leave out.
"""

from __future__ import annotations

import gzip
import itertools
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from ledgerloom.llm.common import filesystem, prepare, staged, write_atomically
from ledgerloom.operators.layout import broadcast_if_small

# Payloads shorter than this are always stored.
LEAST_REVISIT_BYTES = 100
# File bytes of one read partition (a larger archive has a partition of its own).
PARTITION_BYTES = 64 * 1024 * 1024
# Payload bytes of one Arrow batch.
BATCH_BYTES = 4 * 1024 * 1024

DATE = "1970-01-01T00:00:00Z"
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122 name space of URLs

SCHEMA = (
    "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
    "headers map<string,string>, payload binary, file string, offset long"
)
# columns that are headers, and the header of each
HEADER_COLUMNS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}


# kept in header values; everything else (control and non-ASCII characters) is percent-coded
_PRINTABLE = "".join(chr(c) for c in range(32, 127))


def record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'page:{page}')}>"


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One record."""
    lines = "".join(f"{k}: {quote(v, safe=_PRINTABLE)}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def http_response(payload: bytes) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def with_first_copies(pages: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """Append ``digest`` and ``first_copy``: the smallest key among equal payloads of at least ``least`` bytes.

    ``first_copy`` is null where the row itself is that first one, or its payload
    is short or unique.  Only digests are shuffled (summed up per task), and the
    repeated ones come back as a broadcast while they are measured small.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    hashed = pages.withColumn("digest", F.sha2(text, 256))
    repeated = staged(
        hashed.where(F.octet_length(text) >= least)
        .groupBy("digest")
        .agg(F.min(key).alias("first_copy"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first_copy"),
        "repeated-payloads",
    )
    side, _ = broadcast_if_small(repeated)
    joined = hashed.join(side, "digest", "left")
    return joined.withColumn("first_copy", F.expr(f"CASE WHEN first_copy <> {key} OR {key} IS NULL THEN first_copy END"))


def write(
    pages: DataFrame,
    root: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = LEAST_REVISIT_BYTES,
) -> DataFrame:
    """Write a record per row under ``root``, one archive per task; its (file, records) table.

    A null payload is empty, a null url leaves out the target header; a row with
    a null key has an empty key header; rows that repeat a key and a payload are
    each a response.  No rows: no archive.
    """
    prepare(pages.sparkSession)
    rows = with_first_copies(
        pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload")),
        "key",
        "payload",
        least,
    ).select("key", "url", "payload", "digest", "first_copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = next(batches, None)
        if first is None:
            return
        written = []

        def save(out):
            info = b"software: ledgerloom\r\nformat: WARC File Format 1.1\r\n"
            out.write(record(_headers("warcinfo", f"archive:{part}", {"Content-Type": "application/warc-fields"}), info))
            for batch in itertools.chain([first], batches):
                _write_batch(out, batch, written)

        uri = f"{root}/part-{part:08d}.warc"
        write_atomically(uri, save)
        yield pa.RecordBatch.from_arrays(
            [pa.array([uri]), pa.array([sum(written)], pa.int64())], ["file", "records"]
        )

    return staged(rows.mapInArrow(run, "file string, records long"), "warc-files")


def _headers(kind: str, page: object, more: dict[str, str]) -> dict[str, str]:
    return {"WARC-Type": kind, "WARC-Record-ID": record_id(page), "WARC-Date": DATE, **more}


def _write_batch(out, batch: pa.RecordBatch, written: list[int]) -> None:
    for row in batch.to_pylist():
        payload = (row["payload"] or "").encode("utf-8")
        page = "" if row["key"] is None else str(row["key"])
        more = {
            "X-Page-Id": page,
            "X-Payload-Length": str(len(payload)),
            "WARC-Payload-Digest": f"sha256:{row['digest']}",
        }
        if row["url"] is not None:
            more["WARC-Target-URI"] = row["url"]
        if row["first_copy"] is None:
            more["Content-Type"] = "application/http;msgtype=response"
            out.write(record(_headers("response", page, more), http_response(payload)))
        else:
            more["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            more["WARC-Refers-To"] = record_id(row["first_copy"])
            more["X-Refers-To-Page"] = str(row["first_copy"])
            out.write(record(_headers("revisit", page, more), b""))
    written.append(batch.num_rows)


# --------------------------------------------------------------------------
# The data source
# --------------------------------------------------------------------------
@dataclass
class Archives(InputPartition):
    files: list[str]


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder or file)``.

    Options: ``payload`` ("false": no payload of any record is read),
    ``partitionBytes``.  Files end in ``.warc`` or ``.warc.gz``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() != "false"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.wanted: list[tuple[str, frozenset | None]] = []

    def pushFilters(self, filters: list[Filter]):
        """Take equality, IN and NOT NULL tests of header columns; Spark keeps the others."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADER_COLUMNS and isinstance(f, EqualTo):
                self.wanted.append((HEADER_COLUMNS[column], frozenset([f.value])))
            elif column in HEADER_COLUMNS and isinstance(f, In):
                self.wanted.append((HEADER_COLUMNS[column], frozenset(f.value)))
            elif column in HEADER_COLUMNS and isinstance(f, IsNotNull):
                self.wanted.append((HEADER_COLUMNS[column], None))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        store, path = filesystem(self.root)
        prefix = self.root[: len(self.root) - len(path)] if self.root.endswith(path) else ""
        found = store.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            return [Archives([])]
        infos = [found] if found.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
        groups: list[Archives] = []
        size = 0
        for info in sorted(infos, key=lambda x: x.path):
            if info.type != fs.FileType.File or not info.path.endswith((".warc", ".warc.gz")):
                continue
            if not groups or size + info.size > self.partition_bytes:
                groups.append(Archives([]))
                size = 0
            groups[-1].files.append(prefix + info.path)
            size += info.size
        return groups or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for uri in partition.files:
            for row in records(uri, self.wants, self.payloads):
                rows.append(row)
                size += len(row["payload"] or b"") + 1000
                if size >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    def wants(self, headers: dict[str, str]) -> bool:
        return all(
            headers.get(name) is not None and (values is None or headers[name] in values)
            for name, values in self.wanted
        )


_ARROW = pa.schema(
    [
        *((c, pa.string()) for c in HEADER_COLUMNS),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
        ("file", pa.string()),
        ("offset", pa.int64()),
    ]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


def records(uri: str, wants, payloads: bool = True) -> Iterator[dict]:
    """The records of one archive whose headers ``wants`` accepts, in file order.

    Blocks of other records are jumped over, not read.  Bytes that are no record
    raise an error.
    """
    store, path = filesystem(uri)
    with store.open_input_file(path) as raw:
        buffer = _Buffered(gzip.GzipFile(fileobj=raw) if uri.endswith(".gz") else raw)
        while True:
            at = buffer.tell()
            line = buffer.line()
            if not line:
                return
            if line.strip() == b"":
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record at byte {at} of {uri}")
            headers: dict[str, str] = {}
            while (line := buffer.line().strip(b"\r\n")) != b"":
                name, _, value = line.decode("utf-8").partition(":")
                headers[name.strip().lower()] = value.strip()
            length = int(headers["content-length"])
            if not wants(headers):
                buffer.skip(length)
                continue
            payload = None
            if payloads and headers.get("warc-type") != "revisit":
                payload = buffer.take(length)
                if headers.get("content-type", "").startswith("application/http"):
                    payload = payload.partition(b"\r\n\r\n")[2]
            else:
                buffer.skip(length)
            yield {
                **{c: headers.get(h) for c, h in HEADER_COLUMNS.items()},
                "headers": list(headers.items()),
                "payload": payload,
                "file": uri,
                "offset": at,
            }


class _Buffered:
    """Lines, exact reads and skips over a file that seeks (or a gzip stream)."""

    SIZE = 1 << 16

    def __init__(self, f):
        self.f, self.data, self.at, self.base = f, b"", 0, 0

    def tell(self) -> int:
        return self.base + self.at

    def _more(self) -> bool:
        new = self.f.read(self.SIZE)
        self.base += self.at
        self.data, self.at = self.data[self.at :] + new, 0
        return bool(new)

    def line(self) -> bytes:
        while (end := self.data.find(b"\n", self.at)) < 0:
            if not self._more():
                end = len(self.data) - 1
                break
        line, self.at = self.data[self.at : end + 1], end + 1
        return line

    def take(self, n: int) -> bytes:
        have = len(self.data) - self.at
        if n <= have:
            out, self.at = self.data[self.at : self.at + n], self.at + n
            return out
        out = self.data[self.at :] + self.f.read(n - have)
        self.base, self.data, self.at = self.base + self.at + n, b"", 0
        if len(out) < n:
            raise ValueError("archive ends inside a record")
        return out

    def skip(self, n: int) -> None:
        have = len(self.data) - self.at
        if n <= have:
            self.at += n
            return
        self.base, self.data, self.at = self.base + self.at + n, b"", 0
        self.f.seek(self.base)


def read(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """The records of the archives under ``root``; filters on header columns reach the reader."""
    prepare(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").options(**options).load(root)

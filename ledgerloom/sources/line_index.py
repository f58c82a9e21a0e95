"""Line numbers of delimited files from block offsets, and reads of single blocks.

Spark reads text in blocks (file, start, length).  An index has one row per block with
the number of its first line: one count per block and prefix sums over the counts, first
inside a file, then over the files by name.  A line's number is its block's plus its
place in the block, so nothing is sorted and no line is shuffled.

* ``number_rows`` numbers rows made from a text scan in one pass over the files.
* ``IndexedSource`` finds the one block that can hold a line number and reads only the
  bytes of that block; a scan reads every block once, with its numbers.

Blocks are read by tasks through pyarrow's file systems (local, HDFS, S3 and others that
it knows) with the rule of Hadoop's line reader: a block owns the lines that start after
its first byte and up to its end, the first block also the line at 0.  Files are
uncompressed text; a line is one record, so a quoted line break is not supported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators.layout import broadcast_if_small, written_side
from ledgerloom.session import scratch_path

INDEX_SCHEMA = "file string, start long, length long, first_line long, n_lines long"
LINE_BREAK = re.compile(rb"\r\n|\n|\r")
READ_BYTES = 1 << 20
# lines that a task hands on at once
BATCH_LINES = 10_000


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _first_lines(blocks: DataFrame, header: bool) -> DataFrame:
    """Append ``first_line`` to blocks (``file, start, n_lines``).

    Lines are numbered from 1 over all files by name.  With ``header`` the first line of
    a file has no number of its own: it gets the one before the file's first row.
    """
    skipped = int(header)
    per_file = blocks.groupBy("file").agg((F.sum("n_lines") - skipped).alias("_rows"))
    # one row per file
    files = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_file.select("file", F.coalesce(F.sum("_rows").over(files), F.lit(0)).alias("_earlier"))
    earlier, size = written_side(earlier, scratch_path(blocks.sparkSession, "file-offsets"))
    # one row per block of a file
    inside = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_inside", F.coalesce(F.sum("n_lines").over(inside), F.lit(0)))
    number = (F.col("_earlier") + F.col("_inside") + F.lit(1 - skipped)).cast("long")
    return placed.join(broadcast_if_small(earlier, size=size)[0], "file").withColumn("first_line", number).drop("_earlier", "_inside")


def index_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The written index of the files under ``path`` (``INDEX_SCHEMA``): one pass that only counts."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
    )
    blocks = _written(lines.groupBy("file", "start", "length").agg(F.count(F.lit(1)).alias("n_lines")), "line-counts")
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
    return _written(_first_lines(blocks, header).select(*names), "line-index")


def number_rows(spark: SparkSession, path: str, key: str, header: bool = True, **columns) -> DataFrame:
    """``key`` and ``columns`` (of the line, ``value``) for every line but the files' headers.

    The rows are written once with their block and place; the blocks' counts come from
    there, and the numbers are added when the rows are read.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
        *(c.alias(n) for n, c in columns.items()),
    )
    rows = _written(rows, "numbered-rows")
    counts = rows.groupBy(F.col("_file").alias("file"), F.col("_start").alias("start")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("_line").alias("_first")
    )
    placed = _first_lines(_written(counts, "line-counts"), header)
    blocks, size = written_side(
        placed.select(F.col("file").alias("_file"), F.col("start").alias("_start"), "first_line", "_first"),
        scratch_path(spark, "line-index"),
    )
    numbered = rows.join(broadcast_if_small(blocks, size=size)[0], ["_file", "_start"])
    if header:
        numbered = numbered.where("_start > 0 OR _line > _first")
    place = (F.col("first_line") + F.col("_line") - F.col("_first")).cast("long")
    return numbered.select(place.alias(key), *columns)


def _filesystem(uri: str):
    from pyarrow import fs

    # Spark's paths are URL-encoded
    local = uri.startswith("file:")
    return (fs.LocalFileSystem(), unquote(urlparse(uri).path)) if local else fs.FileSystem.from_uri(uri)


def block_lines(file, start: int, length: int, read_bytes: int = READ_BYTES) -> Iterator[bytes]:
    """The lines that a block of an open file owns, without their line breaks."""
    file.seek(start)
    end, at, skip, rest = start + length, start, start > 0, b""
    while True:
        # a line longer than what was read so far is read in doubling steps
        chunk = file.read(max(read_bytes, len(rest)))
        data, cut = rest + chunk, 0
        for found in LINE_BREAK.finditer(data):
            if chunk and found.end() == len(data) and found.group() == b"\r":
                break  # its line feed may follow
            if not skip:
                yield data[cut : found.start()]
            skip = False
            at, cut = at + found.end() - cut, found.end()
            if at > end:
                return
        rest = data[cut:]
        if not chunk:
            if rest and not skip:
                yield rest
            return


def _block_reader(header: bool, encoding: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("line", pa.int64()), ("value", pa.string())])

        def batch(first: int, values: list[bytes]) -> pa.RecordBatch:
            texts = [v.decode(encoding, "replace") for v in values]
            return pa.record_batch([pa.array(range(first, first + len(texts)), pa.int64()), pa.array(texts, pa.string())], schema=schema)

        for block in (b for batch_ in batches for b in batch_.to_pylist()):
            store, path = _filesystem(block["file"])
            with store.open_input_file(path) as file:
                number, held = block["first_line"], []
                for i, value in enumerate(block_lines(file, block["start"], block["length"])):
                    if header and block["start"] == 0 and i == 0:
                        number += 1
                        continue
                    held.append(value)
                    if len(held) == BATCH_LINES:
                        yield batch(number, held)
                        number, held = number + len(held), []
                if held:
                    yield batch(number, held)

    return read


class IndexedSource:
    """Delimited files with a header, their rows keyed by line: ``first`` for the first row, and so on.

    Columns are the header's, all text (as ``read_untyped``), after the key column.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "row_key", sep: str = ";", encoding: str = "UTF-8", first: int = 0):
        from ledgerloom.sources.delimited import read_delimited

        self.spark, self.path, self.key, self.sep, self.encoding, self.first = spark, path, key, sep, encoding, first
        plain = encoding.upper().replace("-", "") == "UTF8"
        self.columns = read_delimited(spark, path, sep=sep, encoding=None if plain else encoding).columns
        if key in self.columns:
            raise ValueError(f"the files have a column {key!r}")
        self.index = index_lines(spark, path)

    def blocks_of(self, key_value: int) -> DataFrame:
        """The index row of the block that holds a key: one, or none if no line has the key."""
        line = int(key_value) - self.first + 1
        # the header counts as a line of its block, but has the number before it
        own = F.when(F.col("start") == 0, F.col("first_line") + 1).otherwise(F.col("first_line"))
        return self.index.where((own <= line) & (line < F.col("first_line") + F.col("n_lines")))

    def _rows(self, blocks: DataFrame) -> DataFrame:
        lines = blocks.mapInArrow(_block_reader(True, self.encoding), "line long, value string")
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in self.columns)
        cells = F.from_csv("value", schema, {"sep": self.sep})
        key = (F.col("line") + F.lit(self.first - 1)).alias(self.key)
        return lines.select(key, cells.alias("cells")).select(self.key, *(F.col("cells")[c].alias(c) for c in self.columns))

    def lookup(self, key_value: int) -> DataFrame:
        """The row with that key, or none; only its block is read."""
        return self._rows(self.blocks_of(key_value)).where(F.col(self.key) == F.lit(int(key_value)))

    def scan(self) -> DataFrame:
        """All rows with their keys, a task per block."""
        blocks = self.index.count()
        return self._rows(self.index.repartition(max(1, blocks)))

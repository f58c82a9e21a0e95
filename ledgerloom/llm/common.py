"""Helpers shared by the llm operators: session preparation, files, slices of batches."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir, scratch_path

# Rows handed to a Python worker at once: texts are a few KB on average, so a
# batch is a few MB, and a batch of very long texts still fits a worker.
ARROW_ROWS = 1000
# Characters handled by one vectorised step inside a worker.
SLICE_CHARS = 4_000_000


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session ready for the Python-side operators.

    Workers must be able to import this package (a cluster ships it with
    ``--py-files``; locally its folder is put on the workers' path), Arrow
    batches stay small, and checkpoints go to the shared folder.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, env.get("PYTHONPATH", "")) if p)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) != ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ensure_checkpoint_dir(spark)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows dealt evenly (round-robin) over the shuffle partitions."""
    return df.repartition(parts or shuffle_partitions(df.sparkSession))


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key's decimal text, modulo ``divisor`` (the fold of a row)."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % divisor


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` of at most ``most`` characters each (a longer text alone)."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def strings(column: pa.Array) -> list[str]:
    """Values of a string column; null becomes the empty string."""
    return [x or "" for x in column.to_pylist()]


# --------------------------------------------------------------------------
# Files that tasks write and read themselves (binary id files, web archives)
# --------------------------------------------------------------------------
def filesystem(uri: str):
    """(pyarrow filesystem, path) of a local, ``file:`` or other URI."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri)


def write_atomically(uri: str, write: Callable) -> int:
    """Write a file under a private name and rename it when complete; its size in bytes.

    A task that is retried or run twice writes the same bytes under the same
    final name, so readers see the whole file or none.
    """
    store, path = filesystem(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as out:
        write(out)
        size = out.tell()
    store.move(part, path)
    return size


def read_bytes(uri: str) -> bytes:
    store, path = filesystem(uri)
    with store.open_input_file(path) as f:
        return f.read()


def tidy(run: Callable) -> Callable:
    """A batch function that gives a task's free memory back to the system when it ends.

    Workers outlive their tasks, and an idle one otherwise keeps the work space of
    the largest task it has run.
    """

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # glibc only
            ctypes.CDLL(None).malloc_trim(0)

    return tidied

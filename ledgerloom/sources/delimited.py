"""Delimited text: writers, typed/untyped readers, and a locale-tolerant cell reader.

All readers are plain ``spark.read`` scans, so Catalyst prunes columns and
pushes filters into them.  Supply a schema for typed reads whenever one is
known: schema inference costs an extra full pass over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.cells import locale_cell
from ledgerloom.operators.layout import broadcast_if_small
from ledgerloom.session import enable_legacy_charsets
from ledgerloom.sources.line_index import number_rows

DEFAULT_SEP = ";"


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = DEFAULT_SEP,
    header: bool = True,
    encoding: str | None = None,
    mode: str = "errorifexists",
) -> str:
    """Write ``df`` as delimited text, one file per partition, header in each file."""
    writer = df.write.mode(mode).option("sep", sep).option("header", str(header).lower())
    if encoding:
        enable_legacy_charsets(df.sparkSession)
        writer = writer.option("encoding", encoding)
    writer.csv(path)
    return path


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    sep: str = DEFAULT_SEP,
    header: bool = True,
    encoding: str | None = None,
) -> DataFrame:
    """General delimited scan; without schema or ``infer`` every column is a string."""
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    if encoding:
        enable_legacy_charsets(spark)
        reader = reader.option("encoding", encoding)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_untyped(spark: SparkSession, path: str, sep: str = DEFAULT_SEP) -> DataFrame:
    """Header names, every cell a string, missing cells null."""
    return read_delimited(spark, path, sep=sep)


def read_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    encoding: str = "windows-1251",
    sep: str = DEFAULT_SEP,
) -> DataFrame:
    """Typed scan in a legacy charset; infers types only when no schema is given."""
    return read_delimited(
        spark, path, schema=schema, infer=schema is None, sep=sep, encoding=encoding
    )


def read_locale_cells(spark: SparkSession, path: str, sep: str = DEFAULT_SEP,
                      key: str | None = None) -> DataFrame:
    """Read a delimited file as typed cells: ``cells array<struct<num,text>>``.

    With ``key``, rows also get a dense long key 1, 2, 3, ... in the order of the
    lines (files by name), from the line counts of the blocks: no sort, no shuffle of rows.

    The first line of every file is its header; every other line becomes one row,
    also one that repeats the header.  The line is split on ``sep`` with trailing
    empty cells dropped, as Java's split does it: rows can be shorter than the
    header, a line of separators alone has no cell, an empty line has one empty
    cell.  Each cell is typed by :func:`locale_cell`.
    """
    if len(sep) != 1:
        raise ValueError("single-character separator expected")
    quoted = "\\" + sep if sep in "\\^$.|?*+()[]{}" else sep
    trimmed = F.regexp_replace(F.col("value"), f"{quoted}+$", "")
    raw = F.when((trimmed == "") & (F.col("value") != ""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, quoted, -1)
    )
    typed = F.transform(raw, lambda cell: locale_cell(cell))
    if key is not None:
        return number_rows(spark, path, key, cells=typed)
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    # the first line of a file is the lowest of its first block; one row per file, broadcast while measured small
    headers = lines.where("_block = 0").groupBy("_file").agg(F.min("_line").alias("_line")).select("_line")
    body = lines.join(broadcast_if_small(headers)[0], "_line", "left_anti")
    return body.select(typed.alias("cells"))

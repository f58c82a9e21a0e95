"""The synthetic ledger, generated in parallel from row ordinals.

Every column is a closed form of the 0-based ordinal ``i``, so any partition
can produce its slice without coordination: ``spark.range(n)`` spreads the
ordinals, and the same columns can be derived from any integer column of an
existing table (``ledger_from_ordinals``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.delimited import write_delimited

# The ledger file layout (header order and constant cells).
LEDGER_COLUMNS = [
    "id",
    "BUSINESS_UNIT",
    "JOURNAL_DATE",
    "LEDGER",
    "ACCOUNT",
    "ALTACCT",
    "DEPTID",
    "OPERATING_UNIT",
    "PRODUCT",
    "ACRUAL_IND_SFI",
    "GEO_AREA_SFI",
    "PROF_CTR_OFC_SFI",
]
# Columns whose cell is always the column name itself.
_CONSTANT_COLUMNS = {
    "JOURNAL_DATE",
    "LEDGER",
    "ALTACCT",
    "OPERATING_UNIT",
    "ACRUAL_IND_SFI",
    "GEO_AREA_SFI",
    "PROF_CTR_OFC_SFI",
}
# Cycled columns: name -> (offset added to i, modulus); cell = name || ((i + offset) % modulus)
_CYCLED_COLUMNS = {"BUSINESS_UNIT": (0, 10), "DEPTID": (1, 7), "PRODUCT": (2, 11)}
# ACCOUNT = max((i + 99) % 1000, 100)
_ACCOUNT_OFFSET, _ACCOUNT_MOD, _ACCOUNT_FLOOR = 99, 1000, 100


def ledger_schema() -> T.StructType:
    fields = []
    for name in LEDGER_COLUMNS:
        if name == "id":
            fields.append(T.StructField(name, T.LongType(), True))
        elif name == "ACCOUNT":
            fields.append(T.StructField(name, T.IntegerType(), True))
        else:
            fields.append(T.StructField(name, T.StringType(), True))
    return T.StructType(fields)


def _ledger_column(name: str, i: Column) -> Column:
    if name == "id":
        return (i + 1).cast("long")
    if name == "ACCOUNT":
        return F.greatest((i + _ACCOUNT_OFFSET) % _ACCOUNT_MOD, F.lit(_ACCOUNT_FLOOR)).cast("int")
    if name in _CONSTANT_COLUMNS:
        return F.lit(name)
    offset, modulus = _CYCLED_COLUMNS[name]
    return F.concat(F.lit(name), ((i + offset) % modulus).cast("string"))


def ledger_from_ordinals(df: DataFrame, ordinal: str = "id") -> DataFrame:
    """Ledger rows for the 0-based ordinals in column ``ordinal`` of ``df``."""
    i = F.col(ordinal).cast("long")
    return df.select([_ledger_column(name, i).alias(name) for name in LEDGER_COLUMNS])


# Rows per generator task when no partition count is given: tasks stay short
# (cheap to retry after a lost executor) and output files stay moderate.
ROWS_PER_TASK = 5_000_000


def generate_ledger(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    """``n`` ledger rows, computed in parallel (no driver loop, no single writer)."""
    if num_partitions is None:
        num_partitions = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    return ledger_from_ordinals(spark.range(0, n, 1, num_partitions), "id")


def write_ledger_file(
    spark: SparkSession,
    n: int,
    path: str,
    num_partitions: int | None = None,
    encoding: str | None = None,
) -> str:
    """Write the ledger as ``;``-separated text with a header (one file per task)."""
    return write_delimited(generate_ledger(spark, n, num_partitions), path, encoding=encoding)

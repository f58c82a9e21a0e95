"""Operators a Spark user calls on tables: keyed tables, row indexes, layout helpers."""

from ledgerloom.operators.indexing import dense_index, with_row_index
from ledgerloom.operators.keyed_table import KeyedTable, KeyedTableConflict, KeyedTableError
from ledgerloom.operators.layout import (
    broadcast_if_small,
    measure_bounded,
    partition_by_key,
    persist_in_memory,
    plan_rows,
    plan_text,
    sort_with_tiebreak,
)
from ledgerloom.operators.read_through import load_from_source, lookup_through

__all__ = [
    "KeyedTable",
    "KeyedTableConflict",
    "KeyedTableError",
    "broadcast_if_small",
    "dense_index",
    "load_from_source",
    "lookup_through",
    "measure_bounded",
    "partition_by_key",
    "persist_in_memory",
    "plan_rows",
    "plan_text",
    "sort_with_tiebreak",
    "with_row_index",
]

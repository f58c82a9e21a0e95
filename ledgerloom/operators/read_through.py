"""Lookups that read through a keyed table to the source it was loaded from."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.operators.keyed_table import KeyedTable
from ledgerloom.sources.line_index import IndexedSource


def load_from_source(table: KeyedTable, source: IndexedSource, where: str | None = None) -> int:
    """Load the source's rows (those where ``where`` holds) into the table; its version afterwards."""
    rows = source.scan()
    # line numbers are unique by construction
    return table.append(rows if where is None else rows.where(where), validate=False)


def lookup_through(table: KeyedTable, source: IndexedSource, key_value: int, store: bool = True) -> DataFrame:
    """The table's row for a key; if it has none, the source's, or an empty frame.

    A miss reads the one block of the source that can hold the key.  With ``store`` its
    row is added to the table, so the next lookup of the key is a hit; a key that the
    source lacks changes nothing.
    """
    if table.exists():
        hit = table.lookup(key_value)
        if not hit.isEmpty():
            return hit
    row = source.lookup(key_value)
    if not store or row.isEmpty():
        return row
    table.append(row)
    return table.lookup(key_value)

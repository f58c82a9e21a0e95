"""Sources and sinks: delimited text, the ledger generator, Parquet."""

from ledgerloom.sources.delimited import (
    read_delimited,
    read_locale_cells,
    read_typed,
    read_untyped,
    write_delimited,
)
from ledgerloom.sources.ledger import (
    LEDGER_COLUMNS,
    generate_ledger,
    ledger_from_ordinals,
    ledger_schema,
    write_ledger_file,
)
from ledgerloom.sources.line_index import IndexedSource, index_lines, number_rows
from ledgerloom.sources.parquet import read_parquet, write_parquet

__all__ = [
    "LEDGER_COLUMNS",
    "IndexedSource",
    "generate_ledger",
    "index_lines",
    "ledger_from_ordinals",
    "ledger_schema",
    "number_rows",
    "read_delimited",
    "read_locale_cells",
    "read_parquet",
    "read_typed",
    "read_untyped",
    "write_delimited",
    "write_ledger_file",
    "write_parquet",
]

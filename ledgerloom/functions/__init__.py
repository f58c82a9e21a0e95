"""Column expressions used by the sources and plans (all JVM-side, codegen-friendly)."""

from ledgerloom.functions.cells import (
    CELL_TYPE,
    double_or_zero,
    locale_cell,
    required_double,
    unsafe_row_bytes,
)

__all__ = ["CELL_TYPE", "double_or_zero", "locale_cell", "required_double", "unsafe_row_bytes"]

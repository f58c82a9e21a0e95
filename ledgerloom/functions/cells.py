"""Cell-level typing rules as built-in column expressions.

``locale_cell`` types one text cell the way the passenger loader does: an empty
cell is NaN, a plain number is a double, a number written with a French decimal
comma (and optional no-break-space grouping) is parsed from the longest numeric
prefix, and anything else stays text.  The result is ``struct<num double, text
string>`` with exactly one side set, so a column of mixed cells keeps one type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL_TYPE = T.StructType(
    [T.StructField("num", T.DoubleType(), True), T.StructField("text", T.StringType(), True)]
)

# The French number format (decimal comma; grouping by U+00A0, or
# U+202F in newer locale data).  A prefix matches an optional minus sign, then
# digits with grouping spaces and an optional comma part, or a bare ",digits";
# then an optional exponent ("E", an optional minus sign, digits).
_FRENCH_PREFIX = "^(-?(?:[0-9][0-9\u00a0\u202f]*(?:,[0-9]*)?|,[0-9]+)(?:E-?[0-9]+)?)"
_FRENCH_GROUPING = "[\u00a0\u202f]"
# The French format's infinity symbol, read as a prefix like the digits.
_FRENCH_INFINITY = "^(-?)\u221e"
# Spellings of infinity / NaN that Spark's cast accepts but a plain Java
# double parse rejects (which only takes "Infinity" and "NaN", optionally
# signed, case-sensitive): such cells are not plain numbers.
_LENIENT_SPECIALS = "(?i)^\\s*[+-]?(inf|infinity|nan)\\s*$"
_JAVA_SPECIALS = "^\\s*[+-]?(Infinity|NaN)\\s*$"


def java_double(c: Column) -> Column:
    """A double parse with Java's grammar: ``try_cast`` minus Spark's extra
    spellings of infinity and NaN.  Null when the text is not a number."""
    number = c.try_cast("double")
    # no special spelling is a finite number: most cells need no pattern
    return (
        F.when(F.abs(number) < F.lit(float("inf")), number)
        .when(c.rlike(_LENIENT_SPECIALS) & ~c.rlike(_JAVA_SPECIALS), F.lit(None).cast("double"))
        .otherwise(number)
    )


def locale_cell(cell: Column | str) -> Column:
    """Type one text cell: empty/null -> NaN, number -> double, else text."""
    c = F.col(cell) if isinstance(cell, str) else cell
    plain = java_double(c)
    prefix = F.regexp_extract(c, _FRENCH_PREFIX, 1)
    french = F.regexp_replace(F.regexp_replace(prefix, _FRENCH_GROUPING, ""), ",", ".")
    # "-" or "," alone is not a number: require a digit in the prefix
    french_num = (
        F.when(prefix.rlike("[0-9]"), french.try_cast("double"))
        .when(c.rlike(_FRENCH_INFINITY), F.when(c.startswith("-"), F.lit(float("-inf")))
              .otherwise(F.lit(float("inf"))))
    )
    num = (
        F.when(c.isNull() | (c == ""), F.lit(float("nan")))
        .when(plain.isNotNull(), plain)
        .otherwise(french_num)
    )
    text = F.when(c.isNotNull() & (c != "") & num.isNull(), c)
    return F.struct(num.alias("num"), text.alias("text"))


def required_double(cell: Column | str, name: str | None = None) -> Column:
    """Parse a required numeric cell; a null or malformed value fails the job."""
    c = F.col(cell) if isinstance(cell, str) else cell
    label = name or (cell if isinstance(cell, str) else "cell")
    parsed = java_double(c.cast("string"))
    message = F.concat(
        F.lit(f"{label}: not a number: "), F.coalesce(c.cast("string"), F.lit("null"))
    )
    return F.when(parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def double_or_zero(cell: Column | str, name: str | None = None) -> Column:
    """Optional numeric cell: null -> 0.0, otherwise parsed (malformed still fails)."""
    c = F.col(cell) if isinstance(cell, str) else cell
    return F.when(c.isNull(), F.lit(0.0)).otherwise(required_double(c, name))


_FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def fixed_row_bytes(fields: int) -> int:
    """Least size of a row in Spark's binary layout: a slot per field and the null bitmap."""
    return 8 * fields + 8 * ((fields + 63) // 64)


def unsafe_row_bytes(schema: T.StructType) -> Column:
    """Exact in-memory size of a row in Spark's binary row layout.

    8 bytes per field slot, a null bitmap of 8 bytes per 64 fields, plus the
    variable-length payload (strings, binaries, nested values) rounded up to
    8 bytes.  Used to prove a broadcast side fits before broadcasting it.
    """
    total: Column = F.lit(fixed_row_bytes(len(schema.fields))).cast("long")
    for field in schema.fields:
        dt = field.dataType
        c = F.col(f"`{field.name}`")
        if any(isinstance(dt, t) for t in _FIXED_WIDTH):
            continue
        if isinstance(dt, T.DecimalType):
            # up to 18 digits fit the 8-byte slot; wider decimals take 16 more bytes
            if dt.precision > 18:
                total = total + F.lit(16)
            continue
        if isinstance(dt, (T.StringType, T.BinaryType)):
            var = F.octet_length(c)
        else:
            var = F.octet_length(F.to_json(F.struct(c)))
        total = total + F.coalesce(((var + 7) / 8).cast("long") * 8, F.lit(0))
    return total

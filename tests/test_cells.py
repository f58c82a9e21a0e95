"""Locale-tolerant cell typing: fixed table plus a property test against a plain-Python model."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions.cells import double_or_zero, locale_cell, required_double

NBSP = "\u00a0"  # no-break space
NNBSP = "\u202f"  # narrow no-break space

# (cell, expected num, expected text); None num + text = stays text
TABLE = [
    ("29", 29.0, None),
    ("12,5", 12.5, None),
    ("", math.nan, None),
    ("abc", None, "abc"),
    ("3abc", 3.0, None),
    ("-7,25x", -7.25, None),
    (f"1{NBSP}234,5", 1234.5, None),
    (f"1{NNBSP}234,5", 1234.5, None),
    ("1e3", 1000.0, None),
    ("5 Main St", 5.0, None),
    ("12.5.6", 12.0, None),
    (",5", 0.5, None),
    ("-", None, "-"),
    (",", None, ","),
    # special values: a plain Java double parse takes only these spellings
    ("Infinity", math.inf, None),
    ("-Infinity", -math.inf, None),
    ("NaN", math.nan, None),
    ("inf", None, "inf"),
    ("nan", None, "nan"),
    ("1.5d", 1.5, None),
    # exponents of the French format: a capital E, an optional minus sign, digits
    ("12E3rue", 12000.0, None),
    ("1,5E3", 1500.0, None),
    ("1,5E-1x", 0.15, None),
    ("12E rue", 12.0, None),
    ("12e3rue", 12.0, None),
    ("12E+3rue", 12.0, None),
    # the French infinity symbol, read as a prefix
    ("\u221e", math.inf, None),
    ("-\u221e x", -math.inf, None),
]


def _same(a, b):
    if a is None or b is None:
        return a is b
    if math.isnan(b):
        return math.isnan(a)
    return a == b


def test_cell_table(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in TABLE], "cell string")
    rows = df.select("cell", locale_cell("cell").alias("v")).collect()
    got = {r["cell"]: (r["v"]["num"], r["v"]["text"]) for r in rows}
    for cell, num, text in TABLE:
        gnum, gtext = got[cell]
        assert _same(gnum, num), (cell, gnum, num)
        assert gtext == text, (cell, gtext, text)


def test_null_cell_is_empty(spark):
    df = spark.createDataFrame([(None,)], "cell string")
    v = df.select(locale_cell("cell").alias("v")).first()["v"]
    assert math.isnan(v["num"]) and v["text"] is None


def scan_french(cell):
    """Longest French number at the start, read character by character; None if there is none."""
    i, digits, fraction, exponent = 0, "", "", ""
    negative = cell.startswith("-")
    i += negative
    while i < len(cell) and (cell[i].isdigit() or digits and cell[i] in (NBSP, NNBSP)):
        digits += cell[i] if cell[i].isdigit() else ""
        i += 1
    if i < len(cell) and cell[i] == ",":
        i += 1
        while i < len(cell) and cell[i].isdigit():
            fraction += cell[i]
            i += 1
    if not digits and not fraction:
        return None
    if i < len(cell) and cell[i] == "E":
        j = i + 1 + (cell[i + 1 : i + 2] == "-")
        k = j
        while k < len(cell) and cell[k].isdigit():
            k += 1
        exponent = cell[i + 1 : k] if k > j else ""
    value = float(f"{digits or 0}.{fraction or 0}e{exponent or 0}")
    return -value if negative else value


def plain_number(cell):
    """What a plain double parse takes, among the characters the test draws."""
    body = cell[1:] if cell[:1] == "-" else cell
    mantissa, mark, power = body.partition("e" if "e" in body else "E")
    whole, _, part = mantissa.partition(".")
    ok = (whole + part).isdigit() and (not mark or power.removeprefix("-").isdigit())
    return float(cell) if ok else None


def model(cell):
    """Brute-force Python statement of the rule."""
    if cell == "":
        return math.nan, None
    plain = plain_number(cell)
    if plain is not None:
        return plain, None
    french = scan_french(cell)
    return (french, None) if french is not None else (None, cell)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="0123456789,-.eEab" + NBSP, max_size=7), min_size=200, max_size=200))
def test_cells_match_model(spark, cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, cell string")
    got = {r["i"]: r["v"] for r in df.select("i", locale_cell("cell").alias("v")).collect()}
    for i, cell in enumerate(cells):
        num, text = model(cell)
        assert _same(got[i]["num"], num), (cell, got[i], num)
        assert got[i]["text"] == text, (cell, got[i], text)


def test_double_defaults(spark):
    df = spark.createDataFrame([("1.5", None), ("2", "3")], "a string, b string")
    rows = df.select(required_double("a").alias("a"), double_or_zero("b").alias("b")).collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1.5, 0.0), (2.0, 3.0)]


def test_required_double_fails_on_bad_cell(spark):
    import pytest

    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="not a number"):
        df.select(required_double("a")).collect()


def test_read_locale_cells_keys_and_ragged_rows(spark, scratch):
    from ledgerloom.sources.delimited import read_locale_cells

    path = scratch("cells")
    lines = ["a;b;c", "1;2,5;x", ";7;", "3;;4 rue", "a;b;c", ";;", ""]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = sorted(read_locale_cells(spark, path, key="k").collect(), key=lambda r: r["k"])
    assert [r["k"] for r in rows] == [1, 2, 3, 4, 5, 6]
    first, second, third, header, separators, empty = (r["cells"] for r in rows)
    assert [c["text"] for c in header] == ["a", "b", "c"]  # a data line, although it equals the header
    assert separators == [] and len(empty) == 1 and math.isnan(empty[0]["num"])
    assert [c["num"] for c in first[:2]] == [1.0, 2.5] and first[2]["text"] == "x"
    assert len(second) == 2 and math.isnan(second[0]["num"]) and second[1]["num"] == 7.0
    assert third[0]["num"] == 3.0 and math.isnan(third[1]["num"]) and third[2]["num"] == 4.0


def test_required_double_rejects_lenient_specials(spark):
    import pytest

    ok = spark.createDataFrame([("Infinity",), ("-NaN",), ("2.5",)], "a string")
    got = [r[0] for r in ok.select(required_double("a")).collect()]
    assert got[0] == math.inf and math.isnan(got[1]) and got[2] == 2.5
    bad = spark.createDataFrame([("inf",)], "a string")
    with pytest.raises(Exception, match="not a number"):
        bad.select(required_double("a")).collect()


def test_finite_numbers_and_special_spellings(spark):
    """Numbers need no pattern; only Java's spellings of the specials are numbers."""
    from ledgerloom.functions.cells import java_double

    inf = float("inf")
    want = {"1": 1.0, " -2.5e3 ": -2500.0, "1e400": inf, "-1e400": -inf, "Infinity": inf, "-Infinity": -inf, "+Infinity": inf,
            "inf": None, "INF": None, "-inf": None, "infinity": None, "nan": None, "NAN": None, "": None, "x": None, None: None}
    df = spark.createDataFrame([(k,) for k in want] + [("NaN",)], "c string").select("c", java_double(F.col("c")).alias("d"))
    got = {r["c"]: r["d"] for r in df.collect()}
    assert got.pop("NaN") != got.get("1") and got == want

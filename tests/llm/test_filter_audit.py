"""The filter audit against a walk through all orders, with odd rows."""

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import filter_audit

DOCS = "doc_id long, text string, lang string, n int, part string, bits int, good int"
LONG = " ".join(f"w{i}" for i in range(120))
TEXTS = [
    (1, LONG), (2, LONG), (3, None), (4, ""), (5, " \t\n "), (6, "word " * 150), (7, LONG.upper()), (8, LONG + " $"),
    (9, "ONE # two"), (10, "ONE # two"), (None, LONG), (None, "ONE # two"), (11, LONG), (11, LONG), (12, " ".join(["É"] * 200)),
    (13, "x y " * 60_000), (14, "A" * 50 + "b" * 450), (15, "A" * 51 + "b" * 449), (1, "again |"), (16, "a b " * 100),
]


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    ]


def brute(docs, labels):
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        earlier = doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in docs)
        mine = [m for m in labels if doc_id is not None and m[0] == doc_id]
        rows.append((lang or "", [*fails(text), earlier], any(m[1] == 1 for m in mine), any(m[2] == 1 for m in mine)))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                removed = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                shapley[part, f] += len(removed)
                out[part, "".join("ABCDE"[o] for o in order), step] = [
                    f, len(left), len(removed), sum(r[1][f] for r in own) - len(removed),
                    sum(r[1][f] and sum(r[1]) == 1 for r in own), sum(r[2] for r in removed), sum(r[3] for r in removed),
                ]
    return sorted((*k, *v[1:], shapley[k[0], v[0]]) for k, v in out.items())


def test_audit_by_brute_force(spark, rows):
    langs = ["en", None, "de", "en", ""]
    docs = [(i, t, langs[n % 5]) for n, (i, t) in enumerate(TEXTS)]
    docs += [(100 + i, LONG, langs[i % 3]) for i in range(40)]
    labels = [(1, 1, 0), (2, None, 1), (2, 1, None), (3, 0, 0), (6, 1, 1), (9, 0, 1), (10, 1, None), (None, 1, 1), (11, 1, 0),
              (13, 1, 1), (105, 1, 1), (999, 1, 1)]
    frame = rows(DOCS, [(*d, 5, "p", 3, 9) for d in docs])
    got = filter_audit.audit(filter_audit.bit_counts(frame, rows("doc_id long, quality int, toxic int", labels)))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == brute(docs, labels)


def test_empty_tables(spark, rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.bit_counts(spark.createDataFrame([], DOCS), none)).collect() == []
    one = filter_audit.bit_counts(rows(DOCS, [(1, None, None, 0, "", 0, 0)], 1), none)
    assert filter_audit.audit(one).count() == 600


@pytest.mark.parametrize("filters", ["A", "AB", "ABC", "ABCD", "ABCDEF"])
def test_shapley_of_any_number_of_filters(spark, rows, filters):
    n = len(filters)
    counts = [("p", bits, (bits * 7) % 5 + 1, 0, 0) for bits in range(1 << n)]
    got = filter_audit.audit(rows("part string, bits int, n long, good long, toxic long", counts), filters)
    step = F.substring("filter_order", F.col("step"), F.lit(1)).alias("f")
    found = got.groupBy(step).agg(F.sum("removed").alias("removed"), F.min("shapley").alias("low"), F.max("shapley").alias("high"))
    for r in found.collect():
        assert r["removed"] == r["low"] == r["high"]

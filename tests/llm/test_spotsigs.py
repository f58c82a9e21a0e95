"""Spots against a plain-Python model; edited texts; near pairs against brute force."""

import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import spotsigs as s

ANCHORS = set(s.ANCHORS)


def model(text):
    """The spots of a text as strings."""
    words = re.sub(r"[^\w]+|_+", " ", (text or "").lower()).split()
    out = set()
    for i, word in enumerate(words):
        chain = [w for w in words[i + 1 :] if w not in ANCHORS][: s.CHAIN]
        if word in ANCHORS and len(chain) == s.CHAIN:
            out.add(" ".join([word, *chain]) + " ")
    return out


TEXTS = [
    None, "", "!!!", "no spots here", "The cat, and the dog sat on a mat.", "the the the of", "the cat", "the and cat of dog",
    "Über der Straße und den Weg gehen", "la la la maison est grande", "the cat and the dog " * 400, "x\n\nthe\tcat_dog",
]


def test_spots(spark, rows):
    df = rows("doc_id long, text string, spots int", list(zip(range(len(TEXTS)), TEXTS, [1] * len(TEXTS), strict=True)))
    hashed = lambda x: spark.createDataFrame([(v,) for v in x] or [("",)], "s string").select(F.hash("s")).collect()
    for r in s.with_spots(df.drop("spots"), "text", "found").collect():
        want = model(TEXTS[r.doc_id])
        assert r.found == sorted(set(r.found))
        if want:
            assert r.found == sorted({h[0] for h in hashed(want)}), TEXTS[r.doc_id]
        else:
            assert bool(r.found) == bool(TEXTS[r.doc_id])


def test_pattern_of_words():
    words = ["a", "an", "and", "b", "be", "xyz"]
    for text in [*words, "", "x", "ande", "bea"]:
        assert bool(re.fullmatch(s.one_of(words), text)) == (text in words)


def check_edited(rows, data, parts=3):
    df = rows("doc_id long, text string, next_own int, place int", [(*x, 1, 1) for x in data], parts)
    got = s.edited_fingerprints(df).collect()
    ordered = sorted(data, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want = []
    for i, (key, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        want.append((key, len(text), text[: len(text) - quarter] + after[:quarter]))
    flat = lambda x: sorted(x, key=repr)
    assert flat((r.doc_id, r.n_chars, r.edited) for r in got) == flat(want)
    return got


def test_edited_texts_and_likeness(rows):
    draw = random.Random(1)
    words = ["the", "of", "and", "cat", "dog", "sun", "é", "🎉", "tree", "river"]
    data = [(draw.randint(-50, 50) * 3, " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))) for _ in range(80)]
    data += [(None, "the null cat sat"), (7, None), (7, ""), (7, "the cat sat on"), (7, "the cat sat on"), (2**40, "z " * 20_000)]
    got = check_edited(rows, data)
    by_text = {}
    for r in got:
        for text, print_ in ((r.edited, r.edited_fingerprint),):
            assert by_text.setdefault(text, print_) == print_
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        parts = lambda f: set(f.split(",")) - {""}
        a, b = parts(r.fingerprint), parts(r.edited_fingerprint)
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)


@pytest.mark.parametrize("data", [[(1, "the one cat sat")], [(1, "abcd"), (1, "abcd")], [(5, None)]])
def test_few_documents(rows, data):
    check_edited(rows, data, 1)


def test_no_documents(rows):
    assert s.edited_fingerprints(rows("doc_id long, text string", [])).count() == 0


@pytest.mark.parametrize("n", [2, 100, 5000])
def test_ranges_of_a_key(spark, n):
    draw = random.Random(n)
    keys = [draw.choice([7, draw.randint(-(2**63), 2**63 - 1), draw.randint(0, 900)]) for _ in range(6000)]
    df = spark.createDataFrame([(k,) for k in keys], "place long")
    cuts = s.quantile_cuts(df, "place", n)
    assert cuts == sorted(set(cuts))
    got = df.withColumn("range", s.range_of(F.col("place"), cuts)).collect()
    assert all(r.range == sum(c <= r.place for c in cuts) for r in got[:400])
    # equal keys share a range; the others are spread evenly
    others = Counter(r.range for r in got if r.place != 7)
    assert max(others.values()) <= 3 * 6000 / n + 60
    plan = df.withColumn("range", s.range_of(F.col("place"), cuts))._jdf.queryExecution().optimizedPlan()
    assert plan.expressions().mkString().count("split(") == 0
    assert s.quantile_cuts(df.limit(0), "place", n) == []


def test_many_partitions_cost_no_plan(spark, rows):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20480")
    try:
        started = time.monotonic()
        s.with_next(spark.range(100_000).withColumn("own", F.col("id").cast("string")), "id", ["own"], ["own"])
        assert time.monotonic() - started < 120
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_near_pairs_match_brute_force(spark, rows):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(60):
        if docs and draw.random() < 0.6:
            own = draw.choice(docs)[1].split()
            for _ in range(draw.randint(0, 3)):
                own[draw.randrange(len(own))] = draw.choice(words)
        else:
            own = [w for _ in range(draw.choice([4, 20, 60])) for w in (draw.choice(["the", "of"]), draw.choice(words))]
        docs.append((i, " ".join(own)))
    docs += [(100, None), (101, "")]
    df = rows("doc_id long, text string, class int", [(*d, 0) for d in docs])
    classes, pairs = s.near_pairs(df, percent=70)
    sets = {r.doc_id: frozenset(r.x) for r in s.with_spots(df, "text", "x").collect()}
    rep = {}
    for k in sorted(sets):
        rep.setdefault(sets[k], k)
    assert {r.doc_id: r["class"] for r in classes.collect()} == {k: rep[x] if x else None for k, x in sets.items()}
    reps = [(k, x) for x, k in rep.items() if x]
    want = {
        (min(a, b), max(a, b))
        for i, (a, x) in enumerate(reps)
        for b, y in reps[:i]
        if 100 * len(x & y) >= 70 * len(x | y)
    }
    got = pairs.collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)

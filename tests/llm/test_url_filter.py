"""Rules against a plain-Python model; the trees on labelled urls."""

from pyspark.sql import functions as F

from ledgerloom.llm import url_filter as u
from ledgerloom.llm.queries import op3_url_filter


def model(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        after = rest[end:]
        end = min((after.find(c) for c in "?#" if c in after), default=len(after))
        path = after[:end]
    fits = [r for r in u.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, rule


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/1", "https://www.example.com/en/x?y#z", "http://a.www.example.com/en/",
    "http://notexample.com/en/", "http://com/", "http://com", "http://x.com?u=http://y.net/es/", "http://n.net/es/1", "http://net/fr/",
    "http://n.net/es", "http://a.org/b#c?d", "x://É.com/É", "http://h.com/a\nb", "http://example.com/EN/1", "a://b://c.net/fr/", "http://u@h.com:80/",
]


def test_rules_and_clashing_names(rows):
    df = rows("page_id long, url string, host string, f_depth string, suffix int", [(i, x, "old", "old", 1) for i, x in enumerate(URLS * 2)])
    got = u.judge(df).collect()
    assert len(got) == len(URLS) * 2
    for r in got:
        host, path, rule = model(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text), r
        assert r.verdict in ("allow", "block") and 0 <= r.block_score <= 1
        if rule:
            assert r.verdict == rule.verdict


def test_no_labels_and_one_kind_of_label(rows):
    schema = "page_id long, url string"
    assert u.judge(rows(schema, [])).count() == 0
    assert {r.verdict for r in u.judge(rows(schema, [(1, "http://a.org/"), (2, None)])).collect()} == {"allow"}
    assert {r.verdict for r in u.judge(rows(schema, [(1, "http://a.net/es/"), (2, "http://a.org/")])).collect()} == {"block"}


def test_trees_learn_lexical_marks(rows):
    """Blocked labels carry many digits and parameters: unlabelled urls with these are blocked."""
    rules = (u.Rule("block", "bad.test", "/"), u.Rule("allow", "good.test", "/"))
    data = [(i, f"http://s{i * 7919}{i * 31}.bad.test/{i}{i}?a={i}&b={i}") for i in range(150)]
    data += [(1000 + i, f"http://news{'abc'[i % 3]}.good.test/story/page{'xyz'[i % 3]}") for i in range(150)]
    data += [(5000, "http://s99887766.other.org/3311?a=1&b=2"), (5001, "http://newsa.other.org/story/pagex")]
    got = {r.page_id: r for r in u.judge(rows("page_id long, url string", data), rules=rules).collect()}
    assert got[5000].verdict == "block" and got[5001].verdict == "allow"


def test_few_urls_with_many_rows(rows):
    """The sample counts distinct urls; where it is empty the more frequent label decides."""
    urls = ["http://a.net/es/1?a=1", "http://b.com/story", "http://c.com/page"]
    data = [(i, urls[0] if i % 3 else urls[1 + i % 2]) for i in range(600)] + [(1000, "http://d.org/x")]
    df = rows("page_id long, url string", data)
    got = {r.page_id: r for r in u.judge(df, fit_rows=3).collect()}
    assert len(got) == 601 and 0 < got[1000].block_score < 1
    empty = {r.page_id: r for r in u.judge(df, fit_rows=0).collect()}
    assert empty[1000].verdict == "block" and empty[0].verdict == "allow"


def test_foreign_columns_stay(rows):
    """Names that the operator uses inside are no business of the caller's columns."""
    schema = "page_id long, url string, label string, suffix int, f_rows int, verdict string, url_filter_label int"
    data = [(i, f"http://{'a.net/es' if i % 2 else 'b.com'}/{i}", f"l{i}", i, 2 * i, "old", 3 * i) for i in range(60)]
    got = u.judge(rows(schema, data))
    assert got.columns == ["page_id", "url", "label", "suffix", "f_rows", "url_filter_label", "host", "path", "rule", "verdict", "block_score"]
    for r in got.collect():
        assert (r["label"], r["suffix"], r["f_rows"], r["url_filter_label"]) == (f"l{r.page_id}", r.page_id, 2 * r.page_id, 3 * r.page_id)


def test_suffix_statistics_do_not_hold_the_own_label(rows):
    """Every suffix is seen once, with a random label: only its own label could tell it."""
    import random

    rng = random.Random(3)
    rules = (u.Rule("block", "bad.test", "/"), u.Rule("allow", "good.test", "/"), *(
        u.Rule(rng.choice(["block", "allow"]), f"x{i}", "/") for i in range(120)))
    data = [(i, f"http://h.x{i}/p") for i in range(120)]
    data += [(1000 + i, f"http://{'bad' if i % 2 else 'good'}.test/a?{'q=1&r=2' if i % 2 else ''}") for i in range(120)]
    kept = F.col("page_id") % 3 != 0
    got = u.judge(rows("page_id long, url string", data), rules=rules, learn=kept).where(~kept).collect()
    known = {r.page_id: (r.block_score >= 0.5) == (r.verdict == "block") for r in got}
    assert all(v for k, v in known.items() if k >= 1000)
    # a guess, as it should be: with their own labels the trees would have looked at nothing else
    assert 0.2 < sum(v for k, v in known.items() if k < 1000) / 40 < 0.8


def test_held_out_urls(spark):
    """Quality on a fifth of the urls that the rules label, none of them learned from."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    held_out = F.crc32(F.encode(F.col("url"), "UTF-8")) % 5 == 0
    got = u.judge(pages, learn=~held_out).where(held_out & F.col("rule").isNotNull()).collect()
    truth = [r.verdict == "block" for r in got]
    right = sum((r.block_score >= 0.5) == t for r, t in zip(got, truth, strict=True)) / len(got)
    most = max(sum(truth), len(truth) - sum(truth)) / len(truth)
    wins = [(b.block_score > a.block_score) + 0.5 * (b.block_score == a.block_score)
            for a, x in zip(got, truth, strict=True) if not x for b, y in zip(got, truth, strict=True) if y]
    auc = sum(wins) / len(wins)
    print(f"held-out urls {len(got)}, accuracy {right:.3f}, majority {most:.3f}, area under the curve {auc:.3f}")
    # the rules ask for path words, which none of the lexical features holds: more than chance, far from all
    assert len(got) > 100 and right >= most and auc > 0.6


def test_query(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    got = op3_url_filter(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule = model(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)

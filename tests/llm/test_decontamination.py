"""The suffix automaton against brute force over all windows."""

import random

import pytest

from ledgerloom.llm import decontamination
from ledgerloom.llm import decontamination as d


def brute(text, items, window):
    words = d.words_of(text)
    hit, names = set(), set()
    for name, item in items:
        own = d.words_of(item)
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for p in range(len(words) - size + 1):
            if tuple(words[p : p + size]) in windows:
                hit.update(range(p, p + size))
                if name is not None:
                    names.add(name)
    return len(words), len(hit), sorted(names)


def made(seed, n_items, n_docs):
    draw = random.Random(seed)
    words = ["a", "b", "c", "dd", "É", "9"]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(str(i), text(draw.choice([0, 1, 2, 3, 5, 8, 12]))) for i in range(n_items)]
    return items, [text(draw.randint(0, 60)) for _ in range(n_docs)]


@pytest.mark.parametrize("window", [2, 3, 4, 13])
def test_automaton_matches_brute_force(window):
    for seed in range(40):
        items, docs = made(seed, 6, 8)
        automaton = d.SuffixAutomaton([(n, d.words_of(t)) for n, t in items], window)
        for text in docs:
            spans, names = automaton.matches(d.words_of(text))
            assert (sum(b - a for a, b in spans), sorted(names)) == brute(text, items, window)[1:]
            assert spans == d.merged(spans)


def test_words():
    assert d.words_of("Ab-c'9\tx_y") == [b"ab", b"c", b"9", b"x", b"y"]
    # the no-break space and the accented letter are word characters; only A-Z is lowered
    assert d.words_of("Ab É\u00a0X") == [b"ab", "É\u00a0x".encode()]


def test_frame_blocks_nulls_and_clashing_names(rows):
    items, docs = made(7, 8, 12)
    items += [(None, "a b"), ("dup", "c dd c dd"), ("dup", "9 9 9"), ("none", None), ("3", "")]
    docs += [None, "", "x " * 4000, docs[0], docs[0]]
    table = rows("doc_id long, text string, n_hit string", [(i, t, "old") for i, t in enumerate(docs)])
    bench = rows("item_id string, text string, n_words int", [(n, t, 1) for n, t in items])
    for block_words in (200_000, 9):
        got = d.scan(table, bench, window=4, block_words=block_words).collect()
        assert len(got) == len(docs)
        for r in got:
            assert (r.n_words, r.n_hit, r.hit_items) == brute(docs[r.doc_id] or "", [(n, t or "") for n, t in items], 4)
    assert d.scan(table.limit(0), bench).count() == 0
    assert {r.n_hit for r in d.scan(table, bench.limit(0)).collect()} == {0}


def test_decontaminate_cuts_or_drops_and_leaves_clean_texts(rows):
    passage = " ".join(f"w{i}" for i in range(14))
    clean = "some  Text, as it\tis."
    long_clean = passage + " " + "filler " * 400  # under a twentieth
    docs = rows("doc_id long, text string, decontaminate_n_hit int", [(1, f"Before {passage.upper()}! after", 0), (2, clean, 0), (3, long_clean, 0), (4, None, 0)])
    bench = rows("item_id long, text string", [(1, passage)])
    dropped = d.decontaminate(docs, bench)
    assert dropped.columns == docs.columns
    assert {r.doc_id: r.text for r in dropped.collect()} == {2: clean, 3: long_clean, 4: None}
    cut = {r.doc_id: r.text for r in d.decontaminate(docs, bench, cut=True).collect()}
    assert cut == {1: "Before ! after", 2: clean, 3: long_clean, 4: None}


def test_many_blocks_hold_one_automaton_at_a_time(spark, rows):
    """The result of one automaton, from one pass per block over what the pass before it wrote."""
    from ledgerloom.operators.layout import plan_text

    sentence = [f"w{i}" for i in range(400)]
    items = [(str(i), " ".join(sentence[7 * i : 7 * i + 20])) for i in range(50)] + [("n", None), (None, "w1 w2 w3"), ("e", "")]
    docs = [(i, " ".join(sentence[i : i + 60]), "x") for i in range(0, 340, 11)] + [(1000, None, "y"), (1001, "w1 w2 w3", "z")]
    items, docs = rows("item_id string, text string", items), rows("doc_id long, text string, block string", docs)
    one = decontamination.scan(docs, items)
    many = decontamination.scan(docs, items, block_words=200)
    assert decontamination.automata(items, "item_id", "text", 200, 13).count() == 4
    assert plan_text(many, "formatted").count("MapInArrow (") <= 2  # one operator, named twice
    key = lambda r: r["doc_id"]
    assert sorted(one.collect(), key=key) == sorted(many.collect(), key=key)
    none = decontamination.scan(docs, items.limit(0))
    assert none.where("n_hit > 0").count() == 0 and none.count() == docs.count()

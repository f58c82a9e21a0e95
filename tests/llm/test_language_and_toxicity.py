"""Held-out accuracy of the two classifiers, and their edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import language_id, toxicity
from ledgerloom.llm.queries import op4_language_id, op8_toxicity

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op4_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(rows):
    train = rows("doc_id long, lang string, text string", [(1, "a", "bab aba bab"), (2, "b", "xyz zyx xyz"), (3, None, "zzz"), (4, "a", None), (5, "b", "")])
    model = language_id.fit(train)
    texts = [None, "", "12 !?", "baba", "zyxy", "\U0001d41a", "yx " * 50_000, "baba"]
    df = rows("doc_id long, text string, score string", [(i, t, "old") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in language_id.predict(df, model).collect()}
    assert [got[i].lang_pred for i in range(5)] == ["und", "und", "und", "a", "b"]
    assert got[6].lang_pred == "b" and got[3].score == got[7].score
    assert got[5].lang_pred in ("a", "b")
    none = language_id.fit(train.limit(0))
    assert {r.lang_pred for r in language_id.predict(df, none).collect()} == {"und"}
    one = language_id.fit(train.where("lang = 'a'"))
    assert {r.lang_pred for r in language_id.predict(df, one).collect()} == {"und", "a"}
    assert language_id.predict(df.limit(0), model).count() == 0


@pytest.mark.parametrize("k", [2, 4, 6, 12, 40])
def test_codewords_differ(k):
    code = language_id.codewords(k)
    apart = [(code[i] != code[j]).sum() for i in range(k) for j in range(i)]
    assert min(apart) >= 1 and all((code[:, j] > 0).any() and (code[:, j] < 0).any() for j in range(code.shape[1]))


def test_mixed_text_is_flagged():
    labels, grams, counts = [], [], []
    for name, text in (("a", "babab ab "), ("b", "xyxyx yx ")):
        found, n = np.unique(language_id.grams_of([text * 20])[0], return_counts=True)
        labels += [name] * len(found)
        grams.append(found)
        counts.append(n)
    model = language_id.train(np.array(labels), np.concatenate(grams), np.concatenate(counts))
    pure, mixed = language_id.classify(model, ["bab ab " * 5, "bab xyx ab yx " * 5])
    assert not pure[2] and pure[0] == "a" and mixed[1] < pure[1]


def auc(scores, labels):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable")
    positive = labels == 1
    return (order[positive].mean() - (positive.sum() - 1) / 2) / (~positive).sum()


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op8_toxicity(spark, sf).collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    truth = np.array([labels[r.doc_id] for r in held])
    assert auc(np.array([r.score for r in held]), truth) > 0.95
    assert np.mean([r.predicted for r in held] == truth) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_toxicity_edge_cases(rows):
    docs = rows("doc_id long, text string, score string", [(1, "you fool", "x"), (2, "fine day", "x"), (3, None, "x"), (4, "", "x"), (5, "word " * 30_000, "x"), (1, "you fool", "x")])
    labels = rows("doc_id long, toxic int", [(1, 1), (1, 0), (2, 0), (None, 1), (3, None), (9, 1)])
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    assert toxicity.score(docs.limit(0), model).count() == 0
    unlabelled = toxicity.fit(docs, labels.limit(0))
    assert all(r.score < 0.5 for r in toxicity.score(docs, unlabelled).collect())


def test_repeated_documents_are_learned_once(rows):
    docs = [(i, f"you fool w{i}" if i % 3 == 0 else f"fine day w{i}") for i in range(60)]
    labels = rows("doc_id long, toxic int", [(i, int(i % 3 == 0)) for i in range(60)])
    once = toxicity.fit(rows("doc_id long, text string", docs), labels)
    again = toxicity.fit(rows("doc_id long, text string", docs + [docs[1]] * 2000), labels)
    assert once.bias == again.bias and dict(zip(once.features, once.weights)) == dict(zip(again.features, again.weights))


def test_ftrl_is_sparse_and_finds_the_words():
    draw = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(1500):
        text = " ".join(draw.choice(words, 40))
        rows.append((f"{text} awful" if i % 5 == 0 else text, float(i % 5 == 0)))
    model = toxicity.learn(rows)
    scores = toxicity.raw_scores(toxicity.Hasher(), model.table(), ["w1 w2 awful w3", "w1 w2 w3", ""]) + model.bias
    assert scores[0] > 0 > scores[1] and abs(scores[2] - model.bias) < 1e-9
    assert len(model.features) < 2000


UNLEARNED = [
    "Все люди рождаются свободными и равными в своем достоинстве и правах",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
    "人人生而自由在尊严和权利上一律平等",
    "qzxj vkwq xxzt qqpl wvbn zkrq mxzp",
]
LEARNED = ["The cat sat.", "Guten Morgen", "Buenos días señor", "All human beings are born free and equal in dignity and rights"]


def test_stage_drops_unlearned_languages_and_keeps_short_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    new = [(-1 - i, text) for i, text in enumerate(UNLEARNED)] + [(-101 - i, text) for i, text in enumerate(LEARNED)]
    first = docs.where("text IS NOT NULL AND text <> ''").select(
        (-1001 - F.col("doc_id")).alias("doc_id"), F.array_join(F.slice(F.split("text", r"\s+"), 1, 3), " ").alias("text")
    )
    added = spark.createDataFrame(new, "doc_id long, text string").union(first)
    whole = docs.select("doc_id", "lang", "text").unionByName(added, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.keep_languages(spark, whole, SF).select("doc_id").collect()}
    assert not kept & {-1 - i for i in range(len(UNLEARNED))}
    assert kept >= {-101 - i for i in range(len(LEARNED))}
    lettered = whole.where(F.col("text").rlike(r"\p{L}") & (F.col("doc_id") < -1000) | F.col("text").rlike(r"\p{L}{2}") & (F.col("doc_id") >= 0))
    missing = lettered.where(~F.col("doc_id").isin(list(kept))).collect()
    assert not missing, missing[:3]


def test_long_texts_are_counted_in_pieces(monkeypatch):
    import random
    import tracemalloc

    rng = random.Random(4)
    for size in (0, 1, 2, 3, 20, 301):
        text = "".join(rng.choices("abcé 1.\U00010400", k=size))
        grams, _, letters = language_id.grams_of([text])
        for piece in (1, 2, 3, 7, 1000):
            counts, found = language_id.histogram_of(text, piece)
            assert counts.tolist() == np.bincount(grams, minlength=language_id.GRAMS).tolist() and found == letters[0]
    labels, counted = [], []
    for label, letters in (("x", "abcd "), ("y", "bcdé ")):
        counts, _ = language_id.histogram_of("".join(rng.choices(letters, k=5000)))
        seen = np.flatnonzero(counts)
        labels += [label] * len(seen)
        counted.append((seen, counts[seen]))
    model = language_id.train(np.array(labels), *(np.concatenate(c) for c in zip(*counted, strict=True)))
    texts = ["".join(rng.choices("abcdé ", k=n)) for n in (50, 400, 900)]
    want = [language_id.classify(model, [t])[0] for t in texts]
    monkeypatch.setattr(language_id, "SLICE", 40)
    for text, (lang, score, ambiguous, known) in zip(texts, want, strict=True):
        got = language_id.classify(model, [text])[0]
        assert (got[0], got[2]) == (lang, ambiguous) and got[1] == pytest.approx(score) and got[3] == pytest.approx(known)
    assert language_id.classify(model, [" 1." * 100]) == [("und", 0.0, True, 0.0)]
    monkeypatch.undo()
    text = "abc dé " * 3_000_000
    tracemalloc.start()
    language_id.classify(model, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500_000_000


def test_a_label_column_of_too_many_values_is_refused(rows):
    many = rows("text string, lang string", [("abc", str(i)) for i in range(language_id.MOST_LANGUAGES + 1)])
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(many)

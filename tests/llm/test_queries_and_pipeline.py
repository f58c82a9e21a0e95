"""Queries against their SQL on the smallest tables, and the pipeline against brute force."""

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ledgerloom.llm import bpe, decontamination, minhash
from ledgerloom.llm.common import read_table, staged
from ledgerloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered_once_each():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.select(columns).collect()), key=repr) == want


def test_stages_by_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    texts = {}
    for (name, stage), follows in zip(corpus_pipeline.STAGES, [*corpus_pipeline.STAGES[1:], None], strict=True):
        before = {r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else {}
        after = staged(stage(spark, docs, SF), f"test-{name}")
        if follows:
            assert after.columns == docs.columns
            texts[name] = {r.doc_id: r.text for r in after.collect()}
            assert texts[name].items() <= before.items()
        if name == "near_dedup":
            sets = {k: minhash.shingles_of(t, 5) for k, t in before.items()}
            group = {k: k for k in sets}
            for a in sorted(sets):
                for b in sorted(sets):
                    if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        low, high = sorted((group[a], group[b]))
                        group = {k: low if g == high else g for k, g in group.items()}
            assert set(texts[name]) == set(group.values())
        if name == "decontamination":
            items = [(str(r.item_id), decontamination.words_of(r.text)) for r in read_table(spark, SF, "benchmark").collect()]
            automaton = decontamination.SuffixAutomaton(items)
            for k, t in before.items():
                words = decontamination.words_of(t)
                hit = sum(b - a for a, b in automaton.matches(words)[0])
                assert (k in texts[name]) == (not hit or 20 * hit < len(words))
        docs = after
    encoding = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
    )
    for r in docs.collect():
        assert r.round_trip and r.n_tokens == len(encoding.encode_ordinary(texts["decontamination"][r.doc_id]))


def test_run_with_clashing_columns_nulls_and_empty(spark, tmp_path):
    docs = read_table(spark, SF, "documents").limit(60)
    odd = docs.selectExpr("*", "1 AS score", "'x' AS pipeline_score", "0 AS n_hit", "0 AS ids").unionByName(
        spark.createDataFrame([(10_000, None, None, None, None, 1, "x", 0, 0), (10_001, "", "en", "s", 0, 1, "x", 0, 0)],
                              "doc_id long, text string, lang string, source string, n_chars long, score int, pipeline_score string, n_hit int, ids int")
    )
    for name, table in (("all", odd), ("none", odd.limit(0))):
        path = f"{tmp_path}/{name}"
        table.write.parquet(f"{path}/documents.parquet")
        for t in ("labels", "benchmark"):
            read_table(spark, SF, t).write.parquet(f"{path}/{t}.parquet")
        got = corpus_pipeline.run(spark, path)
        assert got.where("NOT round_trip").count() == 0
        assert (got.count() > 0) == (name == "all")


def test_stages_with_repeated_rows_and_nulls(spark):
    """Rows of one id stay or go together; null texts, keys and languages have the result that the stages state."""
    stages = dict(corpus_pipeline.STAGES)
    docs = read_table(spark, SF, "documents").limit(80)
    words = " ".join(f"word{i}" for i in range(80))
    odd = [(9001, words, None, "s", 0), (9001, words, None, "s", 0), (9002, words + " more", "en", "s", 0), (9003, None, "en", "s", 0),
           (9004, "", None, "s", 0), (9005, " 1 . ", "en", "s", 0), (None, words + " x", "en", "s", 0)]
    twice = docs.unionByName(docs).unionByName(spark.createDataFrame(odd, docs.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")))
    twice = staged(twice, "twice")
    for name in ("toxicity", "language_id", "near_dedup", "decontamination"):
        kept = [r.doc_id for r in stages[name](spark, twice, SF).collect()]
        given = [r.doc_id for r in docs.collect()]
        assert all(kept.count(k) in (0, 2) for k in given)
        assert kept.count(9001) in (0, 2)
        if name == "language_id":
            assert not {9003, 9004, 9005} & set(kept)
        else:
            assert {9003, 9004, 9005} <= set(kept)
        if name == "near_dedup":
            assert kept.count(9001) == 2 and 9002 not in kept and None in kept
        if name == "decontamination":
            assert {9001, 9002, None} <= set(kept)
    tokens = stages["byte_bpe"](spark, twice, SF).collect()
    assert len(tokens) == twice.count() and all(r.round_trip for r in tokens)
    assert {r.n_tokens for r in tokens if r.doc_id in (9003, 9004)} == {0}

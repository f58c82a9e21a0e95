"""The corpus pipeline: toxicity, language, near copies, benchmark passages, token ids.

Every stage takes all documents that the stage before it kept; all but the last
return the columns of ``documents``.  Columns that stages make on the way have a
prefix that no column of the input has.  Every stage handles each row by itself but
for near_dedup; rows that repeat a ``doc_id`` stay rows of their own unless the stage
says otherwise.  An empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontamination, language_id, minhash, toxicity
from ledgerloom.llm.common import read_table, staged
from ledgerloom.operators.layout import broadcast_if_small

# the near-duplicate stage's shingles and similarity
NEAR_WORDS, NEAR_PERCENT = 5, 80
# least language score of a kept document
LEAST_LANGUAGE_SCORE = 0.3
# least share of its n-grams that are usual in its language; the score only compares the learned languages
LEAST_KNOWN_GRAMS = 0.5


def _prefix(docs: DataFrame) -> str:
    prefix = "pipeline_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labelled ones, does not call toxic.

    A null text counts as empty and has the score of no words, so it stays unless most
    labelled documents are toxic.  Without labels nothing is toxic.  A repeated ``doc_id`` with
    the same text is learned from once.
    """
    score = f"{_prefix(docs)}score"
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out=score).where(F.col(score) < 0.5).select(docs.columns)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages learned from the table, or a mixture of them.

    Null and empty texts and texts without a letter are in no language and go; so does
    every document if no row has a ``lang``.  Rows with a null ``lang`` are judged by their text.
    """
    prefix = _prefix(docs)
    found = language_id.predict(docs, language_id.fit(docs), prefix=prefix)
    return found.where(~language_id.is_rejected(LEAST_LANGUAGE_SCORE, prefix, LEAST_KNOWN_GRAMS)).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of every near-duplicate group.

    Null, empty and wordless texts are in no group and stay.  Rows of one ``doc_id`` count as
    one document: they stay or go together.  A row without a ``doc_id`` stays.
    """
    groups = minhash.near_duplicates(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    copies = staged(groups.where("NOT kept").select("doc_id").distinct(), "near-copies")
    side, _ = broadcast_if_small(copies)
    return docs.join(side, "doc_id", "left_anti").select(docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are passages of benchmark items.

    Null and empty texts have no words and stay; null and empty items hit nothing.  An empty
    benchmark keeps every document.
    """
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit), and whether they decode to its text.

    One row per row of ``docs``: a null or empty text has no ids and round-trips.  Columns
    beside ``doc_id``, ``lang``, ``source`` and ``text`` are left out.
    """
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    named = docs.select("doc_id", "lang", "source", "text")
    both = bpe.encode(named, path, pattern, decoded="decoded")
    return both.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_languages),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("byte_bpe", tokenise),
]

# models and token ids cannot be expressed in SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

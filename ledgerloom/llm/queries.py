"""Registered queries of the llm operators (``opN_<name>``) and their DuckDB SQL.

Each query applies its operator to the whole table and derives the digest
columns from the operator's real output.  Operators whose result SQL cannot
express have no SQL here and are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    chat_format,
    decontamination,
    filter_audit,
    hard_negatives,
    language_id,
    minhash,
    spotsigs,
    token_files,
    topk,
    toxicity,
    url_filter,
    warc,
)
from ledgerloom.llm.common import crc_remainder, prepare, read_table, staged
from ledgerloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return fn

    return wrap


OP1_SQL = r"""
WITH RECURSIVE word AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM word WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (
    SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
    WHERE 100 * c >= 85 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN size USING (doc_id)
"""


@register("op1_minhash", OP1_SQL)
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: three-word shingles, similarity 0.85."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, percent=85)


@register("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from binary id files in ascending doc_id order."""
    files = token_files.write(
        read_table(spark, sf_dir, "documents"),
        scratch_path(spark, "token-files"),
        public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
        special=True,
    )
    return token_files.read(spark, files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


OP7_SQL = r"""
WITH ascii AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents, ascii),
item AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark, ascii),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
    SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS gram
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM doc, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, item_id, g.size, p FROM grams g JOIN windows USING (size, gram)),
hit AS (
    SELECT doc_id, count(DISTINCT q) AS n_hit
    FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@register("op7_decontamination", OP7_SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document occurs in benchmark items, and in which."""
    found = decontamination.scan(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"),
    )


@register("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents whose fold is not 2."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous"
    )


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels whose fold is not 0."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_remainder(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@register("op5_spotsigs")
def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    found = spotsigs.edited_fingerprints(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


OP6_SQL = r"""
WITH turn AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
part AS (
    SELECT *, length(role || text) + length(regexp_replace(role || text, '[^\\\[\]<]', '', 'g'))
              + 8 + CASE WHEN role = 'assistant' THEN 5 ELSE 8 END AS chars
    FROM turn)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM part GROUP BY conv_id
"""


@register("op6_chat_format", OP6_SQL)
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations through mixed JSON layouts, canonical turns and the chat template, read back."""
    prepare(spark)
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    records = chat_format.as_records(rows, "conv_id", "turn")
    turns = chat_format.canonical_turns(records, strict=True).select("conv_id", "turns")
    formatted = staged(chat_format.format_turns(turns, "conv_id"), "chat-format")
    back = formatted.withColumn("turns", chat_format.parse_turns(F.col("formatted"))).withColumn(
        "loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))
    )
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = """
WITH page AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
first_copy AS (SELECT body, min(page_id) AS first_id FROM page WHERE strlen(body) >= 100 GROUP BY body)
SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM page LEFT JOIN first_copy USING (body)
"""


@register("op9_warc", OP9_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as read back from web archives: payloads hashed again, repeats as revisits."""
    root = scratch_path(spark, "warc")
    warc.write(read_table(spark, sf_dir, "pages"), root)
    found = warc.read(spark, root).where(F.col("record_type").isin("response", "revisit"))
    stored = F.col("record_type") == "response"
    return found.select(
        F.col("headers")["x-page-id"].cast("long").alias("page_id"),
        F.when(stored, F.octet_length("payload")).otherwise(F.col("headers")["x-payload-length"]).cast("long").alias(
            "payload_bytes"
        ),
        F.when(stored, F.sha2("payload", 256))
        .otherwise(F.regexp_extract("payload_digest", "^sha256:(.*)$", 1))
        .alias("payload_digest"),
        "record_type",
        F.col("headers")["x-refers-to-page"].cast("long").alias("refers_to"),
    )


@register("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: the longest fitting rule's, else the boosted trees'."""
    return url_filter.judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "block_score")


@register("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the multilingual rank file, and the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded")
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP11_SQL = """
WITH vector AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
score AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
           CAST(list_dot_product(a.x, c.x) AS BIGINT) AS s
    FROM vector a JOIN vector c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positive AS (
    SELECT anchor_id, id AS positive_id, s AS positive_score FROM score WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, positive_score,
       n.s AS negative_score
FROM positive p JOIN score n
  ON n.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * n.s AND n.s <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.s DESC, n.id)
QUALIFY row_number() OVER w <= 5
"""


@register("op11_hard_negatives", OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with a seventh of the labels moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 100 == 0)


OP12_SQL = r"""
WITH RECURSIVE perm(filter_order) AS (
    SELECT '' UNION ALL
    SELECT filter_order || f FROM perm, unnest(['A', 'B', 'C', 'D', 'E']) t(f)
    WHERE NOT contains(filter_order, f)),
doc AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
first_of AS (SELECT text, min(doc_id) AS first_id FROM doc GROUP BY text),
mark AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
         FROM labels GROUP BY doc_id),
flag AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
    FROM doc JOIN first_of USING (text) LEFT JOIN mark USING (doc_id)),
grp AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flag GROUP BY part, fails),
step AS (
    SELECT filter_order, s AS step, filter_order[s] AS f, filter_order[1:s - 1] AS earlier
    FROM (SELECT filter_order, unnest(range(1, 6)) AS s FROM perm WHERE length(filter_order) = 5)),
met AS (
    SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS hit,
           length(translate(fails, earlier, '')) < length(fails) AS gone, fails = f AS only_one
    FROM grp, step),
total AS (
    SELECT part, filter_order, step, f,
           CAST(sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
           CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
           CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
           CAST(sum(CASE WHEN only_one THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
           CAST(sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
           CAST(sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM total
"""


@register("op12_filter_audit", OP12_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from the documents of each language in all 120 orders."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(filter_audit.bit_counts(docs, read_table(spark, sf_dir, "labels")))


OP13_SQL = """
WITH vector AS (
    SELECT vec_id, list_transform(embedding, lambda v: CAST(floor(64 * CAST(v AS DOUBLE)) AS DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)
SELECT q.vec_id AS query_id, CAST(row_number() OVER w AS INTEGER) AS rank, c.vec_id,
       CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
FROM vector q JOIN vector c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_dot_product(q.x, c.x) DESC, c.vec_id)
QUALIFY row_number() OVER w <= 20
"""


@register("op13_top_k", OP13_SQL)
def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of highest inner product for every twentieth vector."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)

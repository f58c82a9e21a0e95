"""Operator 5: SpotSigs document fingerprints, in DataFrame functions only.

A spot is a common word (the anchor) with the chain of the next two content
words after it.  A document's fingerprint is its set of spot hashes: prose keeps
most of its spots when parts of it change, and boilerplate without common words
has none.  Fingerprints are compared by Jaccard similarity; the search for near
pairs partitions them by set length and compares only within neighbouring
partitions that share a rare spot.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepare, shuffle_partitions, staged

# common words of the languages at hand; anchors, and skipped inside chains
ANCHORS = (
    "the of and to a in is that it for as with was on be by at this are from or an "  # English
    "der die das und von mit den dem ist ein eine zu im nicht sich auf des als auch "  # German
    "le la les de des et en un une du que est pour par dans au sur ne pas "  # French
    "el los las y que del se por con una para lo no su"  # Spanish
).split()
CHAIN = 2
# quantiles of one aggregate
CUTS_AT_ONCE = 2048


def normalised(text: Column) -> Column:
    """Lower-case words (letters and digits), each between single blanks."""
    return F.concat(
        F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]++", " ")), F.lit(" ")
    )


def one_of(words: Iterable[str]) -> str:
    """A pattern of the words that shares their common beginnings, so a word is tried letter by letter."""
    heads: dict[str, list[str]] = {}
    for word in words:
        heads.setdefault(word[:1], []).append(word[1:])
    parts = [re.escape(head) + one_of(rest) for head, rest in sorted(heads.items()) if head]
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)}){'?' if '' in heads else ''}"


def with_spots(
    df: DataFrame, text: str, out: str, anchors: Iterable[str] = ANCHORS, chain: int = CHAIN
) -> DataFrame:
    """Append ``out``, the sorted distinct spot hashes (32 bits) of column ``text``.

    A text without a spot has the hashes of its words instead, a text without words
    one hash of the text, and a null or empty text none.  The steps are columns of
    their own, so that no step is computed twice.
    """
    word = one_of(set(anchors))
    skip = f"(?:{word} )*+"
    spot = F.regexp_extract_all("_words", F.lit(rf" (?=({word} (?:{skip}[^ ]++ ){{{chain}}}))"), F.lit(1))
    # a line a spot, then the anchors inside the chains go
    lines = F.regexp_replace(F.array_join(spot, "\n"), rf"(?<= ){word} ", "")
    signatures = (
        F.when(F.length("_lines") > 0, F.split("_lines", "\n"))
        .when(F.length("_words") > 2, F.split(F.trim("_words"), " "))
        .when(F.length(text) > 0, F.array(text))
        .otherwise(F.array().cast("array<string>"))
    )
    return (
        df.withColumn("_words", normalised(F.col(text)))
        .withColumn("_lines", lines)
        .withColumn(out, F.sort_array(F.array_distinct(F.transform(signatures, lambda s: F.hash(s)))))
        .drop("_words", "_lines")
    )


def fingerprint(spot_hashes: Column) -> Column:
    """Spot hashes as one string, decimal numbers between commas."""
    return F.array_join(spot_hashes.cast("array<string>"), ",")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two spot sets; 0 where their lengths rule out ``least``; 1 for two empty sets."""
    common = F.size(F.array_intersect(a, b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when(F.least(F.size(a), F.size(b)) < least * F.greatest(F.size(a), F.size(b)), 0.0)
        .otherwise(common / (F.size(a) + F.size(b) - common))
    )


# --------------------------------------------------------------------------
# A document and the next one
# --------------------------------------------------------------------------
def with_next(docs: DataFrame, key: str, columns: list[str], order: list[str], derive=lambda df: df) -> DataFrame:
    """Append ``next_<column>`` of the next row in ascending ``key`` (after the last: the first).

    ``derive`` adds columns to the rows before they are paired, once for each row.

    Rows are dealt into ranges of the key by its quantiles, each sorted on its own;
    the first row of the next range is added to each range, so no range waits for
    another and nothing is ordered in one task.  Rows of equal key are ordered by
    ``order``; null keys come first.
    """
    spark = docs.sparkSession
    place = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    keyed = docs.withColumn("place", place)
    cuts = quantile_cuts(keyed, "place", 2 * shuffle_partitions(spark))
    ranged = keyed.withColumn("range", range_of(F.col("place"), cuts))
    firsts = sorted((r["range"], r["first"]) for r in ranged.groupBy("range").agg(F.min("place").alias("first")).collect())
    # the range before each (non-empty) range, in a circle
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    if not firsts:
        return derive(docs).withColumns({f"next_{c}": F.col(c) for c in columns})
    target = spark.createDataFrame(list(before.items()), "place long, before int")
    heads = (
        ranged.join(F.broadcast(target), "place")  # one row per range
        .groupBy("place", "before")
        .agg(F.min(F.struct(*order, *(c for c in ranged.columns if c not in order))).alias("r"))
        .select("before", "r.*")
        .withColumns({"range": F.col("before"), "added": F.lit(True)})
        .select(*ranged.columns, "added")
    )
    rows = derive(ranged.withColumn("added", F.lit(False)).union(heads))
    after = Window.partitionBy("range").orderBy("added", "place", *order)
    return (
        rows.withColumns({f"next_{c}": F.lead(c).over(after) for c in columns})
        .where("NOT added")
        .drop("place", "range", "added")
    )


def quantile_cuts(df: DataFrame, place: str, n: int) -> list[int]:
    """Distinct numbers that cut the rows, by long column ``place``, into about ``n`` ranges of equal size.

    Up to ``CUTS_AT_ONCE`` come from one aggregate; for more, the ranges of these are
    cut on their own, so no aggregate holds them all.  The driver gets about ``n`` numbers.
    """
    quantiles = lambda parts: F.percentile_approx(place, [i / parts for i in range(1, parts)], 20 * CUTS_AT_ONCE)
    first = df.agg(quantiles(max(2, min(n, CUTS_AT_ONCE))).alias("cuts")).first()["cuts"] or []
    cuts = sorted(set(first))
    if n > CUTS_AT_ONCE and cuts:
        inside = df.groupBy(range_of(F.col(place), cuts).alias("range")).agg(quantiles(-(-n // CUTS_AT_ONCE)).alias("cuts"))
        cuts = sorted(set(cuts).union(*(r["cuts"] for r in inside.collect())))
    return cuts


def range_of(place: Column, cuts: list[int]) -> Column:
    """Number of cuts at or below a place, found through a coarse list of them.

    Each list is one literal once the plan is optimised, however many cuts there are.
    """
    if not cuts:
        return F.lit(0)
    step = max(1, math.isqrt(len(cuts)))
    at = lambda values: F.size(F.filter(values, lambda c: c <= place))
    literal = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")
    coarse, fine = cuts[step - 1 :: step], literal(cuts)
    passed = at(literal(coarse)) * step
    return passed + at(F.slice(fine, passed + 1, F.lit(step)))


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and how they compare.

    The edited text ends in the first characters of the next document (ascending
    key; after the last the first) instead of its own last quarter, as many as
    there are.  Columns: key, ``n_chars``, ``edited``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.  A null text counts as
    empty; repeated rows follow one another; a single document is its own next.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("own"))
    n, quarter = F.length("own"), F.floor(F.length("own") / 4).cast("int")
    paired = (
        with_next(rows, key, ["own", "spots"], ["own"], lambda df: with_spots(df, "own", "spots"))
        .withColumn("n_chars", n)
        .withColumn(
            "edited",
            F.concat(F.substr("own", F.lit(1), n - quarter), F.substr("next_own", F.lit(1), quarter)),
        )
        .drop("own", "next_own")
    )
    return with_spots(paired, "edited", "edited_spots").select(
        key,
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited",
        fingerprint(F.col("spots")).alias("fingerprint"),
        fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


# --------------------------------------------------------------------------
# Near pairs
# --------------------------------------------------------------------------
def near_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(classes, pairs): every document's class of equal spot sets, and the near pairs of classes.

    ``classes`` has (key, class), the class being the smallest key with that
    fingerprint; documents without spots (null or empty texts) have a null class.
    ``pairs`` has (a, b, likeness) of classes with a Jaccard similarity of
    ``percent`` or more.  Sets are partitioned by length so that a near pair lies
    in one partition or two neighbours; within them, two sets are compared only if
    they share one of their rarest spots (as many as any near pair must share one
    of), and only if their lengths allow the similarity.
    """
    prepare(docs.sparkSession)
    t = percent / 100
    rows = staged(with_spots(docs.select(F.col(key), F.col(text).alias("own")), "own", "spots").where(F.size("spots") > 0).drop("own"), "spot-sets")
    sets = staged(
        rows.groupBy("spots").agg(F.min(key).alias("class")).withColumn("n", F.size("spots")), "spot-classes"
    )
    classes = docs.select(key).join(
        rows.join(sets.select("spots", "class"), "spots").select(key, "class").distinct(), key, "left"
    )
    each = sets.select("class", "n", F.explode("spots").alias("spot"))
    rarity = each.groupBy("spot").agg(F.count(F.lit(1)).alias("rows"))
    rank = Window.partitionBy("class").orderBy("rows", "spot")
    least_common = F.ceil(F.col("n") * percent / 100)
    rare = each.join(rarity, "spot").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= F.col("n") - least_common + 1)
    # length partitions that grow by 1/t: lengths of a near pair differ by less
    length_part = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / t) if t < 1 else F.col("n")).cast("int")
    rare = rare.select("class", "n", "spot", length_part.alias("part"))
    longer = rare.select(F.col("class").alias("y"), F.col("n").alias("y_n"), "spot", F.explode(F.array("part", F.col("part") - 1)).alias("part"))
    met = (
        rare.join(longer, ["spot", "part"])
        .where("class <> y AND (n < y_n OR (n = y_n AND class < y))")
        .where(F.col("n") * 100 >= F.col("y_n") * percent)
        .select(F.col("class").alias("x"), "y")
        .distinct()
    )
    by_class = sets.select("class", "spots")
    compared = met.join(by_class.select(F.col("class").alias("x"), F.col("spots").alias("x_spots")), "x").join(
        by_class.select(F.col("class").alias("y"), F.col("spots").alias("y_spots")), "y"
    )
    near = compared.withColumn("likeness", likeness(F.col("x_spots"), F.col("y_spots"), t))
    pairs = near.where(
        F.size(F.array_intersect("x_spots", "y_spots")) * 100 >= F.size(F.array_union("x_spots", "y_spots")) * percent
    ).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "likeness")
    return classes, pairs



"""What document filters remove alone, together and in every order.

Every document has a bit for each filter that it fails.  Documents are counted by part
and combination of bits, which is all that the audit needs: the value v(S) of a
coalition S of filters is the number of documents that fail any of them, whatever the
order.  A step that adds filter i to the filters S before it removes v(S + i) - v(S).

The Shapley value of a filter comes from the Hart-Mas-Colell potential of the removal
game, computed over the coalitions in ascending order:

    P(empty) = 0,    P(S) = (v(S) + sum of P(S - i) over i in S) / |S|

and is P(all) - P(all - i).  P is held as a whole number, multiplied by the least common
multiple of 1..n for n filters, so every division is exact.  ``shapley`` is the Shapley
value times n!: what the filter removes, summed over all n! orders.

On Spark: flags are column expressions of one pass over the texts; the repeat filter
compares text digests.  A row of a digest, an id and the bits goes through one shuffle
by all of these, so a text held by a third of the rows is spread over tasks and comes
together as sums.  The counts are 2^n rows a part at most.

Null texts count as empty; a null ``part`` as the empty string.  A document without an
id fails no repeat filter and makes no other document fail it.  Rows that repeat an id
are documents of their own, all counted; they don't count as smaller than each other.  Labels
that repeat an id: one of them that is good (toxic) is enough.  A null label is neither.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged
from ledgerloom.operators.layout import broadcast_if_small

# fixed values: the filters of the audit
FEWEST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, ODD_SIGNS = 100, 80, 10, "[#$%&*|]"
FILTERS = "ABCDE"
REPEAT = FILTERS.index("E")
STEP = "filter_order string, step int, bit int, before int, after int"


def text_flags(text: Column) -> tuple[Column, Column]:
    """(bits of the filters A to D that a text fails, its digest)."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        n < FEWEST_WORDS,
        100 * distinct < LEAST_DISTINCT_PERCENT * n,
        100 * capitals > MOST_CAPITALS_PERCENT * F.length(text),
        text.rlike(ODD_SIGNS),
    )
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails[1:], 1)), F.when(fails[0], 1).otherwise(0))
    return bits, F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def bit_counts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part, bits`` (of the filters A to E) with the counts ``n``, ``good`` and ``toxic``."""
    bits, digest = text_flags(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    flagged = docs.select(
        F.col(f"`{key}`").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        bits.cast("int").alias("bits"),
        digest.alias("digest"),
    )
    # rows of one id, part, digest are equal in all that follows
    rows = staged(flagged.groupBy("digest", "id", "part", "bits").agg(F.count(F.lit(1)).alias("n")), "flags")
    marks = staged(
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
             F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"))
        .where("good + toxic > 0"),
        "marks",
    )
    # rows without an id have no label: they don't meet in the join
    known = rows.where("id IS NOT NULL").join(broadcast_if_small(marks)[0], "id", "left")
    marked = known.unionByName(rows.where("id IS NULL"), allowMissingColumns=True).fillna(0, ["good", "toxic"])
    same = ("digest", "part", "bits", "good", "toxic")
    combined = marked.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.min("id").alias("first"),
        # of the rows with the least id, and of those without one
        F.coalesce(F.min_by("n", "id"), F.lit(0)).alias("n_first"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("n_none"),
    )
    combined = staged(combined, "flag-counts")
    first = combined.groupBy("digest").agg(F.min("first").alias("first_of_all"), F.sum("n").alias("copies"))
    # a text of one document needs no comparison
    repeated = staged(first.where("copies > 1").drop("copies"), "repeated-texts")
    joined = combined.join(broadcast_if_small(repeated)[0], "digest", "left")
    once = F.col("first_of_all").isNull()
    spared = F.when(once, F.col("n")).otherwise(
        F.when(F.col("first") == F.col("first_of_all"), F.col("n_first")).otherwise(0) + F.col("n_none")
    )
    split = joined.withColumn("spared", spared).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("bits").alias("bits"), F.col("spared").alias("n")),
            F.struct((F.col("bits") + (1 << REPEAT)).alias("bits"), (F.col("n") - F.col("spared")).alias("n")),
        )).alias("s"),
    )
    return (
        split.select("part", "good", "toxic", "s.*")
        .where("n > 0")
        .groupBy("part", "bits")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    )


def coalition_values(counts: DataFrame, filters: int) -> DataFrame:
    """``part``, its document count ``total`` and, for n, good and toxic, v(S) of all coalitions as an array."""
    size = 1 << filters
    measures = ("n", "good", "toxic")
    held = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        *(F.array(*(F.sum(F.when(F.col("bits") == b, F.col(m)).otherwise(0)) for b in range(size))).alias(m) for m in measures),
    )

    def values(held_of: str) -> Column:
        fails = lambda s: F.transform(
            held_of, lambda count, bits: F.when(bits.bitwiseAND(s) != 0, count).otherwise(F.lit(0).cast("long"))
        )
        return F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)),
            lambda s: F.aggregate(fails(s), F.lit(0).cast("long"), lambda a, x: a + x),
        )

    return held.select("part", "total", *(values(m).alias(m) for m in measures))


def potentials(values: Column, filters: int) -> Column:
    """The potential of every coalition times the least common multiple of 1..filters."""
    scale = math.lcm(*range(1, filters + 1))
    zero = F.lit(0).cast("long")

    def next_one(done: Column, s: Column) -> Column:
        without = [F.when(s.bitwiseAND(1 << i) != 0, F.get(done, s - (1 << i))).otherwise(zero) for i in range(filters)]
        of_all = sum(without, F.get(values, s) * scale)
        return F.concat(done, F.array(F.call_function("div", of_all, F.bit_count(s).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(zero), next_one)


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """All steps of all orders for every part of ``counts`` (``part, bits, n, good, toxic``)."""
    n = len(filters)
    everything = (1 << n) - 1
    steps = []
    for order in itertools.permutations(range(n)):
        before = 0
        for step, bit in enumerate(order, 1):
            steps.append(["".join(filters[b] for b in order), step, bit, before, before | 1 << bit])
            before |= 1 << bit
    known = coalition_values(counts, n).withColumn("potential", potentials(F.col("n"), n))
    names = [f.split()[0] for f in STEP.split(", ")]
    table = F.from_json(F.lit(json.dumps([dict(zip(names, s, strict=True)) for s in steps])), f"array<struct<{STEP}>>")
    rows = known.select("*", F.explode(table).alias("s")).select(*known.columns, "s.*")
    alone = F.expr("int(shiftleft(1, bit))")
    at = lambda measure, where: F.get(F.col(measure), where)
    gained = lambda measure: at(measure, F.col("after")) - at(measure, F.col("before"))
    rest = F.lit(everything) - alone
    per_potential = math.factorial(n) // math.lcm(*range(1, n + 1))
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - at("n", F.col("after"))).alias("kept"),
        gained("n").alias("removed"),
        (at("n", alone) - gained("n")).alias("redundant"),
        (at("n", F.lit(everything)) - at("n", rest)).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        ((at("potential", F.lit(everything)) - at("potential", rest)) * per_potential).alias("shapley"),
    )

"""Operator 1: MinHash near-duplicates with sequential Bayesian verification.

1. A signature per document; documents with equal shingle sets form one class
   at once (pre-aggregated per task), and only class representatives go on.
2. Bands of signature rows put representatives into buckets.  First each bucket
   is compared with one pivot, its most connected member; what the pivot links
   needs no further comparison inside.  Members that are still in another
   component than their bucket's largest one are compared with the bucket if it is
   small, else with the texts that share one of their rarest shingles (an exact
   prefix filter).  So no bucket emits all its pairs, and none loses a link.
3. Candidate pairs are compared batch by batch of their signatures; a pair goes
   as soon as the posterior probability of a similarity at the threshold falls
   under the chosen miss probability.
4. Survivors are verified exactly on the shingles of their whole texts, and
   connected components give the groups.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepare, slices, staged, strings, tidy
from ledgerloom.operators.layout import DEFAULT_BROADCAST_BYTES, broadcast_if_small

ROWS = 6  # signature rows of a band
MISS = 1e-6  # chance that a pair at the threshold shares no band
PRUNE_MISS = 1e-7  # posterior probability under which a pair is pruned
# buckets up to this size compare their members pair by pair
SMALL_BUCKET = 32
KEPT_WORDS = 100_000
# tasks that share the rows of one shingle set where the classes are too many to broadcast
CLASS_SALTS = 32
SLICE = 1_000_000


@dataclass(frozen=True)
class Plan:
    """Shingle size, threshold in percent, and the signature they need."""

    words: int
    percent: int

    @property
    def bands(self) -> int:
        share = (self.percent / 100) ** ROWS
        return max(1, math.ceil(math.log(MISS) / math.log1p(-share))) if share < 1 else 1

    @property
    def hashes(self) -> int:
        return self.bands * ROWS

    def least_matches(self) -> list[tuple[int, int]]:
        """(signature rows compared so far, matches needed to go on) after each batch.

        With a uniform prior, ``m`` matches of ``n`` give a Beta(m + 1, n - m + 1)
        posterior, whose mass at or above the threshold t is the chance of at most
        ``m`` successes in n + 1 trials of chance t.
        """
        t, out = self.percent / 100, []
        for n in range(ROWS * 5, self.hashes + ROWS * 5, ROWS * 5):
            n = min(n, self.hashes)
            chance, m = (1 - t) ** (n + 1), 0
            while chance < PRUNE_MISS and m < n:
                m += 1
                chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append((n, m))
        return out


# --------------------------------------------------------------------------
# Shingles and signatures
# --------------------------------------------------------------------------
def words_of(text: str) -> list[bytes]:
    """Words between blanks and ASCII control spaces (``[^\\x20\\x09-\\x0D]+``), A-Z in lower case."""
    return text.encode("utf-8").lower().split()


def shingles_of(text: str, size: int) -> set[bytes]:
    """The distinct shingles themselves: ``size`` words, or the whole of a shorter text."""
    words = words_of(text)
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


class Shingler:
    """Distinct 64-bit shingle hashes of texts; hashes of words seen are kept between batches."""

    def __init__(self, size: int):
        self.size = size
        self.factors = np.random.default_rng(1).integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.hashes = np.zeros(0, np.uint64)

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """Sorted distinct hashes of each text's shingles."""
        if len(self.index) > KEPT_WORDS:
            self._clear()
        words = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        found = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(counts.sum()))
        new = list(itertools.islice(self.index, len(self.hashes), None))
        self.hashes = np.concatenate([self.hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])
        h = self.hashes[found]
        n = max(0, len(h) - self.size + 1)
        mixed = np.zeros(n, np.uint64)
        for k in range(self.size):
            mixed += h[k : k + n] * self.factors[k]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        out, start = [], 0
        for own, count in zip(words, counts.tolist(), strict=True):
            if count >= self.size:
                out.append(np.unique(mixed[start : start + count - self.size + 1]))
            else:
                short = [xxhash.xxh3_64_intdigest(b" ".join(own), seed=count)] if own else []
                out.append(np.array(short, np.uint64))
            start += count
        return out


class Signer:
    """16-bit MinHash signatures."""

    def __init__(self, hashes: int):
        rng = np.random.default_rng(2)
        self.masks = rng.integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2)
        self.factors = rng.integers(0, 2**63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(self, sets: list[np.ndarray]) -> np.ndarray:
        """Signatures (texts x hashes) of non-empty sets."""
        if not sets:
            return np.zeros((0, len(self.masks)), np.uint16)
        flat = np.concatenate(sets)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        starts = np.cumsum(sizes) - sizes
        out = np.empty((len(sets), len(self.masks)), np.uint16)
        values = np.empty_like(flat)
        for i, (mask, factor) in enumerate(zip(self.masks, self.factors, strict=True)):
            np.bitwise_xor(flat, mask, out=values)
            np.multiply(values, factor, out=values)
            # the middle bits of the minimum: its high bits are small by choice
            out[:, i] = (np.minimum.reduceat(values, starts) >> np.uint64(24)).astype(np.uint16)
        return out


def signatures(docs: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature); the last two null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(plan.words), Signer(plan.hashes)
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts, SLICE):
                sets = shingler.sets(texts[a:b])
                signed = iter(signer.sign([s for s in sets if len(s)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(signed).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_key", "signature"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_shingles long, set_key binary, signature binary")


# --------------------------------------------------------------------------
# Candidate pairs
# --------------------------------------------------------------------------
def bucket_members(reps: DataFrame, plan: Plan) -> DataFrame:
    """(bucket, node, n, size) of the buckets with two members or more."""
    band = lambda j: F.xxhash64(j, F.substring("signature", j * (2 * ROWS) + 1, F.lit(2 * ROWS)))
    rows = reps.select(
        "node", "n", F.explode(F.transform(F.sequence(F.lit(0), F.lit(plan.bands - 1)), band)).alias("bucket")
    )
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return rows.join(sizes, "bucket")


def near_size(plan: Plan, a: str, b: str):
    """Set sizes that allow the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * plan.percent


def as_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def pivot_pairs(members: DataFrame, plan: Plan) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, the member with the most bucket neighbours."""
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = members.join(degrees, "node")
    pivots = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "node", "n")).alias("p"))
    return as_pairs(
        members.join(pivots.select("bucket", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n")), "bucket")
        .where("node <> pivot")
        .where(near_size(plan, "n", "pivot_n")),
        "node",
        "pivot",
    )


def mixed_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, n, size, component, major) of buckets with several components; major is the largest one."""
    placed = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("rows"))
    mixed = (
        parts.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("components"), F.max(F.struct("rows", "component")).alias("top"))
        .where("components > 1")
        .select("bucket", F.col("top.component").alias("major"))
    )
    return placed.join(mixed, "bucket").select("bucket", "node", "n", "size", "component", "major")


def small_bucket_pairs(mixed: DataFrame, plan: Plan) -> DataFrame:
    """Pairs in different components of a bucket of at most ``SMALL_BUCKET`` members.

    Two members of the bucket's largest component never pair.  A member meets at
    most ``SMALL_BUCKET`` others in a bucket, so the pairs grow with the members.
    """
    rows = mixed.where(F.col("size") <= SMALL_BUCKET)
    left = rows.where("component <> major").select(
        "bucket", F.col("node").alias("x"), F.col("n").alias("x_n"), F.col("component").alias("x_component")
    )
    return as_pairs(
        rows.join(left, "bucket")
        .where("component <> x_component")
        .where((F.col("component") == F.col("major")) | (F.col("x") < F.col("node")))
        .where(near_size(plan, "n", "x_n")),
        "node",
        "x",
    )


def large_bucket_pairs(mixed: DataFrame, docs: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """Candidate pairs in different components among the members of larger mixed buckets.

    Their buckets say little (thousands of texts that are nearly alike, but not
    enough), so the pairs come from the texts' rarest shingles instead: two sets
    that share ``need = ceil(percent * (n + m) / (100 + percent))`` shingles share
    one among the first ``n - need + 1`` and ``m - need + 1`` in any common order
    (here rarest first).  A shingle at place j of a set thus only meets sets up to a
    certain size; size classes make that part of the join key.  This is exact, and
    the shingles of a group's common text, late in that order, meet nobody of equal
    size.
    """
    p, whole = plan.percent, 100 + plan.percent
    nodes = staged(
        mixed.where(F.col("size") > SMALL_BUCKET)
        .groupBy("node")
        .agg(F.min("component").alias("component"), F.max(F.col("component") != F.col("major")).alias("minor")),
        "large-bucket-nodes",
    )
    side, _ = broadcast_if_small(nodes)
    texts = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).join(side, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(plan.words)
        for batch in batches:
            texts = strings(batch.column(1))
            for a, b in slices(texts, SLICE):
                sets = shingler.sets(texts[a:b])
                sizes = np.fromiter(map(len, sets), np.int64, len(sets))
                at = np.repeat(np.arange(a, b), sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).take(pa.array(at)) for i in (0, 2, 3)),
                        pa.array(np.repeat(sizes, sizes)),
                        pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)),
                    ],
                    ["node", "component", "minor", "n", "shingle"],
                )

    each = staged(
        texts.select("node", "text", "component", "minor").mapInArrow(
            run, "node long, component long, minor boolean, n long, shingle long"
        ),
        "large-bucket-shingles",
    )
    rarity = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    # a shingle that one text alone has meets nobody, but takes its place in the order
    order = Window.partitionBy("node").orderBy(F.coalesce("rows", F.lit(1)), "shingle")
    placed = (
        each.join(rarity, "shingle", "left")
        .withColumn("place", F.row_number().over(order) - 1)
        .where((F.col("place") * 100 <= F.col("n") * (100 - p)) & F.col("rows").isNotNull())
        .withColumn("class", size_class(F.col("n")))
    )
    rare = staged(placed.select("node", "component", "minor", "n", "shingle", "place", "class"), "rare-shingles")
    reach = F.floor((F.col("x_n") - F.col("x_place")) * whole / p) - F.col("x_n")
    probes = (
        rare.where("minor")
        .select("shingle", *(F.col(c).alias(f"x_{c}") for c in ("node", "component", "n", "place")))
        .withColumn("from", size_class(F.ceil(F.col("x_n") * p / 100)))
        .withColumn("to", size_class(reach))
        .where((reach >= 1) & (F.col("from") <= F.col("to")))
        .withColumn("class", F.explode(F.sequence("from", "to")))
        .drop("from", "to")
    )
    need = F.ceil((F.col("n") + F.col("x_n")) * p / whole)
    return as_pairs(
        rare.join(probes, ["shingle", "class"])
        .where("component <> x_component")
        .where((F.col("place") + need <= F.col("n")) & (F.col("x_place") + need <= F.col("x_n")))
        .where(near_size(plan, "n", "x_n")),
        "node",
        "x_node",
    )


def size_class(n: Column) -> Column:
    """Classes of set sizes that grow by a twenty-fifth."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / math.log(1.04)).cast("int")


# --------------------------------------------------------------------------
# Verification
# --------------------------------------------------------------------------
def posterior_survivors(left: np.ndarray, right: np.ndarray, plan: Plan) -> np.ndarray:
    """Numbers of the pairs that no batch of signature rows prunes."""
    alive, done = np.arange(len(left)), 0
    matches = np.zeros(len(left), np.int64)
    for n, least in plan.least_matches():
        matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        alive = alive[matches[alive] >= least]
        done = n
    return alive


def bayes_filter(pairs: DataFrame, reps: DataFrame, plan: Plan) -> DataFrame:
    """The (a, b) pairs whose signatures leave the threshold possible."""
    signed = reps.select("node", "signature")
    both = pairs.join(signed.select(F.col("node").alias("a"), F.col("signature").alias("left")), "a").join(
        signed.select(F.col("node").alias("b"), F.col("signature").alias("right")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (
                    np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, plan.hashes) for i in (2, 3)
                )
                yield batch.select(["a", "b"]).take(pa.array(posterior_survivors(left, right, plan)))

    return both.select("a", "b", "left", "right").mapInArrow(tidy(run), "a long, b long")


def exact_links(pairs: DataFrame, docs: DataFrame, plan: Plan, key: str, text: str) -> DataFrame:
    """The pairs whose whole texts have 100 * intersection >= percent * union of shingles."""
    wanted = staged(
        pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near-nodes"
    )
    side, _ = broadcast_if_small(wanted)
    texts = staged(
        docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).join(side, "node"), "near-texts"
    )
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            linked = []
            for i, (a, b) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if a != last:
                    last, own = a, shingles_of(a or "", plan.words)
                other = shingles_of(b or "", plan.words)
                common = len(own & other)
                if own and 100 * common >= plan.percent * (len(own) + len(other) - common):
                    linked.append(i)
            yield batch.select(["a", "b"]).take(pa.array(linked, pa.int64()))

    return both.select("a", "b", "a_text", "b_text").mapInArrow(tidy(run), "a long, b long").distinct()


# --------------------------------------------------------------------------
# Components
# --------------------------------------------------------------------------
def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of the (a, b) edges; a component is its smallest node.

    Alternates large-star and small-star steps until the edges are stars.  Every
    step is a minimum per node (summed up per task) and a join, so a node with
    very many edges is never gathered; every round is written to the shared folder.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not are_stars(edges):
        # large star: neighbours above a node move to its smallest neighbour
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large-star")
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            low.select("u", F.col("m").alias("v"))
        )
        edges = staged(small.distinct(), "small-star")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def are_stars(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour and no larger one, or only larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    inner = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return inner.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def with_class(rows: DataFrame, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Append ``node``, the smallest ``doc_id`` of the rows of the same ``set_key`` (null without a set).

    A set of one document is its own class; the classes of the others meet the rows by
    broadcast while they are measured small.  Beyond that only rows with a set are
    shuffled, a set's rows over ``CLASS_SALTS`` tasks: neither null nor empty texts nor the
    copies of one text come together in a task.
    """
    linkable = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    found = linkable.groupBy("set_key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = staged(found.where("n > 1").drop("n"), "repeated-sets")
    side, small = broadcast_if_small(classes, max_broadcast_bytes)
    if small:
        joined = rows.join(side, "set_key", "left")
    else:
        salted = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(CLASS_SALTS - 1))))
        keyed = rows.where("set_key IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(CLASS_SALTS)).cast("int"))
        joined = keyed.join(salted, ["set_key", "salt"], "left").drop("salt")
        joined = joined.unionByName(rows.where("set_key IS NULL").withColumn("first", F.lit(None).cast("long")))
    own = F.when(F.col("set_key").isNotNull(), F.coalesce("first", "doc_id"))
    return joined.withColumn("node", own).drop("first")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if their sets of ``words``-word shingles have a
    Jaccard similarity of ``percent`` or more; a component's id is its smallest
    key, and that document is kept.  A null or empty text has no shingles and is
    linked with nothing.  Rows of one key count as one document: their groups are
    joined.  A row without a key has a null component and is kept.  Other columns
    are ignored; an empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    plan = Plan(words, percent)
    signed = staged(signatures(docs, plan, key, text), "signatures")
    linkable = signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    reps = staged(
        linkable.groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("r"))
        .select(F.col("r.doc_id").alias("node"), F.col("r.n_shingles").alias("n"), F.col("r.signature").alias("signature")),
        "representatives",
    )
    members = staged(bucket_members(reps, plan), "bucket-members")
    sharing = staged(reps.join(members.select("node").distinct(), "node", "left_semi"), "bucket-signatures")

    first = staged(pivot_pairs(members, plan), "pivot-pairs")
    links = staged(exact_links(staged(bayes_filter(first, sharing, plan), "pivot-survivors"), docs, plan, key, text), "links")
    labels = staged(connected_components(links), "pivot-components")
    mixed = staged(mixed_buckets(members, labels), "mixed-buckets")
    rest = small_bucket_pairs(mixed, plan).union(large_bucket_pairs(mixed, docs, plan, key, text)).distinct()
    rest = rest.join(first, ["a", "b"], "left_anti")
    more = exact_links(staged(bayes_filter(rest, sharing, plan), "other-survivors"), docs, plan, key, text)

    placed = staged(with_class(signed.select("doc_id", "n_shingles", "set_key")).select("doc_id", "n_shingles", "node"), "classes")
    # a key with several texts joins their classes
    several = placed.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    repeated = placed.join(several, "doc_id").select("a", F.col("node").alias("b")).where("a <> b")
    joined = labels.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more).union(repeated)
    components = staged(connected_components(joined), "components")
    return (
        placed.join(components, "node", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"),
        )
    )

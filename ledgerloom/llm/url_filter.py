"""Operator 3: URL filter by host rules and gradient-boosted trees on lexical features.

The rules label the urls they fit.  Boosted trees learn from those labels what
blocked urls look like (length, depth, digits, entropy, parameters, statistics
of the host's suffix) and judge the urls that no rule fits.  For a url that the trees
learn from, the suffix statistics come from the labelled urls of other folds, so they
never hold its own label.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ascii_lower, prepare, staged
from ledgerloom.operators.layout import broadcast_if_small


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# the given rules (fixed values)
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
ALLOW, BLOCK = "allow", "block"

# Distinct labelled urls used for fitting (about; chosen by a hash of the url).
FIT_ROWS = 20_000
# Tasks of the fit: the sample is bounded, so is its parallelism.
FIT_PARTITIONS = 4
# Folds of urls for the suffix statistics of the fit.
FOLDS = 5

FEATURES = (
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_longest_label", "f_digits",
    "f_host_digits", "f_hyphens", "f_entropy", "f_parameters", "f_query_length", "f_fragment", "f_secure",
    "f_suffix_rows", "f_suffix_blocked",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url; both empty for null and for text without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule whose host is the url's or a parent domain, and whose path starts the url's."""
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(r.text))
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.split(text, "")
    n = F.length(text)
    return F.when(
        n > 0,
        F.aggregate(
            F.transform(
                F.array_distinct(letters),
                lambda c: F.when(F.length(c) > 0, (n - F.length(F.replace(text, c, F.lit("")))) / n).otherwise(1.0),
            ),
            F.lit(0.0),
            lambda total, p: total - p * F.log2(p),
        ),
    ).otherwise(0.0)


def lexical(df: DataFrame, url: Column, prefix: str = "") -> DataFrame:
    """Append the lexical features of ``url`` (with its ``host`` and ``path`` columns) and ``suffix``, all after ``prefix``."""
    text = F.coalesce(url, F.lit(""))
    host, path = F.col("host"), F.col("path")
    digits = F.regexp_replace(text, "[^0-9]", "")
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    features = {
        "f_length": F.length(text),
        "f_host_length": F.length(host),
        "f_path_length": F.length(path),
        "f_depth": F.length(F.regexp_replace(path, "[^/]", "")),
        "f_labels": F.size(labels),
        "f_longest_label": F.array_max(F.transform(labels, F.length)),
        "f_digits": ratio(F.length(digits), F.length(text)),
        "f_host_digits": ratio(F.length(F.regexp_replace(host, "[^0-9]", "")), F.length(host)),
        "f_hyphens": F.length(F.regexp_replace(host, "[^-]", "")),
        "f_entropy": entropy(text),
        "f_parameters": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0),
        "f_query_length": F.length(query),
        "f_fragment": text.contains("#").cast("int"),
        "f_secure": ascii_lower(text).startswith("https://").cast("int"),
    }
    named = {prefix + name: value.cast("double") for name, value in features.items()}
    return df.withColumns(named | {f"{prefix}suffix": F.element_at(labels, -1)})


def judge(
    pages: DataFrame,
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
    fit_rows: int = FIT_ROWS,
    learn: Column | None = None,
) -> DataFrame:
    """Append ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` (0 to 1) to every row.

    A row that a rule fits has the rule's verdict, any other the trees' (block
    from a score of 0.5).  The trees learn from about ``fit_rows`` distinct urls that
    rules label, chosen by hash and weighted by their rows; the suffix statistics
    count all rows.  ``learn`` leaves out labels of rows where it is not true (to hold
    some out).  With no labelled url, or labels of one kind, that kind (else
    allow) is the verdict; with a sample of one kind, or none, the more frequent label.
    A null url has an empty host and path; columns of the same names are
    replaced, all others stay; repeated rows and empty tables need no care.
    """
    prepare(pages.sparkSession)
    made = {"host", "path", "rule", "verdict", "block_score"}
    if url in made:
        raise ValueError(f"column {url} has the name of a result column")
    p = "url_filter_"
    while any(c.startswith(p) for c in pages.columns):
        p += "_"
    features = [p + f for f in FEATURES]
    host, path = host_and_path(F.col(url))
    learns = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    named = pages.withColumn(f"{p}learns", learns).drop(*made).withColumns({"host": host, "path": path})
    ruled = named.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*(F.lit(x) for r in rules for x in (r.text, r.verdict)))
    by_rule = F.when(F.col("rule").isNotNull(), F.element_at(verdicts, F.col("rule")))
    label, suffix, n_rows = F.col(f"{p}label"), f"{p}suffix", F.col(f"{p}n")
    rows = lexical(ruled, F.col(url), p).withColumn(f"{p}label", F.when(F.col(f"{p}learns"), (by_rule == BLOCK).cast("double")))
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col(url)), F.lit(FOLDS)).cast("int")

    def in_fold(value: Column) -> Column:
        return F.array(*(F.sum(F.when(F.col(f"{p}fold") == k, value).otherwise(0.0)) for k in range(FOLDS)))

    suffixes = staged(
        rows.where(label.isNotNull())
        .groupBy(suffix, f"{p}label", url)
        .agg(F.count(F.lit(1)).alias(f"{p}n"))
        .withColumn(f"{p}fold", fold)
        .groupBy(suffix)
        .agg(
            F.sum(n_rows).cast("double").alias("n"),
            F.sum(label * n_rows).alias("blocked"),
            F.count(F.lit(1)).alias("urls"),
            in_fold(n_rows.cast("double")).alias("n_in_fold"),
            in_fold(label * n_rows).alias("blocked_in_fold"),
        ),
        "url-suffixes",
    )
    totals = suffixes.agg(F.sum("n"), F.sum("blocked"), F.sum("urls")).first()
    n, blocked, urls = totals[0] or 0.0, totals[1] or 0.0, totals[2] or 0
    answer = [c for c in ruled.columns if c != f"{p}learns"]
    fits = 0 < blocked < n

    def statistics(of: DataFrame, n_of: Column, blocked_of: Column) -> DataFrame:
        """The two suffix features from counts, which are null for an unseen suffix."""
        known = n_of > 0
        return of.withColumns(
            {
                f"{p}f_suffix_rows": F.when(known, F.log1p(n_of)).otherwise(0.0),
                f"{p}f_suffix_blocked": F.when(known, (blocked_of + 1) / (n_of + 2)).otherwise(blocked / n),
            }
        )

    if fits:
        counts = suffixes.select(suffix, *(F.col(c).alias(p + c) for c in ("n", "blocked", "n_in_fold", "blocked_in_fold")))
        side, _ = broadcast_if_small(counts)
        rows = rows.join(side, suffix, "left")
        assembler = VectorAssembler(inputCols=features, outputCol=f"{p}vector", handleInvalid="keep")
        share = min(1.0, fit_rows / urls)
        own = F.get(F.col(f"{p}n_in_fold"), fold), F.get(F.col(f"{p}blocked_in_fold"), fold)
        learned = rows.where(label.isNotNull()).where(F.pmod(F.xxhash64(url), F.lit(1_000_003)) < share * 1_000_003)
        sample = staged(
            statistics(learned, F.col(f"{p}n") - own[0], F.col(f"{p}blocked") - own[1])
            .groupBy(url, f"{p}label", *features)  # the features depend on the url alone
            .agg(F.count(F.lit(1)).cast("double").alias(f"{p}rows"))
            .select(f"{p}label", f"{p}rows", *features)
            .repartition(FIT_PARTITIONS),
            "url-sample",
        )
        fits = sample.agg(F.count_distinct(f"{p}label")).first()[0] == 2
    if fits:
        trees = GBTClassifier(
            featuresCol=f"{p}vector", labelCol=f"{p}label", predictionCol=f"{p}prediction", weightCol=f"{p}rows",
            maxIter=10, maxDepth=4, stepSize=0.3, seed=7,
        )
        model = trees.fit(assembler.transform(sample)).setProbabilityCol(f"{p}probability").setRawPredictionCol(f"{p}raw")
        seen = statistics(rows, F.col(f"{p}n"), F.col(f"{p}blocked"))
        judged = model.transform(assembler.transform(seen)).withColumn("block_score", vector_to_array(f"{p}probability")[1])
    else:
        judged = ruled.withColumn("block_score", F.lit(1.0 if 2 * blocked > n else 0.0))
    return judged.select(
        *answer,
        F.coalesce(by_rule, F.when(F.col("block_score") >= 0.5, BLOCK).otherwise(ALLOW)).alias("verdict"),
        "block_score",
    )

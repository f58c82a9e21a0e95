"""Decision-tree classification on a table: features, fit, predictions, accuracy.

Feature extraction is built-in column expressions (required cells must parse,
optional cells default to 0); the tree is exact (``plans.tree``), or MLlib's binned
one on request; the accuracy is one aggregation over the scored table.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.cells import double_or_zero, required_double
from ledgerloom.plans import tree


def feature_table(
    df: DataFrame,
    required: list[str],
    default_zero: list[str],
    label: str,
    keep: list[str] | None = None,
    assemble: bool = True,
) -> DataFrame:
    """Columns ``f_<name>`` (doubles), ``label`` and, if ``assemble``, ``features``.

    Required features and the label fail the job on a null or malformed value;
    ``default_zero`` features read null as 0.
    """
    cols = [F.col(c) for c in (keep or [])]
    names = []
    for name in required:
        cols.append(required_double(F.col(name), name).alias(f"f_{name}"))
        names.append(f"f_{name}")
    for name in default_zero:
        cols.append(double_or_zero(F.col(name), name).alias(f"f_{name}"))
        names.append(f"f_{name}")
    cols.append(required_double(F.col(label), label).alias("label"))
    out = df.select(*cols)
    return assemble_features(out) if assemble else out


def assemble_features(df: DataFrame) -> DataFrame:
    """Append ``features``, the vector of the ``f_<name>`` columns in their order."""
    names = [c for c in df.columns if c.startswith("f_")]
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


def fit_tree(
    train: DataFrame,
    max_depth: int = 5,
    min_info_gain: float = 0.0,
    max_bins: int | None = None,
    seed: int = 42,
) -> tree.TreeModel | DecisionTreeClassificationModel:
    """Gini decision tree, depth-limited.

    By default exact at every table size: all distinct values of a feature are split
    candidates (see ``plans.tree``).  With ``max_bins``, MLlib's tree instead, which cuts
    a feature at that many quantiles of a sample (``seed``).
    """
    if max_bins is None:
        return tree.fit(train, max_depth, min_info_gain)
    return DecisionTreeClassifier(
        featuresCol="features",
        labelCol="label",
        maxDepth=max_depth,
        minInfoGain=min_info_gain,
        maxBins=max_bins,
        impurity="gini",
        seed=seed,
    ).fit(train)


def model_text(model: tree.TreeModel | DecisionTreeClassificationModel) -> str:
    """The tree as nested conditions on feature numbers."""
    return model.toDebugString


def model_rows(model: tree.TreeModel, spark: SparkSession) -> DataFrame:
    """The tree as a table, one row per node (``tree.NODE_SCHEMA``)."""
    return model.node_table(spark)


def accuracy_frame(scored: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: ``accuracy`` (share of rows predicted right) and ``test_error``."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return scored.agg(F.avg(hit).alias("accuracy")).withColumn(
        "test_error", F.lit(1.0) - F.col("accuracy")
    )

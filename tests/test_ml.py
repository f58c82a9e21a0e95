"""Features with defaults, tree fit, accuracy on the training table."""

from pyspark.sql import functions as F

from ledgerloom.plans import ml

from .conftest import SF_SMALL


def test_tree_learns_threshold_rule(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "n_chars")
    df = docs.withColumn("toxic", F.lit(None).cast("int")).withColumn(
        "quality", (F.col("n_chars") > 200).cast("int")
    )
    train = ml.feature_table(df, required=["n_chars"], default_zero=["toxic"], label="quality")
    model = ml.fit_tree(train, max_depth=5, max_bins=64)
    acc = ml.accuracy_frame(model.transform(train)).first()
    assert acc["accuracy"] > 0.97
    assert abs(acc["accuracy"] + acc["test_error"] - 1.0) < 1e-12
    assert "If (feature 0" in ml.model_text(model)


def test_default_zero_features(spark):
    df = spark.createDataFrame([("1", None, "0"), ("2", "3", "1")], "a string, b string, y string")
    rows = ml.feature_table(df, ["a"], ["b"], "y", assemble=False).collect()
    assert [(r["f_a"], r["f_b"], r["label"]) for r in rows] == [(1.0, 0.0, 0.0), (2.0, 3.0, 1.0)]

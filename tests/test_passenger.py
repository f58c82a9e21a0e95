"""Passenger flows on a synthetic 14-column file (placeholder names, nulls, one bad id)."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.keyed_table import KeyedTable
from ledgerloom.plans import passenger
from ledgerloom.sources import delimited

HEADER = ["pclass", "label", "c02", "sex", "c04", "sibsp", "parch",
          "c07", "c08", "c09", "c10", "c11", "c12", "id"]


@pytest.fixture(scope="module")
def passenger_file(spark):
    from ledgerloom.session import scratch_path

    rows = []
    for i in range(1, 301):
        pclass = 1 + i % 3
        sibsp = None if i % 7 == 0 else str(i % 4)
        parch = None if i % 11 == 0 else str(i % 3)
        survived = "1" if pclass == 1 else "0"
        sex = "male" if i % 2 else "female"
        ident = "x12" if i == 150 else str(i)
        rows.append((str(pclass), survived, "a", sex, "b", sibsp, parch,
                     "c", "d", "e", "f", "g", "h", ident))
    df = spark.createDataFrame(rows, ", ".join(f"{h} string" for h in HEADER)).repartition(3)
    path = scratch_path(spark, "passengers")
    delimited.write_delimited(df, path)
    return path


def test_sql_count_with_text_ids(spark, passenger_file, scratch):
    df = delimited.read_untyped(spark, passenger_file).repartition(8)
    t = KeyedTable(spark, scratch("passenger-table"), "id")
    t.append(df)
    assert t.scan().select("id", "sex").count() == 300
    n = passenger.count_where_sql(spark, t.scan()).first()["n"]
    # odd ids are male; ids >= 2 -> 3..299 odd = 149, and id 150 (bad) is even anyway
    assert n == 149


def test_keyed_collection_dense_and_sparse(spark, passenger_file):
    df = delimited.read_untyped(spark, passenger_file)
    dense = passenger.keyed_collection(df)
    assert dense.columns[0] == "key" and dense.columns[1:] == [f"c{i:02d}" for i in range(14)]
    assert sorted(r["key"] for r in dense.collect()) == list(range(300))
    sparse = passenger.keyed_collection(df, dense=False)
    assert sparse.select("key").distinct().count() == 300


def test_tree_on_positional_cells(spark, passenger_file):
    collection = passenger.keyed_collection(delimited.read_untyped(spark, passenger_file))
    feats = passenger.positional_features(collection)
    assert feats.where(F.col("f_c05") == 0.0).count() >= 300 // 7
    model, acc = passenger.tree_accuracy(collection)
    row = acc.first()
    assert row["accuracy"] == 1.0 and row["test_error"] == 0.0

"""Passenger-style tables: untyped delimited rows addressed by position.

* ``keyed_collection`` turns a scanned table into ``key long`` plus the first
  ``n_cells`` cells (``c00``, ``c01``, ...), keyed by a dense ordinal or by
  Spark's sparse row id, without bringing rows to the driver.
* ``count_where_sql`` is the SQL count over a keyed passenger table whose
  ``id`` column is text: it is compared numerically with ``try_cast`` so one
  malformed id drops that row instead of failing the job.
* ``positional_features`` picks required / default-zero feature cells and the
  label cell by position, for ``ml.fit_tree``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.indexing import dense_index, with_row_index
from ledgerloom.plans import ml

# The passenger layout - 14 cells; features at positions 0
# (required), 5 and 6 (null -> 0); label at position 1.
PASSENGER_CELLS = 14
FEATURE_REQUIRED = (0,)
FEATURE_DEFAULT_ZERO = (5, 6)
LABEL_POSITION = 1


def cell_name(position: int) -> str:
    return f"c{position:02d}"


def keyed_collection(df: DataFrame, n_cells: int = PASSENGER_CELLS, key: str = "key",
                     dense: bool = True, order_by: list | None = None) -> DataFrame:
    """``key`` + the first ``n_cells`` columns renamed by position.

    ``dense=True``: keys 0, 1, 2, ... in scan order, or that of ``order_by`` (no
    collisions, no driver round trip).  ``dense=False``: Spark's unique sparse id, kept as a long so
    ids of different partitions never collide.
    """
    if len(df.columns) < n_cells:
        raise ValueError(f"table has {len(df.columns)} columns, {n_cells} cells expected")
    indexed = dense_index(df, key, order_by=order_by) if dense else with_row_index(df, key)
    cells = [F.col(f"`{c}`").alias(cell_name(i)) for i, c in enumerate(df.columns[:n_cells])]
    return indexed.select(F.col(key).cast("long").alias(key), *cells)


def count_where_sql(spark: SparkSession, table: DataFrame, view: str = "passengers",
                    min_id: int = 2, sex: str = "male") -> DataFrame:
    """``SELECT COUNT(*) FROM view WHERE id >= min_id AND sex = '<sex>'`` on text ids."""
    table.createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT COUNT(*) AS n FROM {view} WHERE try_cast(id AS BIGINT) >= :min_id AND sex = :sex",
        args={"min_id": int(min_id), "sex": sex},
    )


def positional_features(collection: DataFrame, required=FEATURE_REQUIRED,
                        default_zero=FEATURE_DEFAULT_ZERO, label: int = LABEL_POSITION,
                        key: str = "key") -> DataFrame:
    return ml.feature_table(
        collection,
        required=[cell_name(i) for i in required],
        default_zero=[cell_name(i) for i in default_zero],
        label=cell_name(label),
        keep=[key],
    )


def tree_accuracy(collection: DataFrame, max_depth: int = 5, min_info_gain: float = 0.0):
    """Fit on the collection and score the same rows: ``(model, accuracy frame)``."""
    train = positional_features(collection)
    model = ml.fit_tree(train, max_depth=max_depth, min_info_gain=min_info_gain)
    return model, ml.accuracy_frame(model.transform(train))

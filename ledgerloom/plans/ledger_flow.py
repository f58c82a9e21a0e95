"""The ledger flows: stage -> two keyed tables -> join / average / SQL / update.

Column *roles* make the same flow run on the generated ledger (``LEDGER``)
and on any table with matching roles, e.g. orders (``ORDERS``).

Plan shape at scale (tested in ``tests/test_layout_and_plans.py`` and
``tests/test_bucketed.py``; shown in PLANS.md): the staging filter and the
right-side filter reach the scans; both keyed-table scans read only the
columns the join needs; the join on the unique key is a sort-merge join with
no Exchange when both tables are bucketed alike (a shuffle join otherwise, or
a broadcast one when a side is measured small); the average runs as a partial
aggregate per task followed by a shuffle of one row per group and task, so a
group holding a third of the rows costs no more than any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.keyed_table import KeyedTable, persist_batch
from ledgerloom.operators.layout import (
    DEFAULT_BROADCAST_BYTES,
    broadcast_if_small,
    sort_with_tiebreak,
)


@dataclass(frozen=True)
class Roles:
    key: str
    unit: str
    date: str
    dept: str
    product: str
    account: str
    excluded_unit: str
    excluded_dept: str
    # Money stored as double: averaged as DECIMAL(18, scale) so the sum is exact
    # and the result does not depend on partitioning or summation order.
    account_scale: int | None = None

    @property
    def staged_columns(self) -> list[str]:
        return [self.key, self.unit, self.dept, self.product, self.account]


# Filter constants of the ledger workload.
LEDGER = Roles(
    key="id",
    unit="BUSINESS_UNIT",
    date="JOURNAL_DATE",
    dept="DEPTID",
    product="PRODUCT",
    account="ACCOUNT",
    excluded_unit="BUSINESS_UNIT2",
    excluded_dept="DEPTID2",
)
UPDATE_FROM_UNIT = "BUSINESS_UNIT3"
UPDATE_TO_UNIT = "Mary Major V2"

# Orders standing in for the ledger.
ORDERS = Roles(
    key="o_orderkey",
    unit="o_orderstatus",
    date="o_orderdate",
    dept="o_orderpriority",
    product="o_custkey",
    account="o_totalprice",
    excluded_unit="P",
    excluded_dept="5-LOW",
    account_scale=2,
)


def stage(
    source: DataFrame,
    roles: Roles = LEDGER,
    repartition: int | None = None,
    sort: bool = False,
) -> DataFrame:
    """Drop the excluded unit and keep the five staged columns.

    ``repartition`` adds a round-robin shuffle first (only worth it to spread
    a badly split input).  ``sort`` orders by unit and date (date is not in
    the output) with the key as tie-break; keyed tables are unordered, so
    flows that only write the staged rows leave it off.
    """
    df = source.repartition(repartition) if repartition else source
    df = df.filter(F.col(roles.unit) != roles.excluded_unit)
    if sort:
        df = sort_with_tiebreak(df, [roles.unit, roles.date], [roles.key])
    return df.select(*roles.staged_columns)


@dataclass
class LeftRight:
    left: KeyedTable
    right: KeyedTable


def load_left_right(spark: SparkSession, staged: DataFrame, root: str, roles: Roles = LEDGER,
                    on_conflict: str = "skip", buckets: int | None = None,
                    replicated: bool = False, share: bool = False) -> LeftRight:
    """Append the staged rows to the ``left`` and ``right`` keyed tables under ``root``.

    The staged frame is persisted (memory, spilling to disk), so it is computed
    once, and each table gets its own insert-if-absent append.  With ``share``,
    two tables that start empty hold the same segments: the rows are written once.

    ``buckets`` stores both tables bucketed on the key, so the join between
    them (and later appends) runs without shuffling either table.
    ``replicated`` marks both tables for broadcast joins while they are
    measured small (the replicated table layout).
    """
    left = KeyedTable(spark, f"{root}/ledger_left", roles.key, buckets=buckets, replicated=replicated)
    right = KeyedTable(spark, f"{root}/ledger_right", roles.key, buckets=buckets, replicated=replicated)
    if share and not left.exists() and not right.exists():
        left.append(staged, on_conflict=on_conflict)
        right.clone_from(left)
        return LeftRight(left, right)
    cached = persist_batch(staged)
    try:
        left.append(cached, on_conflict=on_conflict)
        right.append(cached, on_conflict=on_conflict)
    finally:
        cached.unpersist()
    return LeftRight(left, right)


def right_side(right: DataFrame, roles: Roles = LEDGER) -> DataFrame:
    return right.select(roles.key, roles.unit, roles.dept).where(
        F.col(roles.dept) != roles.excluded_dept
    )


def left_side(left: DataFrame, roles: Roles = LEDGER) -> DataFrame:
    return left.select(roles.key, roles.product, roles.account)


def join_left_right(
    left: DataFrame,
    right: DataFrame,
    roles: Roles = LEDGER,
    replicated: bool = False,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Inner join USING the key (one key column in the output).

    ``replicated=True`` broadcasts the right side only after measuring it
    within ``max_broadcast_bytes``; otherwise Spark's own size rules and AQE
    choose between broadcast and shuffle joins.
    """
    l_side, r_side = left_side(left, roles), right_side(right, roles)
    if replicated:
        r_side, _ = broadcast_if_small(r_side, max_broadcast_bytes)
    return l_side.join(r_side, roles.key)


def average_by(df: DataFrame, group: str, value: str, alias: str,
               decimal_scale: int | None = None) -> DataFrame:
    """``groupBy(group).avg(value)`` as a double.

    Integer values are summed exactly as longs.  With ``decimal_scale`` a
    double value is averaged as ``DECIMAL(18, scale)``: an exact sum, and an
    average rounded half-up at ``scale + 4`` places, identical on every run
    whatever the partitioning.  Partial averages run per task before the
    shuffle, so a hot group costs one partial row per task.
    """
    col = F.col(value)
    if decimal_scale is not None:
        col = col.cast(T.DecimalType(18, decimal_scale))
    return df.groupBy(group).agg(F.avg(col).cast("double").alias(alias))


def avg_account_by_dept(left: DataFrame, right: DataFrame, roles: Roles = LEDGER,
                        replicated: bool = False, alias: str = "avg_account") -> DataFrame:
    """Join left and right, then average the account per department."""
    joined = join_left_right(left, right, roles, replicated)
    return average_by(joined, roles.dept, roles.account, alias, roles.account_scale)


def right_filtered_avg(right: DataFrame, roles: Roles = LEDGER, alias: str = "avg_account") -> DataFrame:
    """Average per department over the filtered right table (no join)."""
    filtered = right.select(*roles.staged_columns).where(F.col(roles.dept) != roles.excluded_dept)
    return average_by(filtered.select(roles.dept, roles.account), roles.dept, roles.account, alias,
                      roles.account_scale)


def sql_join(spark: SparkSession, left: DataFrame, right: DataFrame, roles: Roles = LEDGER,
             left_view: str = "ledger_left", right_view: str = "ledger_right") -> DataFrame:
    """The join as SQL text over two views: sub-selects with ORDER BY, joined on key.

    This is a fixed query of the workload (fixed value), written through the
    column roles.
    Duplicate output names (product and account of both sides) are aliased so
    the result can be written.  The ORDER BY clauses inside the sub-selects do
    not affect a join result, and Catalyst removes them.
    """
    left.createOrReplaceTempView(left_view)
    right.createOrReplaceTempView(right_view)
    r = roles
    return spark.sql(
        f"""
        SELECT t1.{r.key}, t1.{r.product} AS left_product, t1.{r.account} AS left_account,
               t2.{r.unit}, t2.{r.dept}, t2.{r.product} AS right_product,
               t2.{r.account} AS right_account
        FROM (SELECT {r.key}, {r.product}, {r.account} FROM {left_view} ORDER BY {r.account}) t1
        JOIN (SELECT {r.key}, {r.unit}, {r.dept}, {r.product}, {r.account} FROM {right_view}
              WHERE {r.dept} IS NOT NULL AND NOT {r.dept} = '{r.excluded_dept}'
              ORDER BY {r.dept}, {r.unit}) t2
        ON t1.{r.key} = t2.{r.key}
        """
    )


def product_avg_sql(spark: SparkSession, table: DataFrame, roles: Roles = LEDGER,
                    view: str = "great_table", alias: str = "avg_account") -> DataFrame:
    """``SELECT product, AVG(account) FROM view GROUP BY product`` (exact, see ``average_by``)."""
    table.createOrReplaceTempView(view)
    value = roles.account
    if roles.account_scale is not None:
        value = f"CAST({value} AS DECIMAL(18, {roles.account_scale}))"
    return spark.sql(
        f"SELECT {roles.product}, CAST(AVG({value}) AS DOUBLE) AS {alias} "
        f"FROM {view} GROUP BY {roles.product}"
    )


def update_unit(table: KeyedTable, roles: Roles = LEDGER, old: str = UPDATE_FROM_UNIT,
                new: str = UPDATE_TO_UNIT) -> int:
    """``UPDATE t SET unit = new WHERE unit = old``; returns the new version."""
    return table.update({roles.unit: F.lit(new)}, F.col(roles.unit) == old)


def large_table_flow(spark: SparkSession, source: DataFrame, root: str, roles: Roles = LEDGER,
                     excluded_key: int = 2) -> DataFrame:
    """Filter ``key != excluded_key``, write Parquet once and a keyed table twice.

    Appending the same frame twice must not duplicate rows.  Returns one row
    per copy: ``source`` ('keyed_table' or 'parquet') and its ``n_rows``.
    """
    staged = persist_batch(
        source.filter(F.col(roles.key) != excluded_key).select(roles.key, roles.unit, roles.date)
    )
    try:
        parquet_path = f"{root}/large_parquet"
        staged.write.mode("overwrite").parquet(parquet_path)
        table = KeyedTable(spark, f"{root}/large_table", roles.key)
        table.append(staged)
        table.append(staged)
    finally:
        staged.unpersist()

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("source"), "n_rows"
        )

    return counted(table.scan(), "keyed_table").unionByName(
        counted(spark.read.parquet(parquet_path), "parquet")
    )

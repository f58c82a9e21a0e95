"""Registered queries: one per operator (group) of the workload, each with a DuckDB oracle.

Every query reads the given tables (or files Spark derives from them), over
whole tables.  Queries that write files put them in a fresh folder under the
shared scratch root and never delete it: the caller evaluates the returned
DataFrame later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.cells import double_or_zero, required_double
from ledgerloom.operators.indexing import dense_index, with_row_index
from ledgerloom.operators.keyed_table import KeyedTable
from ledgerloom.operators.layout import estimated_bytes, persist_in_memory, plan_rows
from ledgerloom.operators.layout import partition_by_key as key_partitioned
from ledgerloom.operators.read_through import load_from_source, lookup_through
from ledgerloom.plans import ledger_flow as lf
from ledgerloom.plans import ml, passenger
from ledgerloom.session import buckets_for, partitions_for, scratch_path
from ledgerloom.sources import delimited, ledger, parquet
from ledgerloom.sources.line_index import IndexedSource

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


R = lf.ORDERS


def money_avg_sql(col: str) -> str:
    """DuckDB form of a DECIMAL(18,2) average: exact cents, rounded half-up at 6 places.

    (Prices are positive, so integer division rounds as Spark's HALF_UP does.)
    """
    cents = f"SUM(CAST(ROUND({col} * 100) AS HUGEINT))"
    n = f"COUNT({col})"
    return f"CAST((2 * {cents} * 10000 + {n}) // (2 * {n}) AS DOUBLE) / 1000000.0"

STAGED_SQL = "SELECT * FROM orders WHERE o_orderstatus != 'P'"


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders standing in for the staged ledger: status != 'P', five columns."""
    return lf.stage(table(spark, sf_dir, "orders"), R)


def ledger_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows whose ordinals are the order keys (grows with the orders table)."""
    return ledger.ledger_from_ordinals(table(spark, sf_dir, "orders"), "o_orderkey")


# DuckDB form of ``ledger_source`` (same closed form, columns in file order).
LEDGER_SQL = """
SELECT CAST(o_orderkey + 1 AS BIGINT) AS id,
       'BUSINESS_UNIT' || CAST(o_orderkey % 10 AS VARCHAR) AS BUSINESS_UNIT,
       'JOURNAL_DATE' AS JOURNAL_DATE,
       'LEDGER' AS LEDGER,
       CAST(greatest((o_orderkey + 99) % 1000, 100) AS INTEGER) AS ACCOUNT,
       'ALTACCT' AS ALTACCT,
       'DEPTID' || CAST((o_orderkey + 1) % 7 AS VARCHAR) AS DEPTID,
       'OPERATING_UNIT' AS OPERATING_UNIT,
       'PRODUCT' || CAST((o_orderkey + 2) % 11 AS VARCHAR) AS PRODUCT,
       'ACRUAL_IND_SFI' AS ACRUAL_IND_SFI,
       'GEO_AREA_SFI' AS GEO_AREA_SFI,
       'PROF_CTR_OFC_SFI' AS PROF_CTR_OFC_SFI
FROM orders
"""
LEDGER_STAGED_SQL = (
    f"SELECT id, BUSINESS_UNIT, DEPTID, PRODUCT, ACCOUNT FROM ({LEDGER_SQL}) "
    "WHERE BUSINESS_UNIT != 'BUSINESS_UNIT2'"
)


# --------------------------------------------------------------------------
# Sources and sinks
# --------------------------------------------------------------------------
@register(
    "delimited_untyped",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer
    """,
)
def delimited_untyped(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    path = delimited.write_delimited(customer, scratch_path(spark, "customer-text"))
    return delimited.read_untyped(spark, path)


# fixed values: 26 Cyrillic letters for A-Z, so that a text needs windows-1251
LATIN, CYRILLIC = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБЦДЕФГХИЖКЛМНОПЯРСТУВШЩЫЗ"


@register(
    "delimited_typed",
    f"""
    SELECT c_custkey, c_name, translate(c_mktsegment, '{LATIN}', '{CYRILLIC}') AS c_segment,
           CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS DOUBLE) AS c_acctbal
    FROM customer
    """,
)
def delimited_typed(spark, sf_dir):
    """Types are inferred, and the segment is text that only windows-1251 reads right."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.translate("c_mktsegment", LATIN, CYRILLIC).alias("c_segment"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
    )
    path = delimited.write_delimited(customer, scratch_path(spark, "customer-cp1251"), encoding="windows-1251")
    return delimited.read_typed(spark, path, encoding="windows-1251").withColumn("c_custkey", F.col("c_custkey").cast("long"))


@register(
    "locale_cells",
    """
    WITH line AS (
        SELECT *, CAST(row_number() OVER (ORDER BY c_custkey, kind) AS BIGINT) AS key
        FROM (SELECT *, unnest(CASE c_nationkey WHEN 5 THEN [0, 1] WHEN 7 THEN [0, 2] ELSE [0] END) AS kind FROM customer))
    SELECT key,
           CASE kind WHEN 0 THEN 5 WHEN 1 THEN 5 ELSE 0 END AS n_cells,
           CASE WHEN kind = 0 THEN CAST(c_custkey AS DOUBLE) END AS c_custkey_num,
           CASE WHEN kind = 1 THEN 'key' END AS c_custkey_text,
           CASE kind WHEN 0 THEN c_name WHEN 1 THEN 'name' END AS c_name_text,
           CASE WHEN kind = 1 THEN 'segment' WHEN kind = 0 AND c_mktsegment <> 'BUILDING' THEN c_mktsegment END
             AS c_segment_text,
           CASE WHEN kind < 2 THEN kind = 0 AND c_mktsegment = 'BUILDING' END AS c_segment_nan,
           CASE WHEN kind = 0 THEN ROUND(c_acctbal, 2) END AS c_acctbal_num,
           CASE WHEN kind = 0 AND c_nationkey % 2 = 0 THEN c_nationkey * 1000.0
                WHEN kind = 0 THEN CAST(c_nationkey AS DOUBLE) END AS c_street_num
    FROM line
    """,
)
def locale_cells(spark, sf_dir):
    """A French-formatted file derived from customer, read as typed cells with their 1-based key.

    Decimal-comma balances, address-like cells with a numeric prefix (some with an
    exponent), empty cells, and among the data lines some that repeat the header
    and some of separators alone.
    """
    customer = table(spark, sf_dir, "customer")
    kinds = (
        F.when(F.col("c_nationkey") == 5, F.array(F.lit(0), F.lit(1)))
        .when(F.col("c_nationkey") == 7, F.array(F.lit(0), F.lit(2)))
        .otherwise(F.array(F.lit(0)))
    )
    lines = customer.withColumn("kind", F.explode(kinds)).sort("c_custkey", "kind")
    values = {
        "key": F.col("c_custkey").cast("string"),
        "name": F.col("c_name"),
        "segment": F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")),
        "balance": F.regexp_replace(F.format_string("%.2f", F.col("c_acctbal")), "\\.", ","),
        "street": F.concat(F.col("c_nationkey").cast("string"), F.when(F.col("c_nationkey") % 2 == 0, "E3rue").otherwise(" rue")),
    }
    text = lines.select(
        *(F.when(F.col("kind") == 0, v).when(F.col("kind") == 1, name).otherwise("").alias(name) for name, v in values.items())
    )
    path = scratch_path(spark, "customer-fr")
    text.write.option("sep", ";").option("header", "true").option("emptyValue", "").csv(path)
    cells = delimited.read_locale_cells(spark, path, key="key")
    cell = lambda i, part: F.get("cells", F.lit(i))[part]
    return cells.select(
        "key",
        F.size("cells").alias("n_cells"),
        cell(0, "num").alias("c_custkey_num"),
        cell(0, "text").alias("c_custkey_text"),
        cell(1, "text").alias("c_name_text"),
        cell(2, "text").alias("c_segment_text"),
        F.when(F.size("cells") > 0, F.coalesce(F.isnan(cell(2, "num")), F.lit(False))).alias("c_segment_nan"),
        cell(3, "num").alias("c_acctbal_num"),
        cell(4, "num").alias("c_street_num"),
    )


@register("ledger_rows", LEDGER_SQL)
def ledger_rows(spark, sf_dir):
    return ledger_source(spark, sf_dir)


@register("ledger_file_roundtrip", LEDGER_SQL)
def ledger_file_roundtrip(spark, sf_dir):
    path = delimited.write_delimited(
        ledger_source(spark, sf_dir), scratch_path(spark, "ledger-text"), encoding="windows-1251"
    )
    return delimited.read_typed(spark, path, schema=ledger.ledger_schema(), encoding="windows-1251")


@register("parquet_roundtrip", "SELECT * FROM part")
def parquet_roundtrip(spark, sf_dir):
    path = parquet.write_parquet(table(spark, sf_dir, "part"), scratch_path(spark, "part-parquet"))
    return parquet.read_parquet(spark, path)


# --------------------------------------------------------------------------
# Keyed tables
# --------------------------------------------------------------------------
def keyed(spark, label: str, key: str) -> KeyedTable:
    return KeyedTable(spark, scratch_path(spark, label), key)


@register(
    "keyed_append",
    """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'X' END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders
    """,
)
def keyed_append(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    t = keyed(spark, "orders-append", "o_orderkey")
    t.append(orders.where(F.col("o_orderstatus") == "F"))
    # every key again with a new status: stored rows win, new keys are added
    t.append(orders.withColumn("o_orderstatus", F.lit("X")))
    return t.scan()


@register(
    "keyed_replace",
    """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders
    """,
)
def keyed_replace(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    t = keyed(spark, "orders-replace", "o_orderkey")
    t.append(orders)
    # upsert: the batch's rows win for keys already stored
    t.append(
        orders.where(F.col("o_orderstatus") == "F").withColumn("o_orderstatus", F.lit("X")),
        on_conflict="replace",
    )
    return t.scan()


@register("keyed_append_twice", STAGED_SQL)
def keyed_append_twice(spark, sf_dir):
    staged = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    t = keyed(spark, "orders-twice", "o_orderkey")
    t.append(staged)
    t.append(staged)
    return t.scan()


@register(
    "keyed_overwrite",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment FROM customer",
)
def keyed_overwrite(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    t = keyed(spark, "customer-overwrite", "c_custkey")
    t.append(customer)
    # the new version reads the previous one: safe, old segments stay untouched
    t.overwrite(t.scan().withColumn("c_mktsegment", F.lower("c_mktsegment")))
    return t.scan()


@register("keyed_scan", "SELECT * FROM customer")
def keyed_scan(spark, sf_dir):
    t = keyed(spark, "customer-scan", "c_custkey")
    t.append(table(spark, sf_dir, "customer"))
    return t.scan()


@register("partition_by_key", "SELECT * FROM customer")
def partition_by_key(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return key_partitioned(customer, partitions_for(spark, estimated_bytes(customer)), "c_custkey")


@register(
    "dense_key_load",
    """
    SELECT CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS row_key, *
    FROM customer
    """,
)
def dense_key_load(spark, sf_dir):
    indexed = dense_index(table(spark, sf_dir, "customer"), "row_key", order_by=["c_custkey"])
    t = keyed(spark, "customer-dense", "row_key")
    # positions are unique by construction
    t.overwrite(indexed.select("row_key", *[c for c in indexed.columns if c != "row_key"]), validate=False)
    return t.scan()


@register("index_key_load", "SELECT *, 1 AS rows_of_key FROM customer")
def index_key_load(spark, sf_dir):
    indexed = with_row_index(table(spark, sf_dir, "customer"), "row_index")
    t = keyed(spark, "customer-index", "row_index")
    t.overwrite(indexed.select("row_index", *[c for c in indexed.columns if c != "row_index"]))
    return rows_of_key(t.scan(), "row_index")


def rows_of_key(df: DataFrame, key: str) -> DataFrame:
    """The rows with ``rows_of_key``, how many have their key, instead of the key (whose values are Spark's own)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows_of_key"))
    return df.join(counts, key).drop(key)


# the passenger flow on the join of orders, customer and nation, which has exactly 14 columns
PASSENGER_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12, 2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority, c_custkey, c_name, c_nationkey,
       CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(12, 2)) END AS c_acctbal, c_mktsegment,
       n_nationkey, n_name, n_regionkey
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""
PASSENGER_CELLS_SQL = ", ".join(
    f"CAST({c} AS VARCHAR) AS {passenger.cell_name(i)}"
    for i, c in enumerate(
        "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority c_custkey c_name c_nationkey "
        "c_acctbal c_mktsegment n_nationkey n_name n_regionkey".split()
    )
)


def passenger_rows(spark, sf_dir) -> DataFrame:
    """The 14 columns as untyped text read from a delimited file."""
    money = lambda c: F.col(c).cast("decimal(12,2)")
    orders = table(spark, sf_dir, "orders").withColumns(
        {"o_totalprice": money("o_totalprice"), "o_orderdate": F.col("o_orderdate").cast("date")}
    )
    customer = table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") >= 0, money("c_acctbal"))
    )
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    columns = [*orders.columns[:6], "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
               "n_nationkey", "n_name", "n_regionkey"]
    path = delimited.write_delimited(joined.select(columns), scratch_path(spark, "passengers"))
    return delimited.read_untyped(spark, path)


@register(
    "passenger_dense",
    f"""
    SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS key, {PASSENGER_CELLS_SQL}
    FROM ({PASSENGER_SQL})
    """,
)
def passenger_dense(spark, sf_dir):
    rows = passenger_rows(spark, sf_dir)
    t = keyed(spark, "passengers-dense", "key")
    t.overwrite(passenger.keyed_collection(rows, order_by=[F.col("o_orderkey").cast("long")]), validate=False)
    return t.scan()


@register("passenger_sparse", f"SELECT {PASSENGER_CELLS_SQL}, 1 AS rows_of_key FROM ({PASSENGER_SQL})")
def passenger_sparse(spark, sf_dir):
    t = keyed(spark, "passengers-sparse", "key")
    t.overwrite(passenger.keyed_collection(passenger_rows(spark, sf_dir), dense=False))
    return rows_of_key(t.scan(), "key")


@register(
    "passenger_features",
    f"""
    SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS key,
           CAST(o_orderkey AS DOUBLE) AS v0, CAST(o_totalprice AS DOUBLE) AS v1,
           CAST(coalesce(c_acctbal, 0) AS DOUBLE) AS v2, CAST(n_regionkey AS DOUBLE) AS label
    FROM ({PASSENGER_SQL})
    """,
)
def passenger_features(spark, sf_dir):
    """Features and label by position; the assembled vector's elements are returned."""
    cells = passenger.keyed_collection(passenger_rows(spark, sf_dir), order_by=[F.col("o_orderkey").cast("long")])
    made = passenger.positional_features(cells, required=(0, 3), default_zero=(9,), label=13)
    vector = vector_to_array("features")
    return made.select("key", *(vector[i].alias(f"v{i}") for i in range(3)), "label")


@register(
    "passenger_count",
    f"""
    SELECT COUNT(*) AS n
    FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'no ' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS id, n_regionkey
          FROM ({PASSENGER_SQL}))
    WHERE TRY_CAST(id AS BIGINT) >= 2 AND n_regionkey % 2 = 0
    """,
)
def passenger_count(spark, sf_dir):
    """The count by SQL on a keyed table whose id is text, malformed for some rows."""
    rows = passenger_rows(spark, sf_dir).select(
        F.concat(F.when(F.col("o_orderstatus") == "P", "no ").otherwise(""), F.col("o_orderkey")).alias("id"),
        F.when(F.col("n_regionkey").cast("int") % 2 == 0, "male").otherwise("female").alias("sex"),
    )
    t = keyed(spark, "passengers-text-id", "id")
    t.append(rows)
    return passenger.count_where_sql(spark, t.scan())


@register("point_lookup", "SELECT * FROM customer WHERE c_custkey = 7")
def point_lookup(spark, sf_dir):
    t = keyed(spark, "customer-lookup", "c_custkey")
    t.append(table(spark, sf_dir, "customer"))
    return t.lookup(7)


def bucketed_customers(spark, sf_dir) -> KeyedTable:
    customer = table(spark, sf_dir, "customer")
    t = KeyedTable(spark, scratch_path(spark, "customer-bucketed"), "c_custkey",
                   buckets=buckets_for(spark, estimated_bytes(customer)))
    t.append(customer.where("c_nationkey % 2 = 0"))
    t.append(customer)
    return t


@register("bucketed_lookup_hit", "SELECT * FROM customer WHERE c_custkey = 7")
def bucketed_lookup_hit(spark, sf_dir):
    return bucketed_customers(spark, sf_dir).lookup(7)


@register("bucketed_lookup_miss", "SELECT * FROM customer WHERE c_custkey = -7")
def bucketed_lookup_miss(spark, sf_dir):
    return bucketed_customers(spark, sf_dir).lookup(-7)


@register(
    "lookup_many",
    """
    SELECT * FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    """,
)
def lookup_many(spark, sf_dir):
    t = keyed(spark, "customer-lookup-many", "c_custkey")
    t.append(table(spark, sf_dir, "customer"))
    keys = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return t.lookup_many(keys, key_column="o_custkey")


# customers as text in key order, their rows keyed by line from 0
SOURCE_SQL = """
SELECT CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS row_key, CAST(c_custkey AS VARCHAR) AS c_custkey,
       c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
"""


def customer_source(spark, sf_dir) -> IndexedSource:
    customer = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    path = delimited.write_delimited(customer.sort("c_custkey"), scratch_path(spark, "customer-lines"))
    return IndexedSource(spark, path)


@register("line_key_load", SOURCE_SQL)
def line_key_load(spark, sf_dir):
    """A keyed table loaded from delimited files, keyed by line number."""
    t = keyed(spark, "customer-line-keys", "row_key")
    load_from_source(t, customer_source(spark, sf_dir))
    return t.scan()


@register("read_through_miss", f"SELECT * FROM ({SOURCE_SQL}) WHERE row_key = 7")
def read_through_miss(spark, sf_dir):
    """The table has the even keys only: the row comes from one block of the source."""
    source, t = customer_source(spark, sf_dir), keyed(spark, "customer-through", "row_key")
    load_from_source(t, source, "row_key % 2 = 0")
    return lookup_through(t, source, 7, store=False)


@register("read_through_table", f"SELECT * FROM ({SOURCE_SQL}) WHERE row_key % 2 = 0 OR row_key = 7")
def read_through_table(spark, sf_dir):
    """The table after a hit, a miss and a key that the source lacks: the missed row is stored."""
    source, t = customer_source(spark, sf_dir), keyed(spark, "customer-through", "row_key")
    load_from_source(t, source, "row_key % 2 = 0")
    for key in (6, 7, -1):
        lookup_through(t, source, key)
    return t.scan()


# --------------------------------------------------------------------------
# Projections and filters
# --------------------------------------------------------------------------
@register(
    "project_filter_ne",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey, o_totalprice
    FROM orders WHERE o_orderstatus != 'P'
    """,
)
def project_filter_ne(spark, sf_dir):
    return staged_orders(spark, sf_dir)


@register(
    "filter_num_ne",
    "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderkey != 2",
)
def filter_num_ne(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderkey != 2").select(
        "o_orderkey", "o_orderstatus", "o_orderdate"
    )


@register(
    "filter_not_null_and_not",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderpriority IS NOT NULL AND NOT o_orderpriority = '5-LOW'
    """,
)
def filter_not_null_and_not(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")
        .where("o_orderpriority IS NOT NULL AND NOT o_orderpriority = '5-LOW'")
    )


@register(
    "filtered_count_cast",
    "SELECT COUNT(*) AS n FROM orders WHERE o_orderkey >= 2 AND o_orderstatus = 'F'",
)
def filtered_count_cast(spark, sf_dir):
    # the untyped copy: every column (the key too) is text
    path = delimited.write_delimited(table(spark, sf_dir, "orders"), scratch_path(spark, "orders-text"))
    delimited.read_untyped(spark, path).createOrReplaceTempView("orders_text")
    return spark.sql(
        "SELECT COUNT(*) AS n FROM orders_text "
        "WHERE try_cast(o_orderkey AS BIGINT) >= 2 AND o_orderstatus = 'F'"
    )


FEATURES_SQL = """
SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS f_n_chars,
       COALESCE(CAST(l.toxic AS DOUBLE), 0.0) AS f_toxic,
       COALESCE(CAST(l.quality AS DOUBLE), 0.0) AS f_quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


@register("features_default_zero", FEATURES_SQL)
def features_default_zero(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select(
        "doc_id",
        required_double(F.col("n_chars"), "n_chars").alias("f_n_chars"),
        double_or_zero(F.col("toxic"), "toxic").alias("f_toxic"),
        double_or_zero(F.col("quality"), "quality").alias("f_quality"),
    )


# --------------------------------------------------------------------------
# Joins
# --------------------------------------------------------------------------
JOIN_SQL = """
SELECT l.o_orderkey, l.o_custkey, l.o_totalprice, r.o_orderstatus, r.o_orderpriority
FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus != 'P') l
JOIN (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
      WHERE o_orderstatus != 'P' AND o_orderpriority != '5-LOW') r
  ON l.o_orderkey = r.o_orderkey
"""


@register("join_using", JOIN_SQL)
def join_using(spark, sf_dir):
    s = staged_orders(spark, sf_dir)
    return lf.join_left_right(s, s, R)


@register("join_broadcast", JOIN_SQL)
def join_broadcast(spark, sf_dir):
    s = staged_orders(spark, sf_dir)
    return lf.join_left_right(s, s, R, replicated=True)


@register(
    "join_on_derived",
    """
    SELECT t1.o_orderkey, t1.o_custkey AS left_product, t1.o_totalprice AS left_account,
           t2.o_orderstatus, t2.o_orderpriority, t2.o_custkey AS right_product,
           t2.o_totalprice AS right_account
    FROM (SELECT * FROM orders WHERE o_orderstatus != 'P') t1
    JOIN (SELECT * FROM orders WHERE o_orderstatus != 'P' AND o_orderpriority != '5-LOW') t2
      ON t1.o_orderkey = t2.o_orderkey
    """,
)
def join_on_derived(spark, sf_dir):
    s = staged_orders(spark, sf_dir)
    return lf.sql_join(spark, s, s, R, left_view="orders_left", right_view="orders_right")


# --------------------------------------------------------------------------
# Aggregations
# --------------------------------------------------------------------------
@register(
    "avg_by_group",
    f"""
    SELECT o_orderpriority, {money_avg_sql("o_totalprice")} AS avg_totalprice
    FROM orders WHERE o_orderstatus != 'P' GROUP BY o_orderpriority
    """,
)
def avg_by_group(spark, sf_dir):
    return lf.average_by(staged_orders(spark, sf_dir), R.dept, R.account, "avg_totalprice", R.account_scale)


AVG_OVER_JOIN_SQL = f"""
SELECT r.o_orderpriority, {money_avg_sql("l.o_totalprice")} AS avg_totalprice
FROM (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus != 'P') l
JOIN (SELECT o_orderkey, o_orderpriority FROM orders
      WHERE o_orderstatus != 'P' AND o_orderpriority != '5-LOW') r
  ON l.o_orderkey = r.o_orderkey
GROUP BY r.o_orderpriority
"""


@register("avg_over_join", AVG_OVER_JOIN_SQL)
def avg_over_join(spark, sf_dir):
    s = staged_orders(spark, sf_dir)
    return lf.avg_account_by_dept(s, s, R, alias="avg_totalprice")


@register(
    "avg_sql",
    f"""
    SELECT o_custkey, {money_avg_sql("o_totalprice")} AS avg_totalprice
    FROM orders WHERE o_orderstatus != 'P' GROUP BY o_custkey
    """,
)
def avg_sql(spark, sf_dir):
    return lf.product_avg_sql(spark, staged_orders(spark, sf_dir), R, view="orders_great", alias="avg_totalprice")


@register("count_all", "SELECT COUNT(*) AS n FROM orders")
def count_all(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_count")
    return spark.sql("SELECT COUNT(*) AS n FROM orders_count")


@register(
    "count_groups",
    """
    SELECT COUNT(*) AS n_groups FROM (
      SELECT o_orderpriority FROM orders WHERE o_orderstatus != 'P' GROUP BY o_orderpriority)
    """,
)
def count_groups(spark, sf_dir):
    groups = lf.average_by(staged_orders(spark, sf_dir), R.dept, R.account, "avg_totalprice", R.account_scale)
    return groups.agg(F.count(F.lit(1)).alias("n_groups"))


# --------------------------------------------------------------------------
# Sorts and top-k (the limit is the feature; a unique key breaks ties)
# --------------------------------------------------------------------------
TOP_K = 100


@register(
    "sort_multi_topk",
    f"""
    SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice FROM orders
    WHERE o_orderstatus != 'P'
    ORDER BY o_orderstatus, o_orderdate, o_orderkey LIMIT {TOP_K}
    """,
)
def sort_multi_topk(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return (
        orders.select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
        .sort("o_orderstatus", "o_orderdate", "o_orderkey")
        .limit(TOP_K)
    )


@register(
    "sort_hidden_topk",
    f"""
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus != 'P'
    ORDER BY o_orderstatus, o_orderdate, o_orderkey LIMIT {TOP_K}
    """,
)
def sort_hidden_topk(spark, sf_dir):
    # o_orderdate is not in the projection; Spark resolves it below the select
    return lf.stage(table(spark, sf_dir, "orders"), R, sort=True).limit(TOP_K)


@register(
    "sort_single_topk",
    f"""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus != 'P'
    ORDER BY o_totalprice, o_orderkey LIMIT {TOP_K}
    """,
)
def sort_single_topk(spark, sf_dir):
    return (
        lf.left_side(staged_orders(spark, sf_dir), R).sort(R.account, R.key).limit(TOP_K)
    )


# --------------------------------------------------------------------------
# SQL surface and keyed-table DML
# --------------------------------------------------------------------------
@register(
    "view_sql",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'O'",
)
def view_sql(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    return spark.sql(
        "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders_view WHERE o_orderstatus = 'O'"
    )


@register("table_sql_project", "SELECT o_orderkey, o_orderstatus FROM orders")
def table_sql_project(spark, sf_dir):
    t = keyed(spark, "orders-sql", "o_orderkey")
    t.append(table(spark, sf_dir, "orders"))
    t.scan().createOrReplaceTempView("orders_keyed")
    return spark.sql("SELECT o_orderkey, o_orderstatus FROM orders_keyed")


@register(
    "update_where",
    f"""
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'O' THEN '{lf.UPDATE_TO_UNIT}' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders
    """,
)
def update_where(spark, sf_dir):
    t = keyed(spark, "orders-update", "o_orderkey")
    t.append(table(spark, sf_dir, "orders"))
    lf.update_unit(t, R, old="O")
    return t.scan()


# --------------------------------------------------------------------------
# Layout operators
# --------------------------------------------------------------------------
@register(
    "repartition_pre",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey, o_totalprice
    FROM orders WHERE o_orderstatus != 'P'
    """,
)
def repartition_pre(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return lf.stage(orders, R, repartition=partitions_for(spark, estimated_bytes(orders)))


@register(
    "repartition_post_sort",
    "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderkey != 2",
)
def repartition_post_sort(spark, sf_dir):
    # a round-robin repartition discards the order before it, so the sort is left out
    kept = table(spark, sf_dir, "orders").filter("o_orderkey != 2").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return kept.repartition(partitions_for(spark, estimated_bytes(kept)))


@register(
    "persist_reuse",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey, o_totalprice
    FROM orders WHERE o_orderstatus != 'P'
    UNION ALL
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey, o_totalprice
    FROM orders WHERE o_orderstatus != 'P'
    """,
)
def persist_reuse(spark, sf_dir):
    staged = persist_in_memory(staged_orders(spark, sf_dir))
    try:
        first = parquet.write_parquet(staged, scratch_path(spark, "staged-a"))
        second = parquet.write_parquet(staged, scratch_path(spark, "staged-b"))
    finally:
        staged.unpersist()
    return spark.read.parquet(first).unionByName(spark.read.parquet(second))


@register(
    "plan_measured",
    """
    SELECT CAST(depth AS INTEGER) AS depth, operator, pushed_filters, read_columns, output_rows
    FROM (SELECT count(*) AS all_rows, count_if(o_orderstatus != 'P') AS kept,
                 count(DISTINCT CASE WHEN o_orderstatus != 'P' THEN o_orderpriority END) AS groups FROM orders) t,
         LATERAL (VALUES (0, 'HashAggregate', NULL, NULL, groups), (1, 'Exchange', NULL, NULL, NULL),
                         (2, 'HashAggregate', NULL, NULL, NULL), (3, 'Project', NULL, NULL, NULL), (4, 'Filter', NULL, NULL, kept),
                         (5, 'Scan parquet', 'IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))',
                          'o_orderstatus,o_orderpriority', all_rows)) v(depth, operator, pushed_filters, read_columns, output_rows)
    """,
)
def plan_measured(spark, sf_dir):
    """The plan of a filtered count per group as rows, with the rows that its operators put out."""
    counted = table(spark, sf_dir, "orders").where("o_orderstatus != 'P'").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    found = plan_rows(counted, execute=True)
    # the partial aggregate has a row per group and task: its count depends on the cores
    fixed = F.when(F.col("depth") != 2, F.col("output_rows"))
    return found.select("depth", "operator", "pushed_filters", "read_columns", fixed.alias("output_rows"))


# --------------------------------------------------------------------------
# Classification
# --------------------------------------------------------------------------
RULE_SQL = """
SELECT AVG(CAST((CASE WHEN d.n_chars > 200 THEN 1.0 ELSE 0.0 END) = CAST(l.quality AS DOUBLE) AS DOUBLE))
  AS accuracy
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""


def _rule_scored(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labelled = table(spark, sf_dir, "labels").join(docs, "doc_id")
    return labelled.select(
        F.when(F.col("n_chars") > 200, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
        required_double(F.col("quality"), "quality").alias("label"),
    )


@register("accuracy_rule", RULE_SQL)
def accuracy_rule(spark, sf_dir):
    return ml.accuracy_frame(_rule_scored(spark, sf_dir)).select("accuracy")


@register("error_rule", f"SELECT 1.0 - accuracy AS test_error FROM ({RULE_SQL})")
def error_rule(spark, sf_dir):
    return ml.accuracy_frame(_rule_scored(spark, sf_dir)).select("test_error")


def tree_sql(rows: str, features: int, classes: int, depth: int) -> str:
    """SQL of the exact Gini tree on ``rows`` (``key``, ``label``, ``f0``, ...): level by level, all splits of all nodes.

    CTEs: ``t<depth>`` has the rows with their final ``node``, ``node_table`` the nodes.
    """
    ks = range(classes)
    counts = ", ".join(f"CAST(sum(CASE WHEN label = {k} THEN 1 ELSE 0 END) AS BIGINT) AS c{k}" for k in ks)
    gini = lambda name, n: "1.0 - (" + " + ".join(f"{name}{k} * {name}{k}" for k in ks) + f") / ({n} * {n})"
    out = [f"t0 AS (SELECT key, label, {', '.join(f'f{i}' for i in range(features))}, CAST(1 AS BIGINT) AS node FROM ({rows}))"]
    for d in range(depth):
        out.append(
            f"v{d} AS (" + " UNION ALL ".join(f"SELECT node, {i} AS f, f{i} AS x, label FROM t{d}" for i in range(features)) + ")"
        )
        out.append(f"g{d} AS (SELECT node, f, x, {counts} FROM v{d} GROUP BY node, f, x)")
        out.append(
            f"w{d} AS (SELECT node, f, x, lead(x) OVER o AS next_x, "
            + ", ".join(f"CAST(sum(c{k}) OVER o AS DOUBLE) AS l{k}, CAST(sum(c{k}) OVER p AS DOUBLE) AS a{k}" for k in ks)
            + f" FROM g{d} WINDOW o AS (PARTITION BY node, f ORDER BY x), p AS (PARTITION BY node, f))"
        )
        out.append(
            f"s{d} AS (SELECT *, {' + '.join(f'l{k}' for k in ks)} AS ln, {' + '.join(f'a{k}' for k in ks)} AS an FROM w{d} "
            "WHERE next_x IS NOT NULL)"
        )
        out.append(f"r{d} AS (SELECT *, an - ln AS rn, " + ", ".join(f"a{k} - l{k} AS r{k}" for k in ks) + f" FROM s{d})")
        out.append(
            f"b{d} AS (SELECT node, f, x, (x + next_x) / 2 AS threshold, "
            f"round({gini('a', 'an')} - ln / an * ({gini('l', 'ln')}) - rn / an * ({gini('r', 'rn')}), 12) AS gain FROM r{d} "
            "QUALIFY gain > 1e-12 AND row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, threshold) = 1)"
        )
        value = "CASE f " + " ".join(f"WHEN {i} THEN f{i}" for i in range(features)) + " END"
        out.append(
            f"t{d + 1} AS (SELECT t.* REPLACE (CASE WHEN b.node IS NULL THEN t.node WHEN {value} <= threshold THEN 2 * t.node "
            f"ELSE 2 * t.node + 1 END AS node) FROM t{d} t LEFT JOIN b{d} b USING (node))"
        )
    # a node that stays a leaf keeps its rows, so it appears at every later level
    out.append("place AS (" + " UNION ".join(f"SELECT node, key, label FROM t{d}" for d in range(depth + 1)) + ")")
    out.append("split AS (" + " UNION ".join(f"SELECT node, f, threshold, gain FROM b{d}" for d in range(depth)) + ")")
    array = "[" + ", ".join(f"CAST(sum(CASE WHEN label = {k} THEN 1 ELSE 0 END) AS BIGINT)" for k in ks) + "]"
    out.append(f"held AS (SELECT node, count(*) AS n_rows, {array} AS counts FROM place GROUP BY node)")
    out.append(
        "node_table AS (SELECT node, CAST(floor(log2(node) + 1e-9) AS INTEGER) AS depth, CAST(f AS INTEGER) AS feature, threshold, gain, "
        "CASE WHEN f IS NOT NULL THEN 2 * node END AS left_node, CASE WHEN f IS NOT NULL THEN 2 * node + 1 END AS right_node, "
        "n_rows AS rows, counts, CAST(list_position(counts, list_max(counts)) - 1 AS DOUBLE) AS prediction "
        "FROM held LEFT JOIN split USING (node))"
    )
    out.append(f"scored AS (SELECT key, label, prediction FROM t{depth} JOIN node_table USING (node))")
    return "WITH " + ",\n".join(out) + "\n"


LABELLED_SQL = """
SELECT doc_id AS key, CAST(quality AS DOUBLE) AS label, CAST(least(n_chars // 500, 20) AS DOUBLE) AS f0,
       CAST(coalesce(toxic, 0) AS DOUBLE) AS f1
FROM labels JOIN documents USING (doc_id)
"""
TREE_SQL = tree_sql(LABELLED_SQL, features=2, classes=2, depth=1)
ACCURACY_SQL = """
SELECT avg(CAST(label = prediction AS DOUBLE)) AS accuracy, 1.0 - avg(CAST(label = prediction AS DOUBLE)) AS test_error
FROM scored
"""


def _tree_scored(spark, sf_dir) -> DataFrame:
    """Rows scored by a tree of one split: a banded length and the toxicity mark, few distinct values each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.least(F.expr("n_chars DIV 500"), F.lit(20)).alias("band"))
    labelled = table(spark, sf_dir, "labels").join(docs, "doc_id")
    features = ml.feature_table(labelled, required=["band"], default_zero=["toxic"], label="quality",
                                keep=["doc_id"], assemble=False)
    # the fit reads its input several times: the join is computed once
    train = ml.assemble_features(parquet.read_parquet(spark, parquet.write_parquet(features, scratch_path(spark, "tree-rows"))))
    return ml.fit_tree(train, max_depth=1, min_info_gain=0.0).transform(train)


@register("tree_fit_predict", TREE_SQL + "SELECT key AS doc_id, label, prediction FROM scored")
def tree_fit_predict(spark, sf_dir):
    return _tree_scored(spark, sf_dir).select("doc_id", "label", "prediction")


@register("tree_accuracy", TREE_SQL + ACCURACY_SQL)
def tree_accuracy(spark, sf_dir):
    return ml.accuracy_frame(_tree_scored(spark, sf_dir))


# the passenger tree: depth 5 on features by position, each with about as many values as rows, five classes
PASSENGER_TREE_SQL = tree_sql(
    f"""SELECT o_orderkey AS key, CAST(n_regionkey AS DOUBLE) AS label, CAST(o_orderkey AS DOUBLE) AS f0,
               CAST(o_totalprice AS DOUBLE) AS f1, CAST(coalesce(c_acctbal, 0) AS DOUBLE) AS f2
        FROM ({PASSENGER_SQL})""",
    features=3, classes=5, depth=5,
)


def _passenger_tree(spark, sf_dir):
    """(training rows, tree) of the passenger collection, keyed by position."""
    cells = passenger.keyed_collection(passenger_rows(spark, sf_dir), order_by=[F.col("o_orderkey").cast("long")])
    train = passenger.positional_features(cells, required=(0, 3), default_zero=(9,), label=13)
    return train, ml.fit_tree(train, max_depth=5)


@register("passenger_tree", PASSENGER_TREE_SQL + "SELECT CAST(key AS DOUBLE) AS order_key, label, prediction FROM scored")
def passenger_tree(spark, sf_dir):
    train, model = _passenger_tree(spark, sf_dir)
    return model.transform(train).select(vector_to_array("features")[0].alias("order_key"), "label", "prediction")


@register("passenger_tree_accuracy", PASSENGER_TREE_SQL + ACCURACY_SQL)
def passenger_tree_accuracy(spark, sf_dir):
    train, model = _passenger_tree(spark, sf_dir)
    return ml.accuracy_frame(model.transform(train))


@register("passenger_tree_nodes", PASSENGER_TREE_SQL + "SELECT * REPLACE (array_to_string(counts, ',') AS counts) FROM node_table")
def passenger_tree_nodes(spark, sf_dir):
    """The fitted tree as rows: conditions, class counts and predictions of all nodes."""
    _, model = _passenger_tree(spark, sf_dir)
    return ml.model_rows(model, spark).withColumn("counts", F.array_join("counts", ","))


# --------------------------------------------------------------------------
# The ledger workload end to end (ledger rows derived from the order keys)
# --------------------------------------------------------------------------
# The ledger tables are bucketed on the key, in as many buckets as their input
# needs (at least one per core): joins and appends between them
# need no shuffle.
def _ledger_tables(spark, sf_dir, replicated: bool = False) -> lf.LeftRight:
    source = ledger_source(spark, sf_dir)
    return lf.load_left_right(spark, lf.stage(source, lf.LEDGER), scratch_path(spark, "ledger"), lf.LEDGER,
                              buckets=buckets_for(spark, estimated_bytes(source)), replicated=replicated)


LEDGER_DEPT_AVG_SQL = f"""
SELECT DEPTID, AVG(ACCOUNT) AS avg_account
FROM ({LEDGER_STAGED_SQL}) WHERE DEPTID != 'DEPTID2' GROUP BY DEPTID
"""


@register("ledger_join_avg", LEDGER_DEPT_AVG_SQL)
def ledger_join_avg(spark, sf_dir):
    tables = _ledger_tables(spark, sf_dir)
    return lf.avg_account_by_dept(tables.left.scan(), tables.right.scan(), lf.LEDGER)


@register("ledger_join_replicated", LEDGER_DEPT_AVG_SQL)
def ledger_join_replicated(spark, sf_dir):
    # both tables created with the replicated layout: their scans are
    # broadcast-hinted while measured small, bucketed joins beyond that
    tables = _ledger_tables(spark, sf_dir, replicated=True)
    return lf.avg_account_by_dept(tables.left.scan(), tables.right.scan(), lf.LEDGER)


@register("ledger_group_avg", LEDGER_DEPT_AVG_SQL)
def ledger_group_avg(spark, sf_dir):
    tables = _ledger_tables(spark, sf_dir)
    return lf.right_filtered_avg(tables.right.scan(), lf.LEDGER)


@register(
    "ledger_sql_join",
    f"""
    SELECT t1.id, t1.PRODUCT AS left_product, t1.ACCOUNT AS left_account,
           t2.BUSINESS_UNIT, t2.DEPTID, t2.PRODUCT AS right_product, t2.ACCOUNT AS right_account
    FROM ({LEDGER_STAGED_SQL}) t1
    JOIN ({LEDGER_STAGED_SQL}) t2 ON t1.id = t2.id
    WHERE t2.DEPTID IS NOT NULL AND NOT t2.DEPTID = 'DEPTID2'
    """,
)
def ledger_sql_join(spark, sf_dir):
    tables = _ledger_tables(spark, sf_dir)
    return lf.sql_join(spark, tables.left.scan(), tables.right.scan(), lf.LEDGER)


@register(
    "ledger_product_avg",
    f"""
    SELECT PRODUCT, AVG(ACCOUNT) AS avg_account
    FROM ({LEDGER_STAGED_SQL}) GROUP BY PRODUCT
    """,
)
def ledger_product_avg(spark, sf_dir):
    tables = _ledger_tables(spark, sf_dir)
    return lf.product_avg_sql(spark, tables.right.scan(), lf.LEDGER)


@register(
    "ledger_update",
    f"""
    SELECT id, '{lf.UPDATE_TO_UNIT}' AS BUSINESS_UNIT, DEPTID, PRODUCT, ACCOUNT
    FROM ({LEDGER_STAGED_SQL}) WHERE BUSINESS_UNIT = '{lf.UPDATE_FROM_UNIT}'
    """,
)
def ledger_update(spark, sf_dir):
    tables = _ledger_tables(spark, sf_dir)
    lf.update_unit(tables.right)
    return tables.right.scan().filter(F.col("BUSINESS_UNIT") == lf.UPDATE_TO_UNIT)


@register("ledger_bucketed_append", LEDGER_STAGED_SQL)
def ledger_bucketed_append(spark, sf_dir):
    # two overlapping batches into a bucketed table: the second append's anti
    # join shuffles only the batch, into the stored buckets
    source = ledger_source(spark, sf_dir)
    t = KeyedTable(spark, scratch_path(spark, "ledger-bucketed"), "id", buckets=buckets_for(spark, estimated_bytes(source)))
    t.append(lf.stage(source.where(F.col("DEPTID") == "DEPTID3")))
    t.append(lf.stage(source))
    return t.scan()


@register(
    "ledger_large_table",
    f"""
    SELECT 'keyed_table' AS source, COUNT(*) AS n_rows FROM ({LEDGER_SQL}) WHERE id != 2
    UNION ALL
    SELECT 'parquet' AS source, COUNT(*) AS n_rows FROM ({LEDGER_SQL}) WHERE id != 2
    """,
)
def ledger_large_table(spark, sf_dir):
    return lf.large_table_flow(spark, ledger_source(spark, sf_dir), scratch_path(spark, "ledger-large"))

"""Every operator applied to the TPC-H-like tables, each query beside the SQL that gives its result.

Inputs with quirks (text columns, mixed-type JSON, nested records, log lines) are derived from whole
tables: quirks hang on column values, so they grow with the data. Queries about sinks and loads write
below the shared folder, in a database of their own, and read back what they wrote.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.functions import money_sum, parse_double, parse_log, strict_double, to_cents
from tablewright.operators import (
    apply_mapping,
    daily_engagement_kpis,
    enrich,
    latest_per_key,
    preview,
    relationalize,
    resolve_choice,
    schema_report,
    split_rejects,
    stringify,
    summarize,
    unmatched,
    with_counters,
)
from tablewright.operators.choice import value_class
from tablewright.names import sql_text
from tablewright.plans.inventory import inventory_report, table_inventory
from tablewright.plans.jobs import export_tables, fan_out
from tablewright.plans.maintenance import compact_table, table_files
from tablewright.plans.programs import SERVICE_LOG_PATTERN, clicks_from_records
from tablewright.session import fresh_path
from tablewright.sources import (
    create_table,
    drop_table,
    insert_select,
    read_csv_text,
    read_json_records,
    read_keyed,
    read_log,
    read_table,
    rebucket_keyed,
    register_log,
    register_path,
    upsert_keyed,
    write_counted,
    write_parquet,
    write_relationalized,
    write_table,
)
from tablewright.streaming import incremental_load, read_loaded, reset_bookmark, store_load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        if sql:
            SQL[name or function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scratch(spark: SparkSession) -> tuple[str, str]:
    """A database of its own and a folder for its tables."""
    path, db = fresh_path(spark, "queries"), f"q_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION {sql_text(f'{path}/db')}")
    return db, path


# Orders as a raw text table: blanks in the names, unreadable and empty totals, a comma in a status.

# Raw order columns and what they become.
RAW_SCHEMA = "`order id` string, `cust id` string, `order total` string, `order date` string, status string"
# The mapping of those columns.
MAPPING = [
    ("order id", "string", "order_id", "bigint"),
    ("cust id", "string", "customer_id", "string"),
    ("order total", "string", "order_total", "double"),
    ("order date", "string", "order_date", "string"),
    ("status", "string", "status", "string"),
]


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    total = (
        F.when(priority == "4-NOT SPECIFIED", "n/a")
        .when(priority == "5-LOW", "")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order id"),
        F.col("o_custkey").cast("string").alias("cust id"),
        total.alias("order total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order date"),
        F.when(status == "F", "shipped").when(status == "O", "shipped, partial").otherwise("pending").alias("status"),
    )


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_mapping(_raw_orders(spark, sf_dir), MAPPING)


RAW = """
WITH raw AS (
  SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a' WHEN o_orderpriority = '5-LOW' THEN '' END AS odd_total,
    CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL ELSE o_totalprice END AS order_total,
    strftime(o_orderdate, '%Y-%m-%d') AS order_date,
    CASE o_orderstatus WHEN 'F' THEN 'shipped' WHEN 'O' THEN 'shipped, partial' ELSE 'pending' END AS status
  FROM orders)
"""
MAPPED = "SELECT order_id, customer_id, order_total, order_date, status FROM raw"
TOTAL = "round(sum(order_total), 2)"


@query(RAW + MAPPED)
def apply_mapping_orders(spark, sf_dir):
    return _mapped(spark, sf_dir)


@query(RAW + f"SELECT status, count(*) AS n, {TOTAL} AS total FROM raw GROUP BY status ORDER BY n DESC, status")
def status_summary(spark, sf_dir):
    measures = {"n": F.count("*"), "total": money_sum("order_total")}
    return summarize(_mapped(spark, sf_dir), "status", measures, [F.desc("n"), "status"])


@query(RAW + "SELECT order_id, order_total FROM raw WHERE status = 'shipped' AND order_total > 100000")
def filter_exact(spark, sf_dir):
    orders = _mapped(spark, sf_dir).filter((F.col("status") == "shipped") & (F.col("order_total") > 100000))
    return orders.select("order_id", "order_total")


@query(RAW + "SELECT count(*) AS n, count(*) FILTER (status = 'shipped') AS shipped, count(order_total) AS totals FROM raw")
def order_counts(spark, sf_dir):
    shipped = F.count_if(F.col("status") == "shipped")
    return _mapped(spark, sf_dir).agg(
        F.count("*").alias("n"), shipped.alias("shipped"), F.count("order_total").alias("totals")
    )


@query(
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, "
    "c_mktsegment FROM customer"
)
def stringify_keys(spark, sf_dir):
    return stringify(_table(spark, sf_dir, "customer"), ["c_custkey", "c_nationkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def preview_largest_orders(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return preview(orders, 20, [F.desc("o_totalprice"), "o_orderkey"])


# Events as records with a mixed-type field: a number, text that is a number, a word, a fraction, null.

def _points_text() -> Column:
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    return (
        F.when(kind == "click", user)
        .when(kind == "view", F.concat(F.lit('"'), user, F.lit('"')))
        .when(kind == "signup", F.lit('"gold"'))
        .when(kind == "purchase", F.col("value").cast("string"))
        .otherwise(F.lit("null"))
    )


def _choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", F.parse_json(_points_text()).alias("points"))


LONG = "CASE WHEN event_type = 'click' THEN user_id END"
DOUBLE = "CASE WHEN event_type = 'purchase' THEN value END"
STRING = "CASE event_type WHEN 'view' THEN CAST(user_id AS VARCHAR) WHEN 'signup' THEN 'gold' END"
KINDS = {"points": ["long", "double", "string"]}


@query(
    "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN user_id "
    "WHEN event_type = 'purchase' THEN CAST(trunc(value) AS BIGINT) END AS points FROM events"
)
def choice_cast_long(spark, sf_dir):
    return resolve_choice(_choices(spark, sf_dir), specs=[("points", "cast:long")])


@query(
    f"SELECT event_id, CASE WHEN event_type = 'purchase' THEN regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') "
    f"WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) ELSE {STRING} END AS points FROM events"
)
def choice_cast_string(spark, sf_dir):
    return resolve_choice(_choices(spark, sf_dir), specs=[("points", "cast:string")])


@query(f"SELECT event_id, {LONG} AS points_long, {DOUBLE} AS points_double, {STRING} AS points_string FROM events")
def choice_make_cols(spark, sf_dir):
    return resolve_choice(_choices(spark, sf_dir), specs=[("points", "make_cols")])


@query(f'SELECT event_id, {LONG} AS "long", {DOUBLE} AS "double", {STRING} AS "string" FROM events')
def choice_make_struct(spark, sf_dir):
    struct = resolve_choice(_choices(spark, sf_dir), specs=[("points", "make_struct")], types=KINDS)
    return struct.select("event_id", "points.*")


@query(
    f"SELECT event_id, {LONG} AS points_long, {DOUBLE} AS points_double, {STRING} AS points_string, "
    "CASE WHEN event_type = 'error' THEN value > 10 END AS mark_boolean, "
    "CASE WHEN event_type <> 'error' THEN event_type END AS mark_string, event_type AS kind FROM events"
)
def choice_make_struct_all(spark, sf_dir):
    kind = F.col("event_type")
    mark = F.when(kind == "error", (F.col("value") > 10).cast("string")).otherwise(F.concat(F.lit('"'), kind, F.lit('"')))
    text = F.format_string(
        '{"event_id": %d, "points": %s, "mark": %s, "kind": "%s"}', F.col("event_id"), _points_text(), mark, kind
    )
    path = fresh_path(spark, "records")
    _table(spark, sf_dir, "events").select(text).write.text(path)
    out = resolve_choice(read_json_records(spark, path), choice="make_struct")
    branches = {"points": ("long", "double", "string"), "mark": ("boolean", "string")}
    flat = [F.col(f"{c}.{b}").alias(f"{c}_{b}") for c, names in branches.items() for b in names]
    return out.select("event_id", *flat, "kind")


@query(f"SELECT event_id, {LONG} AS points FROM events")
def choice_project_long(spark, sf_dir):
    return resolve_choice(_choices(spark, sf_dir), specs=[("points", "project:long")])


@query(
    "SELECT CASE event_type WHEN 'click' THEN 'long' WHEN 'purchase' THEN 'double' WHEN 'error' THEN 'none' "
    "ELSE 'string' END AS class, count(*) AS n FROM events GROUP BY 1"
)
def choice_classes(spark, sf_dir):
    kinds = _choices(spark, sf_dir).select(F.coalesce(value_class(F.col("points")), F.lit("none")).alias("class"))
    return summarize(kinds, "class")


# Orders as nested records: a struct, an array of structs that may be empty or missing, arrays in those.

def _nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    def mark(condition: Column, kind: str, value: Column) -> Column:
        return F.when(condition, F.struct(F.lit(kind).alias("type"), value.alias("value"), F.split(value, "-").alias("words")))

    priority, status, total = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    marks = F.array_compact(
        F.array(
            mark(priority != "5-LOW", "priority", priority),
            mark(status == "F", "status", F.lit("final")),
            mark(total > 250000, "size", F.lit("very-large-order")),
        )
    )
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.struct(F.col("o_custkey").alias("id"), F.struct(F.year("o_orderdate").alias("year")).alias("since")).alias("customer"),
        F.when(priority != "3-MEDIUM", marks).alias("marks"),
    )


# The elements of the array above, by position.
MARKS = """
WITH marked AS (
  SELECT o_orderkey AS order_id, o_custkey, o_orderdate, o_orderpriority,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 0 ELSE CAST(o_orderpriority <> '5-LOW' AS INTEGER) END AS p,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 0 ELSE CAST(o_orderstatus = 'F' AS INTEGER) END AS s,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 0 ELSE CAST(o_totalprice > 250000 AS INTEGER) END AS t
  FROM orders),
child AS (
  SELECT order_id, 0 AS "index", 'priority' AS type, o_orderpriority AS value FROM marked WHERE p = 1
  UNION ALL SELECT order_id, p, 'status', 'final' FROM marked WHERE s = 1
  UNION ALL SELECT order_id, p + s, 'size', 'very-large-order' FROM marked WHERE t = 1),
words AS (SELECT order_id, "index" AS marks_index, string_split(value, '-') AS parts FROM child),
grandchild AS (
  SELECT order_id, marks_index, i AS "index", parts[i + 1] AS value
  FROM words, (SELECT unnest([0, 1, 2]) AS i) WHERE i < len(parts))
"""


@query(
    MARKS + "SELECT order_id, o_custkey AS customer_id, CAST(year(o_orderdate) AS INTEGER) AS customer_since_year, "
    "CASE WHEN o_orderpriority <> '3-MEDIUM' THEN p + s + t END AS marks_size FROM marked"
)
def relationalize_root(spark, sf_dir):
    return relationalize(_nested_orders(spark, sf_dir), "orders", "order_id")["orders"]


@query(
    MARKS + 'SELECT order_id, CAST("index" AS INTEGER) AS "index", type, value, '
    "CAST(len(string_split(value, '-')) AS INTEGER) AS words_size FROM child"
)
def relationalize_child(spark, sf_dir):
    return relationalize(_nested_orders(spark, sf_dir), "orders", "order_id")["orders_marks"]


@query(
    MARKS + 'SELECT order_id, CAST(marks_index AS INTEGER) AS marks_index, CAST("index" AS INTEGER) AS "index", value '
    "FROM grandchild"
)
def relationalize_grandchild(spark, sf_dir):
    return relationalize(_nested_orders(spark, sf_dir), "orders", "order_id")["orders_marks_words"]


@query(MARKS + 'SELECT order_id, o_custkey AS customer_id, c."index", c.type FROM marked JOIN child c USING (order_id)')
def relationalize_generated_link(spark, sf_dir):
    frames = relationalize(_nested_orders(spark, sf_dir), "orders")
    joined = frames["orders"].join(frames["orders_marks"], "orders_id")
    return joined.select("order_id", "customer_id", "index", "type")


@query(
    MARKS + "SELECT 'orders_root' AS table_name, count(*) AS n FROM marked UNION ALL SELECT 'orders_marks', count(*) FROM child "
    "UNION ALL SELECT 'orders_marks_words', count(*) FROM grandchild"
)
def relationalize_to_tables(spark, sf_dir):
    db, path = _scratch(spark)
    names = write_relationalized(_nested_orders(spark, sf_dir), "orders", db, path, "order_id", {"orders": "orders_root"})
    counts = [
        read_table(spark, db, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n")) for name in names
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# Latest row per key, enrichment, keys without a partner.

LATEST = """
WITH latest AS (
  SELECT * FROM (
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1)
"""


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"])


@query(LATEST + "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM latest")
def latest_order_per_customer(spark, sf_dir):
    return _latest(spark, sf_dir)


@query(
    LATEST + "SELECT o_custkey, o_orderkey, o_totalprice, c_name, n_name AS nation FROM latest "
    "LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey"
)
def enrich_latest(spark, sf_dir):
    customers = _table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    nations = _table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    latest = enrich(_latest(spark, sf_dir), customers, "o_custkey", ["c_name", "c_nationkey"])
    out = enrich(latest, nations, "c_nationkey", [("n_name", "nation")])
    return out.select("o_custkey", "o_orderkey", "o_totalprice", "c_name", "nation")


@query(
    "SELECT key, c_name FROM (SELECT c_custkey AS key, c_name FROM customer UNION ALL SELECT -c_custkey, c_name FROM customer) "
    "WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = key)"
)
def customers_without_orders(spark, sf_dir):
    """Every customer has orders in these tables; each stands for a second one without, too."""
    customers = _table(spark, sf_dir, "customer")
    both = customers.selectExpr("c_custkey AS key", "c_name").unionByName(customers.selectExpr("-c_custkey AS key", "c_name"))
    return unmatched(both, _table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "key"), "key")


def _nation_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers, some with a nation that isn't there; nations by key, some without customers."""
    customers = _table(spark, sf_dir, "customer").selectExpr("c_custkey", "if(c_custkey % 3 = 0, -c_nationkey - 1, c_nationkey) AS key")
    nations = _table(spark, sf_dir, "nation").selectExpr("n_nationkey AS key", "n_name")
    return customers, nations.unionByName(nations.selectExpr("key + 100 AS key", "n_name"))


NATION_SIDES = """
WITH l AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN -c_nationkey - 1 ELSE c_nationkey END AS key FROM customer),
r AS (SELECT n_nationkey AS key, n_name FROM nation UNION ALL SELECT n_nationkey + 100, n_name FROM nation)
"""


@query(NATION_SIDES + "SELECT key, c_custkey, n_name FROM l JOIN r USING (key)")
def enrich_inner(spark, sf_dir):
    left, right = _nation_sides(spark, sf_dir)
    return enrich(left, right, "key", ["n_name"], how="inner").select("key", "c_custkey", "n_name")


@query(NATION_SIDES + "SELECT key, c_custkey, n_name FROM l RIGHT JOIN r USING (key)")
def enrich_right(spark, sf_dir):
    left, right = _nation_sides(spark, sf_dir)
    return enrich(left, right, "key", ["n_name"], how="right").select("key", "c_custkey", "n_name")


@query(NATION_SIDES + "SELECT key, c_custkey, n_name FROM l FULL JOIN r USING (key)")
def enrich_full(spark, sf_dir):
    left, right = _nation_sides(spark, sf_dir)
    return enrich(left, right, "key", ["n_name"], how="full").select("key", "c_custkey", "n_name")


@query(
    "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem "
    "GROUP BY l_returnflag, l_linestatus"
)
def lineitem_summary(spark, sf_dir):
    measures = {"n": F.count("*"), "total": money_sum("l_extendedprice")}
    return summarize(_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], measures)


@query(
    "SELECT l_orderkey, l_linenumber, key, p_name FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS key "
    "FROM lineitem) LEFT JOIN part ON p_partkey = key"
)
def enrich_skewed_lineitem(spark, sf_dir):
    """A third of the order lines name the same part."""
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "if(l_orderkey % 3 = 0, 1, l_partkey) AS key"
    )
    parts = _table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "key")
    return enrich(lines, parts, "key", ["p_name"])


@query(
    RAW + "SELECT 'order_id' AS column_name, 'bigint' AS type, count(order_id) AS filled FROM raw UNION ALL "
    "SELECT 'customer_id', 'string', count(customer_id) FROM raw UNION ALL SELECT 'order_total', 'double', count(order_total) FROM raw "
    "UNION ALL SELECT 'order_date', 'string', count(order_date) FROM raw UNION ALL SELECT 'status', 'string', count(status) FROM raw",
    name="schema_report",
)
def columns_with_values(spark, sf_dir):
    """The schema report, with the number of values that each column has."""
    orders = _mapped(spark, sf_dir)
    filled = orders.agg(*(F.count(c).alias(c) for c in orders.columns)).unpivot([], orders.columns, "column_name", "filled")
    return schema_report(orders).select("column_name", "type").join(filled, "column_name")


@query(
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders "
    "WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')"
)
def customers_without_urgent_orders(spark, sf_dir):
    urgent = _table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return unmatched(customers, urgent.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query(
    "SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey "
    "AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'"
)
def enrich_keeping_unmatched(spark, sf_dir):
    urgent = _table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return enrich(customers, urgent.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", ["o_orderkey"])


# Sinks and scans.

YEARLY = "SELECT order_id, customer_id, order_total, order_date, status, substr(order_date, 1, 4) AS order_year FROM raw"


def _yearly(df: DataFrame) -> DataFrame:
    return df.withColumn("order_year", F.substring("order_date", 1, 4))


@query(RAW + YEARLY)
def table_partitioned(spark, sf_dir):
    db, path = _scratch(spark)
    write_table(_yearly(_mapped(spark, sf_dir)), db, "orders", f"{path}/orders", ["order_year"])
    return read_table(spark, db, "orders")


@query(RAW + f"SELECT * FROM ({YEARLY}) WHERE order_year = '1997'")
def table_partition_pruned(spark, sf_dir):
    return table_partitioned(spark, sf_dir).filter("order_year = '1997'")


@query(RAW + MAPPED)
def table_plain(spark, sf_dir):
    db, path = _scratch(spark)
    write_table(_mapped(spark, sf_dir), db, "orders", f"{path}/orders")
    return read_table(spark, db, "orders")


@query(
    RAW + "SELECT order_id, order_total, NULL AS status FROM raw UNION ALL SELECT order_id, order_total, status FROM raw"
)
def table_new_column(spark, sf_dir):
    db, path = _scratch(spark)
    orders = _mapped(spark, sf_dir)
    write_table(orders.select("order_id", "order_total"), db, "orders", f"{path}/orders")
    write_table(orders.select("order_id", "order_total", "status"), db, "orders", f"{path}/orders")
    return read_table(spark, db, "orders")


@query(RAW + MAPPED)
def parquet_overwrite(spark, sf_dir):
    path = fresh_path(spark, "parquet")
    orders = _mapped(spark, sf_dir)
    write_parquet(orders.filter("order_total IS NULL"), path)
    write_parquet(orders, path)
    return spark.read.parquet(path)


MANAGED = "order_id bigint, customer_id string, order_total double, order_date string, status string"


@query(RAW + f"{MAPPED} UNION ALL {MAPPED}", name="insert_select")
def insert_select_twice(spark, sf_dir):
    db, path = _scratch(spark)
    create_table(spark, db, "orders", MANAGED, f"{path}/orders", {"made by": "insert_select_twice"})
    for _ in range(2):
        insert_select(_mapped(spark, sf_dir), db, "orders")
    return read_table(spark, db, "orders")


@query(RAW + "SELECT status, count(*) AS n FROM raw GROUP BY status")
def insert_overwrite_summary(spark, sf_dir):
    db, path = _scratch(spark)
    create_table(spark, db, "orders", MANAGED, f"{path}/orders")
    for _ in range(2):
        insert_select(_mapped(spark, sf_dir), db, "orders", overwrite=True)
    return summarize(read_table(spark, db, "orders"), "status")


@query(RAW + "SELECT 'kept' AS table_name, count(*) AS n FROM raw UNION ALL SELECT 'purged', 0", name="drop_table")
def dropped_tables(spark, sf_dir):
    """Rows that are still under the folder of a dropped and of a purged table."""
    db, path = _scratch(spark)
    for name, purge in (("kept", False), ("purged", True)):
        write_table(_mapped(spark, sf_dir), db, name, f"{path}/{name}")
        drop_table(spark, db, name, purge)
        register_path(spark, db, name, f"{path}/{name}", "parquet")
    kept, purged = (
        read_table(spark, db, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        for name in ("kept", "purged")
    )
    return kept.unionByName(purged)


@query("SELECT c_custkey, c_name, c_mktsegment AS segment, n_name AS nation FROM customer JOIN nation ON n_nationkey = c_nationkey")
def json_path_scan(spark, sf_dir):
    nations = _table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customers = enrich(_table(spark, sf_dir, "customer"), nations, "c_nationkey", ["n_name"])
    nested = customers.select(
        "c_custkey", F.struct("c_name", F.struct("c_mktsegment", "n_name").alias("place")).alias("who")
    )
    path = fresh_path(spark, "json")
    nested.write.json(path)
    who = read_json_records(spark, path)
    return who.select(
        "c_custkey",
        "who.c_name",
        F.col("who.place.c_mktsegment").alias("segment"),
        F.col("who.place.n_name").alias("nation"),
    )


@query(
    RAW + "SELECT CAST(order_id AS VARCHAR) AS order_id, nullif(odd_total, '') AS odd_total, order_total, status FROM raw"
)
def csv_text_scan(spark, sf_dir):
    path = fresh_path(spark, "csv")
    _raw_orders(spark, sf_dir).write.option("header", True).option("emptyValue", "").csv(path)
    raw = read_csv_text(spark, path)
    total = F.col("order total")
    return raw.select(
        F.col("order id").alias("order_id"),
        F.when(parse_double(total).isNull(), total).alias("odd_total"),
        parse_double(total).alias("order_total"),
        "status",
    )


@query(
    "SELECT c_custkey, c_name, c_acctbal, c_nationkey, c_mktsegment FROM customer"
)
def registered_table_scan(spark, sf_dir):
    db, path = _scratch(spark)
    write_parquet(_table(spark, sf_dir, "customer"), f"{path}/customers", partition_by=["c_mktsegment"])
    register_path(spark, db, "customers", f"{path}/customers", "parquet")
    return read_table(spark, db, "customers")


# Incremental loads and the keyed table.

def _early(df: DataFrame) -> Column:
    return F.col("order date") < "1998-07-01"


def _load(spark: SparkSession, db: str, path: str, ctx: str | None, transform: Callable[[DataFrame], DataFrame] | None = None) -> int:
    usual = lambda batch: _yearly(apply_mapping(batch, MAPPING))
    return incremental_load(
        spark, f"{path}/in", RAW_SCHEMA, transform or usual, db, "orders",
        job="orders", ctx=ctx, state_root=f"{path}/state", path=f"{path}/orders", partition_by=["order_year"],
    )


def _arrive(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(f"{path}/in")


@query(RAW + YEARLY)
def incremental_two_loads(spark, sf_dir):
    db, path = _scratch(spark)
    raw = _raw_orders(spark, sf_dir)
    _arrive(raw.filter(_early(raw)), path)
    _load(spark, db, path, "in")
    _arrive(raw.filter(~_early(raw)), path)
    _load(spark, db, path, "in")
    _load(spark, db, path, "in")
    return read_loaded(spark, db, "orders")


@query(RAW + YEARLY)
def incremental_reordered_columns(spark, sf_dir):
    """The second arrival has its columns in another order, and one more."""
    db, path = _scratch(spark)
    raw = _raw_orders(spark, sf_dir)
    _arrive(raw.filter(_early(raw)), path)
    _load(spark, db, path, "in")
    late = raw.filter(~_early(raw)).withColumn("note", F.lit("late"))
    _arrive(late.select("status", "note", "order total", "order id", "order date", "cust id"), path)
    _load(spark, db, path, "in")
    return read_loaded(spark, db, "orders")


@query(RAW + f"{YEARLY} UNION ALL {YEARLY}")
def batch_then_incremental(spark, sf_dir):
    """The batch job and the incremental job fill one table."""
    db, path = _scratch(spark)
    store_load(_yearly(_mapped(spark, sf_dir)), db, "orders", f"{path}/orders", ["order_year"], "batch")
    _arrive(_raw_orders(spark, sf_dir), path)
    _load(spark, db, path, "in")
    return read_loaded(spark, db, "orders")


@query(RAW + YEARLY)
def incremental_failed_then_replayed(spark, sf_dir):
    """A load that fails on some row is done again; its rows are there once."""
    db, path = _scratch(spark)
    raw = _raw_orders(spark, sf_dir)
    _arrive(raw, path)

    def dies(batch: DataFrame) -> DataFrame:
        failure = F.raise_error(F.lit("lost")).cast("string")
        return _yearly(apply_mapping(batch, MAPPING)).withColumn("status", F.when(F.col("status") == "pending", failure).otherwise(F.col("status")))

    with contextlib.suppress(PySparkException):
        _load(spark, db, path, "in", dies)
    _load(spark, db, path, "in")
    return read_loaded(spark, db, "orders")


@query(RAW + f"{YEARLY} UNION ALL {YEARLY}")
def incremental_reset(spark, sf_dir):
    db, path = _scratch(spark)
    _arrive(_raw_orders(spark, sf_dir), path)
    _load(spark, db, path, "in")
    reset_bookmark(spark, "orders", "in", f"{path}/state")
    _load(spark, db, path, "in")
    return read_loaded(spark, db, "orders")


@query(RAW + f"{YEARLY} UNION ALL {YEARLY}")
def incremental_without_context(spark, sf_dir):
    db, path = _scratch(spark)
    _arrive(_raw_orders(spark, sf_dir), path)
    for _ in range(2):
        _load(spark, db, path, None)
    return read_loaded(spark, db, "orders")


@query(
    RAW + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS rn FROM raw) "
    "SELECT customer_id, CAST(order_id AS VARCHAR) AS order_id, order_date, "
    "CASE WHEN order_date >= '1998-07-01' THEN status END AS status FROM ranked WHERE rn = 1"
)
def keyed_upsert(spark, sf_dir):
    """Two batches of which only the second knows the attribute status."""
    db, path = _scratch(spark)
    orders = _mapped(spark, sf_dir).select("customer_id", "order_id", "order_date", "status")
    early = F.col("order_date") < "1998-07-01"
    for batch in (orders.filter(early).drop("status"), orders.filter(~early)):
        latest = latest_per_key(batch, "customer_id", ["order_date", "order_id"])
        upsert_keyed(stringify(latest), db, "latest_orders", "customer_id", f"{path}/latest")
    return read_keyed(spark, db, "latest_orders").select("customer_id", "order_id", "order_date", "status")


# Numbers from text, rejects, counters.

@query(RAW + "SELECT order_id, order_total * 100.0 AS cents FROM raw WHERE status = 'shipped'", name="to_cents")
def to_cents_shipped(spark, sf_dir):
    shipped = _raw_orders(spark, sf_dir).filter(F.col("status") == "shipped")
    return shipped.select(F.col("order id").cast("bigint").alias("order_id"), to_cents("order total").alias("cents"))


@query(RAW + "SELECT order_id, coalesce(order_total, 0.0) AS total FROM raw WHERE coalesce(odd_total, '') <> 'n/a'")
def strict_total(spark, sf_dir):
    readable = _raw_orders(spark, sf_dir).filter(F.col("order total") != "n/a")
    return readable.select(F.col("order id").cast("bigint").alias("order_id"), strict_double("order total").alias("total"))


RULES = {"order total": parse_double}


@query(RAW + "SELECT order_id, status, 'order total' AS reject_column, odd_total AS reject_value FROM raw WHERE odd_total = 'n/a'")
def reject_rows(spark, sf_dir):
    _, rejects = split_rejects(_raw_orders(spark, sf_dir), RULES)
    return rejects.select(F.col("order id").cast("bigint").alias("order_id"), "status", "reject_column", "reject_value")


@query(RAW + "SELECT order_id, order_total FROM raw WHERE odd_total IS DISTINCT FROM 'n/a'")
def accepted_rows(spark, sf_dir):
    good, _ = split_rejects(_raw_orders(spark, sf_dir), RULES)
    return good.select(F.col("order id").cast("bigint").alias("order_id"), F.col("order total").alias("order_total"))


@query(
    RAW + "SELECT count(*) AS n, count(order_total) AS parsed, count(*) FILTER (odd_total = 'n/a') AS failed, "
    "count(*) AS written FROM raw"
)
def reject_counters(spark, sf_dir):
    """Counters taken during a write, which equal those of the committed rows when no task is repeated."""
    path = fresh_path(spark, "counted")
    orders, seen = with_counters(_raw_orders(spark, sf_dir), "orders", RULES)
    counts = write_counted(orders, path, RULES)
    if counts != seen.get:
        counts = {**counts, "rows": -1}
    return spark.read.parquet(path).agg(
        F.lit(counts["rows"]).cast("bigint").alias("n"),
        F.lit(counts["parsed_order total"]).cast("bigint").alias("parsed"),
        F.lit(counts["failed_order total"]).cast("bigint").alias("failed"),
        F.count("*").alias("written"),
    )


# Events as log lines; clicks come as lines that do not fit the pattern.

def _log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "signup", "WARN").otherwise("INFO")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z' "), level, F.lit(" shop-service cust=U"), F.col("user_id").cast("string"),
        F.lit(" status="), kind, F.lit(" amount="), F.col("value").cast("decimal(18,2)").cast("string"),
    )
    other = F.concat(F.lit("click "), F.col("event_id").cast("string"), F.lit(" "), F.col("props"))
    return _table(spark, sf_dir, "events").select(F.when(kind == "click", other).otherwise(line).alias("value"))


LEVEL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END"


@query(
    f"SELECT strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, {LEVEL} AS level, 'shop-service' AS service, "
    "'U' || user_id AS customer_id, event_type AS status, value AS amount FROM events WHERE event_type <> 'click'",
    name="parse_log",
)
def parse_log_lines(spark, sf_dir):
    parsed, _ = parse_log(_log_lines(spark, sf_dir), SERVICE_LOG_PATTERN)
    return parsed


@query("SELECT 'click ' || event_id || ' ' || props AS value FROM events WHERE event_type = 'click'")
def log_rejects(spark, sf_dir):
    _, rejects = parse_log(_log_lines(spark, sf_dir), SERVICE_LOG_PATTERN)
    return rejects


@query(f"SELECT {LEVEL} AS level, count(*) AS n FROM events WHERE event_type <> 'click' GROUP BY 1")
def log_levels(spark, sf_dir):
    path = fresh_path(spark, "log")
    _log_lines(spark, sf_dir).write.text(path)
    parsed, _ = read_log(spark, path, SERVICE_LOG_PATTERN)
    return summarize(parsed, "level")


@query(
    f"SELECT {LEVEL} AS level, count(*) AS n, round(sum(value), 2) AS amount FROM events "
    "WHERE event_type <> 'click' GROUP BY 1"
)
def registered_log(spark, sf_dir):
    db, path = _scratch(spark)
    _log_lines(spark, sf_dir).write.text(f"{path}/log")
    register_log(spark, db, "log", f"{path}/log", SERVICE_LOG_PATTERN)
    return summarize(read_table(spark, db, "log"), "level", {"n": F.count("*"), "amount": money_sum("amount")})


KPIS = """
SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT user_id) AS active_users,
  count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
  count(*) FILTER (event_type = 'purchase') AS purchases,
  round(coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0), 2) AS revenue,
  CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) / nullif(count(*) FILTER (event_type = 'view'), 0) AS conversion
FROM events GROUP BY 1
"""


@query(KPIS, name="daily_engagement_kpis")
def daily_kpis(spark, sf_dir):
    return daily_engagement_kpis(_table(spark, sf_dir, "events"))


@query(KPIS)
def daily_kpis_table(spark, sf_dir):
    db, path = _scratch(spark)
    write_table(daily_engagement_kpis(_table(spark, sf_dir, "events")), db, "kpis", f"{path}/kpis", mode="overwrite")
    return read_table(spark, db, "kpis")


@query(KPIS)
def daily_kpis_from_records(spark, sf_dir):
    """The same figures from nested JSON records with prices as numbers, as text, or as a word."""
    events = _table(spark, sf_dir, "events")
    number = F.col("value").cast("decimal(18,2)").cast("string")
    price = (
        F.when(F.col("event_type") == "click", F.lit('"free"'))
        .when(F.col("user_id") > F.col("value"), F.concat(F.lit('"'), number, F.lit('"')))
        .otherwise(number)
    )
    record = F.format_string(
        '{"ts": "%s", "event_type": "%s", "user": {"id": %d}, "item": {"price": %s}}',
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.col("event_type"), F.col("user_id"), price,
    )
    path = fresh_path(spark, "clicks")
    events.select(record).write.text(path)
    return daily_engagement_kpis(clicks_from_records(spark, path))


# Maintenance, inventory, multi-table and multi-sink jobs.

EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _small_files(spark: SparkSession, sf_dir: str, partition_by: list[str]) -> tuple[str, str]:
    db, path = _scratch(spark)
    writer = _table(spark, sf_dir, "events").repartition(16, "event_id").write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/events")
    register_path(spark, db, "events", f"{path}/events", "parquet")
    return db, path


@query(EVENTS)
def compacted_rows(spark, sf_dir):
    db, _ = _small_files(spark, sf_dir, [])
    compact_table(spark, db, "events")
    return read_table(spark, db, "events")


@query(EVENTS)
def compacted_sorted_partitions(spark, sf_dir):
    db, _ = _small_files(spark, sf_dir, ["event_type"])
    compact_table(spark, db, "events", sort_by=["user_id"])
    return read_table(spark, db, "events")


@query("SELECT event_id, user_id, CAST(row_number() OVER (ORDER BY user_id, event_id) AS BIGINT) AS place FROM events")
def compacted_sorted_single_file(spark, sf_dir):
    """A table is sorted over all its files, one or many: ids in the order of their place in the table."""
    db, path = _scratch(spark)
    write_table(_table(spark, sf_dir, "events").select("event_id", "user_id"), db, "events", f"{path}/events")
    compact_table(spark, db, "events", sort_by=["user_id", "event_id"])
    rows = read_table(spark, db, "events").select("event_id", "user_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    # The files hold one range each; only a row for each of them is put in order here, by the file's first.
    first = (F.max(F.when(F.col("row") == 0, F.col(c))).alias(c) for c in ("user_id", "event_id"))
    files = rows.groupBy("file").agg(F.count("*").alias("n"), *first)
    before = F.sum("n").over(Window.orderBy("user_id", "event_id").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(files, "file").select("event_id", "user_id", (F.col("before") + F.col("row") + 1).alias("place"))


@query("SELECT event_type, CAST(1 AS BIGINT) AS files, count(*) AS n FROM events GROUP BY event_type")
def file_counts(spark, sf_dir):
    """Files per partition after compaction: one each while a partition is below the target size."""
    db, _ = _small_files(spark, sf_dir, ["event_type"])
    compact_table(spark, db, "events")
    files = table_files(spark, db, "events", rows=True)
    return files.groupBy("event_type").agg(F.count("*").alias("files"), F.sum("rows").alias("n"))


@query(
    "SELECT 'customers' AS table_name, count(DISTINCT c_mktsegment) AS partitions, true AS has_data FROM customer "
    "UNION ALL SELECT 'no_orders', 0, false UNION ALL SELECT 'orders', 0, count(*) > 0 FROM orders",
    name="table_inventory",
)
def inventory(spark, sf_dir):
    db, path = _scratch(spark)
    write_table(_table(spark, sf_dir, "customer"), db, "customers", f"{path}/customers", ["c_mktsegment"])
    write_table(_table(spark, sf_dir, "orders"), db, "orders", f"{path}/orders")
    create_table(spark, db, "no_orders", MANAGED, f"{path}/no_orders")
    return table_inventory(spark, [db]).select("table_name", "partitions", "has_data")


@query("SELECT 'orders' AS table_name, count(DISTINCT o_orderstatus) AS partitions, true AS every_file, count(*) AS n FROM orders")
def inventory_relocated_partitions(spark, sf_dir):
    """A CSV table with a partition for each order status, one of them outside the table's folder."""
    db, path = _scratch(spark)
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    inside = f"{path}/orders"
    orders.where("status <> 'O'").write.option("header", True).partitionBy("status").csv(inside)
    orders.where("status = 'O'").drop("status").write.option("header", True).csv(f"{path}/elsewhere")
    spark.sql(
        f"CREATE TABLE {db}.orders (o_orderkey bigint, status string) USING csv OPTIONS (header 'true') "
        f"PARTITIONED BY (status) LOCATION {sql_text(inside)}"
    )
    spark.sql(f"MSCK REPAIR TABLE {db}.orders")
    spark.sql(f"ALTER TABLE {db}.orders ADD PARTITION (status = 'O') LOCATION {sql_text(f'{path}/elsewhere')}")
    found = table_inventory(spark, [db]).select("table_name", "partitions", "files")
    rows = read_table(spark, db, "orders").agg(F.count("*").alias("n"), F.count_distinct("_metadata.file_path").alias("read"))
    # A task without rows may leave a file of a header alone: the inventory counts it, no row comes from it.
    stored = spark.read.option("recursiveFileLookup", True).text([inside, f"{path}/elsewhere"]).agg(F.count_distinct("_metadata.file_path").alias("stored"))
    every = (F.col("files") == F.col("stored")) & (F.col("read") <= F.col("stored"))
    return found.join(rows, F.lit(True)).join(stored, F.lit(True)).select("table_name", "partitions", every.alias("every_file"), "n")


@query(
    "SELECT 'customers: ' || count(DISTINCT c_mktsegment) || ' partitions' AS line FROM customer "
    "UNION ALL SELECT 'no_orders: 0 partitions <-- WARNING: no data at the location' UNION ALL SELECT 'orders: 0 partitions' "
    "UNION ALL SELECT 'database: no tables'",
    name="inventory_report",
)
def reported_inventory(spark, sf_dir):
    db, path = _scratch(spark)
    empty, _ = _scratch(spark)
    write_table(_table(spark, sf_dir, "customer"), db, "customers", f"{path}/customers", ["c_mktsegment"])
    write_table(_table(spark, sf_dir, "orders"), db, "orders", f"{path}/orders")
    create_table(spark, db, "no_orders", MANAGED, f"{path}/no_orders")
    report = fresh_path(spark, "report")
    inventory_report(table_inventory(spark, [db, empty])).write.text(report)
    line = F.regexp_replace(F.regexp_replace("value", r", location=\S+", ""), rf"^({db}\.|{empty})", "")
    return spark.read.text(report).select(F.when(line.startswith(":"), F.concat(F.lit("database"), line)).otherwise(line).alias("line"))


@query(
    f"SELECT event_id, {LONG} AS longs, {DOUBLE} AS doubles, CASE WHEN event_type = 'error' THEN 'new' END AS added FROM events"
)
def json_table_new_field(spark, sf_dir):
    """Files that arrive after the registration bring another field and another type of number."""
    db, path = _scratch(spark)
    events = _table(spark, sf_dir, "events")
    kind = F.col("event_type")
    first = F.format_string('{"event_id": %d, "points": %d}', F.col("event_id"), F.col("user_id"))
    events.where(kind == "click").select(first).write.text(f"{path}/events")
    register_path(spark, db, "events", f"{path}/events", "json")
    points = F.when(kind == "purchase", F.col("value").cast("string")).otherwise(F.lit("null"))
    note = F.when(kind == "error", F.lit('"new"')).otherwise(F.lit("null"))
    later = F.format_string('{"event_id": %d, "points": %s, "added": %s}', F.col("event_id"), points, note)
    events.where(kind != "click").select(later).write.mode("append").text(f"{path}/events")
    spark.catalog.refreshTable(f"{db}.events")
    struct = resolve_choice(read_table(spark, db, "events"), specs=[("points", "make_struct")], types={"points": ["long", "double"]})
    return struct.select("event_id", F.col("points.long").alias("longs"), F.col("points.double").alias("doubles"), "added")


@query(f"SELECT event_id, {LONG} AS a_long, {STRING} AS a_string FROM events")
def choice_in_map(spark, sf_dir):
    """Values of mixed types inside a map."""
    events = _choices(spark, sf_dir).select("event_id", F.create_map(F.lit("a"), F.col("points")).alias("m"))
    out = resolve_choice(events, specs=[("m{}", "make_struct")], types={"m{}": KINDS["points"]})
    value = F.element_at("m", "a")
    return out.select("event_id", value["long"].alias("a_long"), value["string"].alias("a_string"))


@query("SELECT o_orderkey AS orders_id, CAST(0 AS INTEGER) AS \"index\", o_custkey AS id FROM orders")
def relationalize_same_field_name(spark, sf_dir):
    """The elements have a field that is called like the key of the records."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.array(F.struct(F.col("o_custkey").alias("id"))).alias("parts")
    )
    return relationalize(orders, "orders", "id")["orders_parts"]


@query("SELECT event_type, round(sum(value / 1000), 2) AS total FROM events GROUP BY event_type")
def sum_of_small_amounts(spark, sf_dir):
    """Amounts with more than two decimals are added exactly and rounded once."""
    return summarize(_table(spark, sf_dir, "events"), "event_type", {"total": money_sum(F.col("value") / 1000)})


@query(
    f"SELECT 'events' AS table_name, count(*) AS n, count({LONG}) AS longs, count({STRING}) AS strings FROM events "
    "UNION ALL SELECT 'orders', count(*), NULL, NULL FROM orders",
    name="export_tables",
)
def export_all_tables(spark, sf_dir):
    db, path = _scratch(spark)
    out_db, _ = _scratch(spark)
    _raw_orders(spark, sf_dir).write.option("header", True).csv(f"{path}/orders")
    record = F.format_string('{"event_id": %d, "points": %s}', F.col("event_id"), _points_text())
    _table(spark, sf_dir, "events").select(record).write.text(f"{path}/events")
    register_path(spark, db, "orders", f"{path}/orders", "csv")
    register_path(spark, db, "events", f"{path}/events", "json")
    export_tables(spark, db, out_db, f"{path}/out")
    events, orders = read_table(spark, out_db, "events"), read_table(spark, out_db, "orders")
    nothing = F.lit(None).cast("bigint")
    return events.agg(
        F.lit("events").alias("table_name"),
        F.count("*").alias("n"),
        F.count("points.long").alias("longs"),
        F.count("points.string").alias("strings"),
    ).unionByName(
        orders.agg(F.lit("orders").alias("table_name"), F.count("*").alias("n"), nothing.alias("longs"), nothing.alias("strings"))
    )


@query(
    RAW + "SELECT 'all' AS sink, order_id, order_total FROM raw UNION ALL "
    "SELECT 'large', order_id, order_total FROM raw WHERE order_total > 300000",
    name="fan_out",
)
def fan_out_sinks(spark, sf_dir):
    path = fresh_path(spark, "sinks")
    orders = _mapped(spark, sf_dir).select("order_id", "order_total")
    fan_out(
        orders,
        [
            lambda df: write_parquet(df, f"{path}/all"),
            lambda df: write_parquet(df.filter("order_total > 300000"), f"{path}/large"),
        ],
    )
    sinks = [spark.read.parquet(f"{path}/{s}").select(F.lit(s).alias("sink"), "*") for s in ("all", "large")]
    return sinks[0].unionByName(sinks[1])


# Schemas that grow, tables taken up again, files that change.

@query(
    "SELECT o_orderkey AS id, o_orderstatus AS status, NULL AS priority, o_custkey AS n, NULL AS day, o_custkey AS number FROM orders "
    "UNION ALL SELECT -o_orderkey, o_orderstatus, o_orderpriority, o_custkey * 10000000000, strftime(o_orderdate, '%Y-%m-%d'), "
    "o_custkey * 10000000000 FROM orders"
)
def table_nested_growth(spark, sf_dir):
    """The second batch has new fields in a struct and in the structs of an array, and larger numbers there."""
    db, path = _scratch(spark)
    orders = _table(spark, sf_dir, "orders")
    small, large = F.col("o_custkey").cast("int"), F.col("o_custkey").cast("bigint") * 10_000_000_000
    first = orders.select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_orderstatus").alias("status")).alias("info"),
        F.array(F.struct(small.alias("n"))).alias("items"),
        small.alias("number"),
    )
    second = orders.select(
        large.alias("number"),
        F.array(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), large.alias("n"))).alias("items"),
        F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")).alias("info"),
        (-F.col("o_orderkey")).alias("id"),
    )
    for batch in (first, second):
        write_table(batch, db, "orders", f"{path}/orders")
    item = F.col("items")[0]
    return read_table(spark, db, "orders").select("id", "info.status", "info.priority", item["n"].alias("n"), item["day"].alias("day"), "number")


@query(
    "SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL SELECT -c_custkey, c_name, c_nationkey FROM customer"
)
def table_readopted(spark, sf_dir):
    """A dropped table whose files stayed, with numbers as partitions, goes on with the next batch."""
    db, path = _scratch(spark)
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    write_table(customers, db, "customers", f"{path}/customers", ["c_nationkey"])
    drop_table(spark, db, "customers")
    write_table(customers.withColumn("c_custkey", -F.col("c_custkey")), db, "customers", f"{path}/customers", ["c_nationkey"])
    return read_table(spark, db, "customers")


@query(
    f"SELECT event_id, {LONG} AS points_long, {DOUBLE} AS points_double, event_id + 123456789012345678 AS first_long, "
    "value + 0.125 AS second_double, CASE WHEN event_type = 'error' THEN user_id END AS inner_long, "
    "CASE WHEN event_type = 'view' THEN value + 0.125 END AS inner_double FROM events"
)
def choice_long_and_double(spark, sf_dir):
    """Whole numbers and fractions in one field, in one array, and in the structs of an array."""
    events, kind = _table(spark, sf_dir, "events"), F.col("event_type")
    fraction = (F.col("value") + 0.125).cast("string")
    points = F.when(kind == "click", F.col("user_id").cast("string")).when(kind == "purchase", F.col("value").cast("string")).otherwise("null")
    inner = F.when(kind == "error", F.col("user_id").cast("string")).when(kind == "view", fraction).otherwise("null")
    record = F.format_string(
        '{"event_id": %d, "points": %s, "list": [%d, %s], "rows": [{"n": %s}]}',
        F.col("event_id"), points, F.col("event_id") + 123456789012345678, fraction, inner,
    )
    path = fresh_path(spark, "numbers")
    events.select(record).write.text(path)
    out = resolve_choice(read_json_records(spark, path), choice="make_struct")
    number = F.col("rows")[0]["n"]
    return out.select(
        "event_id", F.col("points.long").alias("points_long"), F.col("points.double").alias("points_double"),
        F.col("list")[0]["long"].alias("first_long"), F.col("list")[1]["double"].alias("second_double"),
        number["long"].alias("inner_long"), number["double"].alias("inner_double"),
    )


@query(
    f"SELECT event_id, {LONG} AS longs, {STRING} AS strings, CASE WHEN event_type = 'error' THEN value > 10 END AS truths FROM events"
)
def json_table_new_type(spark, sf_dir):
    """A table is read, files with other types arrive, and it is read again: only those are looked into."""
    db, path = _scratch(spark)
    events, kind = _table(spark, sf_dir, "events"), F.col("event_type")
    record = F.format_string('{"event_id": %d, "points": %s}', F.col("event_id"), _points_text())
    truth = F.format_string('{"event_id": %d, "points": %s}', F.col("event_id"), (F.col("value") > 10).cast("string"))
    events.where(kind == "click").select(record).write.text(f"{path}/events")
    register_path(spark, db, "events", f"{path}/events", "json")
    if dict(read_table(spark, db, "events").dtypes)["points"] != "bigint":
        raise AssertionError("the first files hold whole numbers only")
    for later in (events.where((kind != "click") & (kind != "error")).select(record), events.where(kind == "error").select(truth)):
        later.write.mode("append").text(f"{path}/events")
        spark.catalog.refreshTable(f"{db}.events")
        struct = resolve_choice(read_table(spark, db, "events"), specs=[("points", "make_struct")], types={"points": ["long", "string", "boolean"]})
    return struct.select(
        "event_id", F.col("points.long").alias("longs"), F.col("points.string").alias("strings"), F.col("points.boolean").alias("truths")
    )


@query(
    f"SELECT 'events' AS table_name, 2 * count(*) AS n, 2 * count({LONG}) AS longs, count(*) FILTER (event_type = 'error') AS truths FROM events "
    "UNION ALL SELECT 'orders', 2 * count(*), NULL, NULL FROM orders"
)
def export_tables_twice(spark, sf_dir):
    """The second export brings a class of value that the first did not have."""
    db, path = _scratch(spark)
    out_db, _ = _scratch(spark)
    events, kind = _table(spark, sf_dir, "events"), F.col("event_type")
    _raw_orders(spark, sf_dir).write.option("header", True).csv(f"{path}/orders")
    for truth in ("null", "true"):
        points = F.when(kind == "error", F.lit(truth)).otherwise(_points_text())
        record = F.format_string('{"event_id": %d, "points": %s}', F.col("event_id"), points)
        events.select(record).write.mode("overwrite").text(f"{path}/events")
        register_path(spark, db, "orders", f"{path}/orders", "csv")
        register_path(spark, db, "events", f"{path}/events", "json")
        export_tables(spark, db, out_db, f"{path}/out")
    out = read_table(spark, out_db, "events")
    nothing = F.lit(None).cast("bigint")
    return out.agg(
        F.lit("events").alias("table_name"), F.count("*").alias("n"), F.count("points.long").alias("longs"), F.count("points.boolean").alias("truths")
    ).unionByName(
        read_table(spark, out_db, "orders").agg(
            F.lit("orders").alias("table_name"), F.count("*").alias("n"), nothing.alias("longs"), nothing.alias("truths")
        )
    )


@query(
    RAW + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS rn FROM raw) "
    "SELECT customer_id, order_id, order_date, status, 6 AS parts FROM ranked WHERE rn = 1"
)
def keyed_rebucket(spark, sf_dir):
    """Parts that outgrow their size divide as they are written again; in the end the table gets six."""
    db, path = _scratch(spark)
    orders = _mapped(spark, sf_dir).select("customer_id", "order_id", "order_date", "status")
    early = F.col("order_date") < "1998-07-01"
    for batch in (orders.filter(early), orders.filter(~early)):
        upsert_keyed(batch, db, "latest", "customer_id", f"{path}/latest", ["order_date", "order_id"], buckets=2, part_bytes=8192)
    rebucket_keyed(spark, db, "latest", f"{path}/latest", 6)
    return read_keyed(spark, db, "latest").withColumn("parts", F.lit(spark.sql(f"SHOW PARTITIONS {db}.latest").count()))


@query(
    "WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 7 = 0 THEN NULL "
    "WHEN l_orderkey % 5 = 0 THEN -l_partkey ELSE l_partkey END AS key FROM lineitem), "
    "r AS (SELECT p_partkey AS key, p_name FROM part UNION ALL SELECT p_partkey + 100000000, p_name FROM part "
    "UNION ALL SELECT NULL, p_name FROM part) SELECT key, l_orderkey, l_linenumber, p_name FROM l FULL JOIN r USING (key)"
)
def enrich_full_skewed(spark, sf_dir):
    """A third of the order lines name the same part; others name none, or one that isn't there."""
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN -l_partkey ELSE l_partkey END AS key",
    )
    parts = _table(spark, sf_dir, "part")
    every = parts.selectExpr("p_partkey AS key", "p_name").unionByName(parts.selectExpr("p_partkey + 100000000 AS key", "p_name"))
    every = every.unionByName(parts.selectExpr("CAST(NULL AS BIGINT) AS key", "p_name"))
    return enrich(lines, every, "key", ["p_name"], how="full").select("key", "l_orderkey", "l_linenumber", "p_name")

"""Whole programs over an order and customer lake: raw tables in, cataloged tables out.

The raw orders table has columns `cust id`, `order total`, `order date`, `status`, all text; the raw
customers table has nested JSON records with a mixed-type loyalty_points.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.numbers import money_sum, to_cents
from tablewright.operators.choice import resolve_choice
from tablewright.operators.joins import enrich
from tablewright.operators.latest import latest_per_key
from tablewright.operators.mapping import apply_mapping, stringify
from tablewright.operators.relational import relationalize
from tablewright.operators.summary import daily_engagement_kpis, summarize
from tablewright.plans.jobs import fan_out
from tablewright.plans.maintenance import compact_table, table_files
from tablewright.sources.files import read_json_records
from tablewright.sources.keyed import upsert_keyed
from tablewright.sources.sinks import create_table, insert_select, write_collection, write_parquet, write_table
from tablewright.sources.tables import read_table, register_log
from tablewright.streaming.incremental import incremental_load, store_load

# The raw order columns and what they are called and typed after mapping.
ORDER_MAPPING = [
    ("cust id", "string", "customer_id", "string"),
    ("order total", "string", "order_total", "double"),
    ("order date", "string", "order_date", "string"),
    ("status", "string", "status", "string"),
]
ORDER_TEXT_MAPPING = [(source, kind, target, "string") for source, kind, target, _ in ORDER_MAPPING]
ORDER_SOURCE_SCHEMA = "`cust id` string, `order total` string, `order date` string, status string"

# Fixed value: the form of the service log's lines.
SERVICE_LOG_PATTERN = (
    "%{TIMESTAMP_ISO8601:ts} %{LOGLEVEL:level} %{NOTSPACE:service} cust=%{NOTSPACE:customer_id} "
    "status=%{WORD:status} amount=%{NUMBER:amount:double}"
)


def mapped_orders(spark: SparkSession, db: str = "raw", table: str = "orders") -> DataFrame:
    return apply_mapping(read_table(spark, db, table), ORDER_MAPPING)


def status_report(orders: DataFrame) -> DataFrame:
    """Orders and their total per status, most frequent first."""
    measures = {"n": F.count("*"), "total": money_sum("order_total")}
    return summarize(orders, "status", measures, [F.desc("n"), "status"])


def map_filter_summarize(spark: SparkSession, out_path: str) -> tuple[int, DataFrame]:
    """(number of shipped orders, status report); the mapped orders go to plain Parquet.

    The mapping is computed once; count and report then read the Parquet.
    """
    write_parquet(mapped_orders(spark), out_path)
    orders = spark.read.parquet(out_path)
    return orders.filter(F.col("status") == "shipped").count(), status_report(orders)


def orders_to_table(spark: SparkSession, path: str, out_db: str = "processed", out_table: str = "orders") -> None:
    """All orders, in the layout of the incremental loads, which may go on in the same table."""
    store_load(mapped_orders(spark), out_db, out_table, path, ["order_date"], f"all_{uuid.uuid4().hex}")


def customers_to_tables(
    spark: SparkSession, path: str, key: str | None = None, staging_path: str | None = None, out_db: str = "processed"
) -> dict[str, DataFrame]:
    """Root and contacts tables of the nested customers."""
    customers = resolve_choice(read_table(spark, "raw", "customers"), specs=[("loyalty_points", "cast:string")])
    frames = relationalize(customers, "customers", key, staging_path)
    tables = {("customers_root" if name == "customers" else name): frame for name, frame in frames.items()}
    write_collection(tables, out_db, path)
    return tables


def incremental_orders(
    spark: SparkSession, source: str, path: str, state_root: str, out_db: str = "processed", out_table: str = "orders"
) -> int:
    """Only order files that have not been loaded yet, into the partitioned orders table."""
    return incremental_load(
        spark,
        source,
        ORDER_SOURCE_SCHEMA,
        lambda batch: apply_mapping(batch, ORDER_MAPPING),
        out_db,
        out_table,
        job="orders_to_table",
        ctx="source_orders",
        state_root=state_root,
        path=path,
        partition_by=["order_date"],
    )


def diagnosed_orders(spark: SparkSession, path: str, table: str = "orders_bad", out_db: str = "processed") -> None:
    """Shipped orders with their total in cents; an unreadable total gives NULL, not a failed job."""
    orders = apply_mapping(read_table(spark, "raw", table), ORDER_TEXT_MAPPING)
    shipped = orders.filter(F.col("status") == "shipped")
    write_table(shipped.withColumn("order_total_cents", to_cents("order_total")), out_db, "orders_diagnosed", path)


def latest_orders_enriched(spark: SparkSession) -> DataFrame:
    """Each customer's latest order with the customer's name and city."""
    orders = mapped_orders(spark).drop("status")
    latest = latest_per_key(orders, "customer_id", "order_date")
    return enrich(latest, read_table(spark, "raw", "customers"), "customer_id", ["name", ("address.city", "city")])


def latest_orders_to_keyed(spark: SparkSession, path: str, db: str = "processed", table: str = "orders_enriched") -> None:
    upsert_keyed(stringify(latest_orders_enriched(spark)), db, table, "customer_id", path, "order_date")


def orders_to_managed(
    spark: SparkSession, location: str, out_db: str = "processed", out_table: str = "orders_managed"
) -> dict[str, int]:
    """Create, fill (append) and compact a table; returns its rows, and its files before and after."""
    schema = "customer_id string, order_total double, order_date string, status string"
    create_table(spark, out_db, out_table, schema, location)
    insert_select(mapped_orders(spark), out_db, out_table)
    before = table_files(spark, out_db, out_table).count()
    compact_table(spark, out_db, out_table)
    after = table_files(spark, out_db, out_table).count()
    return {"rows": read_table(spark, out_db, out_table).count(), "files_before": before, "files_after": after}


def counted_and_shown(orders: DataFrame, threshold: float = 100.0) -> list[object]:
    """Row count and number of totals above a threshold, from one computation of `orders`."""
    return fan_out(orders, [DataFrame.count, lambda df: df.filter(F.col("total") > threshold).count()])


# The fields of a click record and what they become.
CLICK_MAPPING = [
    ("ts", "string", "ts", "timestamp_ntz"),
    ("user.id", "bigint", "user_id", "bigint"),
    ("event_type", "string", "event_type", "string"),
    ("item.price", "double", "value", "double"),
]


def clicks_from_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Flat events from nested JSON click records, whose price is a number in some and text in others."""
    records = read_json_records(spark, paths)
    return apply_mapping(resolve_choice(records, specs=[("item.price", "cast:double")]), CLICK_MAPPING)


def engagement_to_table(
    spark: SparkSession, events: DataFrame, path: str, out_db: str = "reporting", **columns
) -> None:
    """Daily engagement figures, replaced on every run."""
    write_table(daily_engagement_kpis(events, **columns), out_db, "daily_engagement_kpis", path, mode="overwrite")


def service_log_to_catalog(spark: SparkSession, path: str, db: str = "raw", table: str = "service_log") -> DataFrame:
    """Catalog the service log with typed columns; returns its lines per level."""
    register_log(spark, db, table, path, SERVICE_LOG_PATTERN)
    return summarize(read_table(spark, db, table), "level")

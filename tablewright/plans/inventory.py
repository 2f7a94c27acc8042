"""What the catalog holds: partitions, location, files and emptiness of every table."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.names import identifier, qualified
from tablewright.plans.maintenance import listed_in, table_folders
from tablewright.sources.tables import table_detail


def table_inventory(spark: SparkSession, databases: Sequence[str] | None = None, concurrency: int = 4) -> DataFrame:
    """One row per table: partitions, location, has_data, files, bytes. Views have no location.

    The catalog is asked for each table's partitions, a few tables at a time; the files of all of them are
    listed and counted by one job, and one row per table reaches the result. has_data is False for a table
    whose location is empty or gone. A database without tables has one row without table_name.
    """
    databases = [d.name for d in spark.catalog.listDatabases()] if databases is None else list(databases)
    names = [
        (identifier(db), t.name)
        for db in databases
        for t in spark.catalog.listTables(db)
        if not t.isTemporary
    ]

    def known(db: str, table: str) -> tuple:
        name = qualified(db, table)
        location = table_detail(spark, name, "Location")
        folders = table_folders(spark, name) if location else []
        return (db, table, len(folders) if folders and folders[0][1] else 0, location), folders

    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        found = list(pool.map(lambda n: known(*n), names))
    filled = {db for db, _ in names}
    rows = [row for row, _ in found] + [(db, None, 0, None) for db in map(identifier, databases) if db not in filled]
    tables = spark.createDataFrame(rows, "database string, table_name string, partitions bigint, location string")
    files = listed_in(spark, {f"{row[0]}.{row[1]}": folders for row, folders in found if folders})
    counts = files.groupBy(F.col("table_name").alias("name")).agg(F.count("*").alias("files"), F.sum("file_size").alias("bytes"))
    name = F.concat_ws(".", "database", "table_name")
    # A view has no files to count; an empty database none.
    counted = F.col("location").isNotNull() | F.col("table_name").isNull()
    number, size = (F.when(counted, F.coalesce(c, F.lit(0))).alias(c) for c in ("files", "bytes"))
    has_data = F.when(F.col("location").isNotNull(), F.coalesce("files", F.lit(0)) > 0).alias("has_data")
    return tables.join(counts, name == F.col("name"), "left").select("database", "table_name", "partitions", "location", has_data, number, size)


def inventory_report(inventory: DataFrame) -> DataFrame:
    """The inventory as lines of text, in order of database and table; write it with .write.text."""
    return inventory.orderBy("database", "table_name").select(
        F.when(F.col("table_name").isNull(), F.concat("database", F.lit(": no tables")))
        .otherwise(F.concat(
            F.format_string(
                "%s.%s: %d partitions, location=%s",
                F.col("database"),
                F.col("table_name"),
                F.col("partitions"),
                F.coalesce("location", F.lit("(none)")),
            ),
            F.when(~F.col("has_data"), " <-- WARNING: no data at the location").otherwise(""),
        ))
        .alias("value")
    )

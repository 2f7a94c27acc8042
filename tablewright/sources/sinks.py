"""Writers: cataloged Parquet tables that follow the data's schema, plain Parquet, and DDL."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.names import has_variant, identifier, qualified, quote, sql_text
from tablewright.operators.quality import Parser, counters
from tablewright.operators.relational import tagged_rows
from tablewright.sources.files import listed_files
from tablewright.sources.schema import conformed, grow_schema
from tablewright.sources.tables import DEFAULT_PARTITION, is_at, partition_columns, table_detail


def _no_choices(df: DataFrame) -> None:
    open_choices = [f.name for f in df.schema.fields if has_variant(f.dataType)]
    if open_choices:
        raise TypeError(f"columns {open_choices} are unresolved choices; use resolve_choice before writing")


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition value brought together, so that each value gets few files.

    REBALANCE lets AQE split a value that is too large for one task and merge small ones; a plain
    repartition would send a value that holds a third of the table through a single task.
    """
    return df.hint("rebalance", *(quote(p) for p in partition_by)) if partition_by else df


def table_order(df: DataFrame, name: str, without: Sequence[str] = ()) -> DataFrame:
    """Columns in the order and of the types of the table, absent ones NULL."""
    return conformed(df, [f for f in df.sparkSession.table(name).schema.fields if f.name not in without])


def write_table(
    df: DataFrame,
    db: str,
    table: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "append",
) -> None:
    """Write Parquet and create or update the catalog table.

    The table's schema grows to the data's, also inside structs, arrays and maps: new fields are added, and
    a type becomes the least one that holds the old and the new values (int to bigint and the like, see
    `schema.common_type`; Parquet files written before are read with the wider type, and data of a
    narrower type is widened when written). Properties, comments and partitions of the table stay. Any
    other change of type is an error, and so is a choice column. A path that already holds Parquet files
    becomes the table first, and the mode then applies to those rows as well; a partition column takes
    the data's type if every folder spells a value of it, else text. Partition values NULL and '' share
    Spark's default partition and read back NULL. mode is append or overwrite; overwrite replaces all
    rows, also where the session overwrites partitions dynamically.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    _no_choices(df)
    spark, name = df.sparkSession, qualified(db, table)
    if path and not spark.catalog.tableExists(name):
        _adopt(df, name, path, partition_by)
    if not spark.catalog.tableExists(name):
        writer = clustered(df, partition_by).write.format("parquet")
        if path:
            writer = writer.option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(name)
        return
    existing = partition_columns(spark, name)
    if list(partition_by) != existing:
        raise ValueError(f"{name} is partitioned by {existing}, not by {list(partition_by)}")
    location = table_detail(spark, name, "Location")
    if path and not is_at(location, path):
        raise ValueError(f"{name} is at {location}, not at {path}")
    grow_schema(df, name, existing)
    insert(table_order(clustered(df, existing), name), name, mode == "overwrite")


def insert(df: DataFrame, name: str, overwrite: bool, partition: Mapping[str, str | None] | None = None) -> None:
    """Append, or replace all rows whatever partitions the new ones have; `df` has the table's order.

    With `partition` only rows of its given values are replaced; columns without value (None) come from the
    rows. How partitions are overwritten goes with the statement: the session's setting, which other
    threads may use meanwhile, neither matters nor changes.
    """
    spark, view = df.sparkSession, f"insert_{uuid.uuid4().hex}"
    values = [quote(k) if v is None else f"{quote(k)} = {sql_text(v)}" for k, v in (partition or {}).items()]
    df.createOrReplaceTempView(view)
    try:
        spark.sql(
            f"INSERT {'OVERWRITE' if overwrite else 'INTO'} {name} WITH ('partitionOverwriteMode' = 'static') "
            f"{f'PARTITION ({", ".join(values)})' if values else ''} SELECT * FROM {view}"
        )
    finally:
        spark.catalog.dropTempView(view)


def _adopt(df: DataFrame, name: str, path: str, partition_by: Sequence[str]) -> None:
    """Make Parquet files that already lie under a path a table; without files nothing happens."""
    spark = df.sparkSession
    try:
        found = _files_schema(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return
        raise
    fields = {f.name: f for f in found.fields}
    missing = [p for p in partition_by if p not in fields]
    if missing:
        raise ValueError(f"the files at {path} have no partition column {missing}")
    given = {f.name: f.dataType for f in df.schema.fields}
    spelled = _spelled(spark, path, {p: given[p] for p in partition_by if p in given})
    kept = [f"{quote(f.name)} {f.dataType.simpleString()}" for f in fields.values() if f.name not in partition_by]
    kept += [f"{quote(p)} {given[p].simpleString() if p in spelled else 'string'}" for p in partition_by]
    text = f"CREATE TABLE {name} ({', '.join(kept)}) USING parquet"
    if partition_by:
        text += f" PARTITIONED BY ({', '.join(quote(p) for p in partition_by)})"
    spark.sql(f"{text} LOCATION {sql_text(path)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _files_schema(spark: SparkSession, path: str) -> T.StructType:
    """All columns of the Parquet files under a path, by their footers.

    Where files differ in a type, one file's schema is taken: the table then grows by what is written.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except (AnalysisException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return spark.read.parquet(path).schema


def _spelled(spark: SparkSession, path: str, types: Mapping[str, T.DataType]) -> set[str]:
    """Those partition columns whose folders all spell a value of the type, the way Spark spells it.

    Folder names carry no type: 007 is text, though a number can be read from it. The folders are listed,
    nothing in them is read.
    """
    if not types:
        return set()
    flags = []
    for p, dtype in types.items():
        raw = F.regexp_extract("path", f"/{re.escape(p)}=([^/]*)/", 1)
        value = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
        same = (value == DEFAULT_PARTITION) | (value.try_cast(dtype).cast("string") == value)
        flags.append(F.coalesce(F.bool_and(F.coalesce(same, F.lit(False))), F.lit(True)).alias(p))
    row = listed_files(spark, path).agg(*flags).first()
    return {p for p, good in row.asDict().items() if good}


def write_collection(frames: Mapping[str, DataFrame], db: str, path: str, mode: str = "append") -> None:
    """Every frame of a collection as a table of its own, in a folder of its own."""
    for name, frame in frames.items():
        write_table(frame, db, name, f"{path.rstrip('/')}/{name}", mode=mode)


def write_relationalized(
    df: DataFrame,
    root: str,
    db: str,
    path: str,
    key: Sequence[str] | str | None = None,
    names: Mapping[str, str] | None = None,
    staging_path: str | None = None,
) -> list[str]:
    """Nested records as one table for each collection in them, by one pass over the records; the tables' names.

    The rows of all tables are written together, divided by table, and each table lies on its part of the
    folder (`<path>/table=<name>`). Writing again appends; columns and types of the tables grow as those of
    `write_table`. `names` renames tables, such as the root.
    """
    spark, names = df.sparkSession, dict(names or {})
    written = []
    for rows, members in tagged_rows(df, root, key, staging_path):
        renamed = {m: names.get(m, m) for m in members}
        for member, schema in members.items():
            name, folder = qualified(db, renamed[member]), f"{path.rstrip('/')}/table={renamed[member]}"
            empty = spark.createDataFrame([], schema)
            _no_choices(empty)
            if not spark.catalog.tableExists(name):
                create_table(spark, db, renamed[member], ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields), folder)
            elif not is_at(table_detail(spark, name, "Location"), folder):
                raise ValueError(f"{name} is not at {folder}")
            grow_schema(empty, name, [])
        table = F.col("table")
        for member, name in renamed.items():
            if member != name:
                table = F.when(F.col("table") == member, name).otherwise(table)
        clustered(rows.withColumn("table", table), ["table"]).write.mode("append").partitionBy("table").parquet(path)
        written += renamed.values()
    for name in written:
        spark.catalog.refreshTable(qualified(db, name))
    return written


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Plain Parquet without a catalog entry."""
    _no_choices(df)
    writer = clustered(df, partition_by).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_counted(
    df: DataFrame, path: str, rules: Mapping[str, Parser], partition_by: Sequence[str] = ()
) -> dict[str, int]:
    """Plain Parquet in place of what was there, and exact counts of what was written: rows, parsed_, failed_.

    The counts are taken from the committed files, of which only the ruled columns are read; what a task
    counted that had to run again is not in them.
    """
    write_parquet(df, path, "overwrite", partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).agg(*counters(rules)).first().asDict()


def create_table(
    spark: SparkSession,
    db: str,
    table: str,
    schema: str,
    location: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    provider: str = "parquet",
) -> None:
    """CREATE TABLE IF NOT EXISTS. schema is DDL; another provider needs its jar on the cluster."""
    text = f"CREATE TABLE IF NOT EXISTS {qualified(db, table)} ({schema}) USING {identifier(provider)}"
    if partition_by:
        text += f" PARTITIONED BY ({', '.join(quote(c) for c in partition_by)})"
    if location:
        text += f" LOCATION {sql_text(location)}"
    if properties:
        text += f" TBLPROPERTIES ({', '.join(f'{sql_text(k)} = {sql_text(v)}' for k, v in properties.items())})"
    spark.sql(text)


def insert_select(df: DataFrame, db: str, table: str, overwrite: bool = False) -> None:
    """INSERT INTO (or OVERWRITE) by column name. Appending twice stores the rows twice."""
    name = qualified(db, table)
    unknown = {c.lower() for c in df.columns} - {c.lower() for c in df.sparkSession.table(name).columns}
    if unknown:
        raise ValueError(f"{name} has no column {sorted(unknown)}")
    insert(table_order(clustered(df, partition_columns(df.sparkSession, name)), name), name, overwrite)


def drop_table(spark: SparkSession, db: str, table: str, purge: bool = False) -> None:
    """Remove the catalog entry; with purge also the rows.

    Spark keeps the files of an external table even with PURGE, so its contents are overwritten
    with nothing first.
    """
    name = qualified(db, table)
    if not spark.catalog.tableExists(name):
        return
    if purge and table_detail(spark, name, "Type") == "EXTERNAL":
        insert(spark.createDataFrame([], spark.table(name).schema), name, True)
    spark.sql(f"DROP TABLE {name}{' PURGE' if purge else ''}")

"""Catalog tables: reading, registering data that already lies somewhere, and their locations."""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.functions.logs import MARK, log_fields
from tablewright.functions.numbers import DECIMAL, WHOLE
from tablewright.names import qualified, quote, sql_text
from tablewright.operators.census import files_schema
from tablewright.operators.choice import open_records

# Fixed value: how the folder of a partition without value is called.
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Property that names the folder of a JSON table's census.
CENSUS = "tablewright.census"


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def table_detail(spark: SparkSession, name: str, item: str) -> str | None:
    """One entry of DESCRIBE EXTENDED, such as Location or Provider."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    start = next((i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed Table")), 0)
    return next((r["data_type"] for r in rows[start:] if r["col_name"] == item), None)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def read_table(spark: SparkSession, db: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table. JSON tables come with one column per field, choices as VARIANT.

    The fields are those that the files have now. They come from the table's census, for which only files
    are read that are new since the last reading; with a schema only its fields are read, without that.
    """
    name = qualified(db, table)
    df = spark.table(name)
    if [f.dataType for f in df.schema.fields] != [T.VariantType()]:
        return df
    folder = None if schema else table_properties(spark, name).get(CENSUS)
    if folder:
        schema = files_schema(spark, table_detail(spark, name, "Location"), folder)
    return open_records(df, df.columns[0], schema)


def register_path(spark: SparkSession, db: str, table: str, path: str, fmt: str) -> None:
    """Make files under a path a catalog table, finding columns and partitions.

    parquet and orc bring their schema, csv takes its names from the header and types nothing, text
    has one column per line. JSON becomes one VARIANT column; its fields are found when it is read, and
    what each file holds is kept in a folder of the database. A CSV file with another header than the
    table's fails the query that meets it. Registering again replaces the entry and leaves the files
    alone; a table that owns its files is not replaced.
    """
    name = qualified(db, table)
    options = {
        "parquet": "",
        "orc": "",
        "csv": "OPTIONS (header 'true', enforceSchema 'false')",
        "text": "",
        "json": "OPTIONS (singleVariantColumn 'record')",
    }
    if fmt not in options:
        raise ValueError(f"unknown format {fmt!r}; one of {sorted(options)}")
    columns = "(record VARIANT)" if fmt == "json" else ""
    if spark.catalog.tableExists(name):
        if table_detail(spark, name, "Type") != "EXTERNAL":
            raise ValueError(f"{name} exists and owns its files; drop it first")
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} {columns} USING {fmt} {options[fmt]} LOCATION {sql_text(path)}")
    if partition_columns(spark, name):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    if fmt == "json":
        folder = f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table}.census/{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({sql_text(CENSUS)} = {sql_text(folder)})")


def register_log(spark: SparkSession, db: str, table: str, path: str, pattern: str) -> None:
    """Make log files queryable as a table with one typed column per capture of the pattern.

    The lines are the table `<table>_lines`; the typed columns are a view over it, so that files that
    arrive later are included. As in parse_log a line is matched once, and then taken apart at marks.
    Lines that do not fit are not in the view; parse_log tells which ones they are.
    """
    lines, view = f"{table}_lines", qualified(db, table)
    register_path(spark, db, lines, path, "text")
    regex, fields = log_fields(pattern)
    columns = []
    for i, (name, dtype) in enumerate(fields, start=1):
        text = f"captures[{i - 1}]"
        if dtype != "string":
            guard = DECIMAL if dtype in ("double", "float") else WHOLE
            text = f"CASE WHEN {text} RLIKE {sql_text(guard)} THEN try_cast({text} AS {dtype}) END"
        columns.append(f"{text} AS {quote(name)}")
    match, mark, template = sql_text(regex), sql_text(MARK), sql_text(MARK + MARK.join(f"${i + 1}" for i in range(len(fields))))
    one_by_one = ", ".join(f"regexp_extract(value, {match}, {i + 1})" for i in range(len(fields)))
    captures = (
        f"CASE WHEN contains(value, {mark}) THEN CASE WHEN value RLIKE {match} THEN array(array({one_by_one})) END "
        f"WHEN startswith(laid_out, {mark}) THEN array(split(substr(laid_out, 2), {mark}, -1)) END"
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(columns)} FROM "
        f"(SELECT value, regexp_replace(value, {match}, {template}) AS laid_out FROM {qualified(db, lines)}) "
        f"LATERAL VIEW explode({captures}) AS captures"
    )


def next_version(location: str) -> str:
    """A fresh folder beside a table's first location, for a rewritten copy of its data."""
    base = re.sub(r"\.v/[0-9a-f]{32}$", "", location.rstrip("/"))
    return f"{base}.v/{uuid.uuid4().hex}"


def is_at(location: str, path: str) -> bool:
    """Whether a table's location is the path, or a rewritten copy beside it.

    The catalog spells locations with scheme and host, which a path may leave out.
    """
    place = re.compile(r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*?)/*$", re.DOTALL)
    (scheme, host, folder), (other_scheme, other_host, other) = (place.match(p).groups() for p in (location, path))
    if (scheme and other_scheme and scheme != other_scheme) or (host and other_host and host != other_host):
        return False
    return re.sub(r"\.v/[0-9a-f]{32}$", "", folder) == re.sub(r"\.v/[0-9a-f]{32}$", "", other)


def partition_values(folder: str) -> dict[str, str]:
    """The values that a partition's name (a=1/b=x) stands for."""
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return {unquote(key): unquote(value) for key, value in pairs}


def partition_clause(values: dict[str, str]) -> str:
    return "PARTITION (" + ", ".join(f"{quote(k)} = {sql_text(v)}" for k, v in values.items()) + ")"


"""Incremental loads: each run reads only files that no earlier run of the same job has loaded.

A bookmark is a ledger of loaded files, a table of its own for every job, context and generation. New files are
those of the listing without a row in the ledger. They are planned as a load, written, and entered into the
ledger; a planned load that is not entered is done again, with the same files and under the same name. Resetting
starts a new generation.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.names import identifier, qualified, quote
from tablewright.sources.files import read_csv_named
from tablewright.sources.schema import grow_schema
from tablewright.sources.sinks import clustered, create_table, insert, table_order

LOAD_ID = "load_id"
_RESETS = "job string, ctx string, at timestamp"
_LEDGER = "file string, modified timestamp, length bigint, name string"

# Options of Spark's file sources about which files there are.
_FINDING = ("pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter")


class LoadFailed(PySparkException):
    """A planned load did not get into the table; the next run does it again."""


def _read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What was written there, or nothing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            return spark.createDataFrame([], schema)
        raise


def generation(spark: SparkSession, job: str, ctx: str, state_root: str) -> int:
    """How often the bookmark has been reset."""
    resets = _read_state(spark, f"{state_root.rstrip('/')}/resets", _RESETS)
    return resets.filter((F.col("job") == job) & (F.col("ctx") == ctx)).count()


def reset_bookmark(spark: SparkSession, job: str, ctx: str, state_root: str) -> None:
    """Forget what the job has read: its next run loads all files again, beside the rows it has loaded."""
    entry = spark.sql("SELECT :job AS job, :ctx AS ctx, current_timestamp() AS at", {"job": job, "ctx": ctx})
    entry.coalesce(1).write.mode("append").parquet(f"{state_root.rstrip('/')}/resets")


def store_load(batch: DataFrame, db: str, table: str, path: str | None, partition_by: Sequence[str], load: str) -> None:
    """Write one load under its own partition value, replacing what a failed try of it left there."""
    spark, name = batch.sparkSession, qualified(db, table)
    if not spark.catalog.tableExists(name):
        partitions = {f.name: f for f in batch.schema.fields if f.name in partition_by}
        plain = [f for f in batch.schema.fields if f.name not in partition_by]
        fields = plain + [partitions[p] for p in partition_by]
        ddl = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in fields)
        create_table(spark, db, table, f"{ddl}, {LOAD_ID} string", path, partition_by=[LOAD_ID, *partition_by])
    grow_schema(batch, name, [LOAD_ID, *partition_by])
    rows = table_order(clustered(batch, partition_by), name, without=[LOAD_ID])
    # Static overwrite of one load_id, whatever the session says: replaying a batch cannot double its rows.
    insert(rows, name, True, {LOAD_ID: load, **dict.fromkeys(partition_by)})


def incremental_load(
    spark: SparkSession,
    source: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    db: str,
    table: str,
    job: str,
    ctx: str | None,
    state_root: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "csv",
    options: dict[str, str] | None = None,
    max_files_per_batch: int = 10_000,
) -> int:
    """Load the new files under `source` through `transform` into a table; returns the batches written.

    The ledger grows only when a batch is in the table; after a failure the same files are read again
    under the same load_id, so nothing is lost or doubled. ctx=None keeps no state: every run loads
    everything. max_files_per_batch splits a large first load into restartable pieces, and is what the
    driver holds of names at most. A file is known by its path: one that is overwritten is not loaded
    again. Runs of one job and context must not overlap.

    CSV columns are matched by the header of each file (read_csv_named); with the option header=false
    by position.
    """
    options = {"header": "true", **(options or {})} if fmt == "csv" else dict(options or {})

    def read(paths: str | list[str]) -> DataFrame:
        if fmt == "csv" and options["header"].lower() == "true":
            return read_csv_named(spark, paths, schema, options)
        return spark.read.schema(schema).options(**options).format(fmt).load(paths)

    if ctx is None:
        batch = transform(read(source))
        store_load(batch, db, table, path, partition_by, f"all_{uuid.uuid4().hex}")
        return 1

    number = generation(spark, job, ctx, state_root)
    state = f"{state_root.rstrip('/')}/{identifier(job)}/{identifier(ctx)}/generation={number}"
    finding = {k: v for k, v in options.items() if k in _FINDING}
    try:
        written = _finish(spark, state, read, transform, db, table, path, partition_by)
        waiting = f"{state}/waiting/{uuid.uuid4().hex}"
        _new_files(spark, source, state, finding).write.parquet(waiting)
        while _plan(spark, state, waiting, max_files_per_batch):
            written += _finish(spark, state, read, transform, db, table, path, partition_by)
    finally:
        # The caller's session may still list files that were replaced.
        if spark.catalog.tableExists(qualified(db, table)):
            spark.catalog.refreshTable(qualified(db, table))
    return written


def _new_files(spark: SparkSession, source: str, state: str, finding: dict[str, str]) -> DataFrame:
    """The listed files that no load has taken: a join of two tables, not a list in the driver."""
    files = spark.read.format("binaryFile").options(**finding).load(source)
    files = files.select(F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("modified"), "length")
    return files.join(_ledger(spark, state).select("file"), "file", "left_anti")


def _ledger(spark: SparkSession, state: str) -> DataFrame:
    return _read_state(spark, f"{state}/ledger", _LEDGER)


def _plan(spark: SparkSession, state: str, waiting: str, most: int) -> bool:
    """Write down the files of the next load, oldest first; False if none are left."""
    files = spark.read.parquet(waiting).join(_ledger(spark, state).select("file"), "file", "left_anti")
    chosen = files.orderBy("modified", "file").limit(most).withColumn("name", F.lit(uuid.uuid4().hex))
    chosen.write.mode("overwrite").parquet(f"{state}/planned")
    return not spark.read.schema(_LEDGER).parquet(f"{state}/planned").isEmpty()


def _finish(
    spark: SparkSession,
    state: str,
    read: Callable[[list[str]], DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    db: str,
    table: str,
    path: str | None,
    partition_by: Sequence[str],
) -> int:
    """Do the planned load, unless it is in the ledger already."""
    planned = _read_state(spark, f"{state}/planned", _LEDGER)
    planned = planned.join(_ledger(spark, state).select("name").distinct(), "name", "left_anti").select("file", "modified", "length", "name")
    # At most max_files_per_batch names.
    rows = planned.collect()
    if not rows:
        return 0
    files = sorted(unquote(row["file"]) for row in rows)
    try:
        store_load(transform(read(files)), db, table, path, partition_by, f"load_{rows[0]['name']}")
    except Exception as error:
        raise LoadFailed(f"load {rows[0]['name']} of {len(files)} files failed and will be repeated by the next run: {error}") from error
    spark.createDataFrame(rows, _LEDGER).coalesce(1).write.mode("append").parquet(f"{state}/ledger")
    return 1


def read_loaded(spark: SparkSession, db: str, table: str) -> DataFrame:
    """The loaded rows, without the column that tells the loads apart."""
    return spark.table(qualified(db, table)).drop(LOAD_ID)

"""Jobs over several sinks or several tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tablewright.operators.choice import CLASSES, choice_columns, resolve_choice
from tablewright.session import materialize
from tablewright.sources.sinks import write_table
from tablewright.sources.tables import read_table


def fan_out(
    df: DataFrame, sinks: Sequence[Callable[[DataFrame], object]], staging_path: str | None = None
) -> list[object]:
    """Run several actions or writes on one frame, computing the frame once.

    It is written once, below the staging path or the shared folder, so that all sinks see the same rows
    and the loss of an executor costs a re-read only.
    """
    staged = materialize(df, staging_path, label="fan_out")
    return [sink(staged) for sink in sinks]


def export_table(spark: SparkSession, db: str, table: str, out_db: str, root: str, mode: str = "append") -> None:
    """Any table to cataloged Parquet without knowledge of its schema; choices become structs.

    The structs have a field for every class there is, so their type stays the same when values of
    another class arrive.
    """
    df = read_table(spark, db, table)
    df = resolve_choice(df, choice="make_struct", types=dict.fromkeys(choice_columns(df), CLASSES))
    write_table(df, out_db, table, f"{root.rstrip('/')}/{table}", mode=mode)


def export_tables(
    spark: SparkSession, db: str, out_db: str, root: str, mode: str = "append", concurrency: int = 2
) -> list[str]:
    """export_table for every table of a database, a few at a time; the first failure fails the run."""
    names = sorted(t.name for t in spark.catalog.listTables(db) if t.tableType != "VIEW" and not t.isTemporary)
    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        list(pool.map(lambda t: export_table(spark, db, t, out_db, root, mode), names))
    return names

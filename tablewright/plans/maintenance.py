"""Data files of a table, and compaction of small ones."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tablewright.names import qualified, quote, sql_text
from tablewright.sources.tables import (
    DEFAULT_PARTITION,
    next_version,
    partition_clause,
    partition_columns,
    partition_values,
    table_detail,
)

def table_files(spark: SparkSession, db: str, table: str, rows: bool = False) -> DataFrame:
    """One row per data file: partition values (as text), file_path, file_size; with `rows` their number, too.

    The files are those in the folders of the table's partitions, wherever these are; nothing in them is read
    unless rows are asked for. The driver knows the folders, as the catalog does; the files are a table.
    """
    name = qualified(db, table)
    parts = partition_columns(spark, name)
    if rows:
        groups = [F.col(quote(c)).cast("string").alias(c) for c in parts]
        meta = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_size")]
        return spark.table(name).groupBy(*groups, *meta).agg(F.count(F.lit(1)).alias("rows"))
    listed = listed_in(spark, {name: table_folders(spark, name)})
    return listed.select(*(F.col("values")[p].alias(p) for p in parts), "file_path", "file_size")


def table_folders(spark: SparkSession, name: str) -> list[tuple[str, dict[str, str | None]]]:
    """The folders that a table's rows are in, with their partition values, by one call to the catalog."""
    state = spark._jsparkSession.sessionState()
    table = state.sqlParser().parseTableIdentifier(name)
    if not partition_columns(spark, name):
        return [(state.catalog().getTableMetadata(table).location().toString(), {})]
    found = []
    partitions = state.catalog().listPartitions(table, spark._jvm.scala.Option.empty()).iterator()
    while partitions.hasNext():
        partition = partitions.next()
        spec = partition.spec().iterator()
        values = {}
        while spec.hasNext():
            pair = spec.next()
            values[pair._1()] = None if pair._2() == DEFAULT_PARTITION else pair._2()
        found.append((partition.location().toString(), values))
    return found


def listed_in(spark: SparkSession, tables: dict[str, list[tuple[str, dict[str, str | None]]]]) -> DataFrame:
    """table_name, values, file_path, file_size of the files in the tables' folders, by one listing.

    Folders that lie as partitions do are listed from the folder above them, all of a table or of a rewritten
    copy at once; what lies there beside them is left out by a join with the folders. Folders that are gone
    hold no files.
    """
    known = [(table, values, _plain_uri(folder)) for table, folders in tables.items() for folder, values in folders]
    schema = "table_name string, values map<string,string>, folder string"
    folders = spark.createDataFrame(known, schema)
    roots = sorted({_root(folder, len(values)) for _, values, folder in known})
    found = None
    for at in range(0, len(roots), 1000):
        listed = _listing(spark, [unquote(r) for r in roots[at : at + 1000]])
        if listed is not None:
            found = listed if found is None else found.unionAll(listed)
    if found is None:
        return folders.select("table_name", "values", F.col("folder").alias("file_path"), F.lit(0).cast("long").alias("file_size")).limit(0)
    # Catalog and listing spell a folder's address with one slash or three; a table may also be a single file.
    file = F.regexp_replace("file_path", "^file:/+", "file:/")
    found = found.withColumn("folder", F.explode(F.array(F.regexp_replace(file, "/[^/]*$", ""), file)))
    return found.join(folders, "folder").select("table_name", "values", "file_path", "file_size")


def _plain_uri(folder: str) -> str:
    return re.sub("^file:/+", "file:/", folder.rstrip("/"))


def _root(folder: str, levels: int) -> str:
    """The folder above `levels` steps that name partition values; the folder itself if they don't."""
    steps = folder.split("/")
    return "/".join(steps[:-levels]) if levels and all("=" in step for step in steps[-levels:]) else folder


def _listing(spark: SparkSession, roots: list[str]) -> DataFrame | None:
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        # One of them is gone: halves find it.
        if len(roots) == 1:
            return None
        halves = [h for h in (_listing(spark, roots[: len(roots) // 2]), _listing(spark, roots[len(roots) // 2 :])) if h is not None]
        return halves[0].unionAll(halves[1]) if len(halves) == 2 else halves[0] if halves else None
    return files.select(F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size"))


def files_in_use(spark: SparkSession, db: str, table: str) -> tuple[int, int]:
    """How many files the table has now, and a sum that changes with any of them; no names reach the driver."""
    spark.catalog.refreshTable(qualified(db, table))
    row = table_files(spark, db, table).agg(F.count("*"), F.sum(F.xxhash64("file_path", "file_size").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def _fragmented(files: DataFrame, parts: Sequence[str], target_bytes: int, factor: float, every: bool) -> DataFrame:
    """Partitions with `factor` times the files their bytes need, and the number they need; or every one."""
    needed = F.greatest(F.ceil(F.sum("file_size") / F.lit(target_bytes)), F.lit(1)).cast("int")
    totals = files.groupBy(*(quote(p) for p in parts)).agg(F.count("*").alias("files"), needed.alias("needed"), F.sum("file_size").alias("bytes"))
    return totals if every else totals.where((F.col("files") > F.col("needed")) & (F.col("files") >= F.col("needed") * factor))


# Partitions that one job rewrites, or files that it strings together.
_TOGETHER = 64
# What one task sorts at most, up to the unevenness of ranges.
_SORTED_ROWS, _SORTED_BYTES = 1 << 20, 64 << 20


class ConcurrentWrite(RuntimeError):
    """The table's files changed while a copy of them was written."""


def compact_table(
    spark: SparkSession,
    db: str,
    table: str,
    target_bytes: int = 256 * 1024 * 1024,
    sort_by: Sequence[str] = (),
    factor: float = 2.0,
) -> int:
    """Rewrite partitions that hold `factor` times the files their size needs; returns the files it aims at.

    Partitions that are fine already are not read. With sort_by every partition is rewritten, its rows
    clustered by those columns, however many files it has. The new files go to a fresh folder; then the
    table, or each rewritten partition, is pointed there. Old folders stay until the caller removes
    them, so running readers finish undisturbed and a failed run changes nothing. The files of the table
    are listed before and after the copy is made: if a writer has changed them meanwhile, the table stays
    as the writer left it and ConcurrentWrite is raised.

    Without sort_by nothing is shuffled: the scans of a partition's files are joined up, a task a new file. A
    partition is written whole, its large files included, because it is one folder: no statement exchanges
    some of a folder's files for others at once. With sort_by each partition's rows are spread by value ranges,
    ties by a hash of the row's place in its old file, which is the same when a lost task is run again.
    """
    name = qualified(db, table)
    provider, location = (table_detail(spark, name, item) for item in ("Provider", "Location"))
    if provider != "parquet":
        raise ValueError(f"{name} is a {provider} table; only Parquet tables are compacted")
    parts = partition_columns(spark, name)
    before = files_in_use(spark, db, table)
    work = _fragmented(table_files(spark, db, table), parts, target_bytes, factor, bool(sort_by))

    def unchanged() -> None:
        if files_in_use(spark, db, table) != before:
            raise ConcurrentWrite(f"the files of {name} changed during compaction; it is left as it is")

    rows = spark.table(name)
    target = next_version(location)

    if not parts:
        needed = work.first()
        if needed is None:
            return 0
        _rewrite(rows, parts, sort_by, needed["needed"], needed["bytes"], target, location)
        unchanged()
        spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_text(target)}")
        spark.catalog.refreshTable(name)
        return needed["needed"]

    # One row per fragmented partition: catalog-sized, like the ALTER statements below.
    chosen = work.collect()
    if not chosen:
        return 0
    types = {f.name: f.dataType for f in rows.schema.fields}

    def own(row: Row) -> DataFrame:
        found = rows
        for p in parts:
            found = found.where(F.col(quote(p)).isNull() if row[p] is None else F.col(quote(p)) == F.lit(row[p]).cast(types[p]))
        return found

    def sort(row: Row) -> None:
        steps = (spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(p, row[p]) for p in parts)
        _rewrite(own(row), parts, sort_by, row["needed"], row["bytes"], "/".join([target, *steps]), location)

    if sort_by:
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(sort, chosen))
    else:
        # The scans of each partition's files are joined up to as many tasks as it needs files: no shuffle. As a
        # task has rows of one partition, one open file is enough, and Spark need not sort them by partition.
        writers = "spark.sql.maxConcurrentOutputFileWriters"
        usual = spark.conf.get(writers)
        spark.conf.set(writers, "1")
        try:
            for at in range(0, len(chosen), _TOGETHER):
                out = reduce(DataFrame.unionAll, [own(row).coalesce(row["needed"]) for row in chosen[at : at + _TOGETHER]])
                out.write.mode("append").partitionBy(*parts).parquet(target)
        finally:
            spark.conf.set(writers, usual)
    unchanged()
    _point_partitions(spark, db, table, target)
    return sum(row["needed"] for row in chosen)


def _rewrite(rows: DataFrame, parts: Sequence[str], sort_by: Sequence[str], count: int, size: int, target: str, location: str) -> None:
    """Write rows, of `size` bytes in their present files, to `count` files of the folder `target`.

    Sorted rows are first written in ranges small enough to be sorted in little memory, however well the
    files are compressed; then neighbouring ranges are strung together to files, which sorts nothing.
    """
    if not sort_by:
        # The scans of the files are joined up to as many tasks as there are to be files: no shuffle.
        rows.drop(*parts).coalesce(count).write.parquet(target)
        return
    spark, keys = rows.sparkSession, [F.col(quote(c)) for c in sort_by]
    ranges = max(-(-rows.count() // _SORTED_ROWS), -(-size // _SORTED_BYTES), 1)
    ranges = -(-ranges // count) * count
    # The place breaks ties, so that one frequent value can still fill several ranges.
    placed = rows.withColumn("__place", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    placed = placed.repartitionByRange(ranges, *keys, F.col("__place")) if ranges > 1 else placed.coalesce(1)
    out = placed.sortWithinPartitions(*keys).drop("__place", *parts)
    if ranges == count:
        out.write.parquet(target)
        return
    staged = next_version(location)
    out.write.parquet(staged)
    path = spark._jvm.org.apache.hadoop.fs.Path(staged)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    # One name per range; their numbers are in the order of the ranges.
    names = [entry.getPath().getName() for entry in system.listStatus(path)]
    names = sorted((n for n in names if n.startswith("part-")), key=lambda n: [int(x) for x in re.search(r"^part-(\d+)-.*-c(\d+)", n).groups()])
    files = [names[i * len(names) // count : (i + 1) * len(names) // count] for i in range(count)]
    for at in range(0, count, _TOGETHER):
        # A union keeps the order of its inputs, and a file's scan that of its rows.
        strung = [[spark.read.schema(out.schema).parquet(f"{staged}/{n}") for n in group] for group in files[at : at + _TOGETHER] if group]
        reduce(DataFrame.unionAll, [reduce(DataFrame.unionAll, group).coalesce(1) for group in strung]).write.mode("append").parquet(target)
    system.delete(path, True)


def _point_partitions(spark: SparkSession, db: str, table: str, target: str) -> None:
    """Point the partitions of a table at the copies below `target`, as far as there are any.

    The folder names come from a short-lived table of the same shape over `target`, so that escaped
    and NULL values are spelled as Spark spelled them.
    """
    name, probe = qualified(db, table), qualified(db, f"{table}_{uuid.uuid4().hex}")
    spark.sql(f"CREATE TABLE {probe} LIKE {name} USING parquet LOCATION {sql_text(target)}")
    try:
        spark.sql(f"MSCK REPAIR TABLE {probe}")
        folders = [row[0] for row in spark.sql(f"SHOW PARTITIONS {probe}").collect()]
    finally:
        spark.sql(f"DROP TABLE {probe}")
    for folder in folders:
        clause = partition_clause(partition_values(folder))
        spark.sql(f"ALTER TABLE {name} {clause} SET LOCATION {sql_text(f'{target}/{folder}')}")
    spark.catalog.refreshTable(name)


def remove_superseded(spark: SparkSession, db: str, table: str, older_than: timedelta) -> int:
    """Delete rewritten copies of a table that it no longer uses; returns how many folders went.

    Compactions and upserts leave each copy in a folder of its own beside the table. One goes if no partition
    lies in it and nothing has been written to it for that long, which should be longer than any query runs.
    What lay in the table's own folder before the first copy stays.
    """
    used = [_plain_uri(folder) for folder, _ in table_folders(spark, qualified(db, table))]
    copies = {re.sub(r"(\.v)/[0-9a-f]{32}(/.*)?$", r"\1", folder) for folder in used}
    copies = {f"{c}.v" if not c.endswith(".v") else c for c in (re.sub(r"(/[^/=]+=[^/]*)+$", "", c) for c in copies)}
    before, gone = (datetime.now(UTC) - older_than).timestamp() * 1000, 0
    for parent in sorted(copies):
        path = spark._jvm.org.apache.hadoop.fs.Path(unquote(parent))
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            continue
        for entry in system.listStatus(path):
            folder = _plain_uri(entry.getPath().toUri().toString())
            in_use = any(f == folder or f.startswith(f"{folder}/") for f in used)
            if entry.isDirectory() and re.fullmatch("[0-9a-f]{32}", entry.getPath().getName()) and not in_use and entry.getModificationTime() < before:
                gone += system.delete(entry.getPath(), True)
    return gone

"""Scans by path: CSV as text, JSON lines with per-record types, log lines."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import quote as escaped
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.logs import parse_log
from tablewright.names import quote
from tablewright.operators.census import files_schema
from tablewright.operators.choice import open_records
from tablewright.session import materialize, ship_package

_HEAD_BYTES = 8192


def read_csv_text(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header line, every column as text. Quotes protect commas; an empty cell is NULL.

    Types are never inferred: that would turn codes such as 04109 into numbers. Columns are matched by
    the header of each file, see read_csv_named. Without `columns` all that any header names are read.
    """
    return read_csv_named(spark, paths, None if columns is None else ", ".join(f"{quote(c)} string" for c in columns))


def read_csv_named(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV files whose columns are found by name, in whatever order each file has them.

    A column that a file lacks is NULL in its rows; one that the schema doesn't name is not read. The header
    lines are read from the heads of the files, by tasks, and grouped; with one form of header, the usual
    case, the paths are read as given. Several forms are read form by form, for which the driver gets the
    names of the files. A header that names a column twice is an error, and so is a file whose header isn't
    what was found.
    """
    options = dict(options or {})
    paths = paths if isinstance(paths, str) else list(paths)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    sep, mark = options.get("sep", options.get("delimiter", ",")), options.get("quote", '"')
    heads = file_heads(spark, paths, {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup")})
    # A row for each form of header; files without a line have no columns and no rows.
    forms = heads.where("head <> ''").groupBy("head").agg(F.count("*").alias("files"), F.min("file").alias("one")).orderBy("head").collect()
    named = []
    for row in forms:
        names = next(csv.reader([row["head"]], delimiter=sep, quotechar=mark), [])
        if len(set(names)) != len(names):
            raise ValueError(f"a column is named twice in {row['head']!r}, in {row['one']}")
        named.append((row["head"], names))
    if wanted is None:
        every = dict.fromkeys(name for _, names in named for name in names)
        wanted = T.StructType([T.StructField(name, T.StringType()) for name in every])
    types = {f.name: f.dataType for f in wanted.fields}
    out = None
    for head, names in named:
        files = paths if len(named) == 1 else [unquote(r["file"]) for r in heads.where(F.col("head") == head).select("file").toLocalIterator()]
        given = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
        part = spark.read.options(**options).option("header", True).option("enforceSchema", False).schema(given).csv(files)
        part = part.select(
            *(F.col(quote(f.name)) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields)
        )
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], wanted) if out is None else out


def file_heads(spark: SparkSession, paths: str | Sequence[str], finding: Mapping[str, str] | None = None) -> DataFrame:
    """file, head: the first line of each file. Tasks open the listed files and read no more than that line.

    Where a store can't be opened from Python (only Spark reads it), the lines come from Spark's scan of the
    text, which reads the first block of each file.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    ship_package(spark)
    files = spark.read.format("binaryFile").options(**(finding or {})).load(paths)
    heads = files.select(F.col("_metadata.file_path").alias("file")).mapInArrow(_first_lines, "file string, head string")
    heads = materialize(heads, label="heads")
    if heads.where("head IS NULL").isEmpty():
        return heads
    lines = spark.read.options(**(finding or {})).text(paths)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.where("block = 0").withColumn("place", F.monotonically_increasing_id())
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("head"))
    return materialize(first.withColumn("head", F.regexp_replace("head", "^\ufeff|\r$", "")), label="heads")


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each file; NULL where its file system can't be opened from here."""

    def first_line(uri: str) -> str | None:
        try:
            # Spark escapes blanks and the like, but no letters beyond ASCII.
            system, path = pa_fs.FileSystem.from_uri(escaped(uri, safe="!#$%&'()*+,/:;=?@[]~"))
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            return None
        with system.open_input_stream(path) as stream:  # decompressed, by the name's ending
            head = b""
            while b"\n" not in head and (more := stream.read(_HEAD_BYTES)):
                head += more
        return head.split(b"\n")[0].rstrip(b"\r").decode("utf-8", "replace").removeprefix("\ufeff")

    for batch in batches:
        heads = [first_line(uri) for uri in batch.column("file").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(heads, pa.string())], names=["file", "head"])


def read_json_records(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, census: str | None = None
) -> DataFrame:
    """JSON lines, one column per field; a field with mixed types stays a VARIANT choice column.

    Without a schema the types are found in one extra pass; with a folder for the census (and one path) that
    pass only reads files that are new since the last call. A malformed line gives a row of NULLs.
    """
    raw = spark.read.option("singleVariantColumn", "record").json(paths if isinstance(paths, str) else list(paths))
    if census and not schema:
        if not isinstance(paths, str):
            raise ValueError("a census is kept for one path")
        schema = files_schema(spark, paths, census)
    return open_records(raw, "record", schema)


def read_log(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejects) of the lines of log files; see parse_log."""
    return parse_log(spark.read.text(paths if isinstance(paths, str) else list(paths)), pattern)


def listed_files(spark: SparkSession, location: str) -> DataFrame:
    """Path and size of every file below a location; the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
    return files.select("path", F.col("length").alias("file_size"))

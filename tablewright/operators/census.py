"""Which classes of values JSON files hold, counted once per file and kept.

A census has a row for each file, path and kind of value in it: the path as steps (`.name` into an object, `[]`
into an array), the kind as a variant reports it. It is taken in one pass, also through arrays and maps. Kept in
a folder, it is only taken of files that are new or have changed; what the files of today hold together is then
a distinct over rows of the census, and no record is read for it.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.names import quote
from tablewright.session import materialize

_ROWS = "file string, modified timestamp, length bigint, path array<string>, kind string"
_FILE = ["file", "modified", "length"]
# Depth that is looked into at first, and names of files that are read by one job when some are new.
_DEPTH, _NAMES = 6, 10_000

# What a file without records, and a record or value that is null, count as.
_NO_RECORD, _NULL = "FILE", "VOID"


def _kind(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    nested = F.when(kind.startswith("OBJECT"), "OBJECT").when(kind.startswith("ARRAY"), "ARRAY")
    return F.coalesce(nested, kind, F.lit(_NULL))


def _nodes(value: Column, path: Column, depth: int) -> Column:
    """(path, kind) of a value and of all values in it, each pair once."""
    kind = _kind(value)
    own = F.array(F.struct(path.alias("path"), kind.alias("kind")))
    if not depth:
        return own
    # Behind a test: a cast that fails costs an exception.
    fields = F.when(kind == "OBJECT", F.variant_get(value, "$", "map<string,variant>"))
    items = F.when(kind == "ARRAY", F.variant_get(value, "$", "array<variant>"))
    steps = F.coalesce(
        F.transform(F.map_entries(fields), lambda e: F.struct(F.concat(F.lit("."), e["key"]).alias("step"), e["value"].alias("value"))),
        F.transform(items, lambda e: F.struct(F.lit("[]").alias("step"), e.alias("value"))),
    )
    inside = F.transform(steps, lambda e: _nodes(e["value"], F.concat(path, F.array(e["step"])), depth - 1))
    return F.when(steps.isNull(), own).otherwise(F.array_distinct(F.concat(own, F.flatten(inside))))


def census(records: DataFrame, column: str, by: tuple[str, ...] = (), depth: int = _DEPTH) -> DataFrame:
    """`by`, path and kind of the values in a VARIANT column down to a depth, each combination once."""
    nodes = _nodes(F.col(quote(column)), F.array().cast("array<string>"), depth)
    return records.select(*by, F.explode(nodes).alias("node")).select(*by, "node.path", "node.kind").distinct()


def _deeper(depth: int) -> Column:
    """Whether something inside was not looked at."""
    return (F.size("path") == depth) & F.col("kind").isin("OBJECT", "ARRAY")


def record_schema(df: DataFrame, column: str) -> T.StructType:
    """The fields of the JSON records in a VARIANT column, by one pass.

    Fields with mixed types come out as VARIANT, and so do those with whole and fractional numbers (long
    and double are classes of their own), wherever they stand.
    """
    depth = _DEPTH
    while True:
        found = census(df, column, depth=depth).withColumn("deeper", _deeper(depth)).collect()
        if not any(row["deeper"] for row in found):
            return schema_of({(tuple(row["path"]), row["kind"]) for row in found})
        depth *= 2


def files_schema(spark: SparkSession, location: str, folder: str) -> T.StructType:
    """The fields of the JSON files below a location, from the census in a folder, brought up to date first.

    Files are told apart by name, time of change and length. Only the names of files that are new reach the
    driver, some at a time, and none at the first census, which reads all.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
    files = files.select(F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("modified"), "length")
    known = _stored(spark, folder)
    if known is None:
        _take(spark, files, location, folder)
    else:
        new = files.join(known.select(*_FILE).distinct(), _FILE, "left_anti")
        while batch := new.limit(_NAMES).collect():
            _take(spark, spark.createDataFrame(batch, new.schema), [unquote(row["file"]) for row in batch], folder)
            # Read anew: what was just written counts as known.
            new = files.join(_stored(spark, folder).select(*_FILE).distinct(), _FILE, "left_anti")
    now = _stored(spark, folder).join(files, _FILE, "left_semi").select("path", "kind").distinct()
    return schema_of({(tuple(row["path"]), row["kind"]) for row in now.collect()})


def _stored(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return spark.read.schema(_ROWS).parquet(folder)


def _take(spark: SparkSession, files: DataFrame, paths: str | list[str], folder: str) -> None:
    """Add the census of some files; a file that holds no record has one row."""
    raw = spark.read.option("singleVariantColumn", "record").option("recursiveFileLookup", True).json(paths)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), "record")
    depth = _DEPTH
    while True:
        found = materialize(census(raw, "record", ("file",), depth), label="census")
        if found.where(_deeper(depth)).isEmpty():
            break
        depth *= 2
    rows = files.join(found, "file", "left")
    rows = rows.select(*_FILE, F.coalesce("path", F.array().cast("array<string>")).alias("path"), F.coalesce("kind", F.lit(_NO_RECORD)).alias("kind"))
    rows.write.mode("append").parquet(folder)


def schema_of(pairs: set[tuple[tuple[str, ...], str]]) -> T.StructType:
    """The type of records that hold values of these kinds at these paths."""
    kinds: dict[tuple[str, ...], set[str]] = {}
    inside: dict[tuple[str, ...], set[str]] = {}
    for path, kind in pairs:
        if kind not in (_NO_RECORD, _NULL):
            kinds.setdefault(path, set()).add(kind)
        if path:
            inside.setdefault(path[:-1], set()).add(path[-1])
    if kinds.get((), set()) != {"OBJECT"} or not inside.get(()):
        raise ValueError(f"the records are no JSON objects but {sorted(kinds.get((), set())) or 'missing'}")
    return _type((), kinds, inside)


def _type(path: tuple[str, ...], kinds: dict[tuple[str, ...], set[str]], inside: dict[tuple[str, ...], set[str]]) -> T.DataType:
    found = kinds.get(path, set())
    if not found:  # never filled
        return T.StringType()
    if found == {"OBJECT"}:
        steps = sorted(s for s in inside.get(path, ()) if s.startswith("."))
        fields = [T.StructField(s[1:], _type((*path, s), kinds, inside)) for s in steps]
        return T.StructType(fields) if fields else T.VariantType()
    if found == {"ARRAY"}:
        return T.ArrayType(_type((*path, "[]"), kinds, inside))
    if all(_is_whole(k) for k in found):
        digits = [int(re.findall(r"\d+", k)[0]) for k in found if k != "BIGINT"]
        # Whole numbers beyond bigint stay decimals, so that they keep their digits.
        return T.DecimalType(max(19, *digits), 0) if digits else T.LongType()
    if all(not _is_whole(k) and k.startswith(("DOUBLE", "FLOAT", "DECIMAL")) for k in found):
        return T.DoubleType()
    return {"STRING": T.StringType(), "BOOLEAN": T.BooleanType()}.get(next(iter(found)), T.VariantType()) if len(found) == 1 else T.VariantType()


def _is_whole(kind: str) -> bool:
    return kind == "BIGINT" or bool(re.fullmatch(r"DECIMAL\(\d+,\s*0\)", kind))

"""A table with one row per key, written by upserts: the last write of a key replaces its row.

Rows lie in parts by the leading bits of a hash of their key. A part that has outgrown its size divides when it is
next written, it alone, by looking at one bit more; the parts are listed in the table's properties. A write puts
the parts it touches into new partitions, then changes the list, by one call to the catalog, and drops the
partitions that are no longer listed.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.names import qualified, quote, sql_text
from tablewright.operators.latest import latest_per_key
from tablewright.session import fresh_path
from tablewright.sources.files import listed_files
from tablewright.sources.schema import grow_schema
from tablewright.sources.sinks import clustered, table_order
from tablewright.sources.tables import next_version, partition_clause, partition_values, table_properties

_PART = "key_part"
_KEY, _PARTS = "tablewright.key", "tablewright.parts."
_FEWEST, _PART_BYTES = 8, 64 * 1024 * 1024
# Characters of one property, as some metastores keep no longer ones, and partitions of one statement.
_TEXT, _STATEMENT = 3500, 500
# Up to 2 ** 18 slots, some ten megabytes, are broadcast.
_BROADCAST_BITS = 18


@dataclass(frozen=True)
class Part:
    """The rows whose key's hash begins with these bits, in the partition of the write that made it."""

    bits: str
    write: str
    bytes: int

    @property
    def name(self) -> str:
        return f"{self.bits or 'all'}.{self.write}"


def read_keyed(spark: SparkSession, db: str, table: str) -> DataFrame:
    """All rows. An attribute that a row was written without is NULL."""
    name = qualified(db, table)
    return _rows(spark, name, parts_of(spark, name)).drop(_PART)


def parts_of(spark: SparkSession, name: str) -> list[Part]:
    """The parts that the table consists of, by their bits."""
    properties = table_properties(spark, name)
    texts = [properties[k] for k in sorted((k for k in properties if k.startswith(_PARTS)), key=lambda k: int(k.removeprefix(_PARTS)))]
    found = (entry.split(":") for text in texts for entry in text.split())
    return sorted((Part(bits.removeprefix("b"), write, int(size)) for bits, write, size in found), key=lambda p: p.bits)


def _rows(spark: SparkSession, name: str, parts: Iterable[Part]) -> DataFrame:
    return spark.table(name).where(F.col(_PART).isin([p.name for p in parts]))


def upsert_keyed(
    df: DataFrame,
    db: str,
    table: str,
    key: str,
    path: str,
    order_by: str | Column | Sequence[str | Column] = (),
    buckets: int | None = None,
    part_bytes: int = _PART_BYTES,
) -> None:
    """Put every row of `df` into the keyed table; a row with a known key replaces the old one whole.

    Among rows of the batch with the same key the first by `order_by` (names descending) is the last
    write. Attributes may come and go between batches, and types may grow. A NULL key fails the job.

    A new table has `buckets` parts, by default one per `part_bytes` of the batch. An upsert reads and
    rewrites only the parts its keys fall into; one of more than `part_bytes` is divided at that. A part is
    written by as many tasks, and into as many files, as its size asks for.

    Readers use `read_keyed`, which takes the parts that the table's properties list: either those before the
    upsert or those after it. A job that dies leaves the table as it was; what it added to the catalog goes
    with the next upsert. Removing old folders is up to the caller (`maintenance.remove_superseded`). A
    query planned before an upsert and run after it should be started again. Upserts into one table must
    not overlap.
    """
    spark, name = df.sparkSession, qualified(db, table)
    exists = spark.catalog.tableExists(name)
    if exists:
        known = table_properties(spark, name).get(_KEY)
        if known != key:
            raise ValueError(f"{name} is keyed by {known!r}, not {key!r}")
    checked = F.coalesce(F.col(quote(key)), F.raise_error(F.lit(f"key {key!r} is NULL")).cast(df.schema[key].dataType))
    batch = latest_per_key(df.withColumn(key, checked), key, order_by)
    # Written once: its size, the parts it touches and what goes into them must not differ.
    staged = fresh_path(spark, "upsert")
    batch.write.parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    if not exists:
        columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in batch.schema.fields)
        _create(spark, name, columns, path, key)
    have = parts_of(spark, name)
    if not have:
        if buckets is None:
            size = listed_files(spark, staged).agg(F.sum("file_size")).first()[0] or 0
            buckets = max(_FEWEST, math.ceil(size / part_bytes))
        have = [Part(bits, "none", 0) for bits in even_bits(buckets)]
    # At most as many names as there are parts reach the driver.
    touched = {row[0] for row in _located(batch, key, have).select(_PART).distinct().collect()}
    old = [p for p in have if p.bits in touched]
    if not old:
        return
    grow_schema(batch, name, [_PART])
    order = [c for c in spark.table(name).columns if c != _PART]
    new = table_order(batch, name, without=[_PART])
    before = _rows(spark, name, old).select(*(quote(c) for c in order))
    kept = before.join(new.select(quote(key)), key, "left_anti").select(*(quote(c) for c in order))
    bits = [b for p in old for b in divided(p.bits, p.bytes, part_bytes)]
    _replace(spark, name, kept.unionAll(new), key, path, [p for p in have if p.bits not in touched], bits)


def rebucket_keyed(spark: SparkSession, db: str, table: str, path: str, buckets: int) -> None:
    """Divide a keyed table into another number of parts, by writing it anew beside the old files."""
    name = qualified(db, table)
    key = table_properties(spark, name).get(_KEY)
    if key is None:
        raise ValueError(f"{name} is no keyed table")
    _replace(spark, name, read_keyed(spark, db, table), key, path, [], even_bits(buckets))


def even_bits(n: int) -> list[str]:
    """Leading bits of n parts that are as even as halving makes them."""
    depth = n.bit_length() - 1
    whole = [format(i, f"0{depth}b") if depth else "" for i in range(1 << depth)]
    more = n - len(whole)
    return [b + bit for b in whole[:more] for bit in "01"] + whole[more:]


def divided(bits: str, size: int, part_bytes: int) -> list[str]:
    """A part's own bits, or those of the parts it divides into once it is larger than it should be."""
    depth = max(0, math.ceil(math.log2(size / part_bytes))) if size > part_bytes else 0
    return [bits + (format(i, f"0{depth}b") if depth else "") for i in range(1 << depth)]


def _located(rows: DataFrame, key: str, parts: Iterable[Part]) -> DataFrame:
    """The rows with the bits of the part that their key belongs to."""
    parts = list(parts)
    depth = max(len(p.bits) for p in parts)
    ranges = [(int("0" + p.bits.ljust(depth, "0"), 2), int("0" + p.bits.ljust(depth, "1"), 2), p.bits) for p in parts]
    slots = rows.sparkSession.createDataFrame(ranges, f"first long, last long, {_PART} string")
    slots = slots.select(F.explode(F.sequence("first", "last")).alias("key_slot"), _PART)
    # A row for each slot: few go to every task; so many that they don't also divide the rows evenly.
    slots = F.broadcast(slots) if depth <= _BROADCAST_BITS else slots
    slot = F.shiftrightunsigned(F.xxhash64(quote(key)), 64 - depth) if depth else F.lit(0).cast("long")
    return rows.withColumn("key_slot", slot).join(slots, "key_slot").drop("key_slot")


def _replace(spark: SparkSession, name: str, rows: DataFrame, key: str, path: str, others: list[Part], bits: list[str]) -> None:
    """Write the rows as parts of these bits, and make them and the others the table's parts."""
    write, target = uuid.uuid4().hex[:12], next_version(path)
    named = _located(rows, key, [Part(b, write, 0) for b in bits])
    named = named.withColumn(_PART, F.concat(F.when(F.col(_PART) == "", "all").otherwise(F.col(_PART)), F.lit(f".{write}")))
    # Brought together by part; a part too large for one task is divided among several.
    clustered(named, [_PART]).write.partitionBy(_PART).parquet(target)
    size = listed_files(spark, target).groupBy(F.regexp_extract("path", f"/{_PART}=([^/]*)/", 1)).agg(F.sum("file_size"))
    sizes = dict(map(tuple, size.collect()))
    made = [Part(b, write, 0) for b in bits]
    made = [Part(p.bits, write, sizes.get(p.name, 0)) for p in made]
    _statements(spark, name, "ADD IF NOT EXISTS", " ", [
        f"{partition_clause({_PART: p.name})} LOCATION {sql_text(f'{target}/{_PART}={p.name}')}" for p in made if p.bytes
    ])
    _commit(spark, name, [*others, *made])
    listed = {p.name for p in [*others, *made]}
    there = (partition_values(row[0])[_PART] for row in spark.sql(f"SHOW PARTITIONS {name}").collect())
    _statements(spark, name, "DROP IF EXISTS", ", ", [partition_clause({_PART: p}) for p in there if p not in listed])
    spark.catalog.refreshTable(name)


def _statements(spark: SparkSession, name: str, verb: str, between: str, partitions: list[str]) -> None:
    for at in range(0, len(partitions), _STATEMENT):
        spark.sql(f"ALTER TABLE {name} {verb} {between.join(partitions[at : at + _STATEMENT])}")


def _commit(spark: SparkSession, name: str, parts: list[Part]) -> None:
    """List the parts in the table's properties, all by one call."""
    texts = [""]
    for p in sorted(parts, key=lambda p: p.bits):
        entry = f"b{p.bits}:{p.write}:{p.bytes}"
        if len(texts[-1]) + len(entry) >= _TEXT:
            texts.append("")
        texts[-1] = f"{texts[-1]} {entry}".strip()
    before = sum(k.startswith(_PARTS) for k in table_properties(spark, name))
    texts += [""] * (before - len(texts))
    listed = ", ".join(f"{sql_text(f'{_PARTS}{i}')} = {sql_text(text)}" for i, text in enumerate(texts))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def _create(spark: SparkSession, name: str, columns: str, path: str, key: str) -> None:
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {_PART} string) USING parquet PARTITIONED BY ({_PART}) "
        f"LOCATION {sql_text(path)} TBLPROPERTIES ({sql_text(_KEY)} = {sql_text(key)})"
    )

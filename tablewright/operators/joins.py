"""Enrichment by equi-joins. The join strategy is left to AQE, which sees the real sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.names import quote

# A key is heavy with a share of a thousandth of the rows; the rows of one key are cut in pieces of a share of a
# 256th at most. So there are a thousand heavy keys at most, found by a sketch of that many times ten.
_HEAVY, _PIECES = 1000, 256


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def enrich(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    columns: Sequence[str | tuple[str, str]],
    how: str = "left",
) -> DataFrame:
    """`df` with columns of `dim`, given as a name or as (path, alias) such as ("address.city", "city").

    Only those columns are read. No broadcast is forced: Spark broadcasts a side that is below its
    size threshold and splits skewed partitions of a sort-merge join otherwise. It splits none of a full
    outer join; there the keys are counted first (one pass over the keys of each side, by a frequency
    sketch), and rows of heavy keys are joined piece by piece.
    """
    if how not in ("left", "inner", "right", "full"):
        raise ValueError(f"unknown kind of join {how!r}")
    keys = _keys(on)
    taken = [
        F.col(quote(c) if c in dim.columns else c).alias(c) if isinstance(c, str) else F.col(c[0]).alias(c[1])
        for c in columns
    ]
    side = dim.select(*(F.col(quote(k)) for k in keys), *taken)
    twice = set(side.columns[len(keys):]) & set(df.columns)
    if twice:
        raise ValueError(f"columns {sorted(twice)} are on both sides; give them an alias")
    return _full(df, side, keys) if how == "full" else df.join(side, keys, how)


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*(F.col(quote(k)) for k in keys))


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> dict[int, int]:
    """Hashes of the keys that hold a large share of the rows, and the pieces their rows are cut in.

    The sketches of all tasks are merged; a row of at most a thousand hashes reaches the driver. Null keys
    don't count.
    """
    found = df.dropna(subset=list(keys)).select(_hash(keys).alias("h"))
    row = found.agg(F.expr(f"approx_top_k(h, {_HEAVY}, {10 * _HEAVY})").alias("top"), F.count("*").alias("n")).first()
    pieces = {e["item"]: -(-e["count"] * _PIECES // row["n"]) for e in row["top"] or () if e["count"] * _HEAVY >= row["n"]}
    return {h: n for h, n in pieces.items() if n > 1}


def _full(df: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """The full outer join as parts that no heavy key holds up.

    Rows with a null key match nothing, so they take no part in a join. Rows whose key is heavy on either side are
    cut in pieces there, each of which meets all rows of that key of the other side; whoever of the other side
    finds no partner at all is added. Which keys count as heavy changes the plan, not the result.
    """
    spark = df.sparkSession
    # Hashes tell keys apart, so both sides need the type that the join compares by.
    common = df.select(*(quote(k) for k in keys)).unionAll(side.select(*(quote(k) for k in keys))).schema
    df, side = (x.withColumns({k: F.col(quote(k)).cast(common[k].dataType) for k in keys}) for x in (df, side))
    order = [*keys, *(c for c in df.columns if c not in keys), *(c for c in side.columns if c not in keys)]
    types = {f.name: f.dataType for frame in (side, df) for f in frame.schema.fields}

    def filled(frame: DataFrame) -> DataFrame:
        return frame.select(*(F.col(quote(c)) if c in frame.columns else F.lit(None).cast(types[c]).alias(c) for c in order))

    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(quote(k)).isNotNull()
    heavy = [heavy_keys(df, keys), heavy_keys(side, keys)]
    heavy[1] = {h: n for h, n in heavy[1].items() if h not in heavy[0]}
    every = [h for own in heavy for h in own]
    rest = complete & ~_hash(keys).isin(every) if every else complete
    parts = [df.where(rest).join(side.where(rest), keys, "full"), filled(df.where(~complete)), filled(side.where(~complete))]
    for own, (large, other) in zip(heavy, ((df, side), (side, df)), strict=True):
        if not own:
            continue
        pieces = spark.createDataFrame(list(own.items()), "enrich_hash long, enrich_pieces int")
        many, few = (x.withColumn("enrich_hash", _hash(keys)).where(complete).join(F.broadcast(pieces), "enrich_hash") for x in (large, other))
        # Rows that are alike may be many, too: the task they are in tells them apart.
        place = F.xxhash64(*(F.col(quote(c)) for c in large.columns if not _is_map(large, c))) + F.spark_partition_id()
        many = many.withColumn("enrich_piece", F.pmod(place, F.col("enrich_pieces")).cast("int")).drop("enrich_hash", "enrich_pieces")
        copies = few.withColumn("enrich_piece", F.explode(F.sequence(F.lit(0), F.col("enrich_pieces") - 1))).drop("enrich_hash", "enrich_pieces")
        parts.append(filled(many.join(copies, [*keys, "enrich_piece"], "left")))
        parts.append(filled(unmatched(few.drop("enrich_hash", "enrich_pieces"), large.where(_hash(keys).isin(list(own))), keys)))
    out = parts[0].select(*(quote(c) for c in order))
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _is_map(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType.simpleString()
    return "map<" in kind or "variant" in kind


def unmatched(dim: DataFrame, df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of `dim` without a partner in `df`.

    The keys of `df` are reduced to distinct ones first; that happens before the shuffle, so a
    frequent key travels once per task and not once per row.
    """
    keys = _keys(on)
    return dim.join(df.select(*(F.col(quote(k)) for k in keys)).distinct(), keys, "left_anti")

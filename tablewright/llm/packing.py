"""Best-fit packing of token pieces into sequences of a fixed capacity, in bulk-synchronous rounds.

Every round sorts the unplaced pieces and the open gaps together by size over range partitions (ties split
by id, so a size that a third of all pieces share still spreads over many partitions). Each partition is
swept once, upwards: a gap takes the largest piece below it that is still free, which is the piece whose
smallest fitting gap it is, and goes on with what remains of it. Gaps that find no piece inside their
partition and pieces that find no gap are ranked there, and ranks decide between the partitions: gaps of
higher partitions take the largest free pieces of lower ones. Then the next round begins with the gaps as
they are now; as rows get fewer, so do the partitions. A gap without a piece can't get one later, since all pieces that fit
are placed, and is closed. When no gap is left, new sequences are opened for the rest.

Many tiny pieces would need many rounds, one per piece of a sequence: beyond eight of them per sequence,
tiny pieces are first strung together to bundles of at most a quarter of the capacity. Some stay single, to
fill up gaps. No piece is dropped or cut for it.

Pieces longer than the capacity are refused; cutting is `pieces`' work. An empty table gives an empty
result. Equal sizes are told apart by id; repeated documents are packed as often as they come.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.bpe import encoder
from tablewright.llm.flat import flat_text, give_back, slices
from tablewright.session import materialize

CAPACITY = 4096
SINGLES_PER_BIN = 8

ROWS_PER_PARTITION = 100_000
FEW_PARTITIONS = 64

_SWEPT = "part int, kind string, idx long, item long, size int, bin long, gap int, last boolean"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Documents as token pieces: doc_id, piece (from 0), start, length, ids_crc32.

    A document's ids are those of its text (null: empty) and `end_id`. Only what is longer than `capacity`
    is cut, every `capacity` ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=1 << 20):
            ids, offsets = encoder(path).encode(*flat_text(batch.column("text")))
            raw, end = ids.astype("<u4").tobytes(), int(end_id).to_bytes(4, "little")
            row, piece, start, length, crc = [], [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                n = b - a + 1
                for k, at in enumerate(range(0, n, capacity)):
                    size = min(capacity, n - at)
                    last = at + size == n
                    code = zlib.crc32(raw[4 * (a + at) : 4 * (a + at + size - last)])
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(end, code) if last else code)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
                + [pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
            del ids, offsets, raw
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fill each gap with the largest free pieces before it; rows come by size, pieces before gaps.

    `last` marks the last piece that a gap took.
    """
    part = TaskContext.get().partitionId()
    free_items: list[int] = []
    free_sizes: list[int] = []  # ascending
    lonely = 0

    def table(kind: str, idx, item, size, bins, gap, last) -> pa.RecordBatch:
        n = len(item)
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.string()), pa.array(idx, pa.int64()), pa.array(item, pa.int64())]
            + [pa.array(size, pa.int32()), pa.array(bins, pa.int64()), pa.array(gap, pa.int32()), pa.array(last, pa.bool_())],
            names=["part", "kind", "idx", "item", "size", "bin", "gap", "last"],
        )

    for batch in batches:
        pairs, gaps = [], []
        for size, is_gap, key in zip(*(batch.column(c).to_pylist() for c in ("size", "is_gap", "id")), strict=True):
            if not is_gap:
                free_items.append(key)
                free_sizes.append(size)
                continue
            before = len(pairs)
            while (at := bisect_right(free_sizes, size)) > 0:
                pairs.append((free_items.pop(at - 1), free_sizes.pop(at - 1), key, size, False))
                size -= pairs[-1][1]
            if len(pairs) > before:
                pairs[-1] = (*pairs[-1][:4], True)
            else:
                gaps.append((lonely, key, size))
                lonely += 1
        if pairs:
            item, size, bins, gap, last = zip(*pairs, strict=True)
            yield table("pair", [0] * len(item), item, size, bins, gap, last)
        if gaps:
            idx, bins, gap = zip(*gaps, strict=True)
            yield table("gap", idx, [None] * len(idx), [None] * len(idx), bins, gap, [None] * len(idx))
    for at in range(0, len(free_items), 10_000):
        item, size = free_items[at : at + 10_000], free_sizes[at : at + 10_000]
        yield table("piece", range(at, at + len(item)), item, size, *[[None] * len(item)] * 3)


def _between_partitions(left: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, int, int, int, int]]:
    """By partition (pieces left, gaps left): which ranks of pieces meet which ranks of gaps.

    (number, piece partition, first piece rank, end, gap partition, first gap rank, end); a gap's rank counts
    up while its piece's counts down.
    """
    stack: list[list[int]] = []
    found = []
    for part in sorted(left):
        n_pieces, n_gaps = left[part]
        taken = 0
        while taken < n_gaps and stack:
            owner, count = stack[-1]
            n = min(count, n_gaps - taken)
            found.append((len(found), owner, count - n, count, part, taken, taken + n))
            taken += n
            stack[-1][1] -= n
            if not stack[-1][1]:
                stack.pop()
        if n_pieces:
            stack.append([part, n_pieces])
    return found


def _round(spark: SparkSession, items: DataFrame, bins: DataFrame, rows: int) -> DataFrame:
    """All items, each with the bin and gap it got in this round, or null; `last` where a bin got no more."""
    both = items.select("size", F.lit(False).alias("is_gap"), F.col("item").alias("id")).unionAll(
        bins.select(F.col("gap").alias("size"), F.lit(True).alias("is_gap"), F.col("bin").alias("id"))
    )
    # Size, kind and a hash of the id as one number: equal sizes are ordered, and split, by the hash.
    key = F.shiftleft(F.col("size").cast("long"), 40) + F.when(F.col("is_gap"), 1 << 39).otherwise(0)
    both = both.withColumn("key", key + F.xxhash64("id").bitwiseAND((1 << 39) - 1))
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION))
    if parts <= FEW_PARTITIONS:
        # So few bounds can be compared one by one, which gives exactly as many partitions as rows ask for.
        share = [i / parts for i in range(1, parts)]
        bounds = both.agg(F.percentile_approx("key", share, 10_000)).first()[0] if share else []
        number = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("key"))) if bounds else F.lit(0)
        ranged = both.repartitionById(parts, number)
    else:
        ranged = both.repartitionByRange(parts, "key")
    ranged = ranged.sortWithinPartitions("key")
    swept = materialize(ranged.mapInArrow(_sweep, _SWEPT), label="sweep")
    # One row per partition, however many pieces there are.
    counts = swept.where("kind <> 'pair'").groupBy("part").agg(F.count_if(F.col("kind") == "piece"), F.count_if(F.col("kind") == "gap"))
    links = _between_partitions({part: (p, g) for part, p, g in counts.collect()})
    pairs = swept.where("kind = 'pair'").select("item", "size", "bin", "gap", "last")
    lonely = swept.where("kind = 'piece'")
    if not links:
        return pairs.unionAll(lonely.select("item", "size", "bin", "gap", "last"))
    # At most two rows per partition.
    link = F.broadcast(spark.createDataFrame(links, "no long, p_part int, p_from long, p_to long, g_part int, g_from long, g_to long"))
    mine = lonely.join(link, (F.col("part") == F.col("p_part")) & (F.col("idx") >= F.col("p_from")) & (F.col("idx") < F.col("p_to")), "left")
    mine = mine.select("item", "size", "no", (F.col("p_to") - 1 - F.col("idx")).alias("rank"))
    theirs = swept.where("kind = 'gap'").join(
        link, (F.col("part") == F.col("g_part")) & (F.col("idx") >= F.col("g_from")) & (F.col("idx") < F.col("g_to"))
    )
    theirs = theirs.select("no", (F.col("idx") - F.col("g_from")).alias("rank"), "bin", "gap")
    crossed = mine.join(theirs, ["no", "rank"], "left").select("item", "size", "bin", "gap", F.lit(True).alias("last"))
    return pairs.unionAll(crossed)


def _bundles(items: DataFrame, capacity: int, share: float) -> DataFrame:
    """The given share of the tiny items, strung together: item, bundle, inner, size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, filled = None, 0
        for batch in batches:
            item, size = batch.column("item").to_pylist(), batch.column("size").to_pylist()
            owner, inner = [], []
            for i, n in zip(item, size, strict=True):
                if bundle is None or filled + n > capacity // 4:
                    bundle, filled = i, 0
                owner.append(bundle)
                inner.append(filled)
                filled += n
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array(owner, pa.int64()), pa.array(inner, pa.int32()), batch.column("size")],
                names=["item", "bundle", "inner", "size"],
            )

    tiny = items.where((F.col("size") <= capacity // 16) & (F.pmod(F.xxhash64("item"), F.lit(1_000_000)) < int(share * 1_000_000)))
    return tiny.select("item", "size").mapInArrow(run, "item long, bundle long, inner int, size int")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`items` (item: a unique long, size: int from 1 to capacity) to item, sequence_id, offset.

    Sequences that one piece fills have negative numbers, the others count from 0.
    """
    spark = items.sparkSession
    items = materialize(items.select(F.col("item").cast("long"), F.col("size").cast("int")), label="items")
    bad, n_tiny, total = items.agg(
        F.count_if(~F.col("size").between(1, capacity) | F.col("size").isNull()),
        F.count_if(F.col("size") <= capacity // 16),
        F.sum(F.when(F.col("size") < capacity, F.col("size").cast("long"))),
    ).first()
    if bad:
        raise ValueError(f"{bad} sizes are not from 1 to {capacity}")
    full = items.where(F.col("size") == capacity).select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_items = items.where(F.col("size") < capacity)
    n_bins = math.ceil((total or 0) / capacity)
    bundled = None
    if n_tiny > 2 * SINGLES_PER_BIN * max(n_bins, 1):
        bundled = materialize(_bundles(open_items, capacity, 1 - SINGLES_PER_BIN * n_bins / n_tiny), label="bundles")
        whole = bundled.groupBy("bundle").agg(F.sum("size").cast("int").alias("size"))
        single = open_items.join(bundled.select("item"), "item", "left_anti")
        # A bundle's number is that of its first item, which is no single.
        open_items = single.unionAll(whole.select(F.col("bundle").alias("item"), "size"))
    placed, first_bin = [], 0
    remaining = (total or 0) > 0
    n_rows = open_items.count()
    bins = None
    while remaining:
        if bins is None:
            bins = spark.range(first_bin, first_bin + n_bins).select(F.col("id").alias("bin"), F.lit(capacity).alias("gap"))
            first_bin += n_bins
            n_rows += n_bins
        result = materialize(_round(spark, open_items, bins, n_rows), label="round")
        n_open, n_left, left = result.agg(
            F.count_if(F.col("bin").isNotNull() & F.col("last") & (F.col("gap") > F.col("size"))), F.count_if(F.col("bin").isNull()), F.sum(F.when(F.col("bin").isNull(), F.col("size").cast("long")))
        ).first()
        got = result.where("bin IS NOT NULL")
        placed.append(got.select("item", F.col("bin").alias("sequence_id"), (capacity - F.col("gap")).cast("long").alias("offset")))
        open_items, remaining = result.where("bin IS NULL").select("item", "size"), n_left > 0
        bins = got.where("last").select("bin", (F.col("gap") - F.col("size")).alias("gap")).where("gap > 0") if n_open else None
        n_rows = n_left + n_open
        n_bins = math.ceil((left or 0) / capacity)
    for part in placed:
        full = full.unionAll(part)
    if bundled is None:
        return full
    inside = bundled.join(full.withColumnRenamed("item", "bundle"), "bundle")
    inside = inside.select("item", "sequence_id", (F.col("offset") + F.col("inner")).alias("offset"))
    return full.join(bundled.select("item"), "item", "left_anti").unionAll(inside)


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of every document."""
    cut = pieces(docs, path, capacity, end_id).withColumn("item", F.monotonically_increasing_id())
    cut = materialize(cut, label="pieces")
    placed = pack(cut.select("item", F.col("length").alias("size")), capacity)
    return cut.join(placed, "item").drop("item")

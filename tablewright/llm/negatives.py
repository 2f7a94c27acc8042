"""Hard-negative mining with exact scores by the method of the Four Russians.

Vectors become integers, floor(scale * x), and travel as bit planes: for each plane of the two's complement one
bit per dimension, eight dimensions packed in a byte. For every group of eight dimensions an anchor has a table
of the sums of all 256 subsets of its components there. A candidate's byte of a plane is the index of its subset,
so one lookup adds up to eight products; planes are put together by shift and add, the sign plane counts
negative. The result is the full inner product, exact, without multiplying any two components.

Anchors and rows meet in cells of a grid (chunks of rows by groups of anchors), each a task of bounded size. The
grid is gone through twice: first each cell hands on the best rows of an anchor's own label, which are merged to
its positives; then, with the positives' scores known, the best rows of other labels inside each positive's
window. Chunks are dealt by a hash of the row, so neither a label nor an id that many rows share makes one
larger. A cell returns k rows per question at most, which are merged by question.

Rows with a null id, label or vector, or with null or non-finite components, take no part; vectors meet others of
their own length only, and an empty vector meets none. Rows repeated with the same id, label and vector count
once; other rows that share an id are rows of their own, none of them a partner of an anchor of that id (an
anchor id with several rows is mined for each). Ties go to the smaller id. A score that a long can't hold raises
an error rather than wrapping around. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import materialize

# Rows and anchors of a cell at most, and anchors whose tables are held at once.
CHUNK, GROUP, TABLES = 16_384, 4096, 32
# Bits of a component at most, the sign among them.
MOST_BITS = 62


def pack(rows: np.ndarray) -> list[bytes]:
    """Each row of whole numbers as bit planes, lowest first, the sign plane last; as few planes as the row needs."""
    n, dims = rows.shape
    groups = -(-dims // 8)
    size = np.maximum(rows, ~rows).max(axis=1)
    planes = np.array([int(x).bit_length() + 1 for x in size.tolist()])
    out: list[bytes] = [b""] * n
    for p in np.unique(planes).tolist():
        at = np.flatnonzero(planes == p)
        bits = ((rows[at][:, None, :] >> np.arange(p)[None, :, None]) & 1).astype(np.uint8)
        packed = np.packbits(bits, axis=2, bitorder="little").reshape(len(at), p * groups)
        for i, row in zip(at.tolist(), packed, strict=True):
            out[i] = row.tobytes()
    return out


def unpack(packed: np.ndarray, dims: int) -> np.ndarray:
    """Whole numbers from rows of bit planes (rows by planes by groups)."""
    bits = np.unpackbits(packed, axis=2, bitorder="little")[:, :, :dims].astype(np.int64)
    weight = np.int64(1) << np.arange(packed.shape[1], dtype=np.int64)
    weight[-1] = -weight[-1]
    return np.einsum("npd,p->nd", bits, weight)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Anchors by groups of eight dimensions by 256: the sum of each subset of a group's components."""
    m, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((m, groups * 8), anchors.dtype)
    padded[:, :dims] = anchors
    padded = padded.reshape(m, groups, 8)
    sums = np.zeros((m, groups, 1), anchors.dtype)
    for bit in range(8):  # those with the bit are those without it, plus its component
        sums = np.concatenate([sums, sums + padded[:, :, bit : bit + 1]], axis=2)
    return sums


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products, anchors by rows. `planes`: planes by groups by rows, bytes as indices."""
    m, groups, _ = tables.shape
    total = np.zeros((m, planes.shape[2]), tables.dtype)
    looked = np.empty_like(total)
    for p in range(len(planes) - 1, -1, -1):
        total <<= 1
        for g in range(groups):
            np.take(tables[:, g], planes[p, g], axis=1, out=looked, mode="clip")
            if p == len(planes) - 1:
                total -= looked
            else:
                total += looked
    return total


class Rows:
    """The rows of a cell, ordered by id, as planes of bytes for each number of planes."""

    def __init__(self, table: pa.Table, dims: int) -> None:
        groups = -(-dims // 8)
        self.id, self.label = table["id"].to_numpy(), table["label"].to_numpy()
        order = np.argsort(self.id, kind="stable")
        self.id, self.label = self.id[order], self.label[order]
        column = table["packed"].combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        raw = column.to_pylist()
        size = np.array([len(x) for x in raw], np.int64)[order] if raw else np.zeros(0, np.int64)
        self.parts = []
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            data = np.frombuffer(b"".join(raw[i] for i in order[at]), np.uint8).reshape(len(at), n // groups, groups)
            self.parts.append((at, data))
        self.dims = dims

    def numbers(self) -> np.ndarray:
        found = np.zeros((len(self.id), self.dims), np.int64)
        for at, data in self.parts:
            found[at] = unpack(data, self.dims)
        return found

    def indices(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(at, np.ascontiguousarray(data.transpose(1, 2, 0)).astype(np.intp)) for at, data in self.parts]

    def most(self) -> int:
        """A bound of the components' absolute values."""
        return 1 << max((data.shape[1] - 1 for _, data in self.parts), default=0)


def scored(anchors: np.ndarray, rows: Rows) -> Iterator[tuple[int, np.ndarray]]:
    """(first anchor, scores of some anchors with all rows), block by block."""
    indices, most = rows.indices(), rows.most()
    reach = max((sum(map(abs, a)) for a in anchors.tolist()), default=0) * most
    if reach >= 1 << 63:
        raise ValueError(f"inner products up to {reach} don't fit a long; use a smaller scale")
    kind = np.int32 if reach < 1 << 30 else np.int64
    for begin in range(0, len(anchors), TABLES):
        tables = subset_sums(anchors[begin : begin + TABLES].astype(kind))
        found = np.empty((len(tables), len(rows.id)), kind)
        for at, planes in indices:
            found[:, at] = scores(tables, planes)
        yield begin, found.astype(np.int64)


def best(score: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Line and column of the k best valid scores of each line (with ties, in order of column), best first."""
    n = score.shape[1]
    least = np.iinfo(np.int64).min
    masked = np.where(valid, score, least)
    if n > k:
        kth = np.partition(masked, n - k, axis=1)[:, n - k]
        line, column = np.nonzero(valid & (masked >= kth[:, None]))
    else:
        line, column = np.nonzero(valid)
    order = np.lexsort((column, -score[line, column], line))
    line, column = line[order], column[order]
    place = np.arange(len(line)) - np.searchsorted(line, line)
    return line[place < k], column[place < k]


def _packed(rows: DataFrame, scale: int, vector: str, id: str, label: str) -> DataFrame:
    """id, label, dims, packed: the different usable rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if len(values) and np.abs(values).max() >= 2.0 ** (MOST_BITS - 1):
                raise ValueError(f"components times {scale} need more than {MOST_BITS} bits; use a smaller scale")
            values, starts = values.astype(np.int64), np.cumsum(lengths) - lengths
            out: list[bytes] = [b""] * batch.num_rows
            for dims in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dims)
                for i, packed in zip(at.tolist(), pack(values[starts[at][:, None] + np.arange(dims)]), strict=True):
                    out[i] = packed
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(lengths, pa.int32()), pa.array(out, pa.binary())], names=["id", "label", "dims", "packed"]
            )

    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    return usable.mapInArrow(run, "id long, label long, dims int, packed binary").distinct()


def hard_negatives(
    rows: DataFrame,
    is_anchor: Callable[[Column], Column],
    positives: int = 5,
    k: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    vector: str = "embedding",
    id: str = "vec_id",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    `is_anchor` says from a row's id whether it is an anchor. An anchor's positives are the rows of its
    label that score best; each positive's negatives are the k best rows of other labels whose score is from
    `low` to `high` percent of the positive's.
    """
    every = materialize(_packed(rows, scale, vector, id, label), label="planes")
    asked = materialize(every.where(is_anchor(F.col("id"))).withColumn("key", F.monotonically_increasing_id()), label="anchors")
    counts, dims = (every.count(), asked.count()), every.agg(F.max("dims")).first()[0] or 1
    # The side of a cell grows with the root of the rows until it has its full size, less for long vectors.
    chunk = max(256, min(CHUNK, (1 << 20) // dims, 4 * math.isqrt(counts[0])))
    chunks, groups = max(1, -(-counts[0] // chunk)), max(1, -(-counts[1] // GROUP))
    dealt = F.pmod(F.xxhash64("id", "label", "packed"), F.lit(chunks)).cast("int")
    deal = every.withColumn("chunk", dealt).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    named = asked.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))

    def to_chunks(anchors: DataFrame) -> DataFrame:
        return anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    cell = ("dims", "chunk", "group")

    def same_label(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if mine.num_rows and theirs.num_rows:
            have, asking = Rows(mine, mine["dims"][0].as_py()), Rows(theirs, mine["dims"][0].as_py())
            names = theirs["key"].to_numpy()[np.argsort(theirs["id"].to_numpy(), kind="stable")]
            for begin, score in scored(asking.numbers(), have):
                own = slice(begin, begin + len(score))
                valid = (asking.label[own][:, None] == have.label) & (asking.id[own][:, None] != have.id)
                line, column = best(score, valid, positives)
                for out, part in zip(found, (names[own][line], have.id[column], score[line, column]), strict=True):
                    out.append(part)
        return _longs(found, ("key", "positive_id", "positive_score"))

    left = deal.groupBy(*cell)
    near = left.cogroup(to_chunks(named).groupBy(*cell)).applyInArrow(same_label, "key long, positive_id long, positive_score long")
    near = _first(near, ["key"], ["positive_score", "positive_id"], positives).drop("rank")
    pairs = near.groupBy("key").agg(F.collect_set(F.struct("positive_score", "positive_id")).alias("positives"))
    pairs = materialize(named.join(pairs, "key"), label="positives")

    def other_label(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], [], [], []]
        if mine.num_rows and theirs.num_rows:
            have, asking = Rows(mine, mine["dims"][0].as_py()), Rows(theirs, mine["dims"][0].as_py())
            order = np.argsort(theirs["id"].to_numpy(), kind="stable")
            names = theirs["key"].to_numpy()[order]
            lists = [theirs["positives"][int(i)].as_py() for i in order]
            for begin, score in scored(asking.numbers(), have):
                own = slice(begin, begin + len(score))
                other = (asking.label[own][:, None] != have.label) & (asking.id[own][:, None] != have.id)
                at = np.repeat(np.arange(len(score)), [len(x) for x in lists[own]])
                pair = [(p["positive_id"], p["positive_score"]) for x in lists[own] for p in x]
                partner, top = (np.array(x, np.int64) for x in zip(*pair, strict=True))
                for a in range(0, len(at), TABLES):
                    part = slice(a, a + TABLES)
                    seen = score[at[part]]
                    valid = other[at[part]] & _inside(seen, top[part][:, None], low, high)
                    line, column = best(seen, valid, k)
                    which = line + a
                    for out, values in zip(found, (names[own][at[which]], partner[which], top[which], have.id[column], seen[line, column]), strict=True):
                        out.append(values)
        return _longs(found, ("key", "positive_id", "positive_score", "negative_id", "negative_score"))

    hard = deal.groupBy(*cell).cogroup(to_chunks(pairs).groupBy(*cell))
    hard = hard.applyInArrow(other_label, "key long, positive_id long, positive_score long, negative_id long, negative_score long")
    hard = _first(hard, ["key", "positive_id", "positive_score"], ["negative_score", "negative_id"], k)
    hard = hard.join(pairs.select("key", F.col("id").alias("anchor_id")), "key")
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _inside(score: np.ndarray, top: np.ndarray, low: int, high: int) -> np.ndarray:
    """low * top <= 100 * score <= high * top, in whole numbers that don't overflow."""
    ends = [(-(-low * x // 100), high * x // 100) for x in top.ravel().tolist()]
    at_least, at_most = (np.array([min(max(e[i], -(1 << 63)), (1 << 63) - 1) for e in ends], np.int64) for i in (0, 1))
    return (score >= at_least.reshape(top.shape)) & (score <= at_most.reshape(top.shape))


def _longs(found: list[list[np.ndarray]], names: tuple[str, ...]) -> pa.Table:
    return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *x]), pa.int64()) for x in found], names=list(names))


def _first(found: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The k first rows of each group: highest score, then smallest id."""
    window = Window.partitionBy(*by).orderBy(F.desc(order[0]), order[1])
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)

"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors become integers, floor(scale * x). A vector is cut into 1, 4, then 16 segments, each known by its mean
and standard deviation. By Cauchy and Schwarz a segment of length l adds at most
l (mean_q mean_x + dev_q dev_x) to the inner product - the same statement as the lower bound
l ((mean_q - mean_x)^2 + (dev_q - dev_x)^2) of the squared distance. From coarse to fine, candidates whose
bound is below the k-th best score so far are dropped; survivors are scored exactly.

Queries and rows meet in cells of a grid (row chunks by query groups), each one task of bounded size: no task
sees all rows or all queries. Each cell returns k rows per query at most, which are merged by query.

Vectors that are null or hold null or non-finite components, and rows without id, take no part; a query
meets vectors of its own length only. Scores are exact as long as a long holds them; beyond, an error is raised
rather than a number that has wrapped around. Rows repeated with the same id and vector count once; if a query id has several vectors, either may score. Ties go to the smaller id. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = (1, 4, 16)
SEEDS = 4


def _statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that a product of two rows bounds their inner product."""
    edges = np.linspace(0, rows.shape[1], segments + 1).astype(int)
    lengths = np.diff(edges)
    sums = np.add.reduceat(rows, edges[:-1], axis=1)
    squares = np.add.reduceat(rows * rows, edges[:-1], axis=1)
    means = sums / lengths
    deviations = np.sqrt(np.maximum(squares / lengths - means**2, 0))
    return np.concatenate([means, deviations], axis=1) * np.sqrt(np.r_[lengths, lengths])


def search(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[list, list, list]:
    """Each query's k best rows (integers, one vector a row): query ids, row ids, scores."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    if len(ids) > 1 and (ids[1:] == ids[:-1]).any():
        both, first = np.unique(np.c_[ids, rows], axis=0, return_index=True)
        ids, rows = ids[np.sort(first)], rows[np.sort(first)]
    wide = rows.astype(np.float64)
    # Whole numbers are exact in doubles up to 2 ** 53; beyond, integers are multiplied.
    reach = float(np.abs(wide).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1]
    safe = reach < 2**53
    if reach >= 2**63:
        raise ValueError(f"inner products of up to {reach:.3g} may not fit a long; use a smaller scale")
    levels = [s for s in SEGMENTS if s <= rows.shape[1]]
    mine = [_statistics(wide, s) for s in levels]
    theirs = [_statistics(queries.astype(np.float64), s) for s in levels]
    slack = 1e-9 * np.sqrt((wide**2).sum(axis=1).max(initial=0))

    def exact(at: np.ndarray, j: int) -> np.ndarray:
        return np.rint(wide[at] @ queries[j].astype(np.float64)).astype(np.int64) if safe else rows[at] @ queries[j]

    out: tuple[list, list, list] = ([], [], [])
    for j, own in enumerate(query_ids):
        loose = slack * np.sqrt((queries[j].astype(np.float64) ** 2).sum()) + 1e-6
        left = np.flatnonzero(ids != own)
        least = None  # the k-th best score so far
        for stats, wanted in zip(mine, theirs, strict=True):
            bound = stats[left] @ wanted[j] + loose
            if least is not None:
                keep = bound >= least
                left, bound = left[keep], bound[keep]
            if len(left) <= SEEDS * k:
                break
            seeds = left[np.argpartition(-bound, SEEDS * k)[: SEEDS * k]]
            score = np.partition(exact(seeds, j), -k)[-k]
            least = score if least is None else max(least, score)
            left = left[bound >= least]
        scores = exact(left, j)
        best = np.lexsort((ids[left], -scores))[:k]
        out[0].extend([int(own)] * len(best))
        out[1].extend(ids[left][best].tolist())
        out[2].extend(scores[best].tolist())
    return out


def _vectors(table: pa.Table, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and whole-number rows by length of the vectors."""
    column = table.column("vector").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(values) and np.abs(values).max() >= 2.0**62:
        raise ValueError(f"components times {scale} don't fit a long; use a smaller scale")
    values = values.astype(np.int64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    starts, ids = np.cumsum(lengths) - lengths, table.column("id").to_numpy()
    found = {}
    for n in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == n)
        found[n] = (ids[rows], values[starts[rows][:, None] + np.arange(n)])
    return found


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, vector: str = "embedding", id: str = "vec_id", group_queries: int = 4096
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k rows of largest inner product."""
    spark = rows.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.where(F.col(id).isNotNull() & F.col(vector).isNotNull() & finite).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))

    n_rows, n_queries = rows.count(), queries.count()
    per_chunk = min(max(n_rows // int(spark.conf.get("spark.sql.shuffle.partitions")), 1024), 65_536)
    chunks, groups = -(-n_rows // per_chunk) or 1, -(-n_queries // group_queries) or 1

    def grid(df: DataFrame, name: str, size: int, other: str, others: int) -> DataFrame:
        dealt = usable(df).withColumn(name, F.pmod(F.monotonically_increasing_id(), F.lit(size)).cast("int"))
        return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).select("chunk", "group", "id", "vector")

    def cell(mine: pa.Table, asked: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if mine.num_rows and asked.num_rows:
            have = _vectors(mine, scale)
            for n, (query_ids, wanted) in _vectors(asked, scale).items():
                if n in have:
                    for whole, part in zip(found, search(*have[n], query_ids, wanted, k), strict=True):
                        whole.extend(part)
        return pa.table([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])

    left = grid(rows, "chunk", chunks, "group", groups).groupBy("chunk", "group")
    right = grid(queries, "group", groups, "chunk", chunks).groupBy("chunk", "group")
    found = left.cogroup(right).applyInArrow(cell, "query_id long, vec_id long, score long").dropDuplicates()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

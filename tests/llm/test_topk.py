import random

import numpy as np
import pytest

from tablewright.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, ids, k):
    usable = {(i, tuple(int(np.floor(256.0 * float(np.float32(x)))) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in ids:
        scores = {}
        for own, a in usable:
            if own == q:
                for i, b in usable:
                    if i != q and len(a) == len(b):
                        scores[(i, sum(x * y for x, y in zip(a, b, strict=True)))] = 1
        for rank, (i, s) in enumerate(sorted(scores, key=lambda x: (-x[1], x[0]))[:k], 1):
            want.append((q, rank, i, s))
    return sorted(want)


@pytest.mark.parametrize("dims", [1, 3, 16, 64])
def test_against_brute_force(spark, dims):
    draw = random.Random(dims)
    rows = [(i, [draw.gauss(0, 0.3) + (i % 3) for _ in range(dims)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(50, None), (51, [None] * dims), (52, [float("nan")] * dims), (53, [float("inf")] * dims), (None, rows[0][1]), (500, [1.0] * (dims + 1)), rows[3]]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = topk.top_k(table, table.where("vec_id % 50 = 0"), k=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == _brute(rows, range(0, 501, 50), 5)


def test_several_chunks_and_groups(spark, monkeypatch):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(3000)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = topk.top_k(table, table.where("vec_id % 100 = 0"), k=3, group_queries=7).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == _brute(rows, range(0, 3000, 100), 3)


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1)], SCHEMA)
    assert [tuple(r) for r in topk.top_k(table, table.where("vec_id = 0")).collect()] == [(0, 1, 1, 256 * 512)]
    nothing = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(nothing, nothing).collect() == []
    assert topk.top_k(table, nothing).collect() == []


def test_bound_holds():
    draw = np.random.default_rng(2)
    a, b = draw.integers(-300, 300, (50, 33)).astype(float), draw.integers(-300, 300, (50, 33)).astype(float)
    exact = a @ b.T
    for s in (1, 4, 16):
        assert (topk._statistics(a, s) @ topk._statistics(b, s).T >= exact - 1e-6).all()


def test_large_components(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**22, 3.0]), (2, [2.0**22 - 1, 2.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = topk.top_k(table, table.where("vec_id = 0"), k=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == _brute(rows, [0], 5)
    for large in (2.0**40, 3e38):
        table = spark.createDataFrame([(0, [large], 1), (1, [-large], 1)], SCHEMA)
        with pytest.raises(Exception, match="smaller scale"):
            topk.top_k(table, table, k=1).collect()

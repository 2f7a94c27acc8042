import random

import numpy as np
import pytest

from tablewright.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, is_anchor, positives=5, k=5, low=80, high=100, scale=256):
    usable = {
        (i, label, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
    }
    want = []
    for a, own, x in usable:
        if not is_anchor(a):
            continue
        others = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, label) for i, label, y in usable if i != a and len(x) == len(y)]
        near = sorted(o for o in others if o[2] == own)[:positives]
        for top, partner in {(-s, i) for s, i, _ in near}:
            window = sorted(o for o in others if o[2] != own and low * top <= -100 * o[0] <= high * top)
            want += [(a, partner, rank, i, top, -s) for rank, (s, i, _) in enumerate(window[:k], 1)]
    return sorted(want)


def _found(table, **how):
    got = negatives.hard_negatives(table, lambda i: i % 25 == 0, **how).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("dims", [1, 7, 8, 9, 64])
def test_against_brute_force(spark, dims):
    draw = random.Random(dims)
    centers = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [x + draw.gauss(0, 0.4) for x in centers[i % 4]], draw.choice([i % 4, 0])) for i in range(400)]
    rows += [(400 + i, rows[7][1], i % 3) for i in range(60)]  # ties
    rows += [(50, None, 1), (51, [None] * dims, 1), (52, [float("nan")] * dims, 1), (53, [float("inf")] * dims, 1), (None, rows[0][1], 1), (54, rows[1][1], None)]
    rows += [(500, [1.0] * (dims + 1), 1), (525, [0.5] * (dims + 1), 1), (526, [1.0] * (dims + 1), 2), (527, [], 1), rows[3], rows[3]]
    table = spark.createDataFrame(rows, SCHEMA)
    want = _brute(rows, lambda i: i % 25 == 0)
    assert _found(table) == want and len(want) > 20
    assert _found(table, positives=2, k=3, low=50, high=120, scale=16) == _brute(rows, lambda i: i % 25 == 0, 2, 3, 50, 120, 16)


def test_many_chunks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP", 7)
    monkeypatch.setattr(negatives, "CHUNK", 100)
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1) for _ in range(12)], int(i % 3 == 0)) for i in range(900)]
    assert _found(spark.createDataFrame(rows, SCHEMA)) == _brute(rows, lambda i: i % 25 == 0)


def test_repeated_ids_and_labels(spark):
    draw = random.Random(2)
    rows = [(i // 3, [draw.gauss(0, 1) + 1 for _ in range(8)], i % 2) for i in range(300)]
    rows += [(0, [2.0] * 8, 1)] * 200  # one row many times
    want = _brute(rows, lambda i: i % 25 == 0)
    assert sorted(set(_found(spark.createDataFrame(rows, SCHEMA)))) == sorted(set(want)) and want


def test_extra_columns_few_and_no_rows(spark):
    rows = [(0, [1.0], 1, "a", 1), (1, [2.0], 1, "b", 2), (2, [1.9], 2, "c", 3)]
    table = spark.createDataFrame(rows, SCHEMA + ", id string, packed int")
    assert _found(table) == [(0, 1, 1, 2, 256 * 512, 256 * 486)]
    assert _found(table.where("vec_id < 2")) == [] and _found(table.where("vec_id > 0")) == []
    assert _found(table.where("false")) == []


def test_large_components(spark):
    """Exact beyond 2**53; an error, not a wrapped number, beyond a long."""
    rows = [(0, [float(2**20), 1.0], 1), (1, [float(2**22), 3.0], 1), (2, [float(2**22 - 1), 2.0], 2)]
    assert _found(spark.createDataFrame(rows, SCHEMA)) == _brute(rows, lambda i: i % 25 == 0)
    for large in (2.0**40, 3e38):
        with pytest.raises(Exception, match="smaller scale"):
            _found(spark.createDataFrame([(0, [large], 1), (1, [large], 1), (2, [1.0], 2)], SCHEMA))


def test_tables_give_inner_products():
    draw = np.random.default_rng(4)
    for dims, most in ((1, 3), (8, 200), (13, 5000), (64, 140)):
        a, b = draw.integers(-most, most + 1, (20, dims)), draw.integers(-most, most + 1, (50, dims))
        packed = negatives.pack(b)
        groups = -(-dims // 8)
        for i, raw in enumerate(packed):
            planes = np.frombuffer(raw, np.uint8).reshape(1, -1, groups)
            assert (negatives.unpack(planes, dims)[0] == b[i]).all()
            indices = planes.transpose(1, 2, 0).astype(np.intp)
            assert (negatives.scores(negatives.subset_sums(a), indices)[:, 0] == a @ b[i]).all()

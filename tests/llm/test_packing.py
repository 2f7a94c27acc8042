import math
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablewright.llm import bpe, packing


def _check(rows, capacity):
    """Sequences are filled without gaps; returns how many there are."""
    sequences = {}
    for sequence, offset, size in rows:
        sequences.setdefault(sequence, []).append((offset, size))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("per_partition", [50_000, 60])
def test_packs_tightly(spark, monkeypatch, per_partition):
    monkeypatch.setattr(packing, "ROWS_PER_PARTITION", per_partition)
    draw = random.Random(5)
    sizes = [draw.choice([1, 7, 30, 64, 99, 100]) if draw.random() < 0.3 else draw.randint(1, 100) for _ in range(900)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size int")
    got = {r.item: r for r in packing.pack(items, 100).collect()}
    assert sorted(got) == list(range(900))
    n = _check([(got[i].sequence_id, got[i].offset, size) for i, size in enumerate(sizes)], 100)
    assert n <= math.ceil(sum(sizes) / 100) * 1.03 + 1


def test_many_tiny_and_equal_sizes(spark):
    for sizes in ([1] * 3000 + [60] * 5, [51] * 40, [100] * 7, [25] * 41, [3]):
        items = spark.createDataFrame(list(enumerate(sizes)), "item long, size int")
        got = {r.item: r for r in packing.pack(items, 100).collect()}
        n = _check([(got[i].sequence_id, got[i].offset, size) for i, size in enumerate(sizes)], 100)
        best = len(sizes) if sizes[0] in (51, 100) else math.ceil(sum(sizes) / 100)
        assert best <= n <= best + 1


def test_sizes_out_of_range_are_refused(spark):
    for bad in (0, 101, None):
        with pytest.raises(ValueError, match="sizes"):
            packing.pack(spark.createDataFrame([(1, bad)], "item long, size int"), 100)


def test_ranks_between_partitions():
    # Pieces of partitions 0 and 1 against gaps of 1 and 2: the nearest lower partition first.
    links = packing._between_partitions({0: (3, 0), 1: (2, 1), 2: (0, 9)})
    assert [(p, a, b, g, c, d) for _, p, a, b, g, c, d in links] == [(0, 2, 3, 1, 0, 1), (1, 0, 2, 2, 0, 2), (0, 0, 2, 2, 2, 4)]


def test_documents(corpus, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = []
    for r in corpus.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((r.doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = packing.pack_documents(corpus.withColumn("item", corpus.doc_id), path).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert _check([(r.sequence_id, r.offset, r.length) for r in rows], 4096) <= math.ceil(sum(w[3] for w in want) / 4096) + 1
    assert packing.pack_documents(nothing, path).collect() == []


def test_a_worker_needs_little_memory():
    """A few MB of text come as one batch; what encoding takes beside it must not grow with the batch."""
    taken = {}

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    run = packing.pieces(Docs(), public_tokenizers.path("word_bpe_49k.json"))
    for megabytes in (2, 8):
        text = " ".join(f"w{i}" for i in range(16_000))[:100_000]
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(10 * megabytes)), "text": [text] * (10 * megabytes)})
        list(run(iter([batch])))
        tracemalloc.start()
        assert sum(out.num_rows for out in run(iter([batch]))) > 0
        taken[megabytes] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert taken[8] < 1.5 * taken[2]


def test_character_classes_need_little_memory(monkeypatch):
    monkeypatch.setattr(bpe, "_classes", [])
    tracemalloc.start()
    table = bpe.character_classes()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 << 20
    assert table[ord("é")] == bpe.LETTER and table[ord("7")] == bpe.NUMBER and table[0x3000] == bpe.BLANK and table[0x10FFFF] == 0

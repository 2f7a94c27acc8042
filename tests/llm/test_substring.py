import hashlib
import random
import re
import tracemalloc

import pyarrow as pa
import pytest
import zstandard

from tablewright.llm import substring

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(rows, window=20):
    seen, out = {}, []
    keyed = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in keyed:
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[k : k + window]), (doc_id, k)) != (doc_id, k):
                gone[k : k + window] = [True] * window
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out += [(doc_id, len(words), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())] * rows.count((doc_id, text))
    return sorted(out, key=str)


def _rows(seed):
    draw = random.Random(seed)
    letters = ["a", "b", "cc", "é", "漢"]
    long = [" ".join(draw.choice(letters) for _ in range(250)) for _ in range(3)]
    rows = [(1, long[0]), (2, long[0][40:300] + " zz " + long[1]), (3, None), (4, ""), (5, "a " * 300), (6, "a\t" * 90 + long[1][90:260])]
    rows += [(7, " ".join(letters) * 40), (None, long[1][:150]), (8, "x " * 19), (9, "x " * 20), (10, "x " * 21), (11, " \n\x0b" + long[2]), (11, " \n\x0b" + long[2])]
    return rows + [(100 + i, " ".join(draw.choice("ab") for _ in range(60))) for i in range(40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = _rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, substring.digests(docs).collect()), key=str) == _brute(rows)


def test_other_window(spark):
    rows = [r for r in _rows(3) if r[0] is None or r[0] < 12]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substring.digests(docs, window=8).collect()), key=str) == _brute(rows, 8)
    with pytest.raises(ValueError, match="windows"):
        substring.digests(docs, window=99)


def test_same_id_with_different_texts(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame([(1, passage), (1, passage + " tail"), (2, "head " + passage)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring.digests(docs).collect())
    assert sorted(g[2] for g in got) == [0, 30, 30] and got[-1] == (2, 31, 30)


def test_cut_text(spark, corpus, nothing):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, f"one\n{passage}\nend"), (2, f"  two  words\n\n{passage} after\tit "), (3, passage), (4, "clean  \n text"), (5, None)]
    docs = spark.createDataFrame([(i, t, "c0", 1.5) for i, t in rows], "doc_id long, text string, spans string, _text double")
    got = {r.doc_id: r for r in substring.remove_repeats(docs).collect()}
    assert [got[i].text for i in range(1, 6)] == [rows[0][1], "  two  words\n\nafter\tit ", "", "clean  \n text", None]
    assert got[1].spans == "c0" and got[1]._text == 1.5
    assert substring.remove_repeats(corpus).columns == corpus.columns
    assert substring.remove_repeats(corpus).count() == corpus.count()
    assert substring.remove_repeats(nothing).collect() == []
    assert substring.digests(nothing).collect() == []


@pytest.mark.parametrize("tag_bits", [23, 1])
def test_many_rows_of_one_id_and_of_none(spark, monkeypatch, tag_bits):
    """Thousands of texts under one id or none; with one bit the second hash collides all the time."""
    monkeypatch.setattr(substring, "_TAG_BITS", tag_bits)
    draw = random.Random(6)
    passages = [" ".join(f"p{i}w{k}" for k in range(40)) for i in range(30)]
    rows = [(draw.choice([None, 7]), f"{'a' * draw.randrange(9)} r{i} {draw.choice(passages)} {'z ' * draw.randrange(30)}") for i in range(3000)]
    rows += [(None, ""), (7, None), (3, passages[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = {r.text: r.h for r in docs.selectExpr("coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()}
    keyed = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, order[r[1] or ""]))
    seen, want = {}, []
    for n, (doc_id, text) in enumerate(keyed):
        words = WORDS.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            if seen.setdefault(tuple(words[k : k + 20]), (n, k)) != (n, k):
                gone[k : k + 20] = [True] * 20
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(map(tuple, substring.digests(docs).collect()), key=str) == sorted(want, key=str)


def test_pieces_are_bounded_by_text_not_by_its_compressed_form():
    """Long texts of few different words compress to almost nothing; many of them must not be unpacked at once."""
    pack = zstandard.ZstdCompressor(level=1).compress
    texts = [b"the same words again " * 10_000] * 40 + [None, b"", b"x " * 2_000_000, "é".encode()]
    batch = pa.RecordBatch.from_pydict({"i": list(range(44)), "_text": [pack(t) if t is not None else None for t in texts]})
    pieces = list(substring.unpacked(iter([batch])))
    assert [t for p in pieces for t in p.column("text").to_pylist()] == [t.decode() if t is not None else None for t in texts]
    assert [i for p in pieces for i in p.column("i").to_pylist()] == list(range(44))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 1 << 20 for p in pieces)


def test_cutting_needs_little_memory(monkeypatch):
    """What a task takes beside a batch must not grow with the texts in it."""

    class Docs:
        columns, schema = ["text"], {}

        def select(self, *_):
            return self

        toDF = select

        def mapInArrow(self, run, _):
            self.run = run
            return self

    monkeypatch.setattr(substring, "_with_spans", lambda docs, *_: docs)
    run, taken = substring.remove_repeats(Docs()).run, {}
    text = " ".join(f"w{i}" for i in range(16_000))[:100_000].encode()
    row = zstandard.ZstdCompressor(level=1).compress(text)
    for megabytes in (2, 8):
        n = 10 * megabytes
        batch = pa.RecordBatch.from_arrays([pa.array([row] * n, pa.binary()), pa.array([[10 * 32 + 5]] * n, pa.list_(pa.int64()))], names=["_text", "spans"])
        tracemalloc.start()
        kept = " ".join(w for i, w in enumerate(text.decode().split(" ")) if not 10 <= i < 34)
        for out in run(iter([batch])):
            assert set(out.column("text").to_pylist()) == {kept}
        taken[megabytes] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert taken[8] < 1.5 * taken[2]

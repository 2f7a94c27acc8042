import hashlib
import random
import re

import numpy as np
import pytest

from tablewright.llm import fim


def _brute(doc_id, text, units="token", seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    pieces = re.findall(r"[A-Za-z]+|[^A-Za-z]", text) if units == "token" else list(text)
    n = len(pieces)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(pieces[:a]), "".join(pieces[a:b]), "".join(pieces[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def _texts():
    draw = random.Random(5)
    signs = "abcXYZ  \n\t<>SPM/é漢😀́ßñ0"
    texts = ["".join(draw.choices(signs, k=draw.randrange(0, 400))) for _ in range(300)]
    texts += [None, "", "a", "é", "😀", "<", "<S", "a<P>b", "<M>", "x" * 70_000, "漢" * 30_000, "a😀" * 20_000, "<S<P", "end <", "\x00\x01", texts[3], texts[3]]
    return list(enumerate(texts)) + [(None, "no id"), (None, None), (7, "id again"), (7, "id again")]


@pytest.mark.parametrize("units", ["token", "char"])
def test_against_plain_python(spark, units):
    rows = _texts()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = fim.fill_in_middle(table, units=units).collect()
    want = sorted(((i, t, *_brute(i, t, units)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=str) == want
    assert {w[3] for w in want} == {"plain", "psm", "spm"}


def test_texts_come_back(spark):
    rows = _texts()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    made = fim.fill_in_middle(table, plain_percent=0, spm_percent=50)
    back = made.select("text", fim.restored(made.output, made.form).alias("back"), "form").collect()
    assert all((r.text or "") == r.back for r in back)
    found = fim.digests(table).collect()
    assert sorted(r.restored_sha256 for r in found) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows)


def test_clashing_and_extra_columns(spark, nothing):
    table = spark.createDataFrame([(1, "some words here", "old", 5, "x")], "doc_id long, text string, form string, `n` int, `odd.name` string")
    row = fim.fill_in_middle(table, plain_percent=0).first().asDict()
    assert list(row) == ["doc_id", "text", "odd.name", *fim.ADDED] and row["odd.name"] == "x" and row["form"] in ("psm", "spm") and row["n"] == 5
    assert fim.fill_in_middle(nothing).collect() == [] and fim.digests(nothing).collect() == []
    with pytest.raises(ValueError, match="units"):
        fim.fill_in_middle(table, units="word")


def test_index_of_exceptions():
    text = "aé漢😀b" * 50 + "plain" * 100 + "ß"
    data = np.frombuffer(text.encode(), np.uint8)
    index = fim.Exceptions(data)
    char = np.arange(len(text) + 1)
    byte = np.array([len(text[:i].encode()) for i in char])
    assert (index.bytes(char) == byte).all() and (index.chars(byte) == char).all()
    assert len(fim.Exceptions(np.frombuffer(b"ascii only", np.uint8)).at) == 0


def test_marks_by_block():
    draw = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        marks = draw.random(n) < 0.3
        begins = fim.Begins(marks)
        at = np.arange(n + 1)
        assert (begins.rank(at) == np.r_[0, np.cumsum(marks)]).all()
        assert (begins.select(np.arange(marks.sum())) == np.flatnonzero(marks)).all()

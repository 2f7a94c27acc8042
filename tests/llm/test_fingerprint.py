import hashlib

import pyarrow as pa

from tablewright.llm import fingerprint as fp
from tablewright.llm.flat import flat_text


def _prints(*texts):
    return fp.fingerprints(*flat_text(pa.array(texts, pa.string())))


def _lcs(a, b):
    a, b = ([s[i : i + 2] for i in range(0, len(s), 2)] for s in (a, b))
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def _likeness(left, right):
    (p, *x), (q, *y) = left.split(":"), right.split(":")
    shared = [(int(p) << i, int(q) << j, x[i], y[j]) for i in (0, 1) for j in (0, 1)]
    return max((_lcs(u, v) for a, b, u, v in shared if a == b), default=0.0)


def test_against_plain_dynamic_programming(spark):
    base = " ".join(f"w{i * i % 1009}" for i in range(2000))
    texts = ["", None, "a", "ab", base[:50], base[:300], base, base[: len(base) // 2] + base[:999], base[3000:] + "!", "z" * 5000, base.upper()]
    prints = _prints(*texts)
    assert prints[0] == prints[1] == "2::"
    pairs = [(a, b) for a in prints for b in prints]
    got = fp.likeness([a for a, _ in pairs], [b for _, b in pairs])
    assert [round(x, 9) for x in got] == [round(_likeness(a, b), 9) for a, b in pairs]
    assert got.min() >= 0 and got.max() <= 1
    alone = [_prints(t)[0] for t in texts]
    assert alone == prints  # a text's fingerprint does not depend on its neighbours


def test_signature_length_is_bounded_by_choice_of_block():
    base = " ".join(f"w{i * i % 1009}" for i in range(5000))
    for text in (base, base * 20, "q" * 100_000):
        block, first, second = _prints(text)[0].split(":")
        assert len(first) // 2 <= fp.MOST_CHUNKS and len(second) <= len(first)


def test_edited_neighbours(spark, corpus, nothing):
    for docs in (corpus, spark.createDataFrame([(5, "abc")], "doc_id long, text string"), corpus.withColumnRenamed("lang", "bucket").withColumnRenamed("source", "copy")):
        rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in docs.collect()))
        want = []
        for i, (has, doc_id, _, text) in enumerate(rows):
            after = rows[(i + 1) % len(rows)][3]
            half = len(text) // 2
            edited = text[: len(text) - half] + after[:half]
            mine, theirs, following = _prints(text, edited, after)
            want.append(
                (doc_id if has else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), mine, theirs)
                + (round(_likeness(mine, theirs), 9), round(_likeness(mine, following), 9))
            )
        got = [(*r[:5], round(r[5], 9), round(r[6], 9)) for r in fp.edited_neighbours(docs).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert fp.edited_neighbours(nothing).collect() == []


def test_fingerprint_column(corpus):
    got = fp.fingerprint(corpus.withColumnRenamed("lang", "fingerprint"))
    assert sorted(got.columns) == ["doc_id", "fingerprint", "n_chars", "source", "text"]
    assert {r.fingerprint for r in got.where("doc_id IN (1, 2)").collect()} == {_prints(corpus.where("doc_id = 1").first().text)[0]}

import random
import re

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.llm import minhash
from tablewright.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(rows):
    """Class of each row: the least id that it is linked to over any chain."""
    words = [tuple(WORDS.findall(t or "")) for _, t in rows]
    sets = [{w[k : k + 5] for k in range(len(w) - 4)} or ({w} if w else set()) for w in words]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if words[i] == words[j] or sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((doc_id, least.get(root(i))) for i, (doc_id, _) in enumerate(rows)), key=str)


def test_recall_on_the_documents(spark):
    """All pairs of different texts at 0.8 or more, found by an inverted index, against the classes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, tuple(WORDS.findall(r.text or ""))) for r in docs.collect()]
    texts = sorted({w for _, w in rows if w})
    sets = [{w[k : k + 5] for k in range(len(w) - 4)} or {w} for w in texts]
    places = {}
    for i, found in enumerate(sets):
        for gram in found:
            places.setdefault(gram, []).append(i)
    shared = {}
    for where in places.values():
        for a in range(len(where)):
            for b in range(a):
                pair = where[b], where[a]
                shared[pair] = shared.get(pair, 0) + 1
    pairs = [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    got = dict(map(tuple, minhash.near_duplicates(docs).collect()))
    named = {w: got[i] for i, w in rows}
    found = sum(named[texts[a]] == named[texts[b]] for a, b in pairs)
    assert pairs and found == len(pairs)
    near = {texts[i] for p in pairs for i in p}
    least = {}
    for i, w in rows:
        least[w] = min(i, least.get(w, i))
    assert all(got[i] == least[w] for i, w in rows if w not in near)


def _variants(seed, groups=6, copies=12):
    """Texts in groups, some far from each other inside their group."""
    draw = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(draw.choice([6, 40, 150]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(draw.randint(0, max(1, len(words) // 30))):
                words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_classes_against_brute_force(spark):
    for seed in (1, 2):
        rows = [*_variants(seed), (900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "a  b"), (905, "b a"), (None, "a b"), (None, "alone here"), (903, "a b")]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        assert sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str) == _brute(rows)


def test_chains_inside_a_band_are_followed(spark):
    """Far ends of a chain of near copies meet over its middle, though their pivot is near few of them."""
    words = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(words[6 * k : 6 * k + 100])) for k in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str) == _brute(rows)


def _repeating(seed, groups=24):
    """Near copies that differ in how often their lines repeat: in one copy only, or other lines in each."""
    draw = random.Random(seed)
    rows = []
    for g in range(groups):
        lines = [" ".join(f"g{g}l{i}w{k}" for k in range(30)) for i in range(10)]
        often = draw.choice([10, 30, 100])
        rows.append((len(rows), "\n".join(lines)))
        rows.append((len(rows), "\n".join([*lines[:7], "\n".join(lines[7:] * often)])))
        # Each of these two ends with a line of its own.
        own = draw.choice([3, 20, 60])
        ends = [" ".join(f"g{g}e{e}w{k}" for k in range(own)) for e in range(2)]
        rows += [(len(rows) + e, "\n".join([f"g{g}start", *lines[::-1], *[end] * often])) for e, end in enumerate(ends)]
    return rows


def test_copies_that_repeat_their_lines_otherwise(spark):
    """Similarity is that of sets, so how often a line stands in a text must not cut its links."""
    rows = _repeating(5)
    want = _brute(rows)
    assert len({c for _, c in want}) < len(rows) - 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str) == want


def test_one_of_each_class_stays(spark, corpus, nothing):
    rows = [*_variants(3), (900, None), (901, ""), (903, "a b"), (903, "a b"), (903, "a  b"), (None, "x y z"), (None, "x y z"), (904, "b a")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, row string")
    kept = minhash.keep_one(docs).collect()
    n_classes = len(set(_brute(rows)) and {c for _, c in _brute(rows)})
    assert len(kept) == n_classes and kept[0].row == "k"
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == sorted({c for _, c in _brute(rows) if c is not None})
    assert minhash.keep_one(corpus).columns == corpus.columns
    assert minhash.keep_one(nothing).collect() == []
    assert minhash.near_duplicates(nothing).collect() == []


def test_signatures_estimate_probability_jaccard():
    draw = np.random.default_rng(4)
    for shared, only in ((80, 20), (50, 50), (95, 5)):
        codes = draw.integers(0, 1 << 44, shared + 2 * only).astype(np.uint64)
        weights = draw.uniform(0.5, 3, shared + 2 * only)
        sides = [np.r_[0:shared, shared : shared + only], np.r_[0:shared, shared + only : shared + 2 * only]]
        doc = np.repeat([0, 1], shared + only)
        found = minhash.signatures(doc, codes[np.concatenate(sides)], weights[np.concatenate(sides)], 2, 2048)
        sums = [weights[s].sum() for s in sides]
        # Probability Jaccard of two weightings: sum over common x of 1 / sum over y of max(a_y / a_x, b_y / b_x).
        want = 0.0
        for x in range(shared):
            a, b = weights[x], weights[x]
            first = np.maximum(weights[:shared] / a, weights[:shared] / b).sum()
            want += 1 / (first + (sums[0] - weights[:shared].sum()) / a + (sums[1] - weights[:shared].sum()) / b)
        assert abs((found[0] == found[1]).mean() - want) < 0.04


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=40))
def test_components(spark, pairs):
    parent = {x: x for p in pairs for x in p if p[0] != p[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = components(spark.createDataFrame([*pairs, (None, 1)], "u long, v long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in parent} and len(got) == len(parent)

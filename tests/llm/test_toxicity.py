import random

import numpy as np
import pytest

from tablewright.llm import toxicity
from tablewright.llm.toxicity import GRADES


def _documents(n, seed):
    draw = random.Random(seed)
    plain = [f"{a}{b}{c}" for a in ("ba", "lo", "mi", "ter") for b in ("na", "so", "ri") for c in ("", "n", "ka", "vel")]
    bad = ["nasty", "vile", "grubby", *(f"scorn{x}" for x in ("a", "ful", "ing", "ers", "ed"))]
    rows = []
    for i in range(n):
        words = [draw.choice(plain) for _ in range(draw.randint(20, 60))]
        toxic = draw.random() < 0.3
        for _ in range(draw.choice([1, 3, 6]) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_documents(spark):
    rows = _documents(1500, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 1000] + [(5000, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert len(model.thresholds) == GRADES - 1 and (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in toxicity.score(docs.where("doc_id >= 1000"), model).collect()}
    right = [got[i].is_toxic == bool(y) for i, _, y in rows[1000:]]
    assert sum(right) / len(right) > 0.97
    # Expected severity rises with the number of marker words.
    new = spark.createDataFrame([(0, "bana losoka"), (1, "bana vile losoka"), (2, "bana vile losoka nasty scornful grubby scorning")], docs.schema)
    severity = [r.severity for r in toxicity.score(new, model).orderBy("doc_id").collect()]
    assert severity[0] < severity[1] < severity[2] <= GRADES - 1


def test_edge_cases(spark, corpus, nothing):
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    tame = toxicity.train(corpus, labels)
    assert {(r.severity, r.grade, r.is_toxic) for r in toxicity.score(corpus, tame).collect()} == {(0.0, 0, False)}
    rows = _documents(300, 2)
    model = toxicity.fit(*_features(rows))
    scored = toxicity.score(corpus.withColumnRenamed("lang", "grade"), model)
    assert sorted(scored.columns) == ["doc_id", "grade", "is_toxic", "n_chars", "severity", "source", "text"]
    assert scored.count() == corpus.count() and not any(r.is_toxic for r in scored.where("text IS NULL OR text = ''").collect())
    assert toxicity.score(nothing, model).collect() == []
    assert len(toxicity.train(nothing, labels).thresholds) == 0


def _features(rows):
    import pyarrow as pa

    doc, code = toxicity.all_features(pa.array([t for _, t, _ in rows]))
    return np.array([bool(y) for *_, y in rows]), [code[doc == i] for i in range(len(rows))]


def test_words_do_not_cross_texts():
    import pyarrow as pa

    joined = toxicity.all_features(pa.array(["abc", "def"]))
    assert sorted(joined[1]) == sorted(np.r_[toxicity.all_features(pa.array(["abc"]))[1], toxicity.all_features(pa.array(["def"]))[1]])


@pytest.mark.parametrize("labels", [np.zeros(3, bool), np.ones(3, bool), np.zeros(0, bool)])
def test_nothing_to_learn(labels):
    assert len(toxicity.fit(labels, [np.zeros(1, np.uint64)] * len(labels)).features) == 0

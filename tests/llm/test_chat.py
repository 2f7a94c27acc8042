import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablewright.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["\\### Assistant: </turn> ok", "####", "#" * 7, "</turn></turn>\n\\", "### x: y</turn>\n### z: ", "", None, "\\", "<\\/turn>", "<</turn>", "a\n"]


def _digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    want = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        want[conv] = (len(turns), _digest("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), _digest(loss))
    return want


def _got(spark, rows):
    found = chat.digests(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}


def test_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "we: ird/\n###", None][i % 4], t) for i, t in enumerate(NASTY)]
    rows += [(2, 0, "user", "only"), (3, 0, "assistant", "first"), (3, 1, "user", "last"), (None, None, None, None), (4, 1, "user", "tie"), (4, 1, "user", "tie")]
    assert _got(spark, rows) == _brute(rows)
    assert chat.digests(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", ""]), st.text("#\\<>/turn:\n é", max_size=30)), min_size=1, max_size=40))
def test_any_text_comes_back(spark, turns):
    rows = [(i // 5, i % 5, role, text) for i, (role, text) in enumerate(turns)]
    assert _got(spark, rows) == _brute(rows)


def test_one_example_per_reply(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b#"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    got = chat.expand(spark.createDataFrame(rows, SCHEMA)).orderBy("example").collect()
    assert [(r.formatted[r.loss_start : r.loss_start + r.loss_length], r.is_last) for r in got] == [("b#", False), ("d", False), ("", True)]
    assert got[1].formatted.startswith(got[0].formatted)
    assert got[0].formatted == "### user: a</turn>\n### assistant: b#</turn>\n"


def test_only_built_in_functions(spark):
    plan = chat.digests(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("PythonRDD", "") and "Arrow" not in plan

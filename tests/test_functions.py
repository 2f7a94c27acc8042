import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablewright.functions import log_fields, money_sum, parse_double, parse_log, strict_double, to_cents
from tablewright.plans.programs import SERVICE_LOG_PATTERN
from tests import fixtures


def _values(spark, texts, expr):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [row[0] for row in df.select(expr("t")).collect()]


def test_parse_double_is_lenient_and_takes_only_decimal_numbers(spark):
    texts = ["12.5", " 12 ", "1e3", "-.5", "", None, "n/a", "1d", "2F", "NaN", "inf", "Infinity", "1_000", "0x1p3", "1,5"]
    assert _values(spark, texts, parse_double) == [12.5, 12.0, 1000.0, -0.5] + [None] * 11


def test_strict_double_counts_missing_as_zero_and_fails_on_junk(spark):
    assert _values(spark, ["3.5", "", None], strict_double) == [3.5, 0.0, 0.0]
    with pytest.raises(PySparkException, match="not a number: 'n/a'"):
        _values(spark, ["n/a"], strict_double)


def test_to_cents(spark):
    assert _values(spark, ["88.5", "n/a", "", None], to_cents) == [8850.0, None, None, None]


def test_money_sum_is_exact(spark):
    df = spark.range(1000).select((F.lit(0.1) + F.col("id") * 0).alias("x"))
    assert df.agg(money_sum("x")).first()[0] == 100.0


def test_log_pattern_to_typed_columns_and_rejects(spark):
    df = spark.createDataFrame([(line,) for line in fixtures.log_lines()], "value string")
    parsed, rejects = parse_log(df, SERVICE_LOG_PATTERN)
    assert parsed.dtypes == [
        ("ts", "string"), ("level", "string"), ("service", "string"),
        ("customer_id", "string"), ("status", "string"), ("amount", "double"),
    ]
    rows = sorted(parsed.collect())
    assert len(rows) == 9
    assert tuple(rows[3]) == ("2026-03-01T08:03:22Z", "ERROR", "shop-1", "K003", "ok", 3.53)
    # "a b" holds a separator, which NOTSPACE does not take.
    assert sorted(r.value for r in rejects.collect()) == sorted(fixtures.log_lines()[-2:])


def test_a_greedy_token_would_take_the_separator(spark):
    df = spark.createDataFrame([(fixtures.log_lines()[-1],)], "value string")
    parsed, rejects = parse_log(df, SERVICE_LOG_PATTERN.replace("NOTSPACE:service", "DATA:service"))
    assert parsed.first().service == "a b"
    assert rejects.count() == 0


def test_log_line_that_holds_the_internal_mark(spark):
    lines = ["a\u0001b x=1", "c x=2", "\u0001", None, "\u0001d x=3"]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    parsed, rejects = parse_log(df, "%{NOTSPACE:name} x=%{NUMBER:x:long}")
    assert sorted(map(tuple, parsed.collect())) == [("\u0001d", 3), ("a\u0001b", 1), ("c", 2)]
    assert {r.value for r in rejects.collect()} == {"\u0001", None}


def test_log_pattern_quotes_literal_text(spark):
    df = spark.createDataFrame([("[x] (1)",), ("x 1",)], "value string")
    parsed, rejects = parse_log(df, "[%{WORD:w}] (%{NUMBER:n:int})")
    assert [tuple(r) for r in parsed.collect()] == [("x", 1)]
    assert rejects.count() == 1


@pytest.mark.parametrize("pattern", ["plain", "%{NOPE:a}", "%{WORD:a} %{WORD:a}", "%{WORD:a:map}"])
def test_bad_log_patterns(pattern):
    with pytest.raises(ValueError):
        log_fields(pattern)

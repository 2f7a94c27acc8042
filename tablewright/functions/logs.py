"""Log lines to typed columns, by patterns such as `%{WORD:status} amount=%{NUMBER:amount:double}`."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.numbers import parse_double, parse_long
from tablewright.names import quote

# The pattern tokens and the text each of them matches.
TOKENS = {
    "TIMESTAMP_ISO8601": r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?",
    "LOGLEVEL": r"TRACE|DEBUG|INFO|NOTICE|WARN(?:ING)?|ERR(?:OR)?|CRIT(?:ICAL)?|FATAL",
    "NOTSPACE": r"\S+",
    "WORD": r"\w+",
    "NUMBER": r"[+-]?\d+(?:\.\d+)?",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
}

# The types a capture may be converted to.
CAPTURE_TYPES = ("string", "double", "float", "int", "long")

_REFERENCE = re.compile(r"%\{(\w+)(?::(\w+))?(?::(\w+))?\}")
MARK = "\u0001"


def log_fields(pattern: str) -> tuple[str, list[tuple[str, str]]]:
    """The pattern as one Java regex for the whole line, and its captures as (name, type)."""
    regex, fields, end = "", [], 0
    for ref in _REFERENCE.finditer(pattern):
        token, name, dtype = ref.groups()
        if token not in TOKENS:
            raise ValueError(f"unknown pattern token {token!r}")
        if dtype is not None and dtype not in CAPTURE_TYPES:
            raise ValueError(f"unknown capture type {dtype!r}")
        regex += re.escape(pattern[end : ref.start()])
        if name:
            if name in (field for field, _ in fields):
                raise ValueError(f"capture {name!r} appears twice")
            fields.append((name, dtype or "string"))
            regex += f"({TOKENS[token]})"
        else:
            regex += f"(?:{TOKENS[token]})"
        end = ref.end()
    if not fields:
        raise ValueError("the pattern captures nothing")
    return rf"\A{regex}{re.escape(pattern[end:])}\z", fields


def parse_log(df: DataFrame, pattern: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed, rejects): one typed column per capture, and the lines the pattern does not fit.

    A line is matched once: the replacement lays all captures out between marks and a split takes
    them apart. A line that holds the mark itself takes the slower way of one extraction per capture.
    """
    regex, fields = log_fields(pattern)
    line, laid_out = F.col(quote(column)), F.col("laid_out")
    template = MARK + MARK.join(f"${i}" for i in range(1, len(fields) + 1))
    one_by_one = F.array(*(F.regexp_extract(F.col("line"), regex, i) for i in range(1, len(fields) + 1)))
    by_marks = F.split(F.substr(laid_out, F.lit(2)), MARK, -1)
    captures = F.when(
        F.col("line").contains(MARK), F.when(F.col("line").rlike(regex), F.array(one_by_one))
    ).when(laid_out.startswith(MARK), F.array(by_marks))

    def typed(i: int, name: str, dtype: str):
        text = F.col("captures")[i]
        if dtype in ("double", "float"):
            text = parse_double(text).cast(dtype)
        elif dtype != "string":
            text = parse_long(text).try_cast(dtype)
        return text.alias(name)

    # explode drops the lines without captures. A filter would do so too, but Spark would move it
    # below the projection and match every line once more.
    matched = df.select(line.alias("line"), F.regexp_replace(line, F.lit(regex), F.lit(template)).alias("laid_out"))
    matched = matched.select(F.explode(captures).alias("captures"))
    parsed = matched.select(*(typed(i, name, dtype) for i, (name, dtype) in enumerate(fields)))
    rejects = df.filter(~F.coalesce(line.rlike(regex), F.lit(False)))
    return parsed, rejects

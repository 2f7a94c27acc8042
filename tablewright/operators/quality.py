"""Setting unparsable records aside, and counting them in the same pass as the write."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablewright.names import quote

Parser = Callable[[Column], Column]


def _failed(column: str, parser: Parser) -> Column:
    """True where there is a value and the parser gives none. Empty text is missing, not wrong."""
    raw = F.col(quote(column))
    text = raw.cast("string")
    return text.isNotNull() & (text != "") & parser(raw).isNull()


def split_rejects(df: DataFrame, rules: Mapping[str, Parser]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) by rules such as {"order_total": parse_double}.

    good has the ruled columns parsed. rejects keeps each failing record as it came, once per
    failing column, with reject_column, reject_value and reject_reason. Both are narrow: no shuffle.
    """
    missing = [c for c in rules if c not in df.columns]
    if missing:
        raise ValueError(f"no column {missing}")
    failures = [(c, _failed(c, parser)) for c, parser in rules.items()]
    any_failure = F.lit(False)
    for _, failed in failures:
        any_failure = any_failure | failed
    good = df.filter(~any_failure).select(
        *(rules[c](F.col(quote(c))).alias(c) if c in rules else F.col(quote(c)) for c in df.columns)
    )
    reasons = F.array_compact(
        F.array(
            *(
                F.when(
                    failed,
                    F.struct(
                        F.lit(c).alias("reject_column"),
                        F.col(quote(c)).cast("string").alias("reject_value"),
                        F.lit(f"{getattr(rules[c], '__name__', 'parser')} gives no value").alias("reject_reason"),
                    ),
                )
                for c, failed in failures
            )
        )
    )
    rejects = df.filter(any_failure).select("*", F.inline(reasons))
    return good, rejects


def with_counters(
    df: DataFrame, name: str, rules: Mapping[str, Parser]
) -> tuple[DataFrame, Observation]:
    """`df` unchanged, with an observation that counts rows, parsed_<column> and failed_<column>.

    The counts are there after the next action on the frame, at no extra pass over the data. Put it
    right before the write: a stage that has to be repeated may count twice. `sources.write_counted` counts
    what was committed.
    """
    observation = Observation(name)
    return df.observe(observation, *counters(rules)), observation


def counters(rules: Mapping[str, Parser]) -> list[Column]:
    """Aggregates: rows, and parsed_<column> and failed_<column> for each rule."""
    counts = [F.count(F.lit(1)).alias("rows")]
    for column, parser in rules.items():
        counts.append(F.count_if(parser(F.col(quote(column))).isNotNull()).alias(f"parsed_{column}"))
        counts.append(F.count_if(_failed(column, parser)).alias(f"failed_{column}"))
    return counts

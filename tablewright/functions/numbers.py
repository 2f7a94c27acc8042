"""Numbers out of text columns, lenient and strict. All of it stays in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# What counts as a whole and as a decimal number in text.
WHOLE = r"^\s*[+-]?\d+\s*$"
DECIMAL = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def parse_double(col: Column | str) -> Column:
    """Text to double; NULL for the empty string and for anything that is not a decimal number.

    A cast alone would also take `1d`, `0x1p3`, `NaN` and `Infinity`. The pattern comes first for
    speed, too: a cast that fails builds an exception, which costs a hundred times a match.
    """
    text = _column(col)
    return F.when(text.rlike(DECIMAL), text.try_cast("double"))


def parse_long(col: Column | str) -> Column:
    """Text to whole number; NULL for anything else."""
    text = _column(col)
    return F.when(text.rlike(WHOLE), text.try_cast("bigint"))


def strict_double(col: Column | str) -> Column:
    """Text to double; missing or empty counts as 0.0, and junk fails the job naming the value."""
    text = _column(col)
    failure = F.raise_error(F.concat(F.lit("not a number: '"), text, F.lit("'")))
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(
        F.coalesce(parse_double(text), failure)
    )


def to_cents(col: Column | str) -> Column:
    """An amount as text to cents; NULL where the text is no number."""
    return parse_double(col) * F.lit(100.0)


def money_sum(col: Column | str) -> Column:
    """Sum of amounts, rounded once to two decimals, as a double.

    Amounts are added as decimals with eight places, so the result does not depend on the order in
    which partial sums meet. Where one amount or the sum is too large for that, or is no finite number,
    doubles are added instead; nothing fails or is left out.
    """
    amount = _column(col)
    exact = amount.try_cast("decimal(28,8)")
    fits = ~F.coalesce(F.bool_or(amount.isNotNull() & exact.isNull()), F.lit(False))
    summed = F.when(fits, F.round(F.try_sum(exact), 2).cast("double"))
    return F.coalesce(summed, F.round(F.sum(amount.cast("double")), 2))

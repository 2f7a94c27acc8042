"""The latest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.names import quote


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return _orderable(dtype.elementType) if isinstance(dtype, T.ArrayType) else True


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], order_by: str | Column | Sequence[str | Column]
) -> DataFrame:
    """One row per key: the first in the given order. Names sort descending, NULLs last.

    Whatever the order leaves open is settled by the remaining columns, so that the same input
    always gives the same rows. Spark cuts each map task's rows to one per key before the shuffle
    (WindowGroupLimit), so a key that holds a large part of the table does not end up in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    named = {o for o in orders if isinstance(o, str)}
    ties = [f.name for f in df.schema.fields if f.name not in named | set(keys) and _orderable(f.dataType)]
    ordering = [F.col(quote(o)).desc_nulls_last() if isinstance(o, str) else o for o in orders]
    ordering += [F.col(quote(t)).desc_nulls_last() for t in ties]
    # Without anything to order by, rows of a key are equal and any of them will do.
    window = Window.partitionBy(*(quote(k) for k in keys)).orderBy(*(ordering or [F.lit(0)]))
    numbered = df.withColumn("__row", F.row_number().over(window))
    return numbered.filter(F.col("__row") <= 1).drop("__row")

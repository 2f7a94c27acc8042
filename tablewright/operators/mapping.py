"""Renaming, casting and selecting columns by a mapping list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.numbers import parse_double, parse_long
from tablewright.names import quote
from tablewright.operators.choice import cast_choice


def _source(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """A column by its literal name, else by a dotted path into structs."""
    if name in df.columns:
        return F.col(quote(name)), df.schema[name].dataType
    dtype: T.DataType = df.schema
    parts = name.split(".")
    for part in parts:
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            raise ValueError(f"no column {name!r}; there are {df.columns}")
        dtype = dtype[part].dataType
    return F.col(".".join(quote(part) for part in parts)), dtype


def _convert(col: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return col
    if isinstance(have, T.VariantType):
        return cast_choice(col, want)
    if isinstance(have, T.StringType) and isinstance(want, (T.DoubleType, T.FloatType)):
        return parse_double(col).cast(want)
    if isinstance(have, T.StringType) and isinstance(want, T.IntegralType):
        return parse_long(col).try_cast(want)
    return col.try_cast(want)


def apply_mapping(df: DataFrame, mappings: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Keep exactly the mapped columns: (source, source type, target, target type).

    A value that does not convert becomes NULL. A source that is missing or has another type than
    stated is an error, since it means the mapping was written for another table.
    """
    if not mappings:
        raise ValueError("nothing is mapped")
    columns, taken = [], set()
    for source, source_type, target, target_type in mappings:
        col, have = _source(df, source)
        if have != T.DataType.fromDDL(source_type):
            raise ValueError(f"column {source!r} is {have.simpleString()}, not {source_type}")
        if target in taken:
            raise ValueError(f"target column {target!r} is mapped twice")
        taken.add(target)
        columns.append(_convert(col, have, T.DataType.fromDDL(target_type)).alias(target))
    return df.select(*columns)


def stringify(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns (all by default) as text, for stores without types; nested values become JSON text."""
    chosen = set(df.columns if columns is None else columns)
    missing = chosen - set(df.columns)
    if missing:
        raise ValueError(f"no column {sorted(missing)}")

    def text(field: T.StructField) -> Column:
        col = F.col(quote(field.name))
        if field.name not in chosen:
            return col
        nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
        return (F.to_json(col) if nested else col.cast("string")).alias(field.name)

    return df.select(*(text(field) for field in df.schema.fields))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullable, and whether it is an unresolved choice."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable, isinstance(f.dataType, T.VariantType))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, type string, nullable boolean, is_choice boolean"
    )


def preview(df: DataFrame, n: int = 20, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """The first n rows; with an order, the top n of that order (no full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)

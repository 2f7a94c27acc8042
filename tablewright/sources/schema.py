"""Schemas that grow: the least type that holds the values of two types, and data brought to it.

The types form a lattice. Whole numbers grow to wider ones and to decimals, decimals to more digits, small whole
numbers and floats to double, dates to timestamps without zone; a struct grows by the fields of the other and
inside its fields, arrays and maps inside their elements. Only steps that keep every value are taken, and only
those that Spark's Parquet readers take when files hold the narrower type, so a table's old files stay as they
are. Types without a common one (text and numbers, bigint and double) are an error that names the place.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.names import quote

# Whole types by size, with the digits that Parquet readers want a decimal to have for them.
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_MOST_DIGITS = 38
# Types that double holds exactly.
_IN_DOUBLE = ("tinyint", "smallint", "int", "float", "double")


def common_type(a: T.DataType, b: T.DataType, place: str = "value") -> T.DataType:
    """The least type that holds all values of both; names are spelled as in `a`."""
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_struct(a, b, place)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, f"{place}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        keys, values = ((x.keyType, x.valueType) for x in (a, b))
        return T.MapType(common_type(keys[0], values[0], f"{place}{{key}}"), common_type(keys[1], values[1], f"{place}{{}}"))
    names = a.simpleString(), b.simpleString()
    if names[0] == names[1]:
        return a
    digits = [_digits(x) for x in (a, b)]
    if None not in digits:
        if all(n in _WHOLE for n in names):
            return max((a, b), key=lambda x: _WHOLE[x.simpleString()])
        whole, scale = (max(d[i] for d in digits) for i in (0, 1))
        if whole + scale <= _MOST_DIGITS:
            return T.DecimalType(whole + scale, scale)
    if all(n in _IN_DOUBLE for n in names):
        return T.DoubleType()
    if set(names) == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    raise TypeError(f"column {place!r} is {names[1]} but {names[0]} in the table, and no type holds both")


def _digits(dtype: T.DataType) -> tuple[int, int] | None:
    """Digits before and behind the point."""
    if isinstance(dtype, T.DecimalType):
        return dtype.precision - dtype.scale, dtype.scale
    return (_WHOLE[dtype.simpleString()], 0) if dtype.simpleString() in _WHOLE else None


def _common_struct(a: T.StructType, b: T.StructType, place: str) -> T.StructType:
    given = _by_name(b, place)
    fields = []
    for f in a.fields:
        other = given.pop(f.name.lower(), None)
        deeper = f"{place}.{f.name}" if place else f.name
        dtype = f.dataType if other is None else common_type(f.dataType, other.dataType, deeper)
        fields.append(T.StructField(f.name, dtype, True, f.metadata))
    return T.StructType([*fields, *(T.StructField(f.name, f.dataType) for f in given.values())])


def _by_name(struct: T.StructType, place: str = "") -> dict[str, T.StructField]:
    found: dict[str, T.StructField] = {}
    for f in struct.fields:
        if f.name.lower() in found:
            raise ValueError(f"{place or 'the data'} has two fields called {f.name!r}")
        found[f.name.lower()] = f
    return found


def conform(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of type `have` as `want`, a type that holds it: fields by name, absent ones NULL."""
    if have.simpleString() == want.simpleString():
        return col
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        given = _by_name(have)
        fields = []
        for f in want.fields:
            own = given.get(f.name.lower())
            value = F.lit(None).cast(f.dataType) if own is None else conform(col.getField(own.name), own.dataType, f.dataType)
            fields.append(value.alias(f.name))
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(col, lambda e: conform(e, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        if have.keyType.simpleString() != want.keyType.simpleString():
            col = F.transform_keys(col, lambda k, _: conform(k, have.keyType, want.keyType))
        return F.transform_values(col, lambda _, v: conform(v, have.valueType, want.valueType))
    return col.cast(want)


def conformed(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The columns of these fields, in their order and of their types; absent ones NULL, others left out."""
    have = _by_name(df.schema)
    return df.select(
        *(
            F.lit(None).cast(f.dataType).alias(f.name)
            if f.name.lower() not in have
            else conform(F.col(quote(have[f.name.lower()].name)), have[f.name.lower()].dataType, f.dataType).alias(f.name)
            for f in fields
        )
    )


def grow_schema(df: DataFrame, name: str, partitions: Sequence[str]) -> None:
    """Let the table's columns grow so that the data fits. Rows written before read NULL in what is new.

    Partition columns keep their types: text takes any plain value as it is spelled, others a narrower type.
    """
    spark = df.sparkSession
    parts = {p.lower() for p in partitions}
    table = spark.table(name).schema
    given = _by_name(df.schema)
    for f in table.fields:
        if f.name.lower() in parts and f.name.lower() in given:
            _check_partition(f, given[f.name.lower()].dataType, name)
    data = T.StructType([f for f in df.schema.fields if f.name.lower() not in parts])
    old = T.StructType([f for f in table.fields if f.name.lower() not in parts])
    new = _common_struct(old, data, "")
    if [f.dataType.simpleString() for f in new.fields[: len(old.fields)]] != [f.dataType.simpleString() for f in old.fields]:
        _set_data_schema(spark, name, new)
    elif len(new.fields) > len(old.fields):
        added = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in new.fields[len(old.fields) :])
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")


def _check_partition(field: T.StructField, given: T.DataType, name: str) -> None:
    if isinstance(field.dataType, T.StringType) and not isinstance(given, (T.StructType, T.ArrayType, T.MapType, T.BinaryType, T.VariantType)):
        return
    if common_type(field.dataType, given, field.name).simpleString() != field.dataType.simpleString():
        raise TypeError(f"partition column {field.name!r} of {name} is {field.dataType.simpleString()}, too narrow for {given.simpleString()}")


def _set_data_schema(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Change column types in the catalog entry, in one call and in place.

    No statement of Spark SQL does that for a file table. Making the entry anew would lose properties and
    comments and leave a moment without a table; this is the call that ADD COLUMNS makes, too.
    """
    state = spark._jsparkSession.sessionState()
    table = state.sqlParser().parseTableIdentifier(name)
    kept = T.StructType.fromJson(json.loads(state.catalog().getTableMetadata(table).dataSchema().json()))
    known = {f.name.lower(): f.metadata for f in kept.fields}
    fields = [T.StructField(f.name, f.dataType, True, known.get(f.name.lower())) for f in schema.fields]
    parsed = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(T.StructType(fields).json())
    state.catalog().alterTableDataSchema(table, parsed)
    spark.catalog.refreshTable(name)

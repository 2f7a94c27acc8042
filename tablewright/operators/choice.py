"""Columns whose values have mixed types ("choices"), kept as VARIANT until resolved."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.numbers import parse_double, parse_long
from tablewright.names import has_variant, quote
from tablewright.operators.census import record_schema

# The classes a value of a choice can belong to, in the order of output columns.
CLASSES = ("long", "double", "string", "boolean", "struct", "array")

# The Spark type of each class. Structs and arrays are kept whole as JSON text.
CLASS_TYPES = {
    "long": "bigint",
    "double": "double",
    "string": "string",
    "boolean": "boolean",
    "struct": "string",
    "array": "string",
}


def _is(kind: Column, cls: str) -> Column:
    """Whether a value whose type Spark reports as `kind` belongs to the class."""
    return {
        "long": kind == "BIGINT",
        "double": (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL"),
        "string": kind == "STRING",
        "boolean": kind == "BOOLEAN",
        "struct": kind.startswith("OBJECT"),
        "array": kind.startswith("ARRAY"),
    }[cls]


def value_class(col: Column) -> Column:
    """The class of one value, NULL for a missing or null value."""
    kind = F.schema_of_variant(col)
    found = F.when(kind.isNull() | (kind == "VOID"), F.lit(None))
    for cls in CLASSES:
        found = found.when(_is(kind, cls), cls)
    return found.otherwise("string")


# Values are taken out as text, which never fails, and converted from there behind a test. Asking the
# variant for a number would raise and swallow an exception for each text value, and that even behind
# a CASE, since Spark moves variant_get into a Parquet scan.

def _text(col: Column) -> Column:
    return F.variant_get(col, "$", "string")


def _branch(col: Column, cls: str) -> Column:
    """The value where it belongs to the class, else NULL; nothing is converted."""
    if cls == "string":
        return F.when(value_class(col) == "string", _text(col))
    return F.when(_is(F.schema_of_variant(col), cls), _text(col).try_cast(CLASS_TYPES[cls]))


def cast_choice(col: Column, target: T.DataType) -> Column:
    """The value converted to a type, NULL where that fails. Fractions are cut for long."""
    text, kind = _text(col), F.schema_of_variant(col)
    truth = (text == "true").cast("int")
    if isinstance(target, T.StringType):
        return text
    if isinstance(target, T.LongType):
        return (
            F.when((kind == "BIGINT") | (kind == "STRING"), parse_long(text))
            .when(kind.startswith("DECIMAL"), parse_long(F.split_part(text, F.lit("."), F.lit(1))))
            .when(_is(kind, "double"), text.try_cast("double").try_cast("bigint"))
            .when(kind == "BOOLEAN", truth.cast("bigint"))
        )
    if isinstance(target, T.DoubleType):
        return F.when(kind == "BOOLEAN", truth.cast("double")).otherwise(parse_double(text))
    return F.try_variant_get(col, "$", target.simpleString())


def choice_columns(df: DataFrame) -> list[str]:
    """The choices of a frame: column names, `a.b` inside a struct, `a[].b` inside the elements of an array,
    `a{}.b` inside the values of a map."""

    def inside(dtype: T.DataType, path: str) -> list[str]:
        if isinstance(dtype, T.VariantType):
            return [path]
        if isinstance(dtype, T.StructType):
            return [p for f in dtype.fields for p in inside(f.dataType, f"{path}.{f.name}")]
        if isinstance(dtype, T.MapType):
            return inside(dtype.valueType, f"{path}{{}}")
        return inside(dtype.elementType, f"{path}[]") if isinstance(dtype, T.ArrayType) else []

    return [p for f in df.schema.fields for p in inside(f.dataType, f.name)]


def _classes(col: Column, dtype: T.DataType, path: str, wanted: str) -> Column:
    """The classes of the values that the choice `wanted` has in one row, as an array."""
    if isinstance(dtype, T.ArrayType):
        return F.flatten(F.transform(col, lambda e: _classes(e, dtype.elementType, f"{path}[]", wanted)))
    if isinstance(dtype, T.MapType):
        return F.flatten(F.transform(F.map_values(col), lambda e: _classes(e, dtype.valueType, f"{path}{{}}", wanted)))
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            deeper = f"{path}.{f.name}"
            if wanted == deeper or wanted.startswith((f"{deeper}.", f"{deeper}[]", f"{deeper}{{}}")):
                return _classes(col.getField(f.name), f.dataType, deeper, wanted)
    return F.array(value_class(col))


def choice_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, list[str]]:
    """The classes that occur in each choice, by one aggregation over the data.

    The driver receives a single row of flags, whatever the size of the table.
    """
    columns = choice_columns(df) if columns is None else list(columns)
    if not columns:
        return {}
    fields = {f.name: f for f in df.schema.fields}
    found = []
    for i, path in enumerate(columns):
        name = path if path in fields else next(n for n in fields if path.startswith((f"{n}.", f"{n}[]", f"{n}{{}}")))
        found.append(_classes(F.col(quote(name)), fields[name].dataType, name, path).alias(f"c{i}"))
    flags = df.select(*found).agg(
        *(
            F.coalesce(F.bool_or(F.array_contains(f"c{i}", cls)), F.lit(False)).alias(f"c{i}_{cls}")
            for i in range(len(columns))
            for cls in CLASSES
        )
    ).first()
    return {c: [cls for cls in CLASSES if flags[f"c{i}_{cls}"]] for i, c in enumerate(columns)}


class _Resolver:
    """Builds the columns that replace choices, following structs and arrays down to them."""

    def __init__(self, actions: Mapping[str, str], classes: Mapping[str, Sequence[str]]):
        self.actions, self.classes = actions, classes

    def field(self, name: str, col: Column, dtype: T.DataType, path: str) -> list[Column]:
        verb, _, target = self.actions.get(path, "").partition(":")
        if isinstance(dtype, T.VariantType) and verb == "make_cols":
            return [_branch(col, kind).alias(f"{name}_{kind}") for kind in self.kinds(path)]
        if isinstance(dtype, T.VariantType) or has_variant(dtype):
            return [self.value(col, dtype, path).alias(name)]
        return [col.try_cast(T.DataType.fromDDL(target)).alias(name) if verb == "cast" else col.alias(name)]

    def value(self, col: Column, dtype: T.DataType, path: str) -> Column:
        if isinstance(dtype, T.StructType):
            fields = (self.field(f.name, col.getField(f.name), f.dataType, f"{path}.{f.name}") for f in dtype.fields)
            return F.when(col.isNotNull(), F.struct(*(c for columns in fields for c in columns)))
        if isinstance(dtype, T.ArrayType):
            return F.transform(col, lambda e: self.value(e, dtype.elementType, f"{path}[]"))
        if isinstance(dtype, T.MapType):
            return F.transform_values(col, lambda _, v: self.value(v, dtype.valueType, f"{path}{{}}"))
        verb, _, target = self.actions.get(path, "").partition(":")
        if not isinstance(dtype, T.VariantType) or not verb:
            return col
        if verb == "cast":
            return cast_choice(col, T.DataType.fromDDL(target))
        if verb == "project":
            return _branch(col, target)
        filled = F.struct(*(_branch(col, kind).alias(kind) for kind in self.kinds(path)))
        return F.when(value_class(col).isNotNull(), filled)

    def kinds(self, path: str) -> Sequence[str]:
        # A choice without any value still needs a type: text.
        return self.classes[path] or ["string"]


def resolve_choice(
    df: DataFrame,
    specs: Sequence[tuple[str, str]] | None = None,
    choice: str | None = None,
    types: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Turn choice columns into ordinary ones.

    specs names choices one by one (as choice_columns does), choice applies one action to all of
    them. Actions: cast:T converts (NULL on failure; a fraction cast to long is cut), project:T keeps
    only values that already are T, make_cols gives one column per class, make_struct one struct
    with a field per class. The last two need the classes of the choice: from `types` if given, else
    counted by choice_types. Everything else stays as it is.
    """
    if (specs is None) == (choice is None):
        raise ValueError("give either specs or choice")
    choices = choice_columns(df)
    actions = dict(specs) if specs is not None else {c: choice for c in choices}
    if specs is not None and len(actions) != len(specs):
        raise ValueError("a column has two actions")
    for name, action in actions.items():
        if name not in df.columns and name not in choices:
            raise ValueError(f"no column {name!r}")
        verb, _, target = action.partition(":")
        if verb not in ("cast", "project", "make_cols", "make_struct") or (
            (verb in ("cast", "project")) != bool(target)
        ):
            raise ValueError(f"unknown action {action!r}")
        if verb == "project" and target not in CLASSES:
            raise ValueError(f"project needs one of {CLASSES}, not {target!r}")

    split = [c for c, a in actions.items() if a in ("make_cols", "make_struct") and c in choices]
    classes = {c: list(types[c]) for c in split if types and c in types}
    unknown = [c for c in split if c not in classes]
    if unknown:
        classes.update(choice_types(df, unknown))
    resolver = _Resolver(actions, classes)
    columns = (resolver.field(f.name, F.col(quote(f.name)), f.dataType, f.name) for f in df.schema.fields)
    out = df.select(*(c for group in columns for c in group))
    if len(set(out.columns)) != len(out.columns):
        raise ValueError(f"make_cols would repeat a column name: {out.columns}")
    return out


def _step(field: str) -> str:
    mark = '"' if "'" in field else "'"
    return f"[{mark}{field}{mark}]"


def open_records(df: DataFrame, column: str = "record", schema: T.StructType | None = None) -> DataFrame:
    """JSON records in one VARIANT column to one column per field; only choices stay VARIANT."""
    schema = schema or record_schema(df, column)
    record = F.col(quote(column))
    return df.select(
        *(F.variant_get(record, "$" + _step(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields)
    )

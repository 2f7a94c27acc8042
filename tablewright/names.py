"""Quoting and checking of names that end up in SQL text or column references."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def identifier(name: str) -> str:
    """A database or table name that may be put into SQL text; anything else is refused."""
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain table or database name: {name!r}")
    return name


def qualified(db: str, table: str) -> str:
    return f"{identifier(db)}.{identifier(table)}"


def quote(column: str) -> str:
    """A column name as one backticked reference, dots and blanks included."""
    return "`" + column.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def has_variant(dtype: T.DataType) -> bool:
    """True if a choice is left anywhere inside the type."""
    if isinstance(dtype, T.VariantType):
        return True
    if isinstance(dtype, T.StructType):
        return any(has_variant(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return has_variant(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return has_variant(dtype.keyType) or has_variant(dtype.valueType)
    return False

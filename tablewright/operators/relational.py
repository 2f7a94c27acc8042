"""Nested records to a root table and one child table per array or map."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.names import has_variant, quote
from tablewright.session import materialize


def _flat(
    dtype: T.StructType, parent: Column | None, prefix: str, sep: str
) -> tuple[list[tuple[str, Column]], list[tuple[str, Column, T.DataType]]]:
    """Struct fields as (name, column) scalars and (name, column, type) collections, depth first."""
    scalars, collections = [], []
    for field in dtype.fields:
        name = prefix + field.name
        col = F.col(quote(field.name)) if parent is None else parent.getField(field.name)
        if isinstance(field.dataType, T.StructType):
            inner_scalars, inner_collections = _flat(field.dataType, col, name + sep, sep)
            scalars += inner_scalars
            collections += inner_collections
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            collections.append((name, col, field.dataType))
        else:
            scalars.append((name, col))
    return scalars, collections


def _select(df: DataFrame, columns: list[tuple[str, Column]], table: str) -> DataFrame:
    names = [name.lower() for name, _ in columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"table {table!r} would have column {twice} twice; use another separator or rename")
    return df.select(*(col.alias(name) for name, col in columns))


def _children(
    df: DataFrame,
    table: str,
    links: list[str],
    collections: list[tuple[str, Column, T.DataType]],
    sep: str,
    out: dict[str, DataFrame],
    link_prefix: str,
) -> None:
    for name, col, dtype in collections:
        child = f"{table}{sep}{name}"
        if child in out:
            raise ValueError(f"two collections would both become table {child!r}")
        kept = [F.col(quote(link)) for link in links]
        if isinstance(dtype, T.MapType):
            rows = df.select(*kept, F.explode(col).alias("key", "value"))
            own, element_type = ["key"], dtype.valueType
        else:
            rows = df.select(*kept, F.posexplode(col).alias("index", "value"))
            own, element_type = ["index"], dtype.elementType
        linked = [(link, F.col(quote(link))) for link in links + own]
        scalars, inner = _element(F.col("value"), element_type, sep)
        sizes = [(f"{inner_name}_size", F.size(inner_col)) for inner_name, inner_col, _ in inner]
        # A link column that an element's field is called like takes the prefix.
        taken = {column.lower() for column, *_ in scalars + sizes}
        linked = [(link_prefix + link if link.lower() in taken else link, col) for link, col in linked]
        out[child] = _select(rows, linked + scalars + sizes, child)
        if inner:
            # The grandchildren see this level's position under its own name.
            renamed = {own[0]: f"{name}_{own[0]}"}
            deeper = rows.withColumnsRenamed(renamed)
            _children(deeper, child, links + list(renamed.values()), inner, sep, out, link_prefix)


def relationalize(
    df: DataFrame,
    root: str,
    key: Sequence[str] | str | None = None,
    staging_path: str | None = None,
    sep: str = "_",
    link_prefix: str | None = None,
) -> dict[str, DataFrame]:
    """Split nested records into flat tables, named root and root_field for each array or map.

    Struct fields become columns `field_sub`. Each array or map leaves `field_size` behind (NULL for
    a missing one, 0 for an empty one). A child row carries the link columns, then `index` (0-based)
    and the element's fields, or `value` for a plain element; a map's child has `key` instead of
    `index`. Deeper levels also carry the positions of the levels above as `field_index`.

    The link columns are the `key` columns, which must identify a record. Without a key the link is
    a generated `<root>_id`. Where an element has a field of that name, or one called index or key, the
    link column is called link_prefix (`<root>_` unless given) and its name. Without a key the records are then written once below staging_path (the shared
    folder if none is given), so that root and children agree on it whenever they are computed.
    """
    df, links = _with_links(df, root, key, staging_path, sep)
    return _frames(df, root, links, sep, f"{root}{sep}" if link_prefix is None else link_prefix)


def _with_links(df: DataFrame, root: str, key: Sequence[str] | str | None, staging_path: str | None, sep: str) -> tuple[DataFrame, list[str]]:
    """The records and the columns that link their tables, generated ones written down."""
    links = [key] if isinstance(key, str) else list(key or [])
    missing = [link for link in links if link not in df.columns]
    if missing:
        raise ValueError(f"no key column {missing}")
    if has_variant(df.schema):
        raise TypeError("resolve the choice columns before splitting the records")
    if not links:
        generated = f"{root}{sep}id"
        if generated in df.columns:
            raise ValueError(f"column {generated!r} exists; name a key")
        ids = df.select(F.monotonically_increasing_id().alias(generated), "*")
        return materialize(ids, staging_path, label="relationalize"), [generated]
    return (materialize(df, staging_path) if staging_path else df), links


def _frames(df: DataFrame, root: str, links: list[str], sep: str, link_prefix: str) -> dict[str, DataFrame]:
    scalars, collections = _flat(df.schema, None, "", sep)
    sizes = [(f"{name}_size", F.size(col)) for name, col, _ in collections]
    out: dict[str, DataFrame] = {root: _select(df, scalars + sizes, root)}
    _children(df, root, links, collections, sep, out, link_prefix)
    return out


def tagged_rows(
    df: DataFrame,
    root: str,
    key: Sequence[str] | str | None = None,
    staging_path: str | None = None,
    sep: str = "_",
    link_prefix: str | None = None,
) -> list[tuple[DataFrame, dict[str, T.StructType]]]:
    """The tables of `relationalize` as rows of one frame, made by one pass over the records.

    Each row names its `table` and has the columns of all of them, NULL where they are another's. Tables with
    a column of the same name and another type go to a frame of their own, so there are as many frames as
    types clash, mostly one. Beside each frame are its tables and their schemas.
    """
    df, links = _with_links(df, root, key, staging_path, sep)
    frames = _frames(df, root, links, sep, f"{root}{sep}" if link_prefix is None else link_prefix)
    schemas = {name: frame.schema for name, frame in frames.items()}
    groups: list[tuple[dict[str, T.StructField], list[str]]] = []
    for name, schema in schemas.items():
        fields = {f.name.lower(): f for f in schema.fields}
        for taken, members in groups:
            if all(taken.get(n, f).dataType.simpleString() == f.dataType.simpleString() for n, f in fields.items()):
                taken.update({n: f for n, f in fields.items() if n not in taken})
                members.append(name)
                break
        else:
            groups.append((fields, [name]))
    scalars, collections = _flat(df.schema, None, "", sep)
    sizes = [F.size(col) for _, col, _ in collections]
    out = []
    for taken, members in groups:
        union = T.StructType([T.StructField("table", T.StringType()), *(T.StructField(f.name, f.dataType) for f in taken.values())])
        if "table" in taken:
            raise ValueError("a column is called 'table'; rename it")
        nothing = F.array().cast(T.ArrayType(union))

        def row(name: str, values: list[Column], taken: dict = taken) -> Column:
            own = dict(zip((c.lower() for c in schemas[name].names), values, strict=True))
            filled = (own[n].cast(f.dataType) if n in own else F.lit(None).cast(f.dataType) for n, f in taken.items())
            return F.struct(F.lit(name).alias("table"), *(c.alias(f.name) for c, f in zip(filled, taken.values(), strict=True)))

        arrays = [F.array(row(root, [col for _, col in scalars] + sizes))] if root in members else []
        arrays += [_nested(member, root, [F.col(quote(link)) for link in links], collections, sep, row, nothing) for member in members if member != root]
        rows = df.select(F.explode(F.concat(*arrays)).alias("row")).select("row.*")
        out.append((rows, {member: schemas[member] for member in members}))
    return out


def _nested(
    wanted: str,
    table: str,
    links: list[Column],
    collections: list[tuple[str, Column, T.DataType]],
    sep: str,
    row: Callable[[str, list[Column]], Column],
    nothing: Column,
) -> Column:
    """The rows of the table `wanted` that one record (or element) holds, as an array."""
    name, col, dtype = next(c for c in collections if wanted == f"{table}{sep}{c[0]}" or wanted.startswith(f"{table}{sep}{c[0]}{sep}"))
    # Of names that begin alike the longest is meant.
    for other in collections:
        if len(other[0]) > len(name) and (wanted == f"{table}{sep}{other[0]}" or wanted.startswith(f"{table}{sep}{other[0]}{sep}")):
            name, col, dtype = other
    child, is_map = f"{table}{sep}{name}", isinstance(dtype, T.MapType)
    element_type = dtype.valueType if is_map else dtype.elementType

    def one(element: Column, index: Column) -> Column:
        value, place = (element["value"], element["key"]) if is_map else (element, index)
        scalars, inner = _element(value, element_type, sep)
        if wanted == child:
            return row(child, [*links, place, *(c for _, c in scalars), *(F.size(c) for _, c, _ in inner)])
        return _nested(wanted, child, [*links, place], inner, sep, row, nothing)

    found = F.transform(F.map_entries(col) if is_map else col, one)
    return F.coalesce(found if wanted == child else F.flatten(found), nothing)


def _element(value: Column, dtype: T.DataType, sep: str) -> tuple[list[tuple[str, Column]], list[tuple[str, Column, T.DataType]]]:
    """Columns and collections of one element. An array directly in an array has no name: its elements are 'items'."""
    if isinstance(dtype, T.StructType):
        return _flat(dtype, value, "", sep)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return [], [("items", value, dtype)]
    return [("value", value)], []

"""Compare a registered query with its SQL, run by DuckDB on the same tables."""

import datetime
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, function, sql, sf_dir):
    """(seconds, rows, problem or None)"""
    start = time.time()
    df = function(spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    if sql is None:
        return seconds, len(got), None
    con.execute(sql)
    names = [d[0] for d in con.description]
    want = con.fetchall()
    if sorted(names) != sorted(df.columns):
        return seconds, len(got), f"columns {df.columns} / {names}"
    mine, theirs = _rows(df.columns, got), _rows(names, want)
    if mine != theirs:
        extra = [r for r in mine if r not in set(theirs)][:3]
        lost = [r for r in theirs if r not in set(mine)][:3]
        return seconds, len(got), f"{len(mine)} / {len(theirs)} rows; only here {extra}; only there {lost}"
    return seconds, len(got), None

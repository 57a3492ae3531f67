"""Compares a Spark frame with the DuckDB result of its SQL."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{round(value, 5) + 0.0:.5f}"
    if hasattr(value, "as_tuple"):
        return f"{float(value):.5f}"
    return str(value)


def normal(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in records)


def differences(frame, con, sql):
    """None if both agree, else a text that says how they differ."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = normal(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} are not {sorted(names)}"
    found = normal(frame.columns, [tuple(r) for r in frame.collect()])
    if found == expected:
        return None if found else "no rows on either side"
    missing, extra = set(expected) - set(found), set(found) - set(expected)
    return (
        f"{len(found)} rows, {len(expected)} expected; columns {sorted(names)}; "
        f"missing {sorted(missing)[:3]}; extra {sorted(extra)[:3]}"
    )

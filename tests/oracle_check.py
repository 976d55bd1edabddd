"""Comparison of query results with their SQL."""

import math

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
            benchmark labels conversations""".split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (1, "nan" if math.isnan(value) else f"{float(value):.9g}")
    return (1, str(value))


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(df, connection, sql):
    """None when equal, else a description of the first difference."""
    got_columns, got = normalised(df.columns, df.collect())
    cursor = connection.execute(sql)
    want_columns, want = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra = list(set(got) - set(want))[:2]
        lacking = list(set(want) - set(got))[:2]
        return f"rows {len(got)} vs {len(want)}; only here {extra}; only there {lacking}"
    return None

"""Compares the result of a query with that of its SQL."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(names), sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(db, sql):
    found = db.execute(sql)
    return rows_of([d[0] for d in found.description], found.fetchall())

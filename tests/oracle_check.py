"""Runs registered queries next to their SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def kinds_differ(df, db, sql) -> list[str]:
    """Columns whose type in Spark is another than in SQL."""
    told = {row[0]: row[1] for row in db.execute("DESCRIBE " + sql).fetchall()}
    return [f"{f.name}: {f.dataType.simpleString()} against {told.get(f.name)}" for f in df.schema.fields
            if KINDS.get(f.dataType.simpleString()) != told.get(f.name)]


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (bool, int, str)) or value is None:
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, db, query, sql, folder) -> tuple[bool, str]:
    started = time.time()
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    done = db.execute(sql)
    columns = [d[0] for d in done.description]
    want = rows_of(columns, done.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    if got == want:
        return True, f"{len(got)} rows, {seconds:.1f} s"
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return False, f"{len(got)} against {len(want)} rows; spark only {extra}; sql only {missing}"[:1500]

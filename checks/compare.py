"""Run registered queries in Spark and DuckDB side by side: python -m checks.compare FOLDER [query…]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.registry import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return float(value) if type(value).__name__ == "Decimal" else value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(normal(record[i]) for i in order) for record in records]
    return sorted(names), sorted(found, key=repr)


def open_tables(folder):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def compare(spark, db, folder, name):
    """None if equal, else what differs; also the seconds Spark took and the row count."""
    started = time.perf_counter()
    df = QUERIES[name](spark, folder)
    ours = rows(df.columns, df.collect())
    seconds = time.perf_counter() - started
    if name not in ORACLES:
        return None, seconds, len(ours[1])
    relation = db.sql(ORACLES[name])
    theirs = rows(relation.columns, relation.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} and {theirs[0]}", seconds, len(ours[1])
    if ours[1] != theirs[1]:
        mine, other = set(ours[1]), set(theirs[1])
        return (
            f"{len(ours[1])} and {len(theirs[1])} rows; only Spark {sorted(mine - other, key=repr)[:3]};"
            f" only SQL {sorted(other - mine, key=repr)[:3]}"
        ), seconds, len(ours[1])
    return None, seconds, len(ours[1])


def main():
    from tests.conftest import local_session

    folder, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, db = local_session(), open_tables(folder)
    for name in chosen:
        try:
            fault, seconds, count = compare(spark, db, folder, name)
        except Exception as error:
            print(f"{name}: ERROR {str(error)[:1500]}", flush=True)
            continue
        kind = "" if name in ORACLES else " (rows only)"
        print(f"{name}: {'same' + kind if fault is None else 'DIFFERENT ' + fault} {count} rows {seconds:.2f}s", flush=True)


if __name__ == "__main__":
    main()

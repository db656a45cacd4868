"""Compare every query with its SQL text in DuckDB: rows, column names, values."""

from __future__ import annotations

import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


# SQL type -> Spark type.
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "TINYINT": "tinyint", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def _canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda t: tuple((v is not None, str(v)) for v in t))


def compare(spark, sf, names=None):
    """Yield (name, message or None, seconds in Spark, seconds in SQL)."""
    import duckdb

    from suite.oracle import oracle_sql
    from suite.queries import REGISTRY

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    oracle = oracle_sql()
    for name, fn in REGISTRY.items():
        if names and name not in names:
            continue
        start = time.time()
        df = fn(spark, sf)
        got = _canonical([tuple(r) for r in df.collect()], df.columns)
        spark_time = time.time() - start
        if name not in oracle:
            yield name, "no sql", spark_time, 0.0
            continue
        start = time.time()
        result = con.execute(oracle[name])
        columns = [c[0] for c in result.description]
        want = _canonical(result.fetchall(), columns)
        sql_time = time.time() - start
        message = None
        kinds = {c[0]: KINDS.get(str(c[1]).upper(), str(c[1])) for c in result.description}
        wrong = {c: (t, kinds.get(c)) for c, t in df.dtypes if kinds.get(c) != t}
        if sorted(columns) != sorted(df.columns):
            message = f"columns {sorted(df.columns)} / {sorted(columns)}"
        elif len(got) != len(want):
            message = f"rows {len(got)} / {len(want)}"
        elif got != want:
            first = next((a, b) for a, b in zip(got, want) if a != b)
            message = f"values {first}"
        elif wrong:
            message = f"types {wrong}"
        yield name, message, spark_time, sql_time


if __name__ == "__main__":
    from degraus import get_session

    session = get_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, message, spark_time, sql_time in compare(session, sys.argv[1], set(sys.argv[2:])):
        bad += message not in (None, "no sql")
        print(f"{name:24s} {spark_time:6.2f}s {sql_time:6.2f}s {message or 'ok'}"[:700], flush=True)
    print("mismatches:", bad)

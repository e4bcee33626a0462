"""Runs a registered query on Spark and its SQL on DuckDB, and compares all rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str):
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, db, query, sql, folder, empty_ok=False) -> str | None:
    """None if equal, else what differs."""
    left = query(spark, folder)
    left_rows = [tuple(r) for r in left.collect()]
    done = db.execute(sql)
    names = [d[0] for d in done.description]
    right_rows = done.fetchall()
    if sorted(left.columns) != sorted(names):
        return f"columns {sorted(left.columns)} against {sorted(names)}"
    a, b = rows_of(left.columns, left_rows), rows_of(names, right_rows)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    if a != b:
        x = [r for r in a if r not in set(b)][:3]
        y = [r for r in b if r not in set(a)][:3]
        return f"values differ, sorted columns {sorted(names)}: {x} against {y}"
    if not a and not empty_ok:
        return "no rows on either side"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from seasonflow.session import local_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    db = database(folder)
    sqls, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            if name in sqls:
                result = compare(spark, db, query, sqls[name], folder)
            else:
                rows = query(spark, folder).collect()
                result = None if rows else "no rows"
                if only:
                    print(*rows[:8], sep="\n")
        except Exception as e:
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += result is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'ok  ' if result is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {result or ''}", flush=True)
    print("failures:", bad)

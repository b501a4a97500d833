"""Run registered queries next to their SQL and compare the results."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    if type(value).__name__ == "Decimal":
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


def compare(spark, con, name, fn, sql, sf):
    """(ok, message, seconds)."""
    started = time.time()
    df = fn(spark, sf)
    got_columns = df.columns
    got = rows_of(got_columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    if sql is None:
        return bool(got), f"{len(got)} rows, no SQL", seconds
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = rows_of(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return False, f"columns {sorted(got_columns)} / {sorted(want_columns)}", seconds
    if len(got) != len(want):
        return False, f"{len(got)} / {len(want)} rows; {got[:2]} / {want[:2]}", seconds
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a if x is not None] != [type(x) for x in b if x is not None]:
            return False, f"{a} / {b}", seconds
    return True, f"{len(got)} rows", seconds


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from __spark_entry__ import oracle_sql, queries
    from riskframe.session import local_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    oracles = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            ok, message, seconds = compare(spark, con, name, fn, oracles.get(name), sf)
        except Exception as e:  # noqa: BLE001
            ok, message, seconds = False, f"{type(e).__name__}: {str(e)[:600]}", 0.0
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {seconds:.1f}s {message[:700]}", flush=True)
    print("failed:", bad)

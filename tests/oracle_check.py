"""Run registered Spark queries next to their DuckDB oracle SQL and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (exact values,
columns sorted by name), like the correctness gate.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return v
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


_TYPES = {
    "LongType": "BIGINT",
    "IntegerType": "INTEGER",
    "DoubleType": "DOUBLE",
    "FloatType": "FLOAT",
    "StringType": "VARCHAR",
    "BooleanType": "BOOLEAN",
    "ShortType": "SMALLINT",
    "ByteType": "TINYINT",
}


def spark_type(dt) -> str:
    n = type(dt).__name__
    if n == "ArrayType":
        return spark_type(dt.elementType) + "[]"
    return _TYPES.get(n, n)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: spark_type(f.dataType) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con.execute(f"create or replace view checked_oracle as {sql}")  # as the driver does: what can't be a view fails here
    res = con.execute("select * from checked_oracle")
    d_cols = [d[0] for d in res.description]
    d_types = {d[0]: str(d[1]) for d in res.description}
    d_rows = res.fetchall()
    t2 = time.time()
    msg = []
    if sorted(s_cols) != sorted(d_cols):
        msg.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
    bad_t = {c: (s_types[c], d_types.get(c)) for c in s_cols if c in d_types and s_types[c] != d_types[c]}
    if bad_t:
        msg.append(f"types differ: {bad_t}")
    if len(s_rows) != len(d_rows):
        msg.append(f"rows differ: spark={len(s_rows)} duck={len(d_rows)}")
    if not msg:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a != b:
            bad = [(x, y) for x, y in zip(a, b) if x != y]
            msg.append(f"values differ in {len(bad)} rows; first: spark={bad[0][0]} duck={bad[0][1]}")
    return msg, len(s_rows), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from flowtriage.runtime import local_session, release

    spark = local_session()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in oracle:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name:32s} rows={n} spark={time.time() - t0:.1f}s (no oracle)")
            continue
        try:
            msg, n, ts, td = compare(spark, con, name, fn, oracle[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            msg, n, ts, td = [f"error: {type(e).__name__}: {str(e)[:400]}"], -1, 0, 0
        failed += bool(msg)
        print(f"{'FAIL' if msg else 'OK  '}  {name:32s} rows={n} spark={ts:.1f}s duck={td:.1f}s {' | '.join(msg)}")
    release(spark)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

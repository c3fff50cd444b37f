"""Run registered queries in Spark and their SQL in DuckDB and compare them.

Usage: ``python tests/oracle.py [sf_dir] [name ...]``. Also used by ``tests/test_oracle.py``.
Comparison: same column names and types, same row count, same multiset of rows after sorting
columns by name and rounding doubles to 6 decimals.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    duck_types = {d[0]: str(d[1]) for d in res.description}
    type_diffs = {k: (v, duck_types.get(k)) for k, v in spark_types.items() if v != duck_types.get(k)}
    if type_diffs:
        problems.append(f"types differ {type_diffs}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(srows), t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from keelson.session import build_session

    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            df = fn(spark, sf_dir)
            print(f"{name:45s} rows-only {df.count()}")
            continue
        try:
            problems, n, ts, td = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # report and continue
            problems, n, ts, td = [f"error {type(e).__name__}: {str(e)[:400]}"], -1, 0, 0
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name:45s} rows={n:7d} spark={ts:6.2f}s duck={td:5.2f}s {'; '.join(problems)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

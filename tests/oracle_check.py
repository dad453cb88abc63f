"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison mirrors the driver: columns sorted by name, row counts, and an
order-insensitive comparison of the value multiset.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as se  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.driver import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session(os.environ.get("ORACLE_MASTER", "local[8]"),
                          shuffle_partitions=int(os.environ.get("ORACLE_SHUFFLE", "0")) or None)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = se.queries(), se.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(s_rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        if sorted(s_cols) != sorted(d_cols):
            print(f"FAIL {name}: columns {sorted(s_cols)} vs {sorted(d_cols)}")
            bad += 1
            continue
        dmap = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                "StringType()": "VARCHAR", "DateType()": "DATE", "TimestampNTZType()": "TIMESTAMP",
                "ShortType()": "SMALLINT", "BooleanType()": "BOOLEAN"}
        s_types = {f.name: dmap.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
        d_types = {d[0]: str(d[1]) for d in res.description}
        diff = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
        if diff:
            print(f"WARN {name}: dtypes differ {diff}")
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a != b:
            bad += 1
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}")
            sa, sb = set(a), set(b)
            print("  spark only:", sorted(sa - sb, key=repr)[:3])
            print("  duck only: ", sorted(sb - sa, key=repr)[:3])
        else:
            print(f"OK   {name}: {len(a)} rows {ts:.1f}s")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

"""Run registered queries on Spark and their oracle on DuckDB and compare.

usage: python tests/check_oracle.py [--sf 0.01] [--hot N] [key ...]
"""

import argparse
import glob
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from starloom.session import get_spark  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return str(v) if not isinstance(v, int) else v


def table(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in idx], sorted((tuple(norm(r[i]) for i in idx) for r in rows), key=repr)


def connect(folder):
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{folder}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, q, tables):
    t0 = time.time()
    df = q.run(tables)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if not q.sql:
        return f"rows-only {len(rows)} rows {t1 - t0:.1f}s", len(rows) > 0
    rel = con.execute(q.sql)
    desc = rel.description
    orows = rel.fetchall()
    t2 = time.time()
    c1, r1 = table(df.columns, rows)
    c2, r2 = table([d[0] for d in desc], orows)
    if c1 != c2:
        return f"COLUMNS spark={c1} duck={c2}", False
    types = {d[0]: str(d[1]) for d in desc}
    bad = [(n, t, types[n]) for n, t in df.dtypes if TYPES.get(t, t) != types[n]]
    note = f" types differ {bad}" if bad else ""
    if r1 != r2:
        diff = [(a, b) for a, b in zip(r1, r2) if a != b]
        return f"VALUES rows {len(r1)}/{len(r2)}, {len(diff)} differ {c1}\n   spark {diff[0][0] if diff else r1[:1]}\n   duck  {diff[0][1] if diff else r2[:1]}" + note, False
    return f"ok {len(r1)} rows spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s" + note, len(r1) > 0 and not bad


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--hot", default=None)
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from starloom.plans.catalogue import QUERIES
    from starloom.plans.views import Tables

    conf = {"spark__ui__showConsoleProgress": "false", "spark__sql__shuffle__partitions": "8", "spark__driver__memory": "12g"}
    if a.hot:
        conf["spark__starloom__hotRows"] = a.hot
    spark = get_spark("check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{a.sf}"
    con = connect(folder)
    tables = Tables(spark, folder)
    keys = [k for k in QUERIES if not a.keys or any(k == x or (x.endswith("*") and k.startswith(x[:-1])) for x in a.keys)]
    failed = []
    for k in keys:
        try:
            msg, good = compare(spark, con, QUERIES[k], tables)
        except Exception as e:
            msg, good = "ERROR " + (traceback.format_exc()[-1500:] if len(keys) < 4 else str(e)[:700]), False
        if not good:
            failed.append(k)
        print(("  " if good else "! ") + k, msg, flush=True)
    print(f"{len(keys) - len(failed)}/{len(keys)} good; failed: {failed}")


if __name__ == "__main__":
    main()

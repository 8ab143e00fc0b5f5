"""Run every registered query in Spark and its DuckDB twin; compare row count,
column names and order-insensitive values (as the driver does).

    python -m tests.oracle_harness [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


SPARK_TO_DUCK = {"double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT",
                 "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_mismatches(schema, duck_types):
    d = dict(duck_types)
    return [(n, t, d.get(n)) for n, t in schema if SPARK_TO_DUCK.get(t, t) != d.get(n)]


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(canon(r[i]) for i in order) for r in rows], sorted(cols)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    s, scols = rows_of(sdf.columns, srows)
    d, dcols_sorted = rows_of(dcols, drows)
    ok_cols = scols == dcols_sorted
    ok_n = len(s) == len(d)
    ok_v = sorted(s) == sorted(d)
    return dict(name=name, ok=ok_cols and ok_n and ok_v, cols=ok_cols, n=(len(s), len(d)),
                values=ok_v, sec=round(t1 - t0, 2), spark_cols=scols, duck_cols=dcols_sorted,
                s_only=sorted(set(s) - set(d))[:3], d_only=sorted(set(d) - set(s))[:3],
                schema=[(f.name, f.dataType.simpleString()) for f in sdf.schema.fields],
                duck_types=[(c[0], str(c[1])) for c in res.description])


def main(argv):
    from pyspark.sql import SparkSession
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in oracle:
            print(f"{name:28s} NO-ORACLE")
            continue
        try:
            r = compare(spark, con, name, fn, oracle[name], sf_dir)
        except Exception as e:  # report and go on
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        tm = type_mismatches(r["schema"], r["duck_types"])
        if tm:
            print(f"{name:28s} TYPES {tm}")
        flag = "ok " if r["ok"] else "BAD"
        bad += not r["ok"]
        print(f"{name:28s} {flag} n={r['n']} cols={r['cols']} values={r['values']} {r['sec']}s")
        if not r["ok"]:
            print("   spark", r["spark_cols"], "\n   duck ", r["duck_cols"])
            print("   s_only", r["s_only"], "\n   d_only", r["d_only"])
            print("   schema", r["schema"], "\n   duck_types", r["duck_types"])
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

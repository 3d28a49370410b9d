"""Compare registered Spark queries with their DuckDB oracles.

Mirrors the driver's check: row count, column names (sorted) and an
order-insensitive hash of the values.  Usable as a script:

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6) + 0.0)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, con, key, query, sql, sf_dir):
    t0 = time.time()
    df = query(spark, sf_dir)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(cols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_hash = ok_cols and digest(cols, srows) == digest(dcols, drows)
    return dict(key=key, rows=len(srows), oracle_rows=len(drows), cols_ok=ok_cols,
                hash_ok=ok_hash, spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2),
                cols=cols, oracle_cols=dcols)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from tallyho.session import build_session
    if os.environ.get("ORACLE_PLAIN_SESSION"):
        # what a harness typically builds: defaults only (1 GB heap)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracles = queries(), oracle_sql()
    bad = 0
    for key in qs:
        if wanted and key not in wanted:
            continue
        if key not in oracles:
            df = qs[key](spark, sf_dir)
            print(f"{key:28s} rows-only {df.count()}")
            continue
        try:
            r = compare(spark, con, key, qs[key], oracles[key], sf_dir)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{key:28s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["hash_ok"] and r["rows"] == r["oracle_rows"]
        bad += not ok
        print(f"{key:28s} {'OK ' if ok else 'BAD'} rows={r['rows']}/{r['oracle_rows']} "
              f"cols={r['cols_ok']} spark={r['spark_s']}s duck={r['duck_s']}s"
              + ("" if r["cols_ok"] else f" {r['cols']} vs {r['oracle_cols']}"))
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

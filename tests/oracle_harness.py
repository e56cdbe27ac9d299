"""Run registered Spark queries and their DuckDB SQL side by side and compare the results.

Usage: ``python tests/oracle_harness.py [sf_dir] [name ...]``. Compares column names, row
counts and the multiset of rows, once exactly and once with floats rounded to 6 significant
digits, and prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v.is_integer() and abs(v) < 2 ** 53:
            return int(v)
        if digits is None:
            return repr(v + 0.0)
        return float(f"{v:.{digits}g}") + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def rows_of(pdf: pd.DataFrame, digits):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(None if (not isinstance(x, (list, tuple)) and pd.isna(x)) else x,
                               digits) for x in rec))
    return sorted(out, key=repr)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    res = {"cols": sorted(spark_pdf.columns) == sorted(duck_pdf.columns),
           "rows": (len(spark_pdf), len(duck_pdf))}
    if not res["cols"]:
        res["col_diff"] = (sorted(set(spark_pdf.columns) - set(duck_pdf.columns)),
                           sorted(set(duck_pdf.columns) - set(spark_pdf.columns)))
        return res
    res["exact"] = rows_of(spark_pdf, None) == rows_of(duck_pdf, None)
    a, b = rows_of(spark_pdf, 6), rows_of(duck_pdf, 6)
    res["approx"] = a == b
    if not res["approx"]:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_duck"] = sorted(sb - sa)[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    if os.environ.get("PLAIN_SESSION"):
        # a bare session like the correctness driver's: none of tripdeck's settings
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8")
                 .config("spark.sql.session.timeZone", os.environ.get("PLAIN_TZ", "UTC"))
                 .getOrCreate())
    else:
        from tripdeck.session import build_session
        spark = build_session()
    queries, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(queries):
        t0 = time.time()
        try:
            sp = queries[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"{name:28s} rows-only {len(sp)} rows  spark {t1 - t0:.1f}s")
            continue
        try:
            dk = con.sql(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        r = compare(sp, dk)
        ok = r["cols"] and r["rows"][0] == r["rows"][1] and r.get("approx")
        bad += 0 if ok else 1
        print(f"{name:28s} {'OK ' if ok else 'BAD'} exact={r.get('exact')} rows={r['rows']} "
              f"spark {t1 - t0:.1f}s" + ("" if ok else f"  {r}"))
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

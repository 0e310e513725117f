"""Run a registered Spark query and its DuckDB twin on the same tables and compare them.

Comparison as the driver does it: same row count, same column names, same multiset of rows
(values compared exactly, columns sorted by name).
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and v == int(v) and abs(v) < 2**53:
        return float(v)
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0) for v in row)


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, repr(x)) for x in r))
    return cols, out


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None, verbose: bool = True) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols, s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t_spark = time.time() - t0
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    rel = con.execute(sql)
    d_names = [d[0] for d in rel.description]
    d_cols, d_rows = rows_of(d_names, rel.fetchall())
    res["duck_rows"] = len(d_rows)
    if s_cols != d_cols:
        res["status"] = f"columns differ: spark={s_cols} duck={d_cols}"
    elif len(s_rows) != len(d_rows):
        res["status"] = "row count differs"
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        res["status"] = f"values differ, e.g. {diff}"
    else:
        res["status"] = "match"
    if verbose:
        print(res, file=sys.stderr)
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from listenkpi.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8, 8)
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, sf, name, fn, sqls.get(name), con, verbose=False)
        except Exception as e:  # report and go on
            r = {"query": name, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("match", "no-oracle")
        print(r, flush=True)
    print("mismatches:", bad)

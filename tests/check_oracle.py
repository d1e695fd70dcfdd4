"""Run registered queries against their DuckDB oracle.

    python tests/check_oracle.py [sf_dir] [name ...]

Prints one line per query: row counts, column names, and whether the
order-insensitive multiset of rows is equal (exactly, and with doubles
rounded to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
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
            return None
        if digits and v != 0 and math.isfinite(v):
            return float(f"{v:.{digits}g}")
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), digits)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def rows_of(records, cols, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in records]
    return sorted(out, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, spark_rows=len(srows), oracle=None, secs=round(t1 - t0, 2))
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res = dict(name=name, spark_rows=len(srows), duck_rows=len(drows),
               cols_equal=sorted(scols) == sorted(dcols), secs=round(t1 - t0, 2))
    if not res["cols_equal"]:
        res["spark_cols"], res["duck_cols"] = scols, dcols
        return res
    res["exact"] = rows_of(srows, scols, 0) == rows_of(drows, dcols, 0)
    a, b = rows_of(srows, scols, 9), rows_of(drows, dcols, 9)
    res["rounded"] = a == b
    if not res["rounded"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_duck"] = list(sb - sa)[:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from wattline.session import get_session
    spark = get_session("local[8]", 8, driver_memory="8g")
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as e:  # report and go on
            r = dict(name=name, error=f"{type(e).__name__}: {str(e)[:400]}")
        ok = r.get("oracle", True) is None or (r.get("rounded") and r.get("spark_rows") == r.get("duck_rows"))
        bad += 0 if ok and "error" not in r else 1
        print(("OK  " if ok and "error" not in r else "BAD ") + repr(r), flush=True)
    print(f"{bad} bad of {len(names or qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

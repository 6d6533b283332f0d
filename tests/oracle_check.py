"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and an order-insensitive canonical form of values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tokenmeter.sources.tables import TABLES, table_path  # noqa: E402


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else format(v.normalize(), "f")
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if hasattr(v, "item"):
        return canon(v.item())
    return str(v)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = table_path(sf_dir, t)
        if Path(p).exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in records), [columns[i] for i in order]


def compare(spark, name, query, sql, sf_dir, con):
    t = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    st = time.time() - t
    s_sorted, s_cols = rows_of(sdf.columns, srows)
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(st, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    d_sorted, d_cols = rows_of(dcols, res.fetchall())
    ok = s_cols == d_cols and s_sorted == d_sorted
    out = dict(name=name, ok=ok, rows=len(srows), oracle_rows=len(d_sorted), spark_s=round(st, 2))
    if not ok:
        out["cols"] = (s_cols, d_cols) if s_cols != d_cols else None
        diff_s = sorted(set(s_sorted) - set(d_sorted))[:3]
        diff_d = sorted(set(d_sorted) - set(s_sorted))[:3]
        out["only_spark"] = diff_s
        out["only_oracle"] = diff_d
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from tokenmeter.session import build_session

    spark = build_session()
    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        r = compare(spark, name, qs[name], ors.get(name), sf_dir, con)
        bad += r["ok"] is False
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

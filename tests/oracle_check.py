"""Run registered queries in Spark and their SQL twins in DuckDB; compare like the driver does:
row count, column names, and an order-insensitive comparison of values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    return v


def canon(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["duck_sec"] = round(time.time() - t1, 2)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS differ: spark-only {sorted(set(s_cols) - set(d_cols))} " \
                        f"oracle-only {sorted(set(d_cols) - set(s_cols))}"
        return res
    a, b = canon(s_cols, s_rows), canon(d_cols, d_rows)
    if len(a) != len(b):
        res["status"] = "ROWCOUNT differs"
    elif a != b:
        bad = next(i for i in range(len(a)) if a[i] != b[i])
        names = sorted(s_cols)
        diff = [(names[j], a[bad][j], b[bad][j]) for j in range(len(names)) if a[bad][j] != b[bad][j]]
        res["status"] = f"VALUES differ (first diff row {bad}: {diff[:4]})"
    else:
        res["status"] = "ok"
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from zoneflow.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    only = [a for a in argv if not a.startswith("--")]
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and not any(o in name for o in only):
            continue
        try:
            r = compare(spark, name, fn, sqls.get(name), sf_dir, con)
        except Exception as exc:  # report and go on
            r = {"query": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing of {len(qs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

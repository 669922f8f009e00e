"""Run every registered query against its DuckDB twin (the driver's gate, locally).

usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows, schema and value-hash agreement.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

STRICT = os.environ.get("ORACLE_STRICT") == "1"

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return repr(v) if STRICT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def digest(rows):
    keys = sorted(repr(r) for r in rows)
    return hashlib.sha1("\n".join(keys).encode()).hexdigest()[:12], keys


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    return cols, [tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from spokes.session import local_session

    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as ex:  # noqa: BLE001
            print(f"{k:32s} SPARK-ERROR {type(ex).__name__}: {str(ex)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sqls:
            print(f"{k:32s} rows={len(spdf):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            opdf = con.execute(sqls[k]).df()
        except Exception as ex:  # noqa: BLE001
            print(f"{k:32s} SQL-ERROR {str(ex)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(spdf)
        oc, orr = rows_of(opdf)
        hs, ks = digest(sr)
        ho, ko = digest(orr)
        ok = sc == oc and len(sr) == len(orr) and hs == ho
        if not ok:
            bad += 1
        print(f"{k:32s} {'OK ' if ok else 'BAD'} rows={len(sr)}/{len(orr)} cols={'=' if sc == oc else (sc, oc)} "
              f"hash={'=' if hs == ho else 'DIFF'} {ts:.1f}s")
        if not ok and sc == oc:
            a, b = set(ks), set(ko)
            for x in list(a - b)[:3]:
                print("   spark-only:", x[:300])
            for x in list(b - a)[:3]:
                print("   oracle-only:", x[:300])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()

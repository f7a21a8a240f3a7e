"""Run catalogue queries on Spark and their SQL oracle on DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from tessera.plans.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in v.items())
    if isinstance(v, (list, tuple)) or hasattr(v, "dtype") and getattr(v, "ndim", 0):
        return tuple(_norm(x) for x in v)
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bool,)):
        return bool(v)
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
    except ImportError:
        pass
    return v


def rows_of(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    out.sort(key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))
    return cols, out


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}


def type_diffs(spark_schema, con, sql: str) -> dict:
    """Columns whose Spark type and oracle type differ (or that only one side has)."""
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_schema.fields}
    d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    c1, r1 = rows_of(spark_pdf)
    c2, r2 = rows_of(duck_pdf)
    if c1 != c2:
        return False, f"columns differ: {c1} vs {c2}"
    if len(r1) != len(r2):
        return False, f"row count {len(r1)} vs {len(r2)}"
    for a, b in zip(r1, r2):
        if a != b:
            return False, f"first diff: spark={a} duck={b}"
    return True, f"{len(r1)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a]
    from __spark_entry__ import oracle_sql, queries
    from tessera.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            spdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"ROWS {name}: {len(spdf)} rows (no oracle) spark={t1-t0:.2f}s")
            continue
        try:
            dpdf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok, msg = compare(spdf, dpdf)
        tdiff = type_diffs(sdf.schema, con, sqls[name])
        if ok and tdiff:
            ok, msg = False, f"column types differ: {tdiff}"
        stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        dtypes = dict(zip(dpdf.columns, [str(t) for t in dpdf.dtypes]))
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {msg} spark={t1-t0:.2f}s  types={stypes} duck={dtypes}"
              if not ok else f"OK   {name}: {msg} spark={t1-t0:.2f}s")
        bad += (not ok)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

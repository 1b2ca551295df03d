"""Run registered analyses on Spark and their SQL oracles on DuckDB; compare.

Usage: python tools/check_oracle.py [SF_DIR] [name ...]

Comparison: row count, column names (sorted), coarse column types, and an
order-insensitive exact comparison of the row multisets.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from aulaframe.session import get_spark  # noqa: E402
from aulaframe.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _kind(t: str) -> str:
    t = t.lower()
    if any(k in t for k in ("double", "float")):
        return "float"
    if any(k in t for k in ("int", "long", "bigint", "short")):
        return t  # keep width visible
    if "decimal" in t:
        return "decimal"
    return t


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, a, sf_dir):
    t0 = time.time()
    sdf = a.run(spark, sf_dir)
    stab = sdf.toArrow()
    t1 = time.time()
    sql = a.oracle()
    if sql is None:
        return {"name": a.name, "rows": stab.num_rows, "oracle": None, "spark_s": round(t1 - t0, 2)}
    dtab = con.sql(sql).to_arrow_table()
    res = {"name": a.name, "rows": stab.num_rows, "oracle_rows": dtab.num_rows,
           "spark_s": round(t1 - t0, 2)}
    scols, dcols = sorted(stab.column_names), sorted(dtab.column_names)
    if scols != dcols:
        res["error"] = f"columns differ: spark={scols} duck={dcols}"
        return res
    stypes = {f.name: _kind(str(f.type)) for f in stab.schema}
    dtypes = {f.name: _kind(str(f.type)) for f in dtab.schema}
    tdiff = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
    if tdiff:
        res["type_diff"] = tdiff
    srows = Counter(tuple(_norm(v) for v in r) for r in zip(*[stab.column(c).to_pylist() for c in scols]))
    drows = Counter(tuple(_norm(v) for v in r) for r in zip(*[dtab.column(c).to_pylist() for c in scols]))
    if stab.num_rows != dtab.num_rows:
        res["error"] = "row count differs"
    if srows != drows:
        only_s = list((srows - drows).elements())[:3]
        only_d = list((drows - srows).elements())[:3]
        res["error"] = f"values differ; spark-only {only_s} duck-only {only_d} cols={scols}"
    return res


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for x in argv:
        if x.startswith("/"):
            sf_dir = x
        else:
            names.append(x)
    from aulaframe.plans.registry import load_all
    reg = load_all()
    spark = get_spark("local[8]", shuffle_partitions=int(os.environ.get("CHECK_SHUFFLE_PARTITIONS", "8")))
    con = duck(sf_dir)
    bad = 0
    for name, a in reg.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, a, sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:600]}"}
        ok = "error" not in r and "type_diff" not in r
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} problem(s)")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

"""Run registered Spark queries next to their DuckDB oracles and compare.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [key ...]

Compares row count, column names, column type family and the multiset of
rows (floats compared exactly and, as a fallback, to 1e-9 relative).
"""

from __future__ import annotations

import argparse
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fareweave.sources.tables import TABLES, table_path  # noqa: E402


def duck_conn(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v, tol):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.{tol}g}") if tol else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, tol) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, tol)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), tol)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _family(t: str) -> str:
    t = t.lower()
    for k, f in (("bigint", "i64"), ("long", "i64"), ("int", "i32"), ("double", "f64"),
                 ("float", "f32"), ("varchar", "str"), ("string", "str"), ("bool", "bool"),
                 ("timestamp", "ts"), ("date", "date"), ("decimal", "dec")):
        if t.startswith(k):
            return f
    if t.endswith("[]") or t.startswith("array"):
        return "list"
    return t


def compare(spark, key, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
    ts = time.time() - t0
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = [str(t) for t in rel.types]
    drows = rel.fetchall()
    res = {"key": key, "spark_rows": len(srows), "duck_rows": len(drows), "sec": round(ts, 2)}
    if sorted(scols) != sorted(dcols):
        res["status"] = "COLS"
        res["detail"] = f"spark={scols} duck={dcols}"
        return res
    order = [dcols.index(c) for c in sorted(scols)]
    sorder = [scols.index(c) for c in sorted(scols)]
    fam_s = [_family(stypes[i]) for i in sorder]
    fam_d = [_family(dtypes[i]) for i in order]
    if fam_s != fam_d:
        res["types"] = [(c, a, b) for c, a, b in zip(sorted(scols), fam_s, fam_d) if a != b]
    for tol, name in ((None, "EXACT"), (12, "TOL12"), (9, "TOL9")):
        a = sorted((tuple(_norm(r[i], tol) for i in sorder) for r in srows), key=repr)
        b = sorted((tuple(_norm(r[i], tol) for i in order) for r in drows), key=repr)
        if a == b:
            res["status"] = name if not res.get("types") else name + "+TYPES"
            return res
    res["status"] = "DIFF"
    sa = set(map(repr, a))
    sb = set(map(repr, b))
    res["only_spark"] = list(sa - sb)[:3]
    res["only_duck"] = list(sb - sa)[:3]
    return res


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    from fareweave.session import local_session
    from fareweave.plans.registry import ORACLES, QUERIES, load_all
    load_all()
    spark = local_session()
    con = duck_conn(args.sf)
    keys = args.keys or sorted(QUERIES)
    bad = 0
    for k in keys:
        if k not in ORACLES:
            print(json.dumps({"key": k, "status": "NO-ORACLE"}))
            continue
        try:
            r = compare(spark, k, QUERIES[k], ORACLES[k], args.sf, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": "ERROR", "detail": str(e)[:600]}
        if not r["status"].startswith("EXACT") or "types" in r:
            bad += 1
        print(json.dumps(r, default=str), flush=True)
    print(f"# {len(keys)} keys, {bad} not exact", flush=True)


if __name__ == "__main__":
    main()

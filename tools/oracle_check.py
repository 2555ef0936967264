"""Run registered Spark queries next to their DuckDB oracle and compare.

usage: python tools/oracle_check.py [--sf DIR] [--json OUT] [name-or-prefix ...]
(QUARRY_TZ=<zone> runs the Spark side under another session time zone;
 QUARRY_CONF="key=value,key=value" adds other session settings)

Prints one line per query: exact (values identical after column sort),
close (equal to 9 significant digits), TYPES (result types differ),
FAIL with the first difference, or rows (no oracle: row count only).
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.plans.compare import compare, duck, type_diff  # noqa: E402
from quarry.plans.registry import load_all  # noqa: E402
from quarry.session import build_session  # noqa: E402


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--json", default=None)
    ap.add_argument("--skip", default="", help="comma-separated query names to leave out")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    reg = load_all()
    skip = set(filter(None, a.skip.split(",")))
    names = [n for n in reg if (not a.names or any(n == p or n.startswith(p) for p in a.names)) and n not in skip]
    conf = dict(kv.split("=", 1) for kv in os.environ.get("QUARRY_CONF", "").split(",") if "=" in kv)
    if os.environ.get("QUARRY_TZ"):
        conf["spark.sql.session.timeZone"] = os.environ["QUARRY_TZ"]
    spark = build_session("local[8]", **conf)
    con = duck(a.sf)
    results = {}
    for n in names:
        q = reg[n]
        t0 = time.time()
        try:
            sdf = q.fn(spark, a.sf)
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {n}: spark: {str(e).splitlines()[0][:300]}")
            results[n] = "spark-error"
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"rows  {n}: {len(srows)} rows ({ts:.1f}s)")
            results[n] = "rows"
            continue
        try:
            rel = con.execute(q.sql)
            desc = rel.description
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {n}: duckdb: {str(e).splitlines()[0][:300]}")
            results[n] = "duck-error"
            continue
        td = type_diff(sdf.schema, desc)
        if td:
            print(f"TYPES {n}: {td}")
            results[n] = "types"
            continue
        res = compare(sdf.columns, srows, [d[0] for d in desc], drows)
        if res in ("exact", "close"):
            print(f"{res:5s} {n}: {len(srows)} rows ({ts:.1f}s)")
        else:
            print(f"FAIL  {n}: {res}")
        results[n] = res if res in ("exact", "close") else "fail"
    if a.json:
        with open(a.json, "w") as f:
            json.dump(results, f, indent=1)
    summary: dict[str, int] = {}
    for v in results.values():
        summary[v] = summary.get(v, 0) + 1
    print("SUMMARY", summary)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

"""Run registered queries in Spark and their SQL in DuckDB, compare results.

Usage: python tools/check_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import importlib.util
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tadkit.plans.verify import compare, duck  # noqa: E402
from tadkit.session import get_spark  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    spec = importlib.util.spec_from_file_location("entry", os.path.join(ROOT, "__spark_entry__.py"))
    ent = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(ent)
    qs, sqls = ent.queries(), ent.oracle_sql()
    spark = get_spark("local[4]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in sorted(qs):
        if pats and not any(p in name for p in pats):
            continue
        try:
            st = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            st = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if not st["status"].startswith(("ok", "rows-only")):
            bad += 1
        print(st, flush=True)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()

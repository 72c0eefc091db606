"""Run registered queries against their DuckDB oracle SQL.

usage: python tools/check_oracle.py [sf_dir] [name-prefix ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threatlake.catalog import QUERIES  # noqa: E402
from threatlake.oracle.compare import compare, duckdb_connection  # noqa: E402
from threatlake.oracle.queries import ORACLE  # noqa: E402
from threatlake.session import get_spark  # noqa: E402
from threatlake.sources.bindings import TABLES  # noqa: E402


def main(argv):
    import threatlake.oracle.compare as cmp
    if "--strict" in argv:
        cmp.STRICT = True
        argv = [a for a in argv if a != "--strict"]
    sf = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in argv[1:] if not a.startswith("/")]
    spark = get_spark("local[8]", 8)
    con = duckdb_connection(sf, TABLES)
    bad = 0
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            r = compare(spark, sf, name, fn, ORACLE.get(name), con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "error", "detail": repr(e)[:800]}
        r["sec"] = round(time.time() - t0, 2)
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main(sys.argv)

"""List column-type differences between each Spark query and its DuckDB oracle."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threatlake.catalog import QUERIES  # noqa: E402
from threatlake.oracle.compare import duckdb_connection  # noqa: E402
from threatlake.oracle.queries import ORACLE  # noqa: E402
from threatlake.session import get_spark  # noqa: E402
from threatlake.sources.bindings import TABLES  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
                 "array<string>": "VARCHAR[]", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def spark_type(dt) -> str:
    s = dt.simpleString()
    if s.startswith("decimal"):
        return s.upper()
    return SPARK_TO_DUCK.get(s, s)


def main():
    sf = "/root/testdata/sf0.01"
    spark = get_spark("local[4]", 4)
    con = duckdb_connection(sf, TABLES)
    prefixes = sys.argv[1:]
    n = 0
    for name, sql in ORACLE.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        df = QUERIES[name](spark, sf)
        s = {f.name: spark_type(f.dataType) for f in df.schema.fields}
        d = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        diff = {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}
        if diff:
            n += 1
            print(name, diff)
    print("mismatched queries:", n)


if __name__ == "__main__":
    main()

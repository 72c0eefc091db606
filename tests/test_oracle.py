"""Every registered query against its DuckDB oracle on the sf0.01 tables."""
import pytest

import threatlake.oracle.compare as cmp
from threatlake.catalog import QUERIES
from threatlake.oracle.compare import compare
from threatlake.oracle.queries import ORACLE

from paths import SF01


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    cmp.STRICT = True  # floats bit-identical, as a value hash would require
    r = compare(spark, SF01, name, QUERIES[name], ORACLE.get(name), duck)
    assert r["status"] in ("ok", "rows-only"), r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_rows_only_queries_are_few():
    # Only the alert payload documents (engine-specific JSON number formatting) go without an oracle.
    assert set(QUERIES) - set(ORACLE) <= {"alert_generic_payload", "alert_chat_payload"}


def test_oracle_column_types_match(spark, duck):
    from tools.check_types import spark_type
    bad = {}
    for name, sql in ORACLE.items():
        s = {f.name: spark_type(f.dataType) for f in QUERIES[name](spark, SF01).schema.fields}
        d = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
        if s != d:
            bad[name] = {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}
    assert not bad, bad

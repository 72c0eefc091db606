import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_smoke(spark):
    m = _entry()
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["cve_id", "epss", "percentile", "cvss_base", "in_kev"]
    assert [r.epss for r in rows] == sorted([r.epss for r in rows], reverse=True)


def test_contract_keys():
    m = _entry()
    q, o = m.queries(), m.oracle_sql()
    assert len(q) >= 100
    assert set(o) <= set(q)

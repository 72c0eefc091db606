"""Relation helpers not covered by a registered query."""
from pyspark.sql import functions as F

from threatlake.plans import relations as rel
from threatlake.plans import triage as tri
from threatlake.sources.bindings import AS_OF, Tables

from paths import SF001


def test_keyword_sweep_matches_single_lookups(spark):
    t = Tables(spark, SF001)
    search = rel.analysis_search(t.archive, t.analysis)
    kws = spark.createDataFrame([("and",), ("AND",), ("the",), ("zzzz-not-a-word",)], "keyword string")
    got = {r.keyword: r.analyses for r in rel.keyword_sweep(search, kws).collect()}
    for k in ("and", "the"):
        assert got.get(k, 0) == search.where(F.array_contains("document", k)).count()
    assert "zzzz-not-a-word" not in got


def test_ioc_export_files(spark, tmp_path):
    t = Tables(spark, SF001)
    iocs = tri.extract_iocs(rel.analysis_entries_lite(t.archive, t.analysis), AS_OF, limit=40)
    tri.write_iocs(iocs, str(tmp_path / "csv"), "csv")
    tri.write_iocs(iocs, str(tmp_path / "json"), "json")
    back = spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "csv"))
    assert back.columns == tri.IOC_COLUMNS and back.count() == iocs.count()
    assert spark.read.json(str(tmp_path / "json")).count() == iocs.count()


def test_every_view_registers_and_plans(spark):
    from threatlake.plans.views import register_views
    t = Tables(spark, SF001)
    names = register_views(spark, t, AS_OF, "2024-01-30")
    assert len(names) == 39
    for n in names:
        spark.sql(f"SELECT * FROM {n}").schema  # analyses without running
    assert spark.sql("SELECT count(*) FROM v_missing_both_per_feed").first()[0] > 0


def test_since_column(spark):
    import datetime as dt
    now = dt.datetime(2024, 1, 31)
    specs = ["24h", "7d", "2024-01-02", "2024-01-02T10:00:00+02:00", "2024-01-02T10:00:00Z"]
    df = spark.createDataFrame([(s,) for s in specs], "s string")
    got = [str(r[0]) for r in df.select(tri.since_column("s", now)).collect()]
    assert got == ["2024-01-30 00:00:00", "2024-01-24 00:00:00", "2024-01-02 00:00:00", "2024-01-02 08:00:00", "2024-01-02 10:00:00"]


def test_materialized_refresh_publishes_new_versions(spark, tmp_path):
    import pytest

    from threatlake.plans import materialized as mv
    t = Tables(spark, SF001)
    root = str(tmp_path / "mv")
    with pytest.raises(LookupError):
        mv.read(spark, root, "analysis_cve_mentions")
    first = mv.refresh(spark, t, root, ["analysis_cve_mentions"])["analysis_cve_mentions"]
    second = mv.refresh(spark, t, root, ["analysis_cve_mentions"])["analysis_cve_mentions"]
    assert first != second
    got = mv.read(spark, root, "analysis_cve_mentions")
    assert got.inputFiles()[0].startswith("file:" + second) or second in got.inputFiles()[0]
    assert got.count() == rel.cve_mentions(t.analysis).count()


def test_token_index_computes_its_tokens_once(spark, tmp_path):
    from threatlake.plans.relations import index_sweep, write_token_index
    seen = spark.sparkContext.accumulator(0)

    def counted(i):
        seen.add(1)
        return ["the", f"t{i}"]
    search = spark.range(200).select(F.concat(F.lit("an-"), "id").alias("analysis_id"), F.udf(counted, "array<string>")("id").alias("document"))
    write_token_index(search, str(tmp_path / "index"))
    assert seen.value == 200
    index = spark.read.parquet(str(tmp_path / "index"))
    assert index.count() == 400
    phrases = spark.createDataFrame([("the t7",), ("the",), ("t1 t2",)], "phrase string")
    assert {tuple(r) for r in index_sweep(index, phrases).collect()} == {("the t7", 1), ("the", 200), ("t1 t2", 0)}

"""EPSS loads out of order and after a broken-off batch; keys beyond five digits."""
import datetime as dt

from pyspark.sql import functions as F

from threatlake.operators.query import relation_query
from threatlake.operators import tables as tbl
from threatlake.plans.epss import epss_latest
from threatlake.sources.bindings import _cve_id
from threatlake.sources.landing import write_epss_pages
from threatlake.streaming import jobs


def _day(spark, day, scores):
    rows = [(dt.date.fromisoformat(day), f"CVE-2024-{i:05d}", s, s) for i, s in scores]
    return spark.createDataFrame(rows, "as_of date, cve_id string, epss double, percentile double").select(
        "as_of", "cve_id", F.col("epss").cast("decimal(6,5)").alias("epss"), F.col("percentile").cast("decimal(6,5)").alias("percentile"))


def _load(spark, root, name):
    jobs.epss_ingest(spark, f"{root}/landing/*/", f"{root}/staging", f"{root}/epss_daily", latest_path=f"{root}/latest",
                     manifest_path=f"{root}/manifest", name=name).awaitTermination()


def _latest(spark, root):
    return {(r.cve_id, r.as_of, r.epss) for r in spark.read.parquet(f"{root}/latest").collect()}


def test_late_day_and_broken_batch(spark, tmp_path, monkeypatch):
    import pytest
    from uuid import uuid4
    root, name = str(tmp_path), f"late-{uuid4().hex[:8]}"
    key = F.substr("cve_id", F.lit(10)).cast("long")
    write_epss_pages(_day(spark, "2024-01-30", [(1, 0.9), (2, 0.8)]), f"{root}/landing", key)
    _load(spark, root, name)
    write_epss_pages(_day(spark, "2024-01-29", [(1, 0.1), (3, 0.3)]), f"{root}/landing", key)
    with monkeypatch.context() as m:  # breaks off between the snapshot and the latest table
        def fail(*a, **k):
            raise RuntimeError("lost")
        m.setattr(tbl, "record_days", fail)
        with pytest.raises(Exception):
            _load(spark, root, name)
    _load(spark, root, name)
    daily = spark.read.parquet(f"{root}/epss_daily")
    want = {(r.cve_id, r.as_of, r.epss) for r in epss_latest(daily).collect()}
    assert _latest(spark, root) == want and len(want) == 3
    assert {r.as_of for r in tbl.manifest_days(spark.read.parquet(f"{root}/manifest")).collect()} == {r.as_of for r in daily.select("as_of").distinct().collect()}


def test_ids_beyond_five_digits_stay_keys(spark):
    ids = spark.range(99_990, 100_030).select(_cve_id(F.col("id")).alias("c"))
    assert ids.distinct().count() == 40 and ids.where("c = 'CVE-2024-100000'").count() == 1


def test_explicit_limit_beats_the_default_cap(spark):
    df = spark.range(1500).withColumnRenamed("id", "k")
    assert relation_query(df, limit=1200).count() == 1200 and relation_query(df).count() == 1000


def test_latest_is_a_hash_aggregate(spark):
    plan = epss_latest(_day(spark, "2024-01-30", [(1, 0.9)]))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan

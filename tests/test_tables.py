"""Table-write semantics and invariants."""
from pyspark.sql import functions as F

from threatlake.operators import tables as tbl
from threatlake.schemas import FEED_ITEM_KEEP_FIRST
from threatlake.sources.bindings import Tables

from paths import SF001

KEYS, ORDER = ["guid", "feed_url"], ["published", "event_id"]


def test_insert_if_absent_is_idempotent(spark):
    v = Tables(spark, SF001).item_versions
    archive = tbl.append_new(v.where(F.lit(False)), v, KEYS, ORDER)
    assert archive.count() == v.select(*KEYS).distinct().count()
    assert tbl.append_new(archive, v, KEYS, ORDER).count() == 0  # second run adds nothing


def test_upsert_last_wins_keep_first(spark):
    v = Tables(spark, SF001).item_versions
    cur = tbl.upsert_latest(v.where(F.lit(False)), v, KEYS, ORDER, FEED_ITEM_KEEP_FIRST)
    first = tbl.first_per_key(v, KEYS, ORDER)
    j = cur.alias("c").join(first.alias("f"), KEYS)
    assert j.where(F.col("c.id") != F.col("f.id")).count() == 0
    assert j.where(F.col("c.inserted_at") != F.col("f.inserted_at")).count() == 0
    last = v.groupBy(*KEYS).agg(F.max(F.struct(*ORDER)).alias("m"))
    jj = cur.join(last, KEYS)
    assert jj.where(F.struct(*ORDER) != F.col("m")).count() == 0
    # re-applying the same batch changes nothing
    again = tbl.upsert_latest(cur, v, KEYS, ORDER, FEED_ITEM_KEEP_FIRST)
    assert again.exceptAll(cur).count() == 0


def test_archive_keys_subset_of_current(spark):
    v = Tables(spark, SF001).item_versions
    archive = tbl.append_new(v.where(F.lit(False)), v, KEYS, ORDER)
    cur = tbl.upsert_latest(v.where(F.lit(False)), v, KEYS, ORDER, FEED_ITEM_KEEP_FIRST)
    assert archive.select(*KEYS).exceptAll(cur.select(*KEYS)).count() == 0


def test_classify_failed_rows(spark):
    b = spark.createDataFrame([("g1", "f", 1), (None, "f", 2), ("g1", "f", 3), ("g2", "f", 4)],
                              "guid string, feed_url string, n int")
    existing = spark.createDataFrame([("g2", "f")], "guid string, feed_url string")
    got = {r.n: r.change for r in tbl.classify_changes(existing, b, KEYS, ["n"]).collect()}
    assert got == {1: "new", 2: "failed", 3: "updated", 4: "updated"}


def test_buckets_sum_to_total(spark):
    from threatlake.plans import dashboards as dsh
    t = Tables(spark, SF001)
    dist = dsh.epss_distribution(t.epss_daily).first()
    assert sum(dist) == dsh.epss_records_latest(t.epss_daily).first().records


def test_movers_antisymmetry(spark):
    from threatlake.plans.epss import movers_24h
    e = Tables(spark, SF001).epss_daily
    fwd = {r.cve_id: r.delta for r in movers_24h(e, "2024-01-30").collect()}
    # swap the two days: every delta flips sign
    swapped = e.withColumn("as_of", F.when(F.col("as_of") == "2024-01-30", F.lit("2024-01-29").cast("date"))
                           .when(F.col("as_of") == "2024-01-29", F.lit("2024-01-30").cast("date"))
                           .otherwise(F.col("as_of")))
    back = {r.cve_id: r.delta for r in movers_24h(swapped, "2024-01-30").collect()}
    assert fwd.keys() == back.keys() and all(fwd[k] == -back[k] for k in fwd)


def test_snapshot_write_skips_loaded_days(spark, tmp_path):
    e = Tables(spark, SF001).epss_daily
    path, man = str(tmp_path / "epss"), str(tmp_path / "manifest")
    tbl.write_snapshot(e.where(F.col("as_of") < "2024-01-10"), path, manifest_path=man)
    stored = spark.read.parquet(path)
    new = tbl.new_snapshot_rows(stored, e.where(F.col("as_of") >= "2024-01-05"))
    assert new.agg(F.min("as_of")).first()[0].isoformat() == "2024-01-10"
    tbl.write_snapshot(new, path, manifest_path=man)
    assert spark.read.parquet(path).count() == e.count()
    days = {r.as_of: r.rows for r in tbl.manifest_days(spark.read.parquet(man)).collect()}
    assert days == {r.as_of: r["count"] for r in e.groupBy("as_of").count().collect()}


def test_percent_rank_matches_window_on_a_hot_day(spark):
    import random

    from pyspark.sql import Window

    from threatlake.functions.ranking import percent_rank_within
    rnd = random.Random(7)
    rows = [("2024-01-01", f"c{i}", rnd.choice([0.1, 0.2, 0.2, 0.5, 0.9])) for i in range(3000)]  # hot day, ties
    rows += [(f"2024-01-0{d}", f"c{i}", rnd.random()) for d in (2, 3) for i in range(50)]
    rows += [("2024-01-04", "only", 0.3)]  # single-row day -> 0.0
    df = spark.createDataFrame(rows, "as_of string, cve_id string, epss double")
    ours = percent_rank_within(df, "as_of", "epss", "p").select("as_of", "cve_id", "p")
    ref = df.select("as_of", "cve_id", F.percent_rank().over(Window.partitionBy("as_of").orderBy("epss")).alias("p"))
    assert ours.exceptAll(ref).count() == 0 and ref.exceptAll(ours).count() == 0


def test_upsert_with_a_hot_key(spark):
    # one key holds a third of the batch: the keyed max_by/min_by aggregation still gives
    # exactly one row per key with the last / first versions
    rows = [("hot", "f", i, f"v{i}") for i in range(600)] + [(f"k{i}", "f", i, f"v{i}") for i in range(1200)]
    b = spark.createDataFrame(rows, "guid string, feed_url string, n int, val string")
    cur = tbl.upsert_latest(b.where(F.lit(False)), b, KEYS, ["n"], keep_first=["val"])
    hot = cur.where("guid = 'hot'").collect()
    assert len(hot) == 1 and hot[0].n == 599 and hot[0].val == "v0"
    assert cur.count() == 1201
    assert tbl.append_new(b.where(F.lit(False)), b, KEYS, ["n"]).where("guid = 'hot'").first().n == 0


def test_change_summary_counts_empty_content(spark):
    b = spark.createDataFrame([("g1", "f", 1, "", None), ("g2", "f", 2, "x", ""), (None, "f", 3, "", ""),
                               ("g3", "f", 4, None, "")], "guid string, feed_url string, n int, content string, summary string")
    existing = spark.createDataFrame([], "guid string, feed_url string")
    r = tbl.change_summary(tbl.classify_changes(existing, b, KEYS, ["n"])).first()
    assert (r.processed, r.new, r.updated, r.failed, r.empty_content) == (4, 3, 0, 1, 2)

"""Structured Streaming jobs: file landing -> tables, idempotent re-runs."""
import json
import os
import shutil
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from threatlake.operators.cursors import append_cursor, read_cursors
from threatlake.operators.storage import KeyedTable
from threatlake.sources import feeds
from threatlake.sources.bindings import Tables
from threatlake.streaming import jobs

from paths import FIXTURES, SF001


def _name():
    return "t-" + uuid.uuid4().hex[:8]


UPDATE = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>Alpha Advisories</title><language>en</language>
<item><title>Second bulletin (rev 2)</title><link>https://alpha.example.net/a/2</link><guid>alpha-0002</guid>
<pubDate>Thu, 01 Feb 2024 09:00:00 GMT</pubDate><description>Revised summary</description></item>
<item><title>Fourth</title><link>https://alpha.example.net/a/4</link><guid>alpha-0004</guid>
<pubDate>Thu, 01 Feb 2024 10:00:00 GMT</pubDate><description>New one</description></item>
</channel></rss>"""


def test_feed_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    shutil.copytree(os.path.join(FIXTURES, "feeds"), landing)
    arch, cur, name = str(tmp_path / "archive"), str(tmp_path / "current"), _name()
    jobs.feed_ingest(spark, f"{landing}/*/", arch, cur, now="2024-01-31 00:00:00", name=name).awaitTermination()
    a = spark.read.parquet(arch)
    c = spark.read.parquet(cur)
    assert a.count() == 4 and c.count() == 4  # the orphan item is rejected
    (landing / "alpha" / "2024-02-01.xml").write_text(UPDATE)
    jobs.feed_ingest(spark, f"{landing}/*/", arch, cur, now="2024-02-01 12:00:00", name=name).awaitTermination()
    a = {r.guid: r for r in spark.read.parquet(arch).collect()}
    c = {r.guid: r for r in spark.read.parquet(cur).collect()}
    assert len(a) == 5 and len(c) == 5
    assert a["alpha-0002"].title == "Second bulletin"           # archive: first write wins
    assert c["alpha-0002"].title == "Second bulletin (rev 2)"   # current: last write wins
    assert str(c["alpha-0002"].inserted_at) == "2024-01-31 00:00:00"  # keep-first column
    # nothing new landed: a re-run changes nothing
    jobs.feed_ingest(spark, f"{landing}/*/", arch, cur, now="2024-02-02 00:00:00", name=name).awaitTermination()
    assert spark.read.parquet(cur).count() == 5 and spark.read.parquet(arch).count() == 5


def test_feed_stream_maps_folders_through_the_registry(spark, tmp_path):
    from threatlake.sources.registry import registry_from_config
    landing = tmp_path / "landing"
    shutil.copytree(os.path.join(FIXTURES, "feeds"), landing)
    reg = registry_from_config(spark, [{"name": "alpha", "url": "https://alpha.example.net/rss", "feed_type": "rss",
                                        "tags": ["vendor"]}])
    cur = str(tmp_path / "current")
    jobs.feed_ingest(spark, f"{landing}/*/", str(tmp_path / "archive"), cur, now="2024-01-31 00:00:00",
                     name=_name(), registry=reg).awaitTermination()
    urls = {r.feed_url for r in spark.read.parquet(cur).select("feed_url").collect()}
    assert urls == {"https://alpha.example.net/rss", "beta"}


def test_feed_stream_stamps_ntz_times_without_fixed_now(spark, tmp_path):
    from threatlake.schemas import FEED_ITEM
    landing = tmp_path / "landing"
    shutil.copytree(os.path.join(FIXTURES, "feeds"), landing)
    cur = str(tmp_path / "current")
    jobs.feed_ingest(spark, f"{landing}/*/", str(tmp_path / "archive"), cur, name=_name()).awaitTermination()
    got = {f.name: f.dataType for f in spark.read.parquet(cur).schema.fields}
    assert all(got[f.name] == f.dataType for f in FEED_ITEM.fields)


def test_epss_stream_waits_for_complete_page_sets(spark, tmp_path):
    landing = tmp_path / "landing"
    shutil.copytree(os.path.join(FIXTURES, "epss"), landing)
    stage, epss, name = str(tmp_path / "stage"), str(tmp_path / "epss"), _name()
    latest = str(tmp_path / "latest")
    run = lambda: jobs.epss_ingest(spark, f"{landing}/*/", stage, epss, name=name,
                                   latest_path=latest).awaitTermination()
    run()
    assert spark.read.parquet(epss).count() == 3
    assert not os.path.exists(stage)  # a complete day never touches staging
    (landing / "day2").mkdir()
    (landing / "day2" / "p0.json").write_text(
        '{"status":"OK","total":2,"offset":0,"limit":1,"data":[{"cve":"CVE-2024-10001","epss":"0.5",'
        '"percentile":"0.9","date":"2024-01-31"}]}')
    run()
    assert spark.read.parquet(epss).count() == 3  # short page set: not loaded
    assert spark.read.parquet(stage).count() == 1  # ... and its page waits in staging
    (landing / "day2" / "p1.json").write_text(
        '{"status":"OK","total":2,"offset":1,"limit":1,"data":[{"cve":"CVE-2024-10009","epss":"0.1",'
        '"percentile":"0.5","date":"2024-01-31"}]}')
    run()
    days = {str(r.as_of): r["count"] for r in spark.read.parquet(epss).groupBy("as_of").count().collect()}
    assert days == {"2024-01-30": 3, "2024-01-31": 2}
    # the incrementally kept latest-per-CVE table equals the aggregate over the history
    from threatlake.plans.epss import epss_latest
    kept = {(r.cve_id, str(r.as_of), str(r.epss)) for r in spark.read.parquet(latest).collect()}
    full = {(r.cve_id, str(r.as_of), str(r.epss)) for r in epss_latest(spark.read.parquet(epss)).collect()}
    assert kept == full and len(kept) == 4


def test_cve_streams_and_catalog_gate(spark, tmp_path):
    cve, state = str(tmp_path / "cve"), str(tmp_path / "state")
    jobs.cve_ingest(spark, os.path.join(FIXTURES, "nvd"), cve, "nvd", now="2024-01-31 00:00:00",
                    name=_name()).awaitTermination()
    landing = tmp_path / "kev"
    shutil.copytree(os.path.join(FIXTURES, "kev"), landing)
    name = _name()
    jobs.cve_ingest(spark, str(landing), cve, "kev", state_path=state, name=name).awaitTermination()
    t = KeyedTable(spark, cve, ["cve_id", "source"]).table()
    assert t.where("source = 'NVD'").count() == 3 and t.where("source = 'CISA-KEV'").count() == 2
    assert spark.read.parquet(state).where("source = 'CISA-KEV'").first().cursor == "2024-01-30T15:04:05Z"
    # the same catalog landing again is skipped by the change gate
    shutil.copy(landing / "catalog.json", landing / "catalog-again.json")
    before = t.where("source = 'CISA-KEV'").orderBy("cve_id").collect()
    jobs.cve_ingest(spark, str(landing), cve, "kev", state_path=state, name=name).awaitTermination()
    after = KeyedTable(spark, cve, ["cve_id", "source"]).table().where("source = 'CISA-KEV'").orderBy("cve_id").collect()
    assert before == after


def test_sitrep_streams(spark, tmp_path):
    from threatlake.schemas import ANALYSIS
    src = str(tmp_path / "analysis")
    a = Tables(spark, SF001).analysis
    a.write.parquet(src)
    out, tab = str(tmp_path / "sitreps"), str(tmp_path / "sitrep_table")
    jobs.sitrep_upsert_stream(spark, src, ANALYSIS, tab, name=_name()).awaitTermination()
    expected = {r.w.start: r["count"] for r in a.groupBy(F.window("analysed_at", "1 hour").alias("w")).count().collect()}
    got = {r.window_start: r.items for r in spark.read.parquet(tab).collect()}
    assert got == expected
    jobs.sitrep_stream(spark, src, ANALYSIS, out, delay="2 hours", name=_name()).awaitTermination()
    appended = {r.window_start: r.items for r in spark.read.parquet(out).collect()}
    # append mode writes only windows the watermark has closed; those match exactly
    assert appended and all(expected[k] == v for k, v in appended.items())


def test_epss_stream_alerts_once_per_day(spark, tmp_path):
    from threatlake.schemas import CVE_KEY
    t = Tables(spark, "/root/testdata/sf0.01")
    landing = str(tmp_path / "landing")
    # one landed page per day, built from the B1 snapshot rows (test fixture writer)
    pages = (t.epss_daily.groupBy("as_of").agg(
        F.count(F.lit(1)).alias("total"),
        F.collect_list(F.struct(F.col("cve_id").alias("cve"), F.col("epss").cast("string").alias("epss"),
                                F.col("percentile").cast("string").alias("percentile"),
                                F.col("as_of").cast("string").alias("date"))).alias("data"))
        .select("as_of", F.to_json(F.struct(F.lit("OK").alias("status"), "total", F.lit(0).alias("offset"),
                                            F.col("total").alias("limit"), "data")).alias("value")))
    pages.write.partitionBy("as_of").text(landing)
    cve = str(tmp_path / "cve")
    KeyedTable(spark, cve, CVE_KEY).upsert(t.cve_enriched, ["modified"])
    stage, epss, alerts, state, name = (str(tmp_path / x) for x in ("stage", "epss", "alerts", "state", "n"))
    name = _name()
    jobs.epss_ingest(spark, f"{landing}/*/", stage, epss, cve, alerts, state, name=name,
                     now="2024-01-31 00:00:00").awaitTermination()
    assert spark.read.parquet(epss).count() == t.epss_daily.count()
    sent = spark.read.parquet(alerts).collect()
    assert len(sent) == 1 and '"count":3' in sent[0].payload
    assert spark.read.parquet(state).where("source = 'ALERTING'").first().cursor == "2024-01-30"
    jobs.epss_ingest(spark, f"{landing}/*/", stage, epss, cve, alerts, state, name=name).awaitTermination()
    assert spark.read.parquet(alerts).count() == 1
    # a replay that lost the cursor write (crash between the two writes) sends nothing twice
    jobs._alert_after_load(spark, epss, cve, alerts, str(tmp_path / "lost-state"), "2024-01-31 00:00:00")
    assert spark.read.parquet(alerts).count() == 1


DUP = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>Dup Feed</title>
<item><title>first version</title><link>https://d.example.net/1</link><guid>d-1</guid></item>
<item><title>other</title><link>https://d.example.net/2</link><guid>d-2</guid></item>
<item><title>second version</title><link>https://d.example.net/1</link><guid>d-1</guid></item>
</channel></rss>"""


def test_document_order_within_one_fetch(spark, tmp_path):
    landing = tmp_path / "landing" / "dup"
    landing.mkdir(parents=True)
    (landing / "f.xml").write_text(DUP)
    arch, cur = str(tmp_path / "archive"), str(tmp_path / "current")
    jobs.feed_ingest(spark, f"{tmp_path}/landing/*/", arch, cur, now="2024-01-31 00:00:00",
                     name=_name()).awaitTermination()
    a = {r.guid: r.title for r in spark.read.parquet(arch).collect()}
    c = {r.guid: r.title for r in spark.read.parquet(cur).collect()}
    assert a == {"d-1": "first version", "d-2": "other"}
    assert c == {"d-1": "second version", "d-2": "other"}


def test_keyed_upsert_rewrites_only_changed_buckets(spark, tmp_path):
    from threatlake.operators.storage import KeyedTable
    t = Tables(spark, SF001)
    v = t.item_versions
    table = KeyedTable(spark, str(tmp_path / "cur"), ["guid", "feed_url"], buckets=16)
    assert table.upsert(v, ["published", "event_id"]) > 0
    before = sorted(spark.read.parquet(str(tmp_path / "cur")).inputFiles())
    assert table.upsert(v, ["published", "event_id"]) == 0  # same batch again: nothing changes
    assert sorted(spark.read.parquet(str(tmp_path / "cur")).inputFiles()) == before
    one = v.where("guid = 'u3' AND feed_url = 'view'").withColumn("title", F.lit("edited")) \
        .withColumn("published", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    assert table.upsert(one, ["published", "event_id"]) == 1  # one key -> one bucket rewritten
    got = table.table().where("guid = 'u3' AND feed_url = 'view'").collect()
    assert len(got) == 1 and got[0].title == "edited"


def test_keyed_insert_replay_appends_nothing(spark, tmp_path):
    from threatlake.operators.storage import KeyedTable
    v = Tables(spark, SF001).item_versions
    table = KeyedTable(spark, str(tmp_path / "arch"), ["guid", "feed_url"], buckets=8)
    first = table.insert_new(v, ["published", "event_id"])
    assert first == v.select("guid", "feed_url").distinct().count()
    assert table.insert_new(v, ["published", "event_id"]) == 0  # a replayed batch
    assert table.table().count() == first


def test_documents_of_any_kind_share_a_folder(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "mix").mkdir(parents=True)
    for kind, folder in (("rss", "feeds"), ("rdf", "rdf"), ("atom", "atom")):
        for i, path in enumerate(sorted(Path(FIXTURES, folder).rglob("*.*"))):
            shutil.copy(path, landing / "mix" / f"{kind}{i}.xml")
    (landing / "mix" / "cut.xml").write_text(UPDATE[:len(UPDATE) // 2])
    (landing / "mix" / "page.xml").write_text("<!doctype html><html><body>503</body></html>")
    (landing / "mix" / "empty.xml").write_text(" \n")
    (landing / "mix" / "latin.xml").write_bytes('<?xml version="1.0" encoding="ISO-8859-1"?><rss><channel><item><guid>latin-1</guid>'
                                                '<title>Käse</title></item></channel></rss>'.encode("latin-1"))
    arch, log, rejects = (str(tmp_path / x) for x in ("archive", "log", "rejects"))
    name = _name()
    jobs.feed_ingest(spark, f"{landing}/*/", arch, str(tmp_path / "current"), now="2024-01-31 00:00:00", name=name,
                     log_path=log, rejects_path=rejects).awaitTermination()
    by_kind = feeds.parse_documents(spark.read.format("binaryFile").load(f"{landing}/*/"))
    assert {r.kind for r in by_kind.where("reason is null").collect()} == {"rss", "rdf", "atom"}
    got = {os.path.basename(r.file): (r.kind, r.reason) for r in spark.read.parquet(rejects).collect()}
    assert got == {"cut.xml": ("rss", "malformed"), "page.xml": (None, "unknown root"), "empty.xml": (None, "unknown root")}
    def alone(kind, folder):
        files = [str(x) for x in Path(FIXTURES, folder).rglob("*.*")]
        items = feeds.normalise_items(feeds.read_feed_items(spark, files, kind), F.lit("mix"), "2024-01-31 00:00:00")
        return items.where("_valid").select("guid").distinct().count()
    stored = spark.read.parquet(arch)
    assert stored.count() == alone("rss", "feeds") + alone("rdf", "rdf") + alone("atom", "atom") + 1 and stored.where("guid = 'latin-1'").first().title == "Käse"
    entry = spark.read.parquet(log).first()
    assert (entry.rejected, entry.new, entry.status) == (3, stored.count(), "success")


def test_log_entry_of_the_first_run_of_a_batch_stays(spark, tmp_path):
    """A batch that runs again after its tables were written must not log its items as updates."""
    landing = tmp_path / "landing"
    shutil.copytree(os.path.join(FIXTURES, "feeds"), landing)
    paths = [str(tmp_path / x) for x in ("archive", "current")]
    name = _name()
    for checkpoint in (name, name):
        jobs.feed_ingest(spark, f"{landing}/*/", *paths, now="2024-01-31 00:00:00", name=name, log_path=str(tmp_path / "log")).awaitTermination()
        shutil.rmtree(jobs._checkpoint(spark, name).removeprefix("file:"))  # the batch is not known to be done
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.groupBy().sum("new", "updated", "failed").first() == (4, 0, 1)


def test_two_writers_and_a_crash_lose_no_cursor(spark, tmp_path):
    path = str(tmp_path / "cursors")
    assert read_cursors(spark, path).count() == 0
    for i in range(3):
        append_cursor(spark, path, "NVD", f"2024-01-0{i + 1}T00:00:00Z")
        append_cursor(spark, path, "CISA-KEV", f"release {i}")
    os.makedirs(f"{path}/_temporary/0")  # what a writer that died in between leaves
    append_cursor(spark, path, "EPSS", None)
    assert {tuple(r) for r in read_cursors(spark, path).collect()} == {("NVD", "2024-01-03T00:00:00Z"), ("CISA-KEV", "release 2")}


def test_windowed_run_goes_on_after_the_last_stored_window(spark, tmp_path, monkeypatch):
    pages, cve, state = tmp_path / "nvd", str(tmp_path / "cve"), str(tmp_path / "state")
    pages.mkdir()
    records = [{"cve": {"id": f"CVE-2023-{i:05}", "published": f"2023-{i:02}-01T00:00:00", "lastModified": "2024-01-01T00:00:00"}} for i in range(1, 13)]
    (pages / "0.json").write_text(json.dumps({"resultsPerPage": 12, "startIndex": 0, "totalResults": 12, "vulnerabilities": records}))
    append_cursor(spark, state, "NVD", "2023-01-01T00:00:00Z")
    upsert, calls = KeyedTable.upsert, []

    def breaks(self, rows, *a, **k):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return upsert(self, rows, *a, **k)
    monkeypatch.setattr(KeyedTable, "upsert", breaks)
    with pytest.raises(RuntimeError):
        jobs.nvd_window_ingest(spark, str(pages), cve, state, "2024-01-01 00:00:00", days=100)
    assert read_cursors(spark, state).first().cursor == "2023-07-20T00:00:00Z"
    assert spark.read.parquet(cve).count() == 7
    assert jobs.nvd_window_ingest(spark, str(pages), cve, state, "2024-01-01 00:00:00", days=100) == 2
    assert spark.read.parquet(cve).count() == 12 and read_cursors(spark, state).first().cursor == "2024-01-01T00:00:00Z"
    assert jobs.nvd_window_ingest(spark, str(pages), cve, state, "2024-01-01 00:00:00", days=100) == 0


def test_a_schema_error_is_not_an_empty_table(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    assert KeyedTable(spark, str(tmp_path / "none"), ["k"]).read() is None
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt|read"):
        KeyedTable(spark, str(tmp_path / "t"), ["k"]).read()


def test_a_corrected_page_wins_whatever_the_order(spark, tmp_path):
    def page(folder, score, at):
        path = tmp_path / "landing" / "2024-01-05" / folder
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"status": "OK", "total": 1, "offset": 0, "limit": 10, "data": [
            {"cve": "CVE-2024-00001", "epss": score, "percentile": "0.5", "date": "2024-01-05"}]}))
        os.utime(path, (at, at))
    page("b.json", "0.20000", 1_700_000_000)
    page("a.json", "0.70000", 1_700_000_900)  # lands later, is listed first
    epss = str(tmp_path / "epss")
    jobs.epss_ingest(spark, f"{tmp_path}/landing/*/", str(tmp_path / "staging"), epss, name=_name()).awaitTermination()
    assert [str(r.epss) for r in spark.read.parquet(epss).collect()] == ["0.70000"]


def _files(path):
    return {str(x) for x in Path(path).rglob("*.parquet")}


def test_new_keys_are_appended_and_nothing_stays_staged(spark, tmp_path):
    """A batch of new keys rewrites no stored file; a changed row rewrites its bucket only."""
    from threatlake.session import checkpoint_dir
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v string, first int, at int")
    staged = lambda: set(Path(checkpoint_dir(spark).removeprefix("file:")).glob("staged-*"))
    before = staged()
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, ["k"], ["k", "v", "first"], buckets=2)
    table.upsert(rows(*[(f"k{i}", "a", i, 1) for i in range(40)], (None, "a", 0, 1)), ["at"], ["first"])
    had = _files(path)
    assert table.upsert(rows(*[(f"n{i}", "b", i, 2) for i in range(40)]), ["at"], ["first"]) == 2
    assert had < _files(path)
    assert table.upsert(rows(("k1", "c", 9, 3), ("k1", "b", 8, 2), ("n1", "b", 5, 3), ("k2", "a", 7, 3)), ["at"], ["first"]) == 1
    assert table.upsert(rows((None, "d", 6, 3), ("new", "d", 6, 3)), ["at"], ["first"]) in (1, 2)
    got = {r.k: (r.v, r.first) for r in table.table().collect()}
    assert len(got) == table.table().count() == 82
    assert (got["k1"], got["n1"], got["k2"], got[None], got["new"]) == (("c", 1), ("b", 1), ("a", 2), ("d", 0), ("d", 6))
    assert staged() == before


def test_documents_of_a_feed_share_a_folder_and_a_run_takes_few_batches(spark, tmp_path):
    from threatlake.sources.landing import write_feed_documents
    items = (spark.range(24).select(F.lit("a").alias("feed_url"), F.concat(F.lit("g"), "id").alias("guid"), F.lit("t").alias("title"),
                                    F.lit("l").alias("link"), F.lit("c").alias("content"), F.lit("s").alias("summary"),
                                    F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("published"), "id"))
    write_feed_documents(items, str(tmp_path / "landing"), F.lit("rss"), F.floor(F.col("id") / 2))
    assert len(list((tmp_path / "landing").glob("feed=*"))) == 1 and len(list((tmp_path / "landing").glob("*/*.txt"))) == 12
    arch, log = str(tmp_path / "archive"), str(tmp_path / "log")
    jobs.feed_ingest(spark, f"{tmp_path}/landing/*/", arch, str(tmp_path / "current"), now="2024-01-31 00:00:00", name=_name(), log_path=log,
                     max_files=1).awaitTermination()
    assert spark.read.parquet(arch).count() == 24
    entries = spark.read.parquet(log)
    assert entries.groupBy().sum("documents", "new").first() == (12, 24) and entries.count() == jobs.MOST_BATCHES


def test_a_later_window_rewrites_no_earlier_one(spark, tmp_path):
    pages, cve, state = tmp_path / "nvd", str(tmp_path / "cve"), str(tmp_path / "state")
    pages.mkdir()
    records = [{"cve": {"id": f"CVE-2023-{i:05}", "published": f"2023-{i:02}-01T00:00:00", "lastModified": "2024-01-01T00:00:00"}} for i in range(1, 13)]
    (pages / "0.json").write_text(json.dumps({"resultsPerPage": 12, "startIndex": 0, "totalResults": 12, "vulnerabilities": records}))
    append_cursor(spark, state, "NVD", "2023-01-01T00:00:00Z")
    run = lambda **more: jobs.nvd_window_ingest(spark, str(pages), cve, state, "2024-01-01 00:00:00", days=100, **more)
    assert run(max_windows=1) == 1 and spark.read.parquet(cve).count() == 4
    had = _files(cve)
    assert run() == 3 and had < _files(cve) and spark.read.parquet(cve).count() == 12

"""Landed-file scans and ingest normalisation on small fixtures."""
import os

from pyspark.sql import functions as F

from threatlake.sources import cve_files, feeds, validation, windows

from paths import FIXTURES

NOW = "2024-01-31 00:00:00"


def _items(spark):
    raw = feeds.read_feed_items(spark, os.path.join(FIXTURES, "feeds", "*", "*.xml"))
    return feeds.normalise_items(raw, feeds.feed_key_from_path(), NOW)


def test_rss_items_and_channel(spark):
    rows = {r.guid: r for r in _items(spark).collect()}
    a1 = rows["alpha-0001"]
    assert a1.feed_title == "Alpha Advisories" and a1.feed_language == "en"
    assert a1.categories == ["firmware", "network"] and a1.author == "Alpha CERT"
    assert str(a1.published) == "2024-01-30 08:15:00"
    assert a1.content == "<p>Full advisory body</p>" and a1.summary == "Firmware update summary"
    a2 = rows["alpha-0002"]
    assert a2.content == a2.summary == "Only a summary here"  # content falls back to description
    assert a2.categories == [] and a2.author == ""


def test_item_without_guid_uses_link_and_orphan_is_rejected(spark):
    df = _items(spark)
    assert df.where(F.col("guid") == "https://alpha.example.net/a/3").count() == 1
    rejected = df.where(~F.col("_valid")).collect()
    assert len(rejected) == 1 and rejected[0].title == "Orphan entry"


def test_empty_content_is_stored_and_flagged(spark):
    r = _items(spark).where(F.col("guid") == "https://alpha.example.net/a/3").first()
    assert r._valid and r._empty and r.content == "" and r.summary == ""
    assert str(r.published) == "2024-01-31 10:00:00"


def test_xss_removed(spark):
    r = _items(spark).where(F.col("guid") == "beta-xss").first()
    assert "Real advisory text" in r.summary
    for bad in ("<script", "onload", "steal(", "javascript:"):
        assert bad not in r.summary and bad not in r.content


def test_time_fallback_to_now(spark):
    r = _items(spark).where(F.col("guid") == "beta-xss").first()
    assert str(r.published) == "2024-01-31 00:00:00" and str(r.entry_updated) == "2024-01-31 00:00:00"


def test_atom(spark):
    raw = feeds.read_feed_items(spark, os.path.join(FIXTURES, "atom", "*", "*.xml"), kind="atom")
    rows = {r.guid: r for r in feeds.normalise_items(raw, "gamma", NOW).collect()}
    e7 = rows["urn:gamma:7"]
    assert e7.link == "https://gamma.example.com/p/7" and e7.author == "G. Researcher"
    assert str(e7.published) == "2024-01-29 11:00:00" and str(e7.entry_updated) == "2024-01-29 11:30:00"
    assert e7.categories == ["memory"] and e7.feed_title == "Gamma Research"
    assert rows["urn:gamma:8"].content == "Body text"


def test_nvd_pages(spark):
    rows = {r.cve_id: r for r in cve_files.read_nvd_pages(spark, os.path.join(FIXTURES, "nvd"), NOW).collect()}
    assert str(rows["CVE-2024-10001"].cvss_base) == "9.8"
    assert str(rows["CVE-2024-10002"].cvss_base) == "7.5"
    assert rows["CVE-2024-10003"].cvss_base is None
    assert str(rows["CVE-2024-10001"].modified) == "2024-01-29 10:00:00"
    assert str(rows["CVE-2024-10002"].modified) == NOW  # unparseable -> now
    assert '"Buffer overflow in parser"' in rows["CVE-2024-10001"].json  # raw object kept
    stats = cve_files.nvd_page_stats(spark, os.path.join(FIXTURES, "nvd"))
    comp = windows.page_completeness(stats.withColumn("snap", F.lit("w1")), "snap").first()
    assert (comp.loaded, comp.total, comp.complete) == (3, 3, True)


def test_kev_catalog_and_gate(spark):
    from threatlake.operators import tables as tbl
    header, rows = cve_files.read_kev_catalog(spark, os.path.join(FIXTURES, "kev"), NOW)
    r = {x.cve_id: x for x in rows.collect()}
    assert set(r) == {"CVE-2024-10001", "CVE-2023-20002"}
    assert "knownRansomwareCampaignUse" not in r["CVE-2024-10001"].json  # unknown field dropped
    assert '"notes":""' in r["CVE-2024-10001"].json
    gate = tbl.catalog_changed(header, tbl.empty_state(spark)).first()
    assert gate.new_cursor == "2024-01-30T15:04:05Z" and gate.changed
    state = tbl.set_cursor(tbl.empty_state(spark), "CISA-KEV", gate.new_cursor)
    assert not tbl.catalog_changed(header, state).first().changed


def test_epss_pages_stamp_first_page_date(spark):
    df = cve_files.read_epss_pages(spark, os.path.join(FIXTURES, "epss", "day1"))
    rows = df.collect()
    assert len(rows) == 3 and {str(r.as_of) for r in rows} == {"2024-01-30"}
    assert str([r for r in rows if r.cve_id == "CVE-2024-10001"][0].epss) == "0.97512"
    stats = cve_files.epss_page_stats(spark, os.path.join(FIXTURES, "epss", "day1"))
    assert windows.page_completeness(stats.withColumn("d", F.lit(1)), "d").first().complete
    short = stats.where(F.col("offset") == 0)
    assert not windows.page_completeness(short.withColumn("d", F.lit(1)), "d").first().complete


def test_window_plan(spark):
    plan = windows.window_plan(spark, "2024-01-01T00:00:00Z", "2024-09-01 00:00:00").collect()
    assert [str(p.w_start)[:10] for p in plan] == ["2024-01-01", "2024-04-30", "2024-08-28"]
    assert str(plan[-1].w_end) == "2024-09-01 00:00:00" and plan[-1].cursor_after == "2024-09-01T00:00:00Z"
    bad = windows.window_plan(spark, "garbage", "2000-03-01 00:00:00").collect()
    assert str(bad[0].w_start) == "2000-01-01 00:00:00"
    assert windows.window_plan(spark, "2030-01-01T00:00:00Z", "2024-01-01 00:00:00").count() == 0


def test_validation(spark):
    docs = spark.createDataFrame([
        ("a", "<rss></rss>", "application/rss+xml", 200), ("b", "nope", "text/plain", 404),
        ("c", "<!DOCTYPE html><html>" + "x\n" * 200, "text/html", 200), ("d", "", "text/xml", 200)],
        "url string, body string, content_type string, status int")
    rep = {r.name: r for r in validation.validate_documents(docs).collect()}
    assert rep["a"].ok and rep["b"].error_kind == "HttpStatus 404"
    assert rep["c"].error_kind == "UnexpectedHtml" and rep["c"].snippet.endswith("…")
    assert len(rep["c"].snippet) == 241 and "\n" not in rep["c"].snippet
    assert rep["d"].error_kind == "Fetch"
    t = validation.validation_totals(validation.validate_documents(docs)).first()
    assert (t.total, t.ok, t.fail) == (4, 1, 3)


def test_optional_length_caps(spark):
    raw = feeds.read_feed_items(spark, os.path.join(FIXTURES, "feeds", "*", "*.xml"))
    capped = feeds.normalise_items(raw, feeds.feed_key_from_path(), NOW, max_summary_chars=5, max_content_chars=7)
    r = capped.where(F.col("guid") == "alpha-0001").first()
    assert r.summary == "Firmw" and r.content == "<p>Full"


def test_atom_elements_with_attributes(spark):
    raw = feeds.read_feed_items(spark, os.path.join(FIXTURES, "atom_attrs", "*", "*.xml"), kind="atom")
    rows = {r.guid: r for r in feeds.normalise_items(raw, "eps", NOW).collect()}
    e1 = rows["urn:eps:1"]
    assert e1.link == "https://eps.example.org/1"  # the alternate link, not the enclosure
    assert str(e1.published) == "2024-01-29 07:00:00"  # +01:00 converted to UTC; updated stands in
    assert e1.content == "<p>Long body</p>" and e1.summary == "<p>Short</p>" and e1.author == "E. One"
    assert e1.feed_title == "Epsilon Labs"
    assert rows["urn:eps:2"].content == "plain text" and rows["urn:eps:2"].summary == ""


def test_rdf_items(spark):
    raw = feeds.read_feed_items(spark, os.path.join(FIXTURES, "rdf", "*", "*.rdf"), kind="rdf")
    rows = {r.guid: r for r in feeds.normalise_items(raw, feeds.feed_key_from_path(), NOW).collect()}
    # RSS 1.0 items carry no guid: the link is the key; dates and authors come from Dublin Core
    n1 = rows["https://zeta.example.net/n/1"]
    assert str(n1.published) == "2024-01-28 06:30:00" and n1.author == "Zeta CERT" and n1.feed_url == "zeta"
    assert str(rows["https://zeta.example.net/n/2"].published) == "2024-01-29 04:30:00"
    assert n1.feed_title == "Zeta Notices" and n1.feed_language == "de"


def test_nvd_rows_selected_by_publication_windows(spark):
    from threatlake.functions.json_fields import cve_published
    rows = cve_files.read_nvd_pages(spark, os.path.join(FIXTURES, "nvd"), NOW).withColumn("published", cve_published("json"))
    sel = windows.select_windowed(rows, "published", "2023-12-01T00:00:00Z", "2024-05-01 00:00:00")
    got = {r.cve_id: (str(r.w_start), str(r.w_end)) for r in sel.collect()}
    # only CVE-2024-10002 (published 2024-03-15) falls in [cursor, now): first 120-day window
    assert got == {"CVE-2024-10002": ("2023-12-01 00:00:00", "2024-03-30 00:00:00")}

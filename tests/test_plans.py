"""Plan-level rules checked on every registered query (planning only, nothing runs)."""
import contextlib
import io

import pytest

from threatlake.catalog import PLANS, QUERIES
from threatlake.plans.layout import StoredTables, write_domain_tables
from threatlake.sources.bindings import Tables

from paths import SF001

# queries whose construction writes landing files or runs a stream (side effects)
SIDE_EFFECTS = {"stream_hourly_severity", "src_feed_xml_roundtrip", "src_nvd_pages_roundtrip",
                "src_kev_catalog_roundtrip", "src_epss_pages_roundtrip", "mv_analysis_cve_mentions",
                "mv_analysis_cve_mentions_v2", "mv_campaign_cve_rollups"}
PYTHON_UDF_QUERIES: set[str] = set()


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layout"))
    write_domain_tables(Tables(spark, SF001), root)
    return StoredTables(spark, root, SF001)


@pytest.mark.parametrize("name", ["dash_top_exploitable", "dash_danger_zone", "dash_movers_latest", "alert_sleepers",
                                  "epss_velocity", "epss_risk_pyramid", "dash_epss_distribution"])
def test_day_selections_are_partition_filters(stored, name):
    plan = _plan(PLANS[name](stored))
    scans = [blk for blk in plan.split("\n(") if blk.split(")")[0].isdigit() and "Scan parquet" in blk
             and "epss_daily" in blk and "ReadSchema: struct<>" not in blk]  # struct<>: max(as_of) probes
    assert scans, name
    for blk in scans:  # every scan that reads scores is pruned to named days
        assert "PartitionFilters: [isnotnull(as_of" in blk and "as_of#" in blk, (name, blk[:400])


def test_source_is_a_partition_filter_and_columns_are_pruned(stored):
    plan = _plan(PLANS["dash_danger_zone"](stored))
    assert "(source#" in plan and "= NVD)" in plan
    nvd_scan = [b for b in plan.split("\n(") if "cve_enriched" in b and "= NVD)" in b][0]
    assert "json" not in nvd_scan.split("ReadSchema:")[1].split("\n")[0]


def _groups(args: str) -> list[str]:
    """Top-level ``[...]`` groups of a formatted ``Arguments:`` line."""
    out, depth, cur = [], 0, ""
    for ch in args:
        if ch == "[":
            depth += 1
        if depth > 0:
            cur += ch
        if ch == "]":
            depth -= 1
            if depth == 0:
                out.append(cur)
                cur = ""
    return out


def unpartitioned_windows(plan: str) -> int:
    n = 0
    for blk in plan.split("\n("):
        if blk.split(")")[0].isdigit() and blk.split("\n")[0].endswith(") Window"):
            g = _groups(blk.split("Arguments:")[1].split("\n")[0])
            if len(g) == 1 or (len(g) == 2 and (" ASC " in g[1] or " DESC " in g[1])):
                n += 1
    return n


# Windows without a partition key, allowed only where they see aggregated rows: five risk
# bands, one row per feed, one row per day.
UNPARTITIONED_WINDOW_QUERIES = {"epss_risk_pyramid", "feed_top_feeds", "epss_universe_growth"}




# Collections built by aggregation, allowed only for bounded groups: the <= 50 alert rows
# of one detection, and the languages of one feed.
COLLECTING_QUERIES = {"alert_generic_payload", "alert_chat_payload", "alert_generic_payload_rows", "alert_chat_payload_blocks",
                      "src_feed_registry_volume"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_plan_rules(spark, name):
    """No cross / nested-loop joins; no Python outside the opt-in UDF; unpartitioned
    windows and aggregate collections only where their input is bounded."""
    plan = _plan(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    if name not in PYTHON_UDF_QUERIES:
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
    assert (unpartitioned_windows(plan) > 0) == (name in UNPARTITIONED_WINDOW_QUERIES), name
    collects = "collect_list(" in plan or "collect_set(" in plan
    assert collects == (name in COLLECTING_QUERIES), name


@pytest.mark.parametrize("name,agg", [("sink_current_upsert", "partial_max_by"), ("sink_archive_table", "partial_min_by"),
                                      ("epss_latest_per_cve", "partial_max_by"), ("alert_sleepers", "partial_min_by")])
def test_version_picks_aggregate_partially(spark, name, agg):
    # first/last version per key is combined map-side: a hot key is reduced before the shuffle
    assert agg in _plan(QUERIES[name](spark, SF001))


@pytest.mark.parametrize("name", ["cli_patchlist", "cli_patchlist_kev", "cli_patchlist_page"])
def test_patchlist_reads_records_after_the_page_is_taken(stored, name):
    plan = PLANS[name](stored)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    pages = [i for i, line in enumerate(plan) if "LocalLimit" in line or "Offset" in line]
    assert pages
    inner = max(pages, key=lambda i: depth[i])
    below = []
    for line, d in zip(plan[inner + 1:], depth[inner + 1:]):
        if d <= depth[inner]:
            break
        below.append(line)
    assert below and not any("descriptions" in line or "dueDate" in line for line in below)
    assert any("descriptions" in line for line in plan)

"""Headline-query benchmark.

Runs the headline queries over the tables in ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": "headline_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is executed in full (``noop`` sink: every row is produced, nothing is
collected to the driver); the reported time per query is the best of ``$BENCH_RUNS``
(default 2) runs, after one untimed warm-up of the session. Extra keys: the same plans
over the stored layout (``stored_layout_*``, ``BENCH_STORED=0`` skips) and the streaming
EPSS load (``ingest_epss_*``, ``BENCH_INGEST=0`` skips).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dash_top_exploitable",      # latest EPSS x NVD x KEV, top 25
    "dash_danger_zone",          # CVSS x EPSS danger zone, top 50
    "dash_movers_latest",        # day vs day-before self join
    "alert_sleepers",            # as-of baseline join + decorrelated look-ups
    "epss_velocity",             # two-snapshot movement counts
    "epss_latest_per_cve",       # newest score per CVE over the whole history
    "epss_risk_pyramid",
    "api_cve_detail",            # 4 chained left joins on cve_id
    "api_campaign_cve_rollups",  # campaign x CVE rollup with distinct counts
    "cli_patchlist",
    "cli_ioc",
    "sink_current_upsert",       # last-write-wins upsert with keep-first columns
    "sink_change_summary",
    "qa_feed_coverage_summary",
    "ops_duration_histogram",
]


def _stored_layout(spark, sf_dir: str, runs: int) -> dict:
    """The same plans over the production layout (domain tables written once, partitioned
    and sorted): what a query costs when it does not re-derive its inputs."""
    import uuid

    from threatlake.catalog import PLANS
    from threatlake.plans.layout import StoredTables, write_domain_tables
    from threatlake.session import scratch_path
    from threatlake.sources.bindings import Tables
    root = scratch_path(spark, f"bench-layout-{uuid.uuid4().hex[:12]}")
    t0 = time.perf_counter()
    write_domain_tables(Tables(spark, sf_dir), root)
    materialise = time.perf_counter() - t0
    st = StoredTables(spark, root, sf_dir)
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            PLANS[name](st).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 4)
    return {"stored_layout_total": round(sum(times.values()), 4), "stored_layout_queries": times,
            "stored_layout_write_sec": round(materialise, 4)}


def _ingest(spark, sf_dir: str) -> dict:
    """Streaming EPSS load: pages landed from the sf tables (untimed), then the staged,
    completeness-gated, partition-overwriting loader timed end to end."""
    import uuid

    from pyspark.sql import functions as F

    from threatlake.session import scratch_path
    from threatlake.sources.bindings import Tables
    from threatlake.sources.landing import write_epss_pages
    from threatlake.streaming import jobs
    root = scratch_path(spark, f"bench-ingest-{uuid.uuid4().hex[:12]}")
    epss = Tables(spark, sf_dir).epss_daily
    write_epss_pages(epss, f"{root}/landing", F.substr("cve_id", F.lit(10)).cast("long"))
    rows = epss.count()
    t0 = time.perf_counter()
    jobs.epss_ingest(spark, f"{root}/landing/*/", f"{root}/staging", f"{root}/epss_daily",
                     latest_path=f"{root}/epss_latest", manifest_path=f"{root}/manifest",
                     name=f"bench-{uuid.uuid4().hex[:12]}").awaitTermination()
    dt = time.perf_counter() - t0
    return {"ingest_epss_rows": rows, "ingest_epss_sec": round(dt, 4), "ingest_epss_rows_per_sec": round(rows / dt)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    from threatlake.catalog import QUERIES
    from threatlake.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus), extra={"spark.driver.memory": "8g"})
    QUERIES["dash_total_cves"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 4), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if os.environ.get("BENCH_STORED", "1") == "1":
        out.update(_stored_layout(spark, sf_dir, runs))
    if os.environ.get("BENCH_INGEST", "1") == "1":
        out.update(_ingest(spark, sf_dir))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Structured Streaming jobs over landing folders.

Each job is ``readStream`` (file source: progress is the stream checkpoint, so a file is
processed once) -> the batch operators inside ``foreachBatch``. Every batch function is
idempotent — a replayed micro-batch leaves the tables as they were — which is what
exactly-once output needs from ``foreachBatch``. Checkpoints live under the shared
``spark.checkpoint.dir``; ``trigger`` defaults to ``availableNow`` (drain what has
landed, then stop), a processing-time trigger turns the same job into a service.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from threatlake.functions.json_fields import cve_published
from threatlake.operators import tables as tbl
from threatlake.operators.cursors import append_cursor, read_cursors
from threatlake.operators.snapshots import ts_lit
from threatlake.operators.storage import KeyedTable, read_if_exists, staged, unstage
from threatlake.plans import alerts as alr
from threatlake.schemas import (CVE_KEY, EPSS_PAGE, FEED_ITEM, FEED_ITEM_KEEP_FIRST, FEED_ITEM_KEY, KEV_CATALOG,
                                NVD_PAGE)
from threatlake.session import checkpoint_dir, few_listing_tasks
from threatlake.sources import cve_files, feeds
from threatlake.sources.windows import MAX_WINDOW_DAYS, page_completeness, select_windowed, window_plan


def _checkpoint(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


def _start(stream: DataFrame, fn, name: str, spark: SparkSession, trigger: dict | None):
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", _checkpoint(spark, name))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


# ---------------------------------------------------------------- STR1 -------------
# Every micro-batch may rewrite the current table, so that a run takes what has landed in so many at most.
MOST_BATCHES = 4
RUN_LOG = ["job", "batch_id", "feed_name", "ts", "status", "documents", "rejected", "items", "new", "updated", "failed", "empty_content"]
REJECTS = ["file", "landed_at", "feed_name", "kind", "reason"]


def feed_ingest(spark: SparkSession, landing: str, archive_path: str, current_path: str,
                kind: str | None = None, now=None, trigger: dict | None = None, name: str = "feeds",
                max_files: int = 100, registry: DataFrame | None = None, feed=None,
                log_path: str | None = None, rejects_path: str | None = None):
    """Landed feed documents (``landing/<feed>/<file>.xml``) -> ``archive`` (insert-if-
    absent) and ``current`` (upsert, keep-first columns). RSS, RDF and Atom documents may
    share a folder: a document's kind is that of its root element (``kind`` restricts it).
    Unreadable documents go to the table at ``rejects_path`` with the reason; rows without
    a key are dropped, as the source system logs and skips them. ``feed_url`` is the feed's
    URL from ``registry`` (``name`` = landing folder), else the folder name; ``feed`` gives
    another expression over ``_file``. A micro-batch takes ``max_files`` files, or more where a run
    would need over ``MOST_BATCHES`` of them: its table writes then grow with what has landed, not
    with the number of batches times the table.

    With ``log_path`` each micro-batch enters its counts per feed in a run log. The entry is
    written before the tables and kept if present: a batch that runs again after a crash
    finds the counts of its first run, which saw the tables as they were."""
    files = "path string, modificationTime timestamp, length long, content binary"
    few_listing_tasks(spark)
    landed = spark.read.format("binaryFile").schema(files).load(landing).select("path").count()
    stream = (spark.readStream.format("binaryFile").schema(files)
              .option("maxFilesPerTrigger", max(max_files, -(-landed // MOST_BATCHES))).load(landing))
    cols = [f.name for f in FEED_ITEM.fields]
    archive = KeyedTable(spark, archive_path, FEED_ITEM_KEY, cols)
    current = KeyedTable(spark, current_path, FEED_ITEM_KEY, cols)
    order = ["_mtime", "_file", "_pos"]  # later fetches win; document order within a fetch
    folder = feed if feed is not None else feeds.feed_key_from_path()

    def named(df: DataFrame) -> DataFrame:
        df = df.withColumn("_feed", folder)
        if registry is None:
            return df.withColumn("_url", F.col("_feed"))
        urls = registry.select(F.col("name").alias("_feed"), F.col("url").alias("_url"))
        return df.join(urls, "_feed", "left").withColumn("_url", F.coalesce("_url", "_feed"))

    def log(documents: DataFrame, items: DataFrame, batch_id: int) -> None:
        # whether there is a content or summary is all that the counts need of them
        items = items.withColumns({c: F.when(F.col(c) != "", "x") for c in ("content", "summary")})
        changes = tbl.change_summary(tbl.classify_changes(archive.stored_like(items.where("_valid")), items, FEED_ITEM_KEY, order))
        seen = documents.groupBy(F.col("_url").alias("feed_name")).agg(F.count("*").alias("documents"), F.count("reason").alias("rejected"))
        counts = seen.join(changes.withColumnsRenamed({"feed_url": "feed_name", "processed": "items"}), "feed_name", "left")
        entry = (counts.na.fill(0).withColumn("job", F.lit(name)).withColumn("batch_id", F.lit(batch_id).cast("long"))
                 .withColumn("ts", (ts_lit(now) if now is not None else F.current_timestamp()).cast("timestamp_ntz"))
                 .withColumn("status", F.when(F.col("rejected") < F.col("documents"), "success").otherwise("error")))
        KeyedTable(spark, log_path, RUN_LOG[:3], RUN_LOG, buckets=8).insert_new(entry, ["ts"])

    def batch(df: DataFrame, batch_id: int) -> None:
        few_listing_tasks(df.sparkSession)
        raw = feeds.parsed_items(named(feeds.parse_documents(df, kind)))
        rows = feeds.normalise_items(raw, F.col("_url"), now if now is not None else F.current_timestamp())
        rows = staged(rows.select(*cols, *order, "_valid", "kind", "reason"))  # one parse per batch
        documents = rows.where("coalesce(_pos, 0) = 0").withColumn("_url", F.col("feed_url"))
        items = rows.where("_pos is not null").drop("kind", "reason")
        if rejects_path:
            refused = documents.where("reason is not null").select(F.col("_file").alias("file"), F.col("_mtime").alias("landed_at"),
                                                                   F.col("_url").alias("feed_name"), "kind", "reason")
            KeyedTable(spark, rejects_path, REJECTS[:2], REJECTS, buckets=8).insert_new(refused, ["reason"])
        if log_path:
            log(documents, items, batch_id)
        valid = items.where("_valid").drop("_valid")
        archive.insert_new(valid, order)
        current.upsert(valid, order, FEED_ITEM_KEEP_FIRST)
        unstage(rows)

    return _start(stream, batch, name, spark, trigger)


# ---------------------------------------------------------------- STR2 + STR4 ------
def epss_ingest(spark: SparkSession, landing: str, staging_path: str, epss_path: str,
                cve_path: str | None = None, alerts_path: str | None = None, state_path: str | None = None,
                trigger: dict | None = None, name: str = "epss", now=None, latest_path: str | None = None,
                max_files: int = 1000, manifest_path: str | None = None):
    """Landed EPSS pages (``landing/<snapshot>/<page>.json``) -> ``epss_daily``.

    A snapshot's pages may arrive over several micro-batches: pages of snapshots that are
    still short are staged, and each batch judges completeness over its own pages plus the
    staged ones. A snapshot is loaded only when its page set is complete (rows >= declared
    total), only if its day is not loaded yet, and as one partition overwrite; a day
    whose pages land together never touches the staging table. After a
    load, sleeper detection runs on the updated table and the alert rows are appended
    once per detection day (the cursor table records the day). With ``latest_path`` the
    newest score per CVE is kept as its own keyed table, upserted from each loaded day,
    so readers of "latest per CVE" never aggregate the whole history."""
    stream = (spark.readStream.schema(EPSS_PAGE).option("multiLine", True)
              .option("maxFilesPerTrigger", max_files).json(landing)
              .withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_mtime", F.col("_metadata.file_modification_time").cast("timestamp_ntz")))

    def batch(df: DataFrame, batch_id: int) -> None:
        page_cols = [f.name for f in EPSS_PAGE.fields] + ["_file", "_mtime", "snapshot"]
        pages = df.withColumn("snapshot", cve_files.snapshot_key()).select(*page_cols)
        touched = [r[0] for r in pages.select("snapshot").distinct().collect()]  # snapshots in this batch
        prior = read_if_exists(spark, staging_path)
        pages_all = pages if prior is None else pages.unionByName(prior.where(F.col("snapshot").isin(touched)).select(*page_cols))
        # a replayed batch or a re-landed page may repeat a page: of each (snapshot, offset) the
        # file that landed last counts, whatever order the files arrived in
        newest = (pages_all.groupBy("snapshot", "offset").agg(F.max(F.struct("_mtime", "_file")).alias("l"))
                  .select("snapshot", "offset", "l._mtime", "l._file"))
        pages_all = (pages_all.join(newest, ["snapshot", "offset", "_mtime", "_file"], "left_semi")
                     .dropDuplicates(["snapshot", "offset"]).checkpoint(eager=True))
        stats = pages_all.select("snapshot", "offset", "total", F.size("data").alias("rows"))
        complete = page_completeness(stats, "snapshot").where("complete").select("snapshot")
        # only pages of snapshots still short are staged for later batches
        pending = pages.join(complete, "snapshot", "left_anti")
        if not pending.isEmpty():
            pending.write.mode("append").partitionBy("snapshot").parquet(staging_path)
        rows = cve_files.epss_rows(pages_all.join(complete, "snapshot"), "snapshot").checkpoint(eager=True)
        days = [r[0] for r in rows.select("as_of").distinct().collect()]  # days complete in this batch
        if not days:
            return
        loaded = read_if_exists(spark, epss_path)
        new = rows if loaded is None else tbl.new_snapshot_rows(loaded, rows)
        tbl.write_snapshot(new, epss_path)
        # Everything below follows from the days as stored, whether this batch or an earlier,
        # broken-off run of it wrote them, and may run again.
        stored = spark.read.parquet(epss_path).where(F.col("as_of").isin(days))
        if manifest_path:
            tbl.record_days(stored, manifest_path)
        if latest_path:
            latest = KeyedTable(spark, latest_path, ["cve_id"], ["cve_id", "as_of", "epss", "percentile"])
            had = latest.table()
            newer = stored if had is None else tbl.not_older(stored, had, ["cve_id"], "as_of")
            latest.upsert(newer.select("cve_id", "as_of", "epss", "percentile"), ["as_of"])
        if cve_path and alerts_path and state_path:
            _alert_after_load(spark, epss_path, cve_path, alerts_path, state_path, now)

    return _start(stream, batch, name, spark, trigger)


def _alert_after_load(spark, epss_path, cve_path, alerts_path, state_path, now):
    epss = spark.read.parquet(epss_path)
    cve = KeyedTable(spark, cve_path, CVE_KEY).table()
    if cve is None:
        cve = spark.createDataFrame([], "cve_id string, source string, json string, cvss_base decimal(3,1), "
                                        "epss decimal(6,5), modified timestamp_ntz")
    state = read_cursors(spark, state_path)
    sleepers = alr.detect_sleepers(epss, cve)
    due = alr.alert_once(sleepers, state).checkpoint(eager=True)
    if due.isEmpty():
        return
    stamp = ts_lit(now) if now is not None else F.current_timestamp().cast("timestamp_ntz")
    day = due.select(F.max("date_now")).scalar()
    # keyed by the detection day and written insert-if-absent: a replayed batch that
    # already sent this day's alert adds nothing
    sent = alr.generic_payload(due, stamp).select(day.alias("alert_day"), stamp.alias("sent_at"), "payload")
    KeyedTable(spark, alerts_path, ["alert_day"], ["alert_day", "sent_at", "payload"], buckets=8) \
        .insert_new(sent, ["sent_at"])
    append_cursor(spark, state_path, "ALERTING", day)


# ---------------------------------------------------------------- STR3 -------------
def cve_ingest(spark: SparkSession, landing: str, cve_path: str, kind: str = "nvd", state_path: str | None = None,
               trigger: dict | None = None, name: str | None = None, now=None, max_files: int = 1000):
    """Landed NVD pages or KEV catalogs -> ``cve_enriched`` upserts. NVD sets json, score
    and modified (EPSS kept); KEV sets json and modified (score and EPSS kept). A KEV
    catalog whose release cursor equals the stored one is skipped."""
    schema = NVD_PAGE if kind == "nvd" else KEV_CATALOG
    stream = (spark.readStream.schema(schema).option("multiLine", True)
              .option("maxFilesPerTrigger", max_files).json(landing)
              .withColumn("_file", F.col("_metadata.file_path")))
    table = KeyedTable(spark, cve_path, CVE_KEY, ["cve_id", "source", "json", "cvss_base", "epss", "modified"])
    n = now if now is not None else F.current_timestamp().cast("timestamp_ntz")

    def batch(df: DataFrame, batch_id: int) -> None:
        if kind == "nvd":
            rows = cve_files.nvd_rows(df, n)
            rows = rows.checkpoint(eager=True)
            table.upsert(rows, ["modified"], keep_first=["epss"])
            if state_path:
                append_cursor(spark, state_path, "NVD", rows.select(_cursor_text(F.max(cve_published("json")))).scalar())
            return
        state = read_cursors(spark, state_path) if state_path else tbl.empty_state(spark)
        gate = tbl.catalog_changed(cve_files.kev_header(df), state)
        fresh = df.join(gate.where("changed").select(F.col("new_cursor")),
                        tbl.normalise_rfc3339(F.coalesce(F.when(F.col("dateReleased") != "", F.col("dateReleased")),
                                                         F.col("catalogVersion"))) == F.col("new_cursor"), "left_semi")
        rows = cve_files.kev_rows(fresh, n).checkpoint(eager=True)
        if rows.isEmpty():
            return
        table.upsert(rows, ["modified"], keep_first=["cvss_base", "epss"])
        if state_path:
            newest = gate.where("changed").select(F.max("new_cursor")).scalar()
            append_cursor(spark, state_path, "CISA-KEV", newest)

    return _start(stream, batch, name or f"cve-{kind}", spark, trigger)


def _cursor_text(t):
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def nvd_window_ingest(spark: SparkSession, landing: str, cve_path: str, state_path: str, now, days: int = MAX_WINDOW_DAYS,
                      multi_line: bool = True, max_windows: int | None = None) -> int:
    """Landed NVD pages -> ``cve_enriched``, one publication window after the other from the
    stored cursor to ``now``. The cursor moves when a window is stored, so a run that breaks
    off goes on with the next window (``max_windows`` ends it early). Returns the windows done;
    their number depends on the time since the cursor only."""
    table = KeyedTable(spark, cve_path, CVE_KEY, ["cve_id", "source", "json", "cvss_base", "epss", "modified"])
    cursor = read_cursors(spark, state_path).where(F.col("source") == "NVD").select(F.max("cursor")).first()[0]
    rows = cve_files.read_nvd_pages(spark, landing, now, multi_line).withColumn("_published", cve_published("json"))
    plan = window_plan(spark, cursor, now, days).limit(max_windows) if max_windows is not None else window_plan(spark, cursor, now, days)
    windows = plan.collect()  # one row per window
    if not windows:
        return 0
    todo = select_windowed(rows, "_published", cursor, now, days)
    todo = staged(todo.where(F.col("w_start") <= F.lit(windows[-1].w_start)))
    try:
        for w in windows:
            table.upsert(todo.where(F.col("w_start") == F.lit(w.w_start)).drop("w_start", "w_end", "_published"), ["modified"], keep_first=["epss"])
            append_cursor(spark, state_path, "NVD", w.cursor_after)
    finally:
        unstage(todo)
    return len(windows)


# ---------------------------------------------------------------- STR5 -------------
def hourly_severity(analyses: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Streaming aggregation: analyses per hour and severity, event time ``analysed_at``;
    rows later than ``delay`` behind the newest event are dropped (watermark)."""
    # watermarks need TIMESTAMP; under the UTC session the wall clock is unchanged
    ev = analyses.withColumn("_event", F.col("analysed_at").cast("timestamp"))
    return (ev.withWatermark("_event", delay)
            .groupBy(F.window("_event", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("items"),
                 F.count_if(F.col("severity_level") == "CRITICAL").alias("critical"),
                 F.count_if(F.col("severity_level") == "HIGH").alias("high"),
                 F.count_if(F.col("severity_level") == "MEDIUM").alias("medium"),
                 F.count_if(F.col("severity_level") == "LOW").alias("low"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "items", "critical", "high", "medium", "low"))


def sitrep_stream(spark: SparkSession, source_path: str, schema, out_path: str, delay: str = "2 hours",
                  trigger: dict | None = None, name: str = "sitreps"):
    """Append-mode hourly counts to Parquet: a window is written once, when the watermark
    passes its end."""
    s = spark.readStream.schema(schema).parquet(source_path)
    q = (hourly_severity(s, delay).writeStream.outputMode("append").format("parquet")
         .option("path", out_path).option("checkpointLocation", _checkpoint(spark, name)))
    return q.trigger(**(trigger or {"availableNow": True})).start()


def sitrep_upsert_stream(spark: SparkSession, source_path: str, schema, table_path: str, delay: str = "2 hours",
                         trigger: dict | None = None, name: str = "sitreps-upsert"):
    """Update-mode variant: every micro-batch upserts the windows it changed, so the table
    always holds the current counts of every hour (including still-open ones)."""
    s = spark.readStream.schema(schema).parquet(source_path)
    table = KeyedTable(spark, table_path, ["window_start"],
                       ["window_start", "window_end", "items", "critical", "high", "medium", "low"], buckets=16)

    def batch(df: DataFrame, batch_id: int) -> None:
        table.upsert(df.withColumn("_batch", F.lit(batch_id)), ["_batch"])

    q = (hourly_severity(s, delay).writeStream.outputMode("update").foreachBatch(batch)
         .option("checkpointLocation", _checkpoint(spark, name)))
    return q.trigger(**(trigger or {"availableNow": True})).start()

"""Stateful table writes expressed as set operations.

* ``append_new``      – insert-if-absent (archive): first version in batch order wins,
                        keys already stored are never touched.
* ``upsert_latest``   – last write wins for the SET columns, ``keep_first`` columns keep
                        the value of the first stored version (current, CVE tables).
* ``classify_changes``– new / updated / failed per incoming row.
* ``new_snapshot_rows`` / ``write_snapshot`` – daily snapshot load, skipping days present,
                        atomic per-day partition overwrite.
* cursors and the catalog change gate.

Dedup and "first/last version" are ``min_by`` / ``max_by`` aggregations keyed by the
table key: they combine partially on the map side, so a key holding a third of a batch
is reduced before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threatlake.schemas import INGEST_STATE


def _has_key(keys) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _order_key(order) -> Column:
    return F.struct(*[F.col(c) for c in order])


def first_per_key(batch: DataFrame, keys, order) -> DataFrame:
    """The first row of each key in ``order`` (ties: lowest full row)."""
    cols = [c for c in batch.columns if c not in keys]
    g = batch.groupBy(*keys).agg(F.min_by(F.struct(*cols), _order_key(order)).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]).select(*batch.columns)


def append_new(existing: DataFrame, batch: DataFrame, keys, order) -> DataFrame:
    """Rows to append to an insert-if-absent table: first batch version of every key the
    table does not hold yet."""
    firsts = first_per_key(batch.where(_has_key(keys)), keys, order)
    return firsts.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def _merged(existing: DataFrame, batch: DataFrame, keys, order, keep_first, *more) -> DataFrame:
    keep_first = [c for c in keep_first if c in existing.columns]
    mutable = [c for c in existing.columns if c not in keys and c not in keep_first]
    old = existing.select(*existing.columns, F.lit(0).alias("_src"), *[F.lit(None).alias(f"_o{i}")
                                                                      for i, _ in enumerate(order)])
    new = batch.select(*existing.columns, F.lit(1).alias("_src"), *[F.col(c).alias(f"_o{i}")
                                                                   for i, c in enumerate(order)])
    # Stored rows only need their relative order against the batch: NULL order cols sort
    # first, and _src = 0 keeps them ahead of every batch row.
    both = old.unionByName(new)
    ok = F.struct(F.col("_src"), *[F.col(f"_o{i}") for i in range(len(order))])
    aggs = [F.max_by(F.struct(*mutable), ok).alias("_last")]
    if keep_first:
        aggs.append(F.min_by(F.struct(*keep_first), ok).alias("_first"))
    g = both.groupBy(*keys).agg(*aggs, *[f(mutable) for f in more])
    out = [F.col(k) for k in keys] + [F.col(f"_last.{c}").alias(c) for c in mutable] + \
        [F.col(f"_first.{c}").alias(c) for c in keep_first]
    return g.select("*", *out[len(keys):])


def upsert_latest(existing: DataFrame, batch: DataFrame, keys, order, keep_first=()) -> DataFrame:
    """The table after upserting ``batch``: per key, SET columns from the last version,
    ``keep_first`` columns from the first (stored rows count as earlier than the batch)."""
    return _merged(existing, batch, keys, order, keep_first).select(*existing.columns)


def merge_changes(existing: DataFrame, batch: DataFrame, keys, order, keep_first=()) -> DataFrame:
    """Those rows of ``upsert_latest`` that are not stored identically; ``_had``: their key is stored."""
    was = F.col("_src") == 0
    g = _merged(existing, batch, keys, order, keep_first, lambda cols: F.count_if(was).alias("_times"),
                lambda cols: F.max_by(F.when(was, F.struct(*cols)), F.when(was, F.lit(1))).alias("_old"))
    same = (F.col("_times") == 1) & F.col("_old").eqNullSafe(F.col("_last"))
    return g.where(~same).select(*existing.columns, (F.col("_times") > 0).alias("_had"))


def classify_changes(existing_archive: DataFrame, batch: DataFrame, keys, order) -> DataFrame:
    """Each batch row with ``change`` = ``new`` (its archive insert happens), ``updated``
    (archive no-op, current rewritten) or ``failed`` (no key)."""
    has_key = _has_key(keys)
    firsts = batch.where(has_key).groupBy(*keys).agg(F.min(_order_key(order)).alias("_first"))
    stored = existing_archive.select(*keys).distinct().withColumn("_stored", F.lit(True))
    j = batch.join(firsts, list(keys), "left").join(stored, list(keys), "left")
    change = (F.when(~has_key, "failed")
              .when(F.col("_stored").isNull() & (_order_key(order) == F.col("_first")), "new")
              .otherwise("updated"))
    return j.select(*batch.columns, change.alias("change"))


def change_summary(classified: DataFrame, group_col: str = "feed_url") -> DataFrame:
    """Per group: processed, new, updated, failed (and, when the rows carry content and
    summary, the stored items whose both are empty)."""
    aggs = [F.count(F.lit(1)).alias("processed"),
            F.count_if(F.col("change") == "new").alias("new"),
            F.count_if(F.col("change") == "updated").alias("updated"),
            F.count_if(F.col("change") == "failed").alias("failed")]
    if {"content", "summary"} <= set(classified.columns):
        empty = (F.coalesce(F.col("content"), F.lit("")) == "") & (F.coalesce(F.col("summary"), F.lit("")) == "")
        aggs.append(F.count_if(empty & (F.col("change") != "failed")).alias("empty_content"))
    return classified.groupBy(group_col).agg(*aggs).orderBy(group_col)


# -------------------------------------------------------------- snapshots ---------
def new_snapshot_rows(existing: DataFrame, batch: DataFrame, date_col: str = "as_of") -> DataFrame:
    """Batch rows of days the table does not hold yet (a day is loaded once)."""
    return batch.join(existing.select(date_col).distinct(), date_col, "left_anti")


def write_snapshot(rows: DataFrame, path: str, date_col: str = "as_of", manifest_path: str | None = None) -> None:
    """Partitioned write; with dynamic partition overwrite each written day is replaced
    as a whole, so a re-run of a half-written day cannot leave it partial. Range
    partitioning on (day, cve_id) keeps tasks even when one day dominates, and sorted
    files give tight min/max statistics on ``cve_id`` for point look-ups."""
    (rows.repartitionByRange(date_col, "cve_id").sortWithinPartitions(date_col, "cve_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    if manifest_path:
        # one row per written day: "latest day", coverage and the ingest log then read
        # this small table instead of the footers of every data file
        record_days(rows, manifest_path, date_col)


def record_days(rows: DataFrame, manifest_path: str, date_col: str = "as_of") -> None:
    """Append a manifest row for each day of ``rows``; readers take the newest of a day."""
    (rows.groupBy(date_col).agg(F.count(F.lit(1)).alias("rows"))
     .withColumn("written_at", F.current_timestamp().cast("timestamp_ntz"))
     .coalesce(1).write.mode("append").parquet(manifest_path))


def not_older(rows: DataFrame, stored: DataFrame, keys, order: str) -> DataFrame:
    """``rows`` without those whose key is stored with a later ``order`` value."""
    had = stored.select(*keys, F.col(order).alias("_had"))
    return rows.join(had, list(keys), "left").where(F.col("_had").isNull() | (F.col(order) >= F.col("_had"))).drop("_had")


def manifest_days(manifest: DataFrame, date_col: str = "as_of") -> DataFrame:
    """Loaded days with their row counts (the newest write of a re-loaded day wins)."""
    g = manifest.groupBy(date_col).agg(F.max_by(F.col("rows"), F.col("written_at")).alias("rows"))
    return g.orderBy(date_col)


def removed_from_catalog(stored: DataFrame, catalog_rows: DataFrame, source: str = "CISA-KEV") -> DataFrame:
    """Stored entries of ``source`` that a (full) catalog release no longer lists. The
    catalog upsert keeps them, as the source system does; this report lets a caller
    tombstone them on purpose."""
    listed = catalog_rows.select("cve_id").distinct()
    return stored.where(F.col("source") == source).join(listed, "cve_id", "left_anti")


# ---------------------------------------------------------------- cursors ---------
def cursor_value(state: DataFrame, source: str) -> Column:
    """Scalar subquery: the stored cursor of ``source`` (NULL when absent)."""
    return state.where(F.col("source") == source).select(F.max("cursor")).scalar()


def set_cursor(state: DataFrame, source: str, value) -> DataFrame:
    """The cursor table with ``source`` set to ``value`` (a literal or scalar Column)."""
    spark = state.sparkSession
    v = value if isinstance(value, Column) else F.lit(value)
    row = spark.range(1).select(F.lit(source).alias("source"), v.cast("string").alias("cursor"))
    return state.where(F.col("source") != source).unionByName(row)


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INGEST_STATE)


def normalise_rfc3339(text) -> Column:
    """RFC 3339 text re-rendered as ``yyyy-MM-ddTHH:mm:ssZ`` in UTC (fraction dropped);
    unparseable text is kept as it is."""
    t = F.col(text) if isinstance(text, str) else text
    ts = F.try_to_timestamp(t)
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), t)


def catalog_changed(header: DataFrame, state: DataFrame, source: str = "CISA-KEV") -> DataFrame:
    """Change gate of a catalog: its cursor is ``dateReleased`` (else ``catalogVersion``);
    the run is skipped when it equals the stored cursor."""
    cur = F.coalesce(F.when(F.col("dateReleased") != "", F.col("dateReleased")), F.col("catalogVersion"))
    stored = cursor_value(state, source)
    return header.select(normalise_rfc3339(cur).alias("new_cursor"), stored.alias("stored_cursor")) \
        .withColumn("changed", F.col("stored_cursor").isNull() | (F.col("new_cursor") != F.col("stored_cursor")))

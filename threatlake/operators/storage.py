"""Keyed Parquet tables that support insert-if-absent and upsert without a MERGE-capable
table format.

Rows are spread over ``buckets`` partition folders by a hash of the key. A batch only
touches the buckets its keys hash to: the stored keys of those buckets are read (a
partition filter) and compared with the batch's. Rows of new keys are appended. Only buckets
with a stored row that the batch changes are merged by the set operators of
``threatlake.operators.tables``, staged as compressed Parquet in the shared checkpoint
folder and written back with dynamic partition overwrite — so a batch of new keys never
rewrites what is stored. Both operations are idempotent: replaying a batch (after a lost
executor or a restarted stream) yields the same table.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from threatlake.operators.tables import append_new, merge_changes, upsert_latest
from threatlake.session import checkpoint_dir, scratch_path

BUCKET = "_bucket"


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where nothing has been written yet. Any other
    failure (a broken schema, no access) is raised, never taken for an empty table."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once into a compressed Parquet table of its own in the shared folder.
    ``unstage`` deletes it when nothing reads it any more."""
    path = scratch_path(df.sparkSession, f"staged-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def unstage(df: DataFrame) -> None:
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys, columns=None, buckets: int = 64):
        """``columns``: the stored columns (default: those of the first batch); order
        columns of a batch that are not listed are used for ordering only."""
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.columns = list(columns) if columns else None

    def bucket_of(self, df: DataFrame):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame | None:
        return read_if_exists(self.spark, self.path)

    def table(self) -> DataFrame | None:
        t = self.read()
        return None if t is None else t.drop(BUCKET)

    def _touched(self, batch: DataFrame):
        b = batch.withColumn(BUCKET, self.bucket_of(batch))
        # at most ``buckets`` small integers reach the driver: the partition filter list
        touched = [r[0] for r in b.select(BUCKET).distinct().collect()]
        return b, touched

    def _stored(self, touched, like: DataFrame) -> DataFrame:
        cols = (self.columns or [c for c in like.columns if c != BUCKET]) + [BUCKET]
        t = self.read()
        if t is None:
            return like.where(F.lit(False)).select(*cols)
        return t.where(F.col(BUCKET).isin(touched)).select(*cols)

    def stored_like(self, batch: DataFrame) -> DataFrame:
        """Stored rows of the buckets that the keys of ``batch`` fall into."""
        b, touched = self._touched(batch)
        return self._stored(touched, b).drop(BUCKET)

    def _write(self, df: DataFrame, mode: str) -> None:
        # a bucket's rows meet in one task, unless it is large: then adaptive execution splits it
        (df.hint("rebalance", F.col(BUCKET)).write.mode(mode).option("compression", "zstd")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path))

    def _same_key(self, one: DataFrame, two: DataFrame):
        return reduce(lambda a, b: a & b, [one[k].eqNullSafe(two[f"_k_{k}"]) for k in self.keys])

    def _renamed_keys(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_k_{k}") for k in self.keys])

    def insert_new(self, batch: DataFrame, order) -> int:
        """Append the first version of every key not stored yet; returns rows appended."""
        b, touched = self._touched(batch)
        if not touched:
            return 0
        stored = self._stored(touched, b)
        new = staged(append_new(stored, b, self.keys, order).select(*stored.columns))
        n = new.count()
        if n:
            self._write(new, "append")
        unstage(new)
        return n

    def upsert(self, batch: DataFrame, order, keep_first=()) -> int:
        """Last version wins for all columns but ``keep_first`` (first version kept).

        Rows of keys not stored yet are appended. Only buckets with stored rows that change are
        rewritten: a feed poll that returns mostly unchanged items reads its buckets but
        writes only where something changed. Returns the number of buckets written."""
        b, touched = self._touched(batch)
        if not touched:
            return 0
        stored = self._stored(touched, b)
        keys = self._renamed_keys(b).distinct()
        known = staged(stored.select(*self.keys).join(keys, self._same_key(stored, keys), "left_semi"))
        if known.isEmpty():  # nothing stored changes
            unstage(known)
            self._write(upsert_latest(stored.where(F.lit(False)), b, self.keys, order, keep_first), "append")
            return len(touched)
        met = self._renamed_keys(known)
        changes = staged(merge_changes(stored.join(met, self._same_key(stored, met), "left_semi"), b, self.keys, order, keep_first))
        unstage(known)
        # <= buckets rows: the buckets that change, and whether a stored row of theirs does
        buckets = {r[0]: r[1] for r in changes.groupBy(BUCKET).agg(F.bool_or("_had")).collect()}
        rewrite, cols = [k for k, had in buckets.items() if had], stored.columns
        added = changes.where(~F.col(BUCKET).isin(rewrite)).select(*cols)
        if rewrite:
            changed = self._renamed_keys(changes.where("_had"))
            kept = stored.where(F.col(BUCKET).isin(rewrite))
            kept = kept.join(changed, self._same_key(kept, changed), "left_anti")
            merged = staged(kept.unionByName(changes.where(F.col(BUCKET).isin(rewrite)).select(*cols)))
            self._write(merged, "overwrite")
            unstage(merged)
        if len(rewrite) < len(buckets):
            self._write(added, "append")
        unstage(changes)
        return len(buckets)

"""Stored layout of the domain tables and a ``Tables``-like view over it.

* ``epss_daily``   – partitioned by ``as_of`` (one folder per day), rows range-sorted by
                     ``cve_id`` inside a day: day selections are partition filters
                     (including ``as_of = (SELECT max(as_of) ...)``, resolved before the
                     scan), CVE look-ups use Parquet min/max statistics.
* ``cve_enriched`` – partitioned by ``source`` (NVD / CISA-KEV), sorted by ``cve_id``.
* feed items, analyses, fetch log – sorted by their time column so time-window filters
                     skip row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threatlake.operators.storage import read_if_exists
from threatlake.operators.tables import write_snapshot


def write_domain_tables(t, root: str) -> None:
    write_snapshot(t.epss_daily, f"{root}/epss_daily")
    (t.cve_enriched.repartitionByRange("source", "cve_id").sortWithinPartitions("source", "cve_id")
     .write.mode("overwrite").partitionBy("source").parquet(f"{root}/cve_enriched"))
    for name, ts in (("current", "inserted_at"), ("analysis", "analysed_at"), ("fetch_log", "ts")):
        df = getattr(t, name)
        df.repartitionByRange(ts).sortWithinPartitions(ts).write.mode("overwrite").parquet(f"{root}/{name}")
    t.item_versions.write.mode("overwrite").parquet(f"{root}/item_versions")
    t.raw_docs.write.mode("overwrite").parquet(f"{root}/raw_docs")


class StoredTables:
    """Domain tables read from ``root`` (same attribute names as ``bindings.Tables``)."""

    def __init__(self, spark: SparkSession, root: str, sf_dir: str | None = None):
        self.spark, self.root, self.sf_dir = spark, root, sf_dir

    def _r(self, name) -> DataFrame:
        df = self.spark.read.parquet(f"{self.root}/{name}")
        return df.drop("_bucket")  # hash-bucket folders of keyed tables are storage, not data

    def raw(self, name):
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def epss_daily(self):
        return self._r("epss_daily").select("as_of", "cve_id", "epss", "percentile")

    @property
    def cve_enriched(self):
        return self._r("cve_enriched").select("cve_id", "source", "json", "cvss_base", "epss", "modified")

    @property
    def current(self):
        return self._r("current")

    archive = current

    @property
    def analysis(self):
        return self._r("analysis")

    @property
    def fetch_log(self):
        return self._r("fetch_log")

    @property
    def raw_docs(self):
        return self._r("raw_docs")

    @property
    def item_versions(self):
        return self._r("item_versions")

    @property
    def epss_latest(self):
        """The stream-maintained newest score per CVE, or None when it is not stored."""
        t = read_if_exists(self.spark, f"{self.root}/epss_latest")
        return None if t is None else t.select("cve_id", "as_of", "epss", "percentile")


def scan_summary(df: DataFrame) -> list[str]:
    """Lines of the formatted physical plan that show scans, pruning, pushdown, joins and
    exchanges — for reviewing a plan without reading all of it."""
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    keep = ("Scan", "PartitionFilters", "PushedFilters", "ReadSchema", "Join", "Exchange", "TakeOrdered",
            "HashAggregate", "Window", "Subquery", "BroadcastExchange", "DynamicPruning")
    return [ln for ln in buf.getvalue().splitlines() if any(k in ln for k in keep)]

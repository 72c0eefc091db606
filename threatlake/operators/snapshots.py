"""Selections over the daily EPSS snapshot table and the CVE source table.

``epss_daily`` is stored partitioned by ``as_of``; every selection below is a predicate
on that column, so on files it becomes a partition filter (for the scalar ``max(as_of)``
subquery Spark resolves the subquery first and prunes partitions at run time).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ value from a datetime, ISO text or Column (a TIMESTAMP column such
    as ``current_timestamp()`` is converted under the UTC session)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def latest_date(epss: DataFrame) -> Column:
    """Scalar subquery ``(SELECT max(as_of) FROM epss_daily)``."""
    return epss.select(F.max("as_of")).scalar()


def latest_snapshot(epss: DataFrame) -> DataFrame:
    return epss.where(F.col("as_of") == latest_date(epss))


def snapshot(epss: DataFrame, day) -> DataFrame:
    return epss.where(F.col("as_of") == date_lit(day))


def nvd(cve: DataFrame) -> DataFrame:
    return cve.where(F.col("source") == "NVD")


def kev(cve: DataFrame) -> DataFrame:
    return cve.where(F.col("source") == "CISA-KEV")


def kev_keys(cve: DataFrame, name: str = "kev_cve_id") -> DataFrame:
    """Distinct KEV CVE ids: the key set of the catalog (about a thousand rows upstream;
    AQE turns the join into a broadcast at run time when it is under the threshold)."""
    return kev(cve).select(F.col("cve_id").alias(name)).distinct()


def feed_filter(col, patterns) -> Column:
    """``feed_url LIKE pattern`` for a multi-select; None / empty / ``%`` selects all."""
    if not patterns:
        return F.lit(True)
    if isinstance(patterns, str):
        patterns = [patterns]
    if "%" in patterns:
        return F.lit(True)
    c = F.col(col) if isinstance(col, str) else col
    cond = None
    for p in patterns:
        term = c.like(p)
        cond = term if cond is None else (cond | term)
    return cond


def mover_order(delta_col: str = "delta", direction: str = "up", key: str = "cve_id") -> list:
    """Sort keys of a movers list: ``up`` largest rise first (the source system's only
    order, so fallers never reach a top-k), ``down`` largest fall first, ``abs`` largest
    move either way first; the key breaks ties."""
    d = F.col(delta_col)
    if direction == "down":
        first = d.asc()
    elif direction == "abs":
        first = F.abs(d).desc()
    elif direction == "up":
        first = d.desc()
    else:
        raise ValueError(f"direction must be up, down or abs, not {direction!r}")
    return [first, F.col(key).asc()]

"""Connected components of a distributed edge list (large-star / small-star rounds)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from threatlake.session import checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and cut from its lineage in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v). Minima are pre-aggregated per node, then joined
    back to the edges, so no node's neighbours are ever collected."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = near.join(low, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns); root is the smallest
    node of the component. Nodes without an edge do not appear; no edges give no rows.
    Every round is checkpointed; the number of rounds is logarithmic in component size."""
    a, b = edges.columns
    e = saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    state = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        e = saved(_star(_star(e, True), False))
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written to a Parquet table of its own in the shared checkpoint folder and read
    back: like ``saved``, but compressed, for wide or large intermediates. Shuffle files of the
    write are removed when it ends, not when the driver happens to collect its garbage.
    ``by``: columns that the table is partitioned by."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, partitionBy=by or None, compression="zstd")
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def discard(*tables: DataFrame, part: str = "") -> None:
    """Deletes tables of ``written``, or their partition ``part``, that nothing reads any more:
    whatever was made from them has to be ``saved`` or ``written`` itself before."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{df.table_path}/{part}" if part else df.table_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)

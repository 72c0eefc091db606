"""Sharding by sampled splitters: near-equal bytes per shard, in DataFrame operations only.

Rows are ordered by a key (hash of the text, then a hash of the row's number). A sample whose
inclusion chance is proportional to a row's size plus the mean size gives quantile boundaries
that cut the keys into ``shards * ranges`` ranges, so a range holds about twice its share of
the bytes at most, and twice its share of the rows. A boundary falls between two texts
(equal texts stay in one range) unless one text spans several boundaries: such an overfull
key range is subdivided by the second half of the key. Exact bytes and rows per range then
give every range its offset; a running sum inside the range places each row, and the shard
is the offset in bytes divided by bytes per shard. Equal texts stay in one shard unless
together they exceed ``1 / (200 * shards)`` of all bytes; a group of fewer bytes whose many
rows were subdivided (null or tiny texts) is placed as one by its start.

Only numbers are shuffled, never a text. Driver and literals see the boundaries and the
totals of ``shards * ranges`` ranges, whatever the input. A range is the unit of parallelism:
raise ``ranges`` with the cluster.

Null text: size 1 (no bytes plus one), crc32 of no bytes. Null and repeated ids and repeated
rows each get a place of their own. An empty table gives no rows. Row numbers come from a
checkpointed table, so a lost executor cannot change them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threatlake.llm.components import saved

SHARDS = 16
RANGES = 16
SAMPLES_PER_RANGE = 64


def _key(h, t) -> Column:
    return F.struct(h.alias("h"), t.alias("t"))


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, h, t): a row's weight and sort key; t tells equal texts apart."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                       F.xxhash64(F.col("text")).alias("h"), F.monotonically_increasing_id().alias("n"))
    return saved(rows.select("doc_id", "size", "text_crc32", "h", F.xxhash64("n").alias("t")))


def boundaries(rows: DataFrame, total: int, n: int, count: int) -> list:
    """At most ``count - 1`` sorted (h, t) splitters from a weighted sample of about
    ``count * SAMPLES_PER_RANGE`` keys of ``n`` rows of ``total`` bytes; the lower half of a boundary is the least value
    unless its text spans several boundaries."""
    draws = count * SAMPLES_PER_RANGE
    # A row is drawn floor(w) times and once more with chance frac(w), w = draws * (size + mean size) / (2 * total).
    w = (F.col("size") + F.lit(total / max(n, 1))) * F.lit(draws / max(2 * total, 1))
    chance = F.pmod(F.xxhash64("t", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (rows.select("h", "t", (F.floor(w) + (chance < w - F.floor(w)).cast("int")).cast("int").alias("times"))
              .where("times > 0").select("h", "t", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("one")))
    keys = sample.agg(F.sort_array(F.collect_list(_key(F.col("h"), F.col("t")))).alias("k"))
    step = F.size("k") / F.lit(float(count))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(count - 1)),
                       lambda i: F.element_at("k", (F.floor(i * step) + 1).cast("int")))
    picked = keys.where(F.size("k") >= count).select(cuts.alias("c")).first() if count > 1 else None
    found = [(b.h, b.t) for b in picked.c] if picked else []
    hs = [h for h, _ in found]
    return sorted({(h, t if hs.count(h) > 1 and i and hs[i - 1] == h else -(1 << 63)) for i, (h, t) in enumerate(found)})


def _literal(bounds: list) -> Column:
    one = lambda b: _key(F.lit(b[0]).cast("long"), F.lit(b[1]).cast("long"))
    return F.array(*[one(b) for b in bounds]) if bounds else F.array().cast("array<struct<h:bigint,t:bigint>>")


def _range_of(bounds: list) -> Column:
    """Boundaries at or below the row's key, found in two steps of about sqrt(n) comparisons."""
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    key = _key(F.col("h"), F.col("t"))
    below = lambda arr: F.size(F.filter(arr, lambda b: b <= key))
    if len(groups) < 2:
        return below(_literal(bounds))
    coarse = below(_literal([g[0] for g in groups]))  # groups that start at or below the key
    fine = F.element_at(F.array(*[_literal(g) for g in groups]), F.greatest(coarse, F.lit(1)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * width + below(fine))


def shard(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    rows = sizes(docs)
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    bounds = boundaries(rows, total, n, shards * ranges)
    ranged = rows.withColumn("r", _range_of(bounds).cast("int"))
    offsets, at, before = {}, 0, 0
    # one row per range: shards * ranges rows at most
    for r in sorted(ranged.groupBy("r").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()):
        offsets[r.r], at, before = (at, before), at + r.b, before + r.n
    lookup = lambda i: F.element_at(F.array(*[F.lit(offsets.get(r, (0, 0))[i]).cast("long")
                                              for r in range(max(offsets, default=0) + 1)]), F.col("r") + 1)
    run = Window.partitionBy("r").orderBy("h", "t")
    same = Window.partitionBy("r", "h")
    placed = (ranged.withColumn("end", F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("i", F.row_number().over(run))
              .withColumn("group_bytes", F.sum("size").over(same))
              .withColumn("group_start", F.min(F.col("end") - F.col("size")).over(same)))
    small = total // (200 * shards)
    start = lookup(0) + F.when(F.col("group_bytes") <= small, F.col("group_start")).otherwise(F.col("end") - F.col("size"))
    # A subdivided text starts the range after its first boundary; one row per such text, as many as boundaries at most.
    opens = {h: i + 1 for i, (h, t) in reversed(list(enumerate(bounds)))}
    cut = sorted({h for h, t in bounds if t != -(1 << 63)})
    for r in ranged.where(F.col("h").isin(cut)).groupBy("h").agg(F.sum("size").alias("b")).collect() if cut else ():
        if r.b <= small:
            at = next(b for i, (b, _) in sorted(offsets.items()) if i >= opens[r.h])  # its first range that has rows
            start = F.when(F.col("h") == r.h, F.lit(at)).otherwise(start)
    pos = start.cast("decimal(38,0)") * shards / F.lit(max(total, 1))
    placed = saved(placed.select("doc_id", "size", "text_crc32", (lookup(1) + F.col("i") - 1).alias("place"),
                                 F.least(F.floor(pos), F.lit(shards - 1)).cast("int").alias("shard")))
    first = {r.shard: r.p for r in placed.groupBy("shard").agg(F.min("place").alias("p")).collect()}
    firsts = F.array(*[F.lit(first.get(s, 0)).cast("long") for s in range(shards)])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("place") - F.element_at(firsts, F.col("shard") + 1)).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))

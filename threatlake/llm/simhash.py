"""SimHash near-duplicates through pivot distance tables.

Fingerprint: 64 bits, bit i set when it is set in more than half the XXH64 hashes (seed 42)
of the text's word shingles. Two fingerprints link when they differ in at most ``max_bits``.

Pivot table: for every distinct fingerprint the Hamming distances to fixed reference
fingerprints are computed once. By the triangle inequality linked fingerprints differ by at
most ``max_bits`` in every coordinate, so a pair with a larger coordinate difference is
discarded and only survivors are compared bit by bit. To find pairs without looking at all
of them, most references differ from the base reference inside one block of bits only:
distance(x, reference) - distance(x, base) then depends on that block alone, and with more
blocks than ``max_bits`` a linked pair agrees in all such differences of some choice of
``blocks - max_bits`` blocks. Those difference vectors are the (equi-)join keys.

Rows and scale: repeated texts collapse to one fingerprint before any pair is formed, and a
fingerprint has at most 1 + 64 + 2016 partners within two bits, so links grow with the number
of distinct fingerprints however large a group of copies is. For more than about 10^9
distinct fingerprints raise ``blocks`` to 4 (keys of 32 bits, six tables instead of three).

Null and empty texts have fingerprint 0 and link like any other. Null ids take part; a
component of null ids only has a null component_id. Repeated rows and ids are all kept.
"""

from __future__ import annotations

import random
from itertools import accumulate, combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from threatlake.llm.components import components, saved
from threatlake.llm.text import LOWER, fresh, of_text

SHINGLE = 3
MAX_BITS = 2
_PER_BLOCK, _GLOBAL = 10, 8
_CHUNK = 1 << 14


def shingle_hashes(raw: bytes | None, size: int = SHINGLE) -> np.ndarray:
    words = (raw or b"").translate(LOWER).split()
    text = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(text, 42)] if words else [], np.uint64)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[s:e], 42) for s, e in zip(starts, ends[size - 1:])), np.uint64,
                       len(words) - size + 1)


def fingerprint(raw: bytes | None, size: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    h = shingle_hashes(raw, size)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), _CHUNK):
        part = h[at:at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprint_of(text: Column | str = "text", size: int = SHINGLE) -> Column:
    return of_text(lambda raw: (fingerprint(raw, size),), "fp long", text)["fp"]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(x: Column, pivot: int) -> Column:
    return F.bit_count(x.bitwiseXOR(F.lit(_signed(pivot)).cast("long")))


def pivot_table(fps: DataFrame, blocks: int, max_bits: int) -> DataFrame:
    """(fp, p0..p7, keys): distances to the whole-width references, and one key per choice of
    ``blocks - max_bits`` blocks made of distance differences to that block's references."""
    rng = random.Random(64)
    edges = [64 * b // blocks for b in range(blocks + 1)]
    x = F.col("fp")
    base = rng.getrandbits(64)
    words = []  # per block: its distance differences, six bits each
    for lo, hi in zip(edges, edges[1:]):
        word = F.lit(0).cast("long")
        for i in range(_PER_BLOCK):
            pivot = base ^ (rng.getrandbits(hi - lo) << lo)
            diff = _distance(x, pivot) - _distance(x, base) + 32
            word = word.bitwiseOR(F.shiftleft(diff.cast("long"), 6 * i))
        words.append(word)
    keys = [F.xxhash64(F.lit(i), *[words[b] for b in chosen])
            for i, chosen in enumerate(combinations(range(blocks), blocks - max_bits))]
    return fps.select("fp", *[_distance(x, rng.getrandbits(64)).cast("byte").alias(f"p{i}") for i in range(_GLOBAL)],
                      F.array(*keys).alias("keys"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int = 3) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints that differ in at most ``max_bits`` bits."""
    if blocks <= max_bits:
        raise ValueError("blocks must exceed max_bits")
    t = pivot_table(fps.select("fp").distinct(), blocks, max_bits)
    names = [f"p{i}" for i in range(_GLOBAL)]
    keyed = t.select("fp", *names, F.explode("keys").alias("key"))
    left = keyed.select(F.col("fp").alias("a"), "key", *[F.col(n).alias(f"l{n}") for n in names])
    right = keyed.select(F.col("fp").alias("b"), "key", *[F.col(n).alias(f"r{n}") for n in names])
    apart = F.greatest(*[F.abs(F.col(f"l{n}") - F.col(f"r{n}")) for n in names])
    return (left.join(right, "key").where((F.col("a") < F.col("b")) & (apart <= max_bits)
                                          & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
            .select("a", "b").distinct())


def classes(rows: DataFrame, max_bits: int = MAX_BITS, blocks: int = 3) -> DataFrame:
    """(fp, root) for every distinct fp of ``rows``: root names its component."""
    fps = rows.select("fp").distinct()
    found = components(links(fps, max_bits, blocks)).select(F.col("node").alias("fp"), "root")
    return fps.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    rows = saved(docs.select("doc_id", fingerprint_of("text", size).alias("fp")))
    found = saved(classes(rows, max_bits, blocks))
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))  # one row per fingerprint before any join
    ids = (found.join(first, "fp").groupBy("root").agg(F.min("first").alias("component_id")))
    return (rows.join(found.join(ids, "root").select("fp", "component_id"), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_per_component(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns: of every component the row with the smallest id
    (null ids last; ties: smallest row hash; of rows equal in every column, one)."""
    row, fp = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), fresh(docs, "_row")
    rows = saved(docs.select("doc_id", row.alias("row"), fingerprint_of("text", size).alias("fp")))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))
    best = (rows.groupBy("fp").agg(F.min(order).alias("best"))
            .join(classes(rows, max_bits, blocks), "fp").groupBy("root").agg(F.min("best").alias("best"))
            .select("best.doc_id", "best.row"))
    times = rows.groupBy("doc_id", "row").agg(F.count("*").alias("times"))
    best = saved(best.join(times, (best["row"] == times["row"]) & best["doc_id"].eqNullSafe(times["doc_id"]))
                 .select(best["doc_id"].alias("_id"), best["row"].alias("_row"), "times"))

    def matching(part: DataFrame) -> DataFrame:
        named = docs.withColumn(fp, row)
        return (named.join(part, (named[fp] == part["_row"]) & named["doc_id"].eqNullSafe(part["_id"]), "left_semi")
                .drop(fp))

    repeated = best.where("times > 1")
    kept = matching(best.where("times = 1"))
    return kept if repeated.isEmpty() else kept.union(matching(repeated).dropDuplicates())

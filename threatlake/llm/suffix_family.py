"""Repeated passages by a logarithmic family of sparse suffix indexes.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts anywhere else.

Suffixes: of every ``LENGTH``-byte window the leftmost least gram of ``GRAM`` bytes (by a mixed hash) is
its anchor; only suffixes at anchors are indexed, little over 1 % of all. Equal windows have their
anchor at the same place, so every match shows as two indexed suffixes with one gram. An index
entry is the gram's hash ``g``, the text ``u``, the anchor ``a``, the windows ``[a - lo, a + hi]``
it stands for, and a hash ``c`` of all bytes of these windows; an index is kept sorted by g.

Family: a batch of texts gets an index, is merge-scanned (joined on g) against itself and
every level, and becomes a level; levels of equal size merge, so n batches make at most
log2 n + 1 levels, and each entry is rewritten as often. Entries whose g occurs twice or more are
hits, those of older levels included.

Resolving hits, once: entries of one g with equal (lo, hi, c) are a class and have all their
windows twice. Where a g has several classes, one entry of each is compared with the others by
splitting spans of windows, which finds the ends of passages. A span has two
hashes, of all bytes of its windows and of the bytes common to them. All bytes seen twice: every
window of the span is found, one entry goes on as a mirror for the others. Common bytes seen
once: no window of the span can be found. Only spans between the two are split. Hashes are
counted per (g, span), pre-aggregated before the shuffle, so no entries of a gram meet in one
task, and an end of a passage costs some rows, not one for each window. Texts travel
compressed, twice: once for the bytes of the compared entries, once for the result.

Null text: empty. Rows equal in id and text are documents of their own, each a copy of the
other. Texts shorter than ``LENGTH`` lose nothing. Very long texts are cut into overlapping
pieces; windows at a cut are compared one by one. An empty table gives no rows. Text numbers
are 64-bit hashes of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from threatlake.llm.components import discard, saved, written

LENGTH = 200
GRAM = 48  # bytes of an anchor: short ones recur by chance, long ones need more anchors
BATCHES = 2
SPLIT = 8  # parts of a span of windows that is neither found nor ruled out
_PIECE = 1 << 20
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))
ENTRY = "g long, u long, a long, lo int, hi int, c long"


def _anchors(raw: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(gram hash, anchor, first window, last window) along a piece of text."""
    n = len(raw) - GRAM + 1
    v = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    h = np.zeros(n, np.uint64)
    for i in range(0, GRAM, 8):
        h = (h ^ (v[i:i + n] * _ODD[1])) * _ODD[0]
        h ^= h >> np.uint64(29)
    h *= _ODD[2]
    h ^= h >> np.uint64(32)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    width, want = 1, length - GRAM + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[:len(least) - (want - width)], least[want - width:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], cuts])
    a = at[first]
    return zip(h[a].view(np.int64).tolist(), a.tolist(), first.tolist(), np.append(cuts - 1, len(at) - 1).tolist())


def text_entries(raw: bytes | None, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(g, a, lo, hi, c) of one text."""
    raw, out = raw or b"", []
    for base in range(0, len(raw) - length + 1, _PIECE):
        piece = raw[base:base + _PIECE + length - 1]
        out += [(g, base + a, a - i, j - a, xxhash.xxh3_64_intdigest(piece[i:j + length]) - (1 << 63))
                for g, a, i, j in _anchors(piece, length)]
    return out


def text_number() -> Column:
    return F.xxhash64("doc_id", "text")


def entries(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The index entries of ``docs``."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list = []
            for i in range(b.num_rows):
                u = b.column(0)[i].as_py()
                rows += [(g, u, a, lo, hi, c) for g, a, lo, hi, c in text_entries(b.column(1)[i].as_py(), length)]
                if len(rows) > 50_000 or i == b.num_rows - 1 and rows:
                    m = np.array(rows, np.int64)
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(m[:, k]).cast(t) for k, t in enumerate(kinds)],
                                                     names=["g", "u", "a", "lo", "hi", "c"])
                    rows = []
    return docs.select(text_number().alias("u"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw")).mapInArrow(make, ENTRY)


class SuffixFamily:
    """Levels of sorted index entries in the shared checkpoint folder. ``levels`` holds
    (batches in it, table), larger first; a level is a table of its own, so a job that fails
    half-way leaves the earlier levels as they are."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self._tables: list[DataFrame] = []

    def add(self, new: DataFrame, keep: bool = True) -> DataFrame:
        """Index a batch of entries; returns the hits it makes: its own entries and those of
        the levels whose gram occurs in it and elsewhere. ``keep=False`` for a last batch."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (m, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((n + m, self._stored(a.union(b))))
        new = self._stored(new)
        grams = self._kept(new.groupBy("g").agg(F.count("*").alias("n")))
        old = [self._kept(level.join(grams, "g", "left_semi")) for _, level in self.levels]
        again = grams.where("n > 1").select("g")
        for o in old:
            again = again.union(o.select("g").distinct())
        hits = new.join(again.distinct(), "g", "left_semi")
        for o in old:
            hits = hits.union(o.select(*hits.columns))
        if keep:
            self.levels.append((1, new))
        return hits

    def discard(self) -> None:
        """Deletes the family's tables; the hits of its batches must have been saved before."""
        discard(*self._tables)
        self.levels, self._tables = [], []

    def _stored(self, df: DataFrame) -> DataFrame:
        return self._kept(df.sortWithinPartitions("g"))

    def _kept(self, df: DataFrame) -> DataFrame:
        self._tables.append(written(df))
        return self._tables[-1]


def _compress(docs: DataFrame, extra: list[str]) -> DataFrame:
    """(u, z, extra...): texts as zstd frames."""
    fields = docs.select(text_number().alias("u"), *extra, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("z"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(1)
        for b in batches:
            z = pa.array([c.compress(v.as_py()) for v in b.column(b.num_columns - 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], z], schema=b.schema)
    return fields.mapInArrow(pack, fields.schema)


def _with_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(g, u, a, lo, hi, once, raw): the entries of ``wanted`` with the bytes of their windows."""
    per = wanted.groupBy("u").agg(F.collect_list(F.struct("g", "a", "lo", "hi", "once")).alias("w"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        names = ["g", "u", "a", "lo", "hi", "once", "raw"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                u, text = b.column(0)[i].as_py(), d.decompress(b.column(1)[i].as_py())
                for x in b.column(2)[i].as_py():
                    rows.append((x["g"], u, x["a"], x["lo"], x["hi"], x["once"], text[x["a"] - x["lo"]:x["a"] + x["hi"] + length]))
                if len(rows) > 20_000 or i == b.num_rows - 1 and rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                    rows = []
    return _compress(docs, []).join(per, "u").mapInArrow(cut, "g long, u long, a long, lo int, hi int, once boolean, raw binary")


def _settle(parts: DataFrame, length: int) -> DataFrame:
    """(u, first, last): ranges of windows of ``once`` entries of ``parts`` that another entry of
    the same gram has at the same distance from its anchor. A span x stands for the windows x to
    x + step - 1, counted from the farthest start whose window still holds the gram."""
    reach, step = length - GRAM, 1
    while step * SPLIT <= reach + 1:
        step *= SPLIT
    low, high = F.lit(reach) - F.col("lo"), F.lit(reach) + F.col("hi")  # the entry's own windows

    def spans(first: Column, last: Column, step: int) -> Column:
        """Starts of the spans of ``step`` windows in [first, last] with a window of the entry."""
        return F.explode(F.filter(F.sequence(first, last, F.lit(step)), lambda x: (x <= high) & (x + (step - 1) >= low)))

    live, found = parts.select("*", spans(F.lit(0), F.lit(reach), step).alias("x")), None
    while True:
        x, last = F.col("x"), F.least(F.col("x") + (step - 1), F.lit(reach))
        at = lambda k: k - low + 1  # noqa: E731  position in raw at which window k starts
        common = F.xxhash64(F.substring("raw", at(last), F.lit(length) - (last - x)))
        union = F.xxhash64(F.substring("raw", at(x), F.lit(length) + (last - x)))
        nodes = written(live.withColumn("e", F.xxhash64("u", "a", "lo")).select(
            "g", "u", "a", "lo", "hi", "once", "x", "e", common.alias("common"),
            F.when((x >= low) & (last <= high), union).otherwise(F.col("e")).alias("whole")))
        same = nodes.groupBy("g", "x", "common", "whole").agg(
            F.count("*").alias("n"), F.bool_or("once").alias("open"), F.min("e").alias("mirror"))
        near = same.groupBy("g", "x", "common").agg(
            F.count("*").alias("kinds"), F.bool_or(F.col("open") & (F.col("n") == 1)).alias("wanting"))
        split = (F.col("kinds") > 1) & F.col("wanting")
        verdict = (same.join(near, ["g", "x", "common"]).withColumn("split", split)
                   .where(F.col("split") | F.col("open") & (F.col("n") > 1)).drop("kinds", "wanting", "open"))
        judged = saved(nodes.join(verdict, ["g", "x", "common", "whole"])
                       .where(F.col("once") & (F.col("n") > 1) | F.col("split") & (F.col("e") == F.col("mirror")))
                       .select("u", "a", "lo", "hi", "once", "x", "n", (F.col("split") & (F.col("e") == F.col("mirror"))).alias("on")))
        discard(nodes)
        runs = judged.where("once and n > 1").select("u", (F.col("a") + x - reach).alias("first"), (F.col("a") + last - reach).alias("last"))
        found = runs if found is None else found.union(runs)
        if step == 1:
            return found
        live = judged.where("on").select("u", "a", "lo", (F.col("once") & (F.col("n") == 1)).alias("once"), spans(x, last, step // SPLIT).alias("x"))
        live = parts.drop("once").join(live, ["u", "a", "lo"])
        step //= SPLIT


def resolve(docs: DataFrame, hits: DataFrame, length: int = LENGTH) -> DataFrame:
    """(u, first, last): ranges of windows that start elsewhere, too."""
    classes = saved(hits.groupBy("g", "lo", "hi", "c").agg(F.count("*").alias("n"), F.min(F.struct("u", "a")).alias("one")))
    several = classes.groupBy("g").agg(F.count("*").alias("k"), F.count_if(F.col("n") == 1).alias("ones")).where("k > 1 and ones > 0")
    wanted = (classes.join(several.select("g"), "g")
              .select("g", "one.u", "one.a", "lo", "hi", (F.col("n") == 1).alias("once")))
    whole = (hits.join(classes.where("n > 1").select("g", "lo", "hi", "c"), ["g", "lo", "hi", "c"])
             .select("u", (F.col("a") - F.col("lo")).alias("first"), (F.col("a") + F.col("hi")).alias("last")))
    parts = written(_with_bytes(docs, wanted, length))
    runs = _settle(parts, length)
    discard(parts)
    return whole.union(runs)


def cut_ranges(raw: bytes, windows: list[tuple[int, int]], length: int = LENGTH) -> tuple[bytes, int, int]:
    """(kept bytes, removed bytes, removed runs) for ranges [first, last] of repeated windows."""
    kept, at, runs = [], 0, 0
    for first, last in sorted(windows):
        end = last + length
        if runs and first <= at:
            at = max(at, end)
            continue
        kept.append(raw[at:first])
        at, runs = end, runs + 1
    kept.append(raw[at:])
    out = b"".join(kept)
    return out, len(raw) - len(out), runs


def repeated_windows(docs: DataFrame, batches: int = BATCHES, length: int = LENGTH) -> DataFrame:
    """(u, first, last) after adding ``docs`` to an empty family in ``batches`` batches."""
    family, hits = SuffixFamily(), None
    for i in range(batches):
        part = docs.where(F.pmod(text_number(), F.lit(batches)) == i) if batches > 1 else docs
        found = family.add(entries(part, length), keep=i < batches - 1)
        hits = found if hits is None else hits.union(found)
    # Several batches may hit one old entry, and rows equal in id and text have equal entries:
    # both count once here, and such rows are copies of each other as a whole.
    twins = (docs.select(text_number().alias("u"), F.octet_length("text").alias("n")).groupBy("u")
             .agg(F.count("*").alias("times"), F.max("n").alias("n")).where((F.col("times") > 1) & (F.col("n") >= length)))
    whole = twins.select("u", F.lit(0).cast("long").alias("first"), (F.col("n") - length).cast("long").alias("last"))
    hits = saved(hits.distinct())
    family.discard()
    return resolve(docs, hits, length).union(whole)


_RESULT = "n_bytes long, n_removed long, n_spans long, kept binary"


def kept_texts(docs: DataFrame, batches: int = BATCHES, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row of ``docs``: the remaining
    bytes, or with ``digest`` their SHA-256 (a cut may fall inside a character)."""
    per = (repeated_windows(docs, batches, length).groupBy("u")
           .agg(F.collect_list(F.struct("first", "last")).alias("w")))
    rows = _compress(docs, ["doc_id"]).join(per, "u", "left").select("doc_id", "z", "w")
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, {_RESULT}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for z, w in zip(b.column(1), b.column(2)):
                raw = d.decompress(z.as_py())
                kept, removed, runs = cut_ranges(raw, [(x["first"], x["last"]) for x in w.as_py() or []], length)
                out.append((len(raw), removed, runs, hashlib.sha256(kept).digest() if digest else kept))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return rows.mapInArrow(cut, schema)


def repeated_passages(docs: DataFrame, batches: int = BATCHES, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``."""
    return (kept_texts(docs, batches, length, digest=True)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256")))

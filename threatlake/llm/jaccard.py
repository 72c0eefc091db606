"""Exact Jaccard join of shingle sets, by skipping with set relations.

A text's set holds its different word shingles (64-bit hashes); two sets link when their Jaccard
similarity is at least ``num / den``. ``jaccard_components`` names every document's component.

Index. All tokens stand in one order: first those of a fixed part of the hash range (``_RANKED``
of 256), seldom ones first, then all others by hash. Any order is exact, this one keeps common
shingles out of the lists: of linked sets with a >= b tokens one of the first a - need + 1 tokens
of the larger is among the first of the smaller (prefix filter), so only these are listed, and
of them only tokens that several sets hold. The order looks at a set's smallest hashes only
(``keys``), so the rest of it is never shuffled.

Skipping of answers: one set of a list, its hub, is compared with the others first (the one with
the fewest rarer tokens: of near copies the original), and its answers are used for theirs. Sets
linked to one hub are connected, whatever their own overlap. In lists of up to ``FEW`` sets the
others meet pair by pair, and the overlaps with the hub x bound theirs, |xy| + |xz| - |x| <= |yz| <=
min(|xy|, |xz|) + min(|y| - |xy|, |z| - |xz|), which settles many without reading a text. In longer
lists a set's answers follow from its difference to the hub alone: y and z differ in what x ^ y
and x ^ z differ in (^: symmetric difference). Of two sets that the hub does not connect one
differs from it by more than links allow, so they only link if their differences share elements:
the differences of a hub's list are joined by an index of their own, seldom elements first.

Skipping in the index: the entries of a difference's element are blocks by size class and
position. What two differences can still share from their positions on bounds how alike their
sets are, so whole pairs of blocks are skipped by their ends, and pairs within the blocks left by
their own positions and by bitmaps of the differences, before any row is made of them. Elements
that all sets of a list share (the hub's own traits) end in blocks that are skipped whole.

Copies collapse to one set before any pair is formed; a group of near copies costs one comparison
with its hub for each of its sets, and its rare differences. No list is gathered: hubs come from
aggregates, blocks are cut to about ``BLOCK`` entries, and links join a component without being
expanded to all pairs.

Texts without words (null, empty) have no shingle, link with nothing and are their own component.
Null ids take part; a component of null ids only has a null component_id. Repeated rows and ids
are all kept. An empty table gives no rows. Two sets are taken as equal when the 128-bit hashes
of their tokens are. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from threatlake.llm.components import components, written
from threatlake.llm.text import LOWER, of_text

SHINGLE = 3
NUM, DEN = 9, 10
FEW = 8  # sets of a list that meet pair by pair
BLOCK = 256  # entries of a block, about
_RANKED = 41  # of 256 parts of the hash range, whose tokens are ordered by how many sets hold them
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


class _Words(dict):
    """Hashes of words, kept between texts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 42)
        return h


_WORDS = _Words()


def tokens(raw: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted different shingle hashes of a text."""
    words = (raw or b"").translate(LOWER).split()
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(size, len(w))
    if not n:
        return w
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ w[i:len(w) - n + 1 + i]) * _MIX[0]
        h ^= h >> np.uint64(29)
        h *= _MIX[1]
        h ^= h >> np.uint64(32)
    return np.unique(h * _MIX[2])


def needed(a: int, num: int = NUM, den: int = DEN) -> int:
    """The least overlap of a set of ``a`` tokens with any it links with."""
    return -(-num * a // den)


def _set_of(size: int, num: int, den: int):
    limit = np.uint64(_RANKED << 56)

    def run(raw):
        h = tokens(raw, size)
        ranked = int(np.searchsorted(h, limit))
        most = max(ranked, len(h) - needed(len(h), num, den) + 1) if len(h) else 0
        return len(h), ranked, xxhash.xxh3_128_digest(h.tobytes()), h[:most].view(np.int64)
    return run


def _may_link(a: str, i: str, b: str, j: str, num: int, den: int) -> Column:
    """Whether sets of a and b tokens can link when their first common token is at i and j."""
    a, i, b, j = map(F.col, (a, i, b, j))
    least = (a + b) * num  # of (num + den) parts of the overlap
    return ((F.least(a, b) * den >= F.greatest(a, b) * num) & ((a - i) * (num + den) >= least) & ((b - j) * (num + den) >= least))


def _entries(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(k, u, n, pos): a set's first tokens that other sets hold too, with their positions."""
    listed = rows.join(sets.select("u"), "u", "left_semi").where("n > 0").select("u", "ranked", F.posexplode("keys").alias("i", "k"))
    listed = listed.select("k", "u", F.when(F.col("i") >= F.col("ranked"), F.col("i")).alias("i"))
    held = listed.groupBy("k").agg(F.count("*").alias("df")).where("df > 1")
    # Ranked tokens of one set only come first, in front of all shared ones.
    shared = (listed.join(held, "k").groupBy("u")
              .agg(F.sort_array(F.collect_list(F.when(F.col("i").isNull(), F.struct("df", "k")))).alias("ranks"),
                   F.collect_list(F.when(F.col("i").isNotNull(), F.struct(F.col("i").cast("long").alias("pos"), "k"))).alias("rest")))
    own = rows.select(F.col("u").alias("v"), "n", "ranked")
    shared = shared.join(own, F.col("u") == F.col("v"))
    first = F.col("ranked") - F.size("ranks")
    placed = F.concat(F.transform("ranks", lambda x, i: F.struct((first + i).cast("long").alias("pos"), x["k"].alias("k"))), F.col("rest"))
    return (shared.select("u", "n", F.explode(placed).alias("x")).select("x.k", "u", "n", "x.pos")
            .where((F.col("n") - F.col("pos")) * den >= F.col("n") * num))


def _texts(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, text): the text of each of ``sets`` (u, id, t), once."""
    t = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_t"), "text")
    return (sets.join(t, (F.col("t") == F.col("_t")) & F.col("id").eqNullSafe(F.col("_id")))
            .groupBy("u").agg(F.first("text").alias("text")))


def _beside(fn, ddl: str) -> Column:
    """``fn`` of the token sets of texts x and y; rows come sorted by x, whose set is kept."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    kind = to_arrow_type(_parse_datatype_string(ddl))

    @F.arrow_udf(ddl)
    def run(x: pa.Array, y: pa.Array, size: pa.Array) -> pa.Array:
        out, last, own = [], None, None
        for a, b, n in zip(x, y, size):
            a = a.as_py()
            if a != last:
                last, own = a, tokens(a, n.as_py())
            out.append(fn(own, tokens(b.as_py(), n.as_py())))
        return pa.array(out, kind)
    return run(F.col("x").cast("binary"), F.col("y").cast("binary"), F.col("size"))


def _common(x: np.ndarray, y: np.ndarray) -> int:
    return int(np.count_nonzero(x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y))


def _apart(x: np.ndarray, y: np.ndarray) -> dict:
    """The elements in one of two sets only, and a bitmap of them (a bit is set by any element)."""
    d = np.setxor1d(x, y, assume_unique=True)
    bits = np.zeros(256, np.uint8)
    bits[d >> np.uint64(56)] = 1
    return {"d": d.view(np.int64), "bits": np.packbits(bits).view(np.int64)}


def _read(pairs: DataFrame, docs: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """``pairs`` (a, b, ...) of sets with their texts x and y."""
    used = pairs.select(F.col("a").alias("u")).union(pairs.select(F.col("b").alias("u"))).distinct()
    texts = written(_texts(docs, sets.join(used, "u", "left_semi")))
    x, y = (texts.select(F.col("u").alias(c), F.col("text").alias(k)) for c, k in (("a", "x"), ("b", "y")))
    return pairs.join(y, "b").join(x, "a").withColumn("size", F.lit(size))


def _compared(pairs: DataFrame, docs: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """``pairs`` (a, b, ...) with ``common``, the overlap of the two sets."""
    return written(_read(pairs, docs, sets, size).withColumn("common", _beside(_common, "long")).drop("x", "y", "size"))


def _in_order(a: Column, an: Column, b: Column, bn: Column, *more: Column) -> list[Column]:
    swap = a > b
    return [F.when(swap, b).otherwise(a).alias("a"), F.when(swap, bn).otherwise(an).alias("an"),
            F.when(swap, a).otherwise(b).alias("b"), F.when(swap, an).otherwise(bn).alias("bn"), *more]


def _few(entries: DataFrame, tested: DataFrame, num: int, den: int) -> DataFrame:
    """(a, an, b, bn, lo, hi): pairs of short lists that their hub's answers do not connect and that
    may link, with the bounds of their overlap that follow from both overlaps with the hub (null:
    none). ``entries``: (k, u, n, pos, root, hub, hn)."""
    known = tested.select(F.col("a").alias("hub"), F.col("b").alias("u"), "common")
    rows = entries.where("u <> hub").join(known, ["hub", "u"], "left")
    other = rows.withColumnsRenamed({c: f"{c}_" for c in rows.columns if c != "k"})
    met = rows.join(other, "k").where((F.col("u") < F.col("u_")) & (F.col("root") != F.col("root_")) & _may_link("n", "pos", "n_", "pos_", num, den))
    hi = F.when(F.col("common").isNotNull() & F.col("common_").isNotNull(),
                F.least("common", "common_") + F.least(F.col("n") - F.col("common"), F.col("n_") - F.col("common_")))
    return met.select(*_in_order(F.col("u"), F.col("n"), F.col("u_"), F.col("n_"), (F.col("common") + F.col("common_") - F.col("hn")).alias("lo"), hi.alias("hi")))


def _by_difference(differences: DataFrame, num: int, den: int) -> DataFrame:
    """(a, an, b, bn): pairs of sets around one hub that may link by what their differences to it
    share. ``differences``: (hub, u, n, root, d, bits), d the elements in which the set and the hub
    differ, bits their bitmap."""
    held = differences.select("hub", "u", F.explode("d").alias("e"))
    often = held.groupBy("hub", "e").agg(F.count("*").alias("df")).where("df > 1")
    ranks = (held.join(often, ["hub", "e"]).groupBy("hub", "u")
             .agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("ranks")))
    own = differences.select("hub", "u", "n", "root", F.size("d").cast("long").alias("size"), "bits")
    first = F.col("size") - F.size("ranks")
    rows = (ranks.join(own, ["hub", "u"])
            .select("hub", "u", "n", "root", "size", "bits", F.explode(F.transform("ranks", lambda x, i: F.struct(
                (first + i).alias("pos"), x["e"].alias("e"), x["df"].alias("df")))).alias("x"))
            .select("hub", "u", "n", "root", "size", "bits", "x.*"))
    # A set of n tokens differs from one it links with in at most n * (den - num) / num tokens.
    rows = rows.where(F.col("pos") * num <= F.col("n") * (den - num))
    # Two sets differ in size + size - 2 * shared, of which links allow (n + n) * (den - num) / (num + den).
    part = F.pmod(F.xxhash64("u"), F.floor(F.col("df") / BLOCK) + 1)
    rest = 2 * (F.col("size") - F.col("pos"))
    blocks = (rows.groupBy("hub", "e", F.floor(F.log2("size") * 16).alias("class"), F.floor(F.log2(F.col("pos") + 1) * 16).alias("place"), part.alias("part"))
              .agg(F.min("size").alias("size0"), F.max(rest).alias("rest1"), F.max("n").alias("n1"), F.min("root").alias("r0"), F.max("root").alias("r1"),
                   F.collect_list(F.struct("u", "n", "root", "size", rest.alias("rest"), "bits")).alias("held"))
              .withColumn("block", F.struct("class", "place", "part")))
    one, two = (blocks.select("hub", "e", *[F.col(c).alias(f"{c}_{s}") for c in blocks.columns if c not in ("hub", "e")]) for s in "xy")

    def within(size_x: Column, size_y: Column, n_x: Column, n_y: Column, twice: Column) -> Column:
        return (size_x + size_y - twice) * (num + den) <= (n_x + n_y) * (den - num)

    def lacks(x: Column, y: Column) -> Column:
        """Elements of x that its bitmap shows not to be in y, at least."""
        return sum((F.bit_count(x["bits"][i].bitwiseAND(F.bitwise_not(y["bits"][i]))) for i in range(4)), F.lit(0))

    def fits(x: Column, y: Column) -> Column:
        shared = F.least(x["rest"], y["rest"], 2 * (x["size"] - lacks(x, y)), 2 * (y["size"] - lacks(y, x)))
        return ((x["root"] != y["root"]) & (~F.col("same") | (x["u"] < y["u"])) & (F.least(x["n"], y["n"]) * den >= F.greatest(x["n"], y["n"]) * num)
                & within(x["size"], y["size"], x["n"], y["n"], shared))
    c = F.col
    met = one.join(two, ["hub", "e"]).where(
        (c("block_x") <= c("block_y")) & ((c("r0_x") != c("r1_x")) | (c("r0_y") != c("r1_y")) | (c("r0_x") != c("r0_y")))
        & within(c("size0_x"), c("size0_y"), c("n1_x"), c("n1_y"), F.least("rest1_x", "rest1_y")))
    both = F.flatten(F.transform("held_x", lambda x: F.transform(F.filter("held_y", lambda y: fits(x, y)), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    pairs = met.withColumn("same", c("block_x") == c("block_y")).select(F.explode(both).alias("p")).select("p.x", "p.y")
    return pairs.select(*_in_order(*[F.col(c) for c in ("x.u", "x.n", "y.u", "y.n")])).distinct()


def _derived(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """(a, an, b, bn, link): every pair once; ``link`` is true or false where the bounds of any list decide, else null."""
    least = (F.col("an") + F.col("bn")) * num
    bounds = pairs.groupBy("a", "an", "b", "bn").agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"))
    return bounds.withColumn("link", F.when(F.col("lo") * (num + den) >= least, True).when(F.col("hi") * (num + den) < least, False)).drop("lo", "hi")


def jaccard_components(docs: DataFrame, size: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    fields = "n long, ranked int, sig binary, keys array<long>"
    rows = written(docs.select("doc_id", F.xxhash64("text").alias("t"), of_text(_set_of(size, num, den), fields).alias("s"))
                   .select(F.monotonically_increasing_id().alias("u"), "doc_id", "t", "s.*"))
    sets = written(rows.groupBy("sig").agg(F.min(F.struct("u", F.col("doc_id").alias("id"), "t")).alias("r"), F.min("doc_id").alias("first"),
                                           F.first("n").alias("n")).select("sig", "first", "n", "r.*"))
    entries = written(_entries(rows, sets, num, den))
    # The set with the fewest rarer tokens: of near copies the original, that most others link with.
    hubs = (entries.groupBy("k").agg(F.min(F.struct("pos", "u", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1"))
    lists = written(entries.join(hubs, "k").select("k", "u", "n", "pos", F.col("hub.u").alias("hub"), F.col("hub.n").alias("hn"),
                                                   F.col("hub.pos").alias("hp"), (F.col("size") <= FEW).alias("few")))
    near = lists.where(F.col("u") != F.col("hub")).where(~F.col("few") | _may_link("n", "pos", "hn", "hp", num, den))

    def linked(found: DataFrame) -> DataFrame:
        return found.where(F.col("common") * (num + den) >= (F.col("an") + F.col("bn")) * num).select("a", "b")

    tested = _compared(written(near.select(F.col("hub").alias("a"), F.col("hn").alias("an"), F.col("u").alias("b"), F.col("n").alias("bn")).distinct()),
                       docs, sets, size)
    spokes = linked(tested)
    lists = lists.join(components(spokes).withColumnRenamed("node", "u"), "u", "left").withColumn("root", F.coalesce("root", "u"))
    mixed = lists.groupBy("k").agg((F.min("root") != F.max("root")).alias("mixed"), F.count("*").alias("size")).where("mixed and size > 2").select("k")
    lists = written(lists.join(mixed, "k", "left_semi"))
    pairs = _derived(_few(lists.where("few"), tested, num, den), num, den)
    around = written(lists.where("not few and u <> hub").select(F.col("hub").alias("a"), F.col("u").alias("b"), "n", "root").distinct())
    differences = _read(around, docs, sets, size).select(F.col("a").alias("hub"), F.col("b").alias("u"), "n", "root",
                                                         _beside(_apart, "struct<d:array<long>,bits:array<long>>").alias("x"))
    differences = written(differences.select("hub", "u", "n", "root", "x.*"))
    unknown = pairs.where("link is null").drop("link").union(_by_difference(differences, num, den)).distinct()
    rest = _compared(written(unknown.join(tested.select("a", "b"), ["a", "b"], "left_anti").select("a", "an", "b", "bn")), docs, sets, size)
    roots = components(spokes.union(pairs.where("link").select("a", "b")).union(linked(rest)))
    rooted = sets.join(roots.withColumnRenamed("node", "u"), "u", "left").select("sig", "n", "first", F.coalesce("root", "u").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(ids, "root").select(F.col("sig").alias("_sig"), "component")
    return (rows.join(named, F.col("sig") == F.col("_sig"))
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS u, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT u, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
e AS (SELECT u, unnest(g) AS k FROM s),
m AS MATERIALIZED (SELECT a.u AS a, b.u AS b, count(*) AS common FROM e a JOIN e b ON a.k = b.k AND a.u <> b.u GROUP BY ALL),
l AS MATERIALIZED (SELECT m.a, m.b FROM m JOIN s x ON x.u = m.a JOIN s y ON y.u = m.b
                   WHERE 100 * common >= 90 * (len(x.g) + len(y.g) - common)),
r AS (SELECT u AS a, u AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT x.doc_id, len(x.g)::BIGINT AS n_shingles, min(y.doc_id) AS component_id
FROM r JOIN s x ON x.u = r.a JOIN s y ON y.u = r.b GROUP BY x.u, x.doc_id, x.g
"""

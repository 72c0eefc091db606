"""Source divergence audit by Gustavson row accumulation.

Terms are runs of letters (ASCII letters lowered, every code point from U+0080 on is a letter).
A language keeps the terms in at least ``least`` of its documents. Every (lang, source) group,
and every language, gives each kept term p = 1 + floor(scale * (count + smooth) / (N + smooth * V)).
``divergence`` reports per group its distance sum |p - q| to every other source of the language,
and its ``top`` terms over the language's own p.

The distances are a sparse product group x term x group, formed row by row (Gustavson): the
term-major index holds per term the groups with it. Each group scatters its terms through that
index into one dense accumulator over its peers, so that no (group, group, term) row is ever
emitted. Only common terms are met that way; the rest are zero counts, whose p is the group's
baseline z, the same for every term. With f = |p_g - p_h| per term, a sum over all V terms is
  sum over terms of g of |p_g - z_h|  +  the same of h  +  (V - terms of g - terms of h) |z_g - z_h|
  + sum over common terms of |p_g - p_h| - |p_g - z_h| - |p_h - z_g| + |z_g - z_h|.
The first two come from sorted values and their running sums, for all peers at once.

Scale: counts are added per batch of texts before any shuffle, so a hot source costs no more
than its different terms. The index is cut into buckets of about ``BUCKET`` postings by term;
a task holds one bucket and adds up one dense row per group. Groups grow with the number of
sources only; the pair rows (each other source of a language, all ranks) are that by contract.
Counts are decimals where they are multiplied, all else is 64-bit integers: nothing is rounded.

Null text, lang and source are ''. Ids play no part, repeated rows are further documents. A
group without terms is reported like any other; V = 0 gives values 0. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from threatlake.llm.components import written

LEAST, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
BUCKET = 1 << 18  # postings of a term bucket
_HELD = 1 << 18  # terms counted in a task before they are passed on
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def _count(batches):
    """Partial counts: per group and term occurrences and documents; one row without a term for
    every group met."""
    times, within, groups = defaultdict(Counter), defaultdict(Counter), set()

    def flush():
        rows = [(lang, source, term.decode("utf-8", "replace"), n, within[lang, source][term])
                for (lang, source), found in times.items() for term, n in found.items()]
        rows += [(lang, source, None, 0, 0) for lang, source in groups]
        cols = list(zip(*rows)) or [()] * 5
        times.clear(), within.clear(), groups.clear()
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, raw in zip(*(c.to_pylist() for c in batch.columns)):
            words = raw.translate(_LETTERS).split()
            groups.add((lang, source))
            if words:
                times[lang, source].update(words)
                within[lang, source].update(set(words))
        if sum(map(len, times.values())) > _HELD:
            yield flush()
    yield flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a group and documents with it;
    one row with a null term for every group."""
    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    part = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def term_index(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """The term-major index: (lang, term, lang_n, postings) of the kept terms; a posting is
    (source, n). Its length is bounded by the number of sources."""
    return (counts.where("term is not null").groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("postings"))
            .where(F.col("docs") >= least).drop("docs"))


def _p(n: Column, total: Column, kept: Column, smooth: int, scale: int) -> Column:
    """1 + floor(scale * (n + smooth) / (total + smooth * kept)); 0 without kept terms."""
    share = F.call_function("div", F.lit(scale).cast("decimal(12,0)") * (n + smooth).cast("decimal(20,0)"),
                            (total + smooth * kept).cast("decimal(20,0)"))
    return F.when(kept > 0, share + 1).otherwise(0).cast("long")


def _groups(counts: DataFrame, index: DataFrame, smooth: int, scale: int) -> DataFrame:
    """(lang, source, g, total, terms, z, kept, lang_total, buckets) of every group; g numbers
    the groups of a language from 0, z is the p of a count of 0."""
    own = (index.select("lang", F.explode("postings").alias("x")).groupBy("lang", F.col("x.source").alias("source"))
           .agg(F.sum("x.n").alias("total"), F.count("*").alias("terms")))
    langs = index.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"),
                                      F.sum(F.size("postings").cast("long")).alias("postings"))
    rows = (counts.where("term is null").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
            .na.fill(0, ["total", "terms", "kept", "lang_total", "postings"]))
    return rows.select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g"), "total", "terms",
        _p(F.lit(0), F.col("total"), F.col("kept"), smooth, scale).alias("z"), "kept", "lang_total",
        (F.floor(F.col("postings") / BUCKET) + 1).alias("buckets"))


def _above(p: np.ndarray, z: np.ndarray) -> np.ndarray:
    """For every z the sum of |p - z|."""
    p = np.sort(p)
    run = np.concatenate([[0], np.cumsum(p, dtype=np.int64)])
    k = np.searchsorted(p, z)
    return z * (2 * k - len(p)) + run[-1] - 2 * run[k]


def _accumulate(postings: pa.Table, peers: pa.Table) -> pa.Table:
    """One dense row per group over a bucket of terms: what its terms add to the distance to
    every peer; common terms are counted on the pair's later group."""
    number, base = np.asarray(peers["h"]), np.asarray(peers["base"])
    lang, bucket = peers["of"][0].as_py(), peers["part"][0].as_py()
    z = np.zeros(len(number), np.int64)
    z[number] = base
    term = np.asarray(postings["term"].combine_chunks().dictionary_encode().indices) if len(postings) else np.zeros(0, np.int64)
    g, p = np.asarray(postings["g"]), np.asarray(postings["p"])
    order = np.lexsort((g, term))  # the term-major index: per term its groups in order
    term, g, p = term[order], g[order], p[order]
    first = np.searchsorted(term, term)  # where a posting's term begins
    rows = np.argsort(g, kind="stable")
    edges = np.searchsorted(g[rows], np.arange(len(z) + 1))
    out = []
    for i in range(len(z)):
        own = rows[edges[i]:edges[i + 1]]
        acc = _above(p[own], z) if len(own) else np.zeros(len(z), np.int64)
        before = own - first[own]  # peers ahead of the group in each of its terms
        at = np.repeat(own, before)
        peer = np.arange(len(at)) - np.repeat(np.cumsum(before) - before, before) + np.repeat(first[own], before)
        h, pg, ph = g[peer], p[at], p[peer]
        np.add.at(acc, h, abs(pg - ph) - abs(pg - z[h]) - abs(ph - z[i]) + abs(z[i] - z[h]))
        out.append(acc)
    return pa.table({"lang": pa.array([lang] * len(z)), "bucket": pa.array([bucket] * len(z), pa.int64()),
                     "g": pa.array(range(len(z)), pa.int32()), "acc": pa.array(out, pa.list_(pa.int64()))})


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, g, h, value) of every ordered pair of groups of a language."""
    dealt = entries.select("lang", F.pmod(F.xxhash64("term"), "buckets").alias("bucket"), "term", "g", "p")
    peers = groups.select(F.col("lang").alias("of"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("part"),
                          F.col("g").alias("h"), F.col("z").alias("base"))
    dense = dealt.groupBy("lang", "bucket").cogroup(peers.groupBy("of", "part")).applyInArrow(
        _accumulate, "lang string, bucket long, g int, acc array<long>")
    summed = (dense.select("lang", "g", F.posexplode("acc").alias("h", "v")).where("g <> h")
              .groupBy("lang", F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b")).agg(F.sum("v").alias("v")))
    side = lambda k: groups.select("lang", F.col("g").alias(k), F.col("z").alias(f"{k}z"), F.col("terms").alias(f"{k}t"), "kept")
    both = summed.join(side("a"), ["lang", "a"]).join(side("b").drop("kept"), ["lang", "b"])
    value = F.col("v") + (F.col("kept") - F.col("at") - F.col("bt")) * F.abs(F.col("az") - F.col("bz"))
    both = both.select("lang", "a", "b", value.alias("value"))
    turned = F.explode(F.array(F.struct(F.col("a").alias("g"), F.col("b").alias("h")), F.struct(F.col("b").alias("g"), F.col("a").alias("h"))))
    return both.select("lang", turned.alias("x"), "value").select("lang", "x.g", "x.h", "value")


def divergence(docs: DataFrame, least: int = LEAST, smooth: int = SMOOTH, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the
    language, part ``term`` the ``top`` terms over the language's share."""
    counts = written(term_counts(docs))
    index = written(term_index(counts, least))
    groups = written(_groups(counts, index, smooth, scale))
    entries = (index.select("lang", "term", "lang_n", F.explode("postings").alias("x")).select("lang", "term", "lang_n", "x.source", "x.n")
               .join(groups, ["lang", "source"])
               .withColumn("p", _p(F.col("n"), F.col("total"), F.col("kept"), smooth, scale)))
    names = groups.select("lang", "g", "source")
    pairs = (_pairs(entries, groups).join(names, ["lang", "g"])
             .join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    over = F.col("p") - _p(F.col("lang_n"), F.col("lang_total"), F.col("kept"), smooth, scale)
    terms = (entries.where("n > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), over.alias("value"))
             .where("value > 0"))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (pairs.withColumn("rank", F.row_number().over(by))
            .union(terms.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
n AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
             1 + 1000000000 * (coalesce(c.c, 0) + 5) // (coalesce(n.n, 0) + 5 * v.v) AS p,
             1 + 1000000000 * (k.c + 5) // (v.n + 5 * v.v) AS q
      FROM g JOIN kept k USING (lang) JOIN v USING (lang)
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 50
"""

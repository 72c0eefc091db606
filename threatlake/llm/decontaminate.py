"""Benchmark contamination: one Aho-Corasick automaton over the normalised benchmark.

Normalised text: A-Z lower-cased, words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
(digits, letters, everything beyond ASCII). The automaton's symbols are words, numbered over
the benchmark's vocabulary, and its patterns are the windows of ``window`` consecutive words
of an item (all words of a shorter one). Each text is scanned once; a match ends at a word
position, so hits map straight to words and, through the word starts, to byte offsets of the
original text (normalising changes no byte length).

The benchmark is collected in parts whose windows are bounded by ``max_windows`` (a few
hundred bytes each in the automaton). A larger benchmark is scanned in several passes over
the same texts; each pass hands its matches on and is checkpointed, so memory stays bounded
and results are whole.

Null and empty texts have no words: never hit, never contaminated. An item without words
matches nothing. Null item ids count as an item named by the empty string. Repeated item ids
count once. Repeated rows and ids of documents give one row each. An empty benchmark gives
no hits.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import Column, DataFrame, functions as F

from threatlake.llm.components import saved
from threatlake.llm.text import fresh, of_text

WINDOW = 13
MAX_WINDOWS = 200_000
# A-Z to a-z; every other byte that is not part of a word to a space
NORMAL = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))
_WORD = re.compile(rb"[^ ]+")
FIELDS = "n_words long, spans array<struct<first:int,last:int>>, items array<string>"


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(NORMAL).split()


def windows_of(raw: bytes | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    w = words_of(raw)
    return [tuple(w[i:i + window]) for i in range(max(1, len(w) - window + 1))] if w else []


class Scanner:
    """Benchmark windows as an automaton over word numbers; built once per task."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.items, self.window, self.automaton, self.number = items, window, None, {}

    def build(self) -> None:
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        owners: dict[tuple[int, ...], list[str]] = {}
        for name, raw in self.items:
            for w in windows_of(raw, self.window):
                key = tuple(self.number.setdefault(x, len(self.number) + 1) for x in w)
                owners.setdefault(key, []).append(name)
        for key, names in owners.items():
            self.automaton.add_word(key, (len(key), sorted(set(names))))
        if owners:
            self.automaton.make_automaton()

    def __call__(self, raw: bytes | None) -> tuple:
        """(number of words, hit word ranges [first, last], ids of items found)."""
        if self.automaton is None:
            self.build()
        words, spans, found = words_of(raw), [], set()
        if not self.number:
            return len(words), [], []
        look = self.number.get
        for end, (size, names) in self.automaton.iter(tuple([look(w, 0) for w in words])):
            first = end - size + 1
            found.update(names)
            while spans and spans[-1][0] >= first:
                spans.pop()
            if spans and spans[-1][1] >= first - 1:
                first = spans.pop()[0]
            spans.append((first, end))
        return len(words), [{"first": a, "last": b} for a, b in spans], sorted(found)

    def __getstate__(self):
        return {"items": self.items, "window": self.window, "automaton": None, "number": {}}


def byte_spans(raw: bytes | None, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets [start, end) in the original text of word ranges [first, last]."""
    at = [m.span() for m in _WORD.finditer((raw or b"").translate(NORMAL))]
    return [(at[a][0], at[b][1]) for a, b in spans]


def _parts(benchmark: DataFrame, window: int, max_windows: int):
    """The benchmark in lists of (item id, text) of at most about ``max_windows`` windows."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("binary").alias("raw")).where("text is not null")
    n = items.agg(F.sum(F.octet_length("raw"))).first()[0] or 0  # two bytes a word at least
    parts = max(1, -(-n // (2 * max_windows)))
    for p in range(parts):
        part = items.where(F.pmod(F.xxhash64("item", "raw"), F.lit(parts)) == p) if parts > 1 else items
        yield [(r.item, bytes(r.raw)) for r in part.toLocalIterator()]


def scan(docs: DataFrame, benchmark: DataFrame, out: str, window: int = WINDOW,
         max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` with a struct column ``out`` (FIELDS): words, hit word ranges, items."""
    found = None
    for items in _parts(benchmark, window, max_windows):
        one = of_text(Scanner(items, window), FIELDS)
        if found is None:
            found, docs = out, docs.withColumn(out, one)
            continue
        more = fresh(docs, "_more")
        docs = saved(docs).withColumn(more, one)
        docs = docs.withColumn(out, F.struct(
            F.col(f"{out}.n_words").alias("n_words"), F.concat(f"{out}.spans", f"{more}.spans").alias("spans"),
            F.array_union(f"{out}.items", f"{more}.items").alias("items"))).drop(more)
    return docs


def _n_hit(spans: Column) -> Column:
    """Words in the union of word ranges (ranges of one pass are disjoint and sorted)."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"] - 1, acc["end"]))).cast("long").alias("n"),
        F.greatest(acc["end"], s["last"]).alias("end"))
    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end")), step)["n"]


def _verdict(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    and the hit word ranges ``spans``."""
    s = scan(docs.select("doc_id", "text"), benchmark, "_s", window, max_windows).select("doc_id", "_s.*")
    s = s.select("doc_id", "n_words", _n_hit(F.col("spans")).alias("n_hit"), F.array_sort("items").alias("items"), "spans")
    return s.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    _verdict(F.col("n_hit"), F.col("n_words")).alias("contaminated"), "spans")


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    out = fresh(docs, "_s")
    s = scan(docs, benchmark, out, window, max_windows)
    return s.where(~_verdict(_n_hit(F.col(f"{out}.spans")), F.col(f"{out}.n_words"))).select(*[f"`{c}`" for c in docs.columns])


def _sql(window: int = WINDOW) -> str:
    """DuckDB SQL of ``contamination`` (without spans) over ``documents`` and ``benchmark``."""
    words = rf"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, {words} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, w FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0),
p AS (SELECT DISTINCT item, least(len(w), {window}) AS size, unnest(list_transform(range(1, greatest(len(w) - {window - 1}, 1) + 1),
        lambda i: array_to_string(w[i:i + {window - 1}], ' '))) AS key FROM b),
q AS (SELECT u, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
r AS (SELECT u, i, list(word) OVER (PARTITION BY u ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING) AS l FROM q),
f AS (SELECT u, size, i, array_to_string(l[1:size], ' ') AS key FROM r, (SELECT DISTINCT size FROM p) WHERE len(l) >= size),
x AS (SELECT f.u, f.i, f.size, p.item FROM f JOIN p ON f.size = p.size AND f.key = p.key),
h AS (SELECT u, count(DISTINCT i + j) AS n_hit FROM x, range({window}) AS o(j) WHERE j < size GROUP BY u),
n AS (SELECT u, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT u, item FROM x) GROUP BY u)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON h.u = d.u LEFT JOIN n ON n.u = d.u"""


ORACLE = _sql()

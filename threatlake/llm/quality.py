"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and evaluates every rule once: one row per input row
with the measurements and ``failure_bits`` (bit i set: rule i fails). A policy is a named,
versioned set of rules; applying one is a bitwise AND over the ledger, so a new policy or an
ablation never reads a text again: ``audit`` stores the ledger in the shared checkpoint folder
and takes the policy's verdicts and its ablation from the stored rows.

Row-wise: no shuffle, any input row gives exactly one output row. Null and empty texts have
no words, so they fail ``short``. Null or repeated ids and repeated rows are kept as they
are; other columns of the input are ignored. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from threatlake.llm.components import written
from threatlake.llm.text import SPACES, fresh, of_text

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_lines long, n_upper long, n_alpha_words long")

# name -> condition under which a text FAILS, over the measurements (integer arithmetic).
# The position in this list is the bit; only ever append.
RULES: list[tuple[str, str]] = [
    ("short", "n_words < 50"),
    ("repetitive", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("word_length", "word_chars < 3 * n_words or word_chars > 12 * n_words"),
    ("endless", "n_words > 1000000"),
    ("not_alphabetic", "10 * n_alpha_words < 8 * n_words"),
    ("shouting", "2 * n_upper > word_chars"),
]
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("short", "repetitive"),
    "prose-1": ("short", "repetitive", "symbols", "duplicate_lines", "word_length", "endless", "not_alphabetic",
                "shouting"),
    # Length alone is no fault: the bit of "endless" stays in the ledger, the policy does not use it.
    "prose-2": ("short", "repetitive", "symbols", "duplicate_lines", "word_length", "not_alphabetic", "shouting"),
}
PRODUCTION = "prose-2"

_SYMBOLS = b"#*$%&|<>"
_NOT_STARTS = SPACES + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes
_UPPER = bytes(range(65, 91))
_NO_LETTER = bytes(b for b in range(0x80) if not chr(b).isalpha() and b not in SPACES)


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) == len(grams):
        return 0
    times, covered, end = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(raw: bytes | None) -> tuple:
    raw = raw or b""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(raw.translate(None, _NOT_STARTS)), len(raw) - len(raw.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines),
            len(raw) - len(raw.translate(None, _UPPER)), len(raw.translate(None, _NO_LETTER).split()))


def bits_of(*rules: str) -> int:
    at = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(at[r] for r in rules)


def _failure_bits(prefix: str) -> Column:
    def one(i: int, cond: str) -> Column:
        for f in MEASURES.split(", "):
            cond = cond.replace(f.split()[0], f"{prefix}.{f.split()[0]}")
        return F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return reduce(lambda a, b: a.bitwiseOR(b), [one(i, c) for i, (_, c) in enumerate(RULES)])


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements..., failure_bits) for every row of ``docs``."""
    return (docs.select("doc_id", of_text(measure, MEASURES).alias("m"))
            .select("doc_id", "m.*", _failure_bits("m").alias("failure_bits")))


def apply_policy(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Ledger rows with ``policy``, ``base_failed`` and ``kept``."""
    failed = lambda name: F.col("failure_bits").bitwiseAND(F.lit(bits_of(*POLICIES[name]))) != 0
    return (rows.withColumn("policy", F.lit(policy)).withColumn("base_failed", failed("base-1"))
            .withColumn("kept", ~failed("base-1") & ~failed(policy)))


def ablation(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per rule of a policy: rows it fails, and rows that only it fails (what dropping the
    rule would give back). One pass: rows are first counted per pattern of failed rules (map
    side), of which there are at most 2^rules, whatever the size of the ledger."""
    mask = bits_of(*POLICIES[policy])
    patterns = rows.groupBy(F.col("failure_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bits_of(r)).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    return (patterns.select("bits", "n", F.explode(rules).alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
                 F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_passed_all"))
            .withColumn("policy", F.lit(policy)))


def keep_good(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """The rows of ``docs``, all columns, that a policy keeps."""
    m, bits = fresh(docs, "_m"), fresh(docs, "_bits")
    mask = bits_of(*POLICIES[policy]) | bits_of(*POLICIES["base-1"])
    return (docs.withColumn(m, of_text(measure, MEASURES)).withColumn(bits, _failure_bits(f"`{m}`"))
            .where(F.col(bits).bitwiseAND(F.lit(mask)) == 0).select(*[f"`{c}`" for c in docs.columns]))


def quality_rules(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    return apply_policy(ledger(docs), policy).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failure_bits", "policy")


def audit(docs: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """``quality_rules`` from a stored ledger, with ``only_rule``, the rule that alone rejects a
    row (null: none or several), and ``n_only``, the rows that dropping this rule gives back."""
    rows = written(ledger(docs))
    bits = F.col("failure_bits").bitwiseAND(F.lit(bits_of(*POLICIES[policy])))
    only = F.coalesce(*[F.when(bits == bits_of(r), F.lit(r)) for r in POLICIES[policy]])
    alone = ablation(rows, policy).select(F.col("rule").alias("only_rule"), "n_only")
    return (apply_policy(rows, policy).withColumn("only_rule", only)
            .join(F.broadcast(alone), "only_rule", "left")  # one row for each rule of the policy
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    "failure_bits", "policy", "only_rule", "n_only"))


def _sql() -> str:
    """DuckDB SQL of ``audit`` over ``documents``."""
    failed = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, (_, cond) in enumerate(RULES))
    production = bits_of(*POLICIES[PRODUCTION])
    only = " ".join(f"WHEN {bits_of(r)} THEN '{r}'" for r in POLICIES[PRODUCTION])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT u, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS g FROM w),
r AS (SELECT u, count(DISTINCT i + j) AS n FROM (SELECT u, i, count(*) OVER (PARTITION BY u, g) AS times FROM g), range(3) AS x(j) WHERE times > 1 GROUP BY u),
m AS (SELECT w.u, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_upper,
             len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')))::BIGINT AS n_alpha_words
      FROM w LEFT JOIN r ON r.u = w.u),
f AS (SELECT *, ({failed})::BIGINT AS failure_bits FROM m),
o AS (SELECT *, CASE failure_bits & {production} {only} END AS only_rule FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failure_bits & {bits_of(*POLICIES["base-1"])} <> 0 AS base_failed,
       failure_bits & {bits_of(*POLICIES["base-1"]) | bits_of(*POLICIES[PRODUCTION])} = 0 AS kept, failure_bits, '{PRODUCTION}' AS policy,
       only_rule, CASE WHEN only_rule IS NOT NULL THEN count(*) OVER (PARTITION BY only_rule) END AS n_only
FROM o"""


ORACLE = _sql()

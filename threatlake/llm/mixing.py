"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power ``alpha``, normalised: alpha 1 keeps the
shares, alpha 0 makes sources equal. Alpha is bisected until the target holds:

* ``max_epochs``: no source is read more than so many times (the smallest such alpha), or
* ``entropy``: the weights' entropy in nats is at most the target (the smallest such alpha).

Budget: ``budget_tokens``, or by default what reads the source with the largest weight per
token exactly once, so every document is used at least once and small sources are repeated.

Realising: a source's documents are laid out in passes, each a permutation of its own (order
of a hash of document and pass). Whole passes are used as they are; of the last pass, the
documents that start inside the budget are used. Drawn copies then go to blocks of about
``block_tokens`` by their position in their source's stream, so every block holds the sources
in the target weights; ``place`` orders a block.

Skew: a source's permutation is cut into 256 slices of the hash, with token totals per
slice first and running sums only inside a slice; one source may hold any share of the rows.
Token counts are exact over all documents. Per-source statistics are reduced by Spark; the
bisection asks for sums over sources, so the number of sources is free.

Tokens are words ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no tokens and are used once
per whole pass. Null source: a source of its own. Rows equal in id, source and text are one
unit: they are used together. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from threatlake.llm.components import saved
from threatlake.llm.text import fresh

MAX_EPOCHS = 2.0
BLOCK_TOKENS = 1 << 20


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit_key() -> list[Column]:
    """Rows that agree in these are one unit."""
    return [F.col("doc_id"), F.col("source"), F.xxhash64("text").alias("h")]


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, source, h, tokens, times): tokens of all ``times`` equal rows together."""
    return (docs.select(*unit_key(), n_tokens(F.col("text")).alias("t")).groupBy("doc_id", "source", "h")
            .agg(F.sum("t").alias("tokens"), F.count("*").alias("times")))


def source_tokens(u: DataFrame) -> DataFrame:
    return u.groupBy("source").agg(F.sum("tokens").alias("n"))


def _sums(stats: DataFrame, alphas: list[float]) -> list[tuple[float, float, float]]:
    """For each alpha over the sources: sum of w, sum of w ln w and max of w / n, w = n^alpha."""
    n = F.col("n").cast("double")
    cols = []
    for a in alphas:
        w = F.exp(F.lit(a) * F.log(n))
        cols += [F.sum(w), F.sum(w * F.lit(a) * F.log(n)), F.max(w / n)]
    row = stats.where("n > 0").agg(*cols).first()
    return [tuple(row[3 * i:3 * i + 3]) for i in range(len(alphas))]


def _bisect(stats: DataFrame, holds: Callable[[float, tuple], bool], steps: int = 6, fan: int = 16) -> float:
    """The least alpha in [0, 1] at which ``holds`` is true (monotone; 1 if it never is), the
    interval narrowed ``fan``-fold by each of ``steps`` aggregates over the source totals."""
    lo, hi = 0.0, 1.0
    for _ in range(steps):
        grid = [lo + (hi - lo) * i / fan for i in range(fan + 1)]
        good = [holds(a, s) for a, s in zip(grid, _sums(stats, grid))]
        at = good.index(True) if True in good else fan
        if at == 0:
            return grid[0]
        lo, hi = grid[at - 1], grid[at]
    return hi


def temperature(stats: DataFrame, budget_tokens: int | None = None, max_epochs: float = MAX_EPOCHS,
                entropy: float | None = None) -> tuple[float, float]:
    """(alpha, budget in tokens): by target entropy where that is given, else by repetition limit."""
    largest = stats.agg(F.max("n")).first()[0] or 0
    if not largest:
        return 1.0, 0.0
    budget = lambda a, s: float(budget_tokens or s[0] * float(largest) ** (1 - a))
    if entropy is not None:
        alpha = _bisect(stats, lambda a, s: math.log(s[0]) - s[1] / s[0] <= entropy)
    else:
        alpha = _bisect(stats, lambda a, s: budget(a, s) * s[2] / s[0] <= max_epochs * (1 + 1e-12))
    return alpha, budget(alpha, _sums(stats, [alpha])[0])


def passes(stats: DataFrame, alpha: float, budget: float) -> DataFrame:
    """(source, n, weight, epochs, whole, rest): how often each source is read; ``rest``
    is the token budget of the last, partial pass."""
    z = _sums(stats, [alpha])[0][0] or 1.0
    weight = F.when(F.col("n") > 0, F.exp(F.lit(alpha) * F.log(F.col("n").cast("double"))) / F.lit(z)).otherwise(F.lit(0.0))
    t = stats.withColumn("weight", weight).withColumn(
        "epochs", F.when(F.col("n") > 0, F.round(F.col("weight") * F.lit(budget) / F.col("n"), 9)).otherwise(F.lit(1.0)))
    return t.withColumn("whole", F.floor("epochs").cast("int")).withColumn("rest", (F.col("epochs") - F.col("whole")) * F.col("n"))


def _order(p: Column) -> Column:
    """A unit's place in pass ``p`` of its source: a 64-bit hash."""
    return F.xxhash64(F.col("h"), F.col("doc_id"), p)


def mixture(docs: DataFrame, budget_tokens: int | None = None, max_epochs: float = MAX_EPOCHS,
            entropy: float | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per unit and pass drawn: doc_id, source, h, n_tokens, n_rows (equal rows of the
    unit), pass, weight and epochs of the source, block, place."""
    u = saved(units(docs))
    stats = saved(source_tokens(u))
    alpha, budget = temperature(stats, budget_tokens, max_epochs, entropy)
    plan = saved(passes(stats, alpha, budget)).withColumnRenamed("source", "s")
    last = F.col("whole") - F.when(F.col("rest") > 0, 0).otherwise(1)
    drawn = (u.join(plan, u["source"].eqNullSafe(plan["s"])).drop("s").where(last >= 0)
             .withColumn("pass", F.explode(F.sequence(F.lit(0), last)))
             .withColumn("at", _order(F.col("pass"))).withColumn("slice", F.shiftright("at", 56)))
    slices = drawn.groupBy("source", "pass", "slice").agg(F.sum("tokens").alias("b"))
    upto = Window.partitionBy("source", "pass").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    slices = slices.select(F.col("source").alias("s"), F.col("pass").alias("p"), F.col("slice").alias("c"),
                           (F.sum("b").over(upto) - F.col("b")).alias("before"))
    run = Window.partitionBy("source", "pass", "slice").orderBy("at", "doc_id", "h").rowsBetween(Window.unboundedPreceding, 0)
    rows = (drawn.join(slices, drawn["source"].eqNullSafe(slices["s"]) & (drawn["pass"] == slices["p"]) & (drawn["slice"] == slices["c"]))
            .withColumn("start", F.col("before") + F.sum("tokens").over(run) - F.col("tokens")))
    rows = rows.where((F.col("pass") < F.col("whole")) | (F.col("start") < F.col("rest")))
    blocks = max(1, math.ceil(budget / block_tokens))
    share = F.when(F.col("n") > 0, (F.col("pass") * F.col("n") + F.col("start")) / (F.col("epochs") * F.col("n"))).otherwise(F.lit(0.0))
    return rows.select("doc_id", "source", "h", F.col("tokens").alias("n_tokens"), F.col("times").alias("n_rows"), "pass",
                       "weight", "epochs", F.least(F.floor(share * blocks), F.lit(blocks - 1)).cast("long").alias("block"),
                       F.xxhash64("at").alias("place"))


def mix(docs: DataFrame, **target) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mixture draws it."""
    drawn = mixture(docs, **target)
    times, key = fresh(docs, "_times"), [fresh(docs, f"_k{i}") for i in range(3)]
    keyed = docs.withColumns({key[0]: F.col("doc_id"), key[1]: F.col("source"), key[2]: F.xxhash64("text")})
    # Per source: whole passes, and the largest place drawn in the partial one.
    partial = F.col("pass") >= F.floor("epochs")
    per = drawn.groupBy("source").agg(F.max(F.floor("epochs")).cast("int").alias("whole"),
                                      F.max(F.when(partial, _order(F.col("pass")))).alias("cut"))
    per = saved(per.withColumnRenamed("source", "_src"))
    at = F.xxhash64(F.col(key[2]), F.col(key[0]), F.col("whole"))
    copies = F.col("whole") + F.when(at <= F.col("cut"), 1).otherwise(0)
    return (keyed.join(per, F.col(key[1]).eqNullSafe(F.col("_src")))
            .withColumn(times, F.explode(F.array_repeat(F.lit(1), copies)))
            .select(*[keyed[f"`{c}`"] for c in docs.columns]))

"""Conversation repair, source divergence and the Jaccard join against brute force and SQL."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from threatlake.llm import divergence, jaccard, repair

SF = "/root/testdata/sf0.001"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def sql(query, documents):
    con = duckdb.connect()
    con.register("documents", documents.select("doc_id", "text", "lang", "source").toArrow())
    return Counter(con.sql(query).fetchall())


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not body else "d" if (role, text) in seen else "-" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def given(state):
    return "a" if state == "u" else "u"


def cheapest(rows, kinds):
    """(cost, edits) from the end of the conversation back, per grammar state."""
    def with_inserts(best):
        for _ in range(3):
            best = {s: min(best[s], (best[given(s)][0] + 3, "I" + best[given(s)][1])) for s in best}
        return best
    best = with_inserts({"": (0, ""), "s": (10**9, ""), "u": (10**9, ""), "a": (0, "")})
    for (_, role, _), kind in reversed(list(zip(rows, kinds))):
        now = {}
        for s in best:
            ways = [(best[s][0] + 4, "D" + best[s][1])]
            if kind not in "bd":
                late = 3 * (kind == "t")
                ways.append((best[given(s)][0] + 3 + late, "R" + best[given(s)][1]))
                if (s, role[:1]) in NEXT:
                    then = best[NEXT[s, role[:1]]]
                    ways.append((then[0] + late, "K" + then[1]))
            now[s] = min(ways)
        best = with_inserts(now)
    return best[""]


def brute_repair(rows):
    kinds = faults_of(rows)
    cost, edits = cheapest(rows, kinds)
    out, state, i = [], "", 0
    for e in edits:
        role, text, then = {"u": "user", "a": "assistant"}[given(state)], "", given(state)
        if e in "KRD":
            role, text, then = (rows[i][1] if e == "K" else role), rows[i][2], (rows[i][1][:1] if e == "K" else then)
            i += 1
        if e != "D":
            out.append(f"{role}:{text}")
            state = then
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[kinds.count(k) for k in "bdt"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, edits,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_audit(rows):
    spaced, convs = (lambda x: " " if x is None else str(x)), defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else spaced(role), spaced(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    order = lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())
    return {conv: brute_repair(sorted(found, key=order)) for conv, found in convs.items()}


def odd_turns():
    rng = random.Random(5)
    roles, texts = ["user", "user", "assistant", "system", "", "tool", None], ["Hi.", "Yes!", "no end", "", "  ", None]
    long = [(7, i // 2 if i % 11 else None, rng.choice(roles), rng.choice([*texts, f"What? {i}.", f"more {i}"])) for i in range(400)]
    short = [(c, i, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", ""])) for c in range(10, 50) for i in range(rng.randrange(1, 9))]
    return long + short + [(None, 0, "user", "a."), (None, None, "assistant", "b"), (1, 0, None, None), (2, None, "user", "x."),
                           (2, None, "user", "x."), (3, 0, "user", "long. " * 50000)]


@pytest.mark.parametrize("name", ["odd", "sf", "empty"])
def test_repair_is_the_cheapest_and_first(spark, name):
    rows = spark.createDataFrame(odd_turns(), "conv_id long, turn long, role string, text string")
    if name == "sf":
        rows = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = rows.where("false") if name == "empty" else rows
    got = {r[0]: tuple(r)[1:] for r in repair.audit(rows, repair.damage(rows)).collect()}
    assert got == brute_audit([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


def test_search_agrees_with_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        rows = [(0, rng.choice("sua-"), "") for _ in range(rng.randrange(1, 12))]
        kinds = [rng.choice("---tbd") for _ in rows]
        cost, edits, state = repair.search("".join(r + k for (_, r, _), k in zip(rows, kinds)), 0, repair.ENDS)
        assert (cost, edits + repair._CLOSING[state]) == cheapest(rows, kinds)


def test_repaired_turns_are_real_rows(spark):
    rows = spark.createDataFrame([("c", 1, "user", "Hi."), ("c", 2, "user", "Are you there?"), ("c", 3, "assistant", "Yes.")],
                                 "conv_id string, turn int, role string, text string").withColumn("chunk", rows_col())
    report, turns = repair.repair(rows)
    assert [tuple(r) for r in report.collect()] == [("c", 0, 0, 0, 0, 1, 3, "KIKK")]
    got = [(r.role, r.text, r.edit) for r in turns.orderBy("chunk", "nr").collect()]
    assert got == [("user", "Hi.", "K"), ("assistant", "", "I"), ("user", "Are you there?", "K"), ("assistant", "Yes.", "K")]


def rows_col():
    from pyspark.sql import functions as F
    return F.lit("clash")


@pytest.mark.parametrize("least", [30, 1])
@pytest.mark.parametrize("name", ["odd", "sf", "empty"])
def test_divergence(spark, odd, empty, name, least, monkeypatch):
    docs = {"odd": odd.withColumn("value", odd.h), "empty": empty, "sf": spark.read.parquet(f"{SF}/documents.parquet")}[name]
    monkeypatch.setattr(divergence, "BUCKET", 500)  # several buckets of terms
    got = divergence.divergence(docs, least=least).select("lang", "source", "part", "item", "value", "rank")
    assert Counter(map(tuple, got.collect())) == sql(divergence.ORACLE.replace(">= 30", f">= {least}"), docs)


def test_sums_around_a_baseline():
    p, z = np.array([5, 1, 9, 5]), np.array([0, 1, 5, 7, 20])
    assert divergence._above(p, z).tolist() == [int(abs(p - x).sum()) for x in z]


def near_copies(spark):
    """Sets around the threshold, of which many share tokens but do not link."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(300)] = f"x{rng.randrange(50)}"
        w = w[:rng.randrange(250, 300)] if i % 3 == 0 else w
        rows.append((i, " ".join(w + [f"y{rng.randrange(9)}" for _ in range(rng.randrange(40))] if i % 5 == 0 else w)))
    rows += [(i, " ".join(f"s{rng.randrange(3)}" for _ in range(rng.randrange(40)))) for i in range(160, 260)]
    rows += [(260, None), (261, ""), (None, "s1 s2"), (262, "s1 s2"), (263, "S1"), (264, "s1"), (264, "s1"), (265, " \n")]
    return spark.createDataFrame([(*r, None, None) for r in rows], "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("name", ["odd", "sf", "empty", "near"])
def test_jaccard(spark, odd, empty, name, monkeypatch):
    docs = {"odd": odd.withColumn("u", odd.h), "empty": empty, "sf": spark.read.parquet(f"{SF}/documents.parquet"), "near": near_copies(spark)}[name]
    monkeypatch.setattr(jaccard, "BLOCK", 4)  # lists of several blocks
    monkeypatch.setattr(jaccard, "FEW", 4)  # and joined by differences
    got = jaccard.jaccard_components(docs).select("doc_id", "n_shingles", "component_id")
    assert Counter(map(tuple, got.collect())) == sql(jaccard.ORACLE, docs)


def test_answers_follow_from_a_common_hub(spark):
    lists = spark.createDataFrame([(5, u, 100, 0, u, 1, 100) for u in (1, 2, 3, 4, 9)],
                                  "k long, u long, n long, pos long, root long, hub long, hn long")
    tested = spark.createDataFrame([(1, 2, 94), (1, 3, 94), (1, 4, 40)], "a long, b long, common long")
    pairs = jaccard._few(lists, tested, 9, 10)
    assert {(r.a, r.b): (r.lo, r.hi) for r in pairs.collect()} == {
        (2, 3): (88, 100), (2, 4): (34, 46), (3, 4): (34, 46), (2, 9): (None, None), (3, 9): (None, None), (4, 9): (None, None)}
    got = {(r.a, r.b): r.link for r in jaccard._derived(pairs, 9, 10).collect()}
    assert got == {(2, 3): None, (2, 4): False, (3, 4): False, (2, 9): None, (3, 9): None, (4, 9): None}
    sure = spark.createDataFrame([(2, 100, 3, 100, 88, 100), (2, 100, 3, 100, 96, 100)], "a long, an long, b long, bn long, lo long, hi long")
    assert [r.link for r in jaccard._derived(sure, 9, 10).collect()] == [True]


def test_differences_to_a_hub_find_every_link_it_does_not_connect(spark):
    rng = random.Random(7)
    hub = set(range(100))
    sets = {}
    for u in range(1, 150):
        edits = rng.sample(range(100), rng.randrange(3, 9))
        sets[u] = hub - set(edits) - {0, 1} | {1000 + rng.randrange(40) for _ in edits} | {2000}
    jac = lambda a, b: 10 * len(a & b) >= 9 * len(a | b)
    far = {u: s for u, s in sets.items() if not jac(s, hub)}
    code = lambda s: np.array(sorted(x * 0x9E3779B97F4A7C15 % 2**64 for x in s), np.uint64)
    apart = {u: jaccard._apart(code(hub), code(s)) for u, s in far.items()}
    assert all(set(apart[u]["d"].view(np.uint64)) == set(code(s ^ hub)) for u, s in far.items())
    rows = [(0, u, len(s), u, apart[u]["d"].tolist(), apart[u]["bits"].tolist()) for u, s in far.items()]
    pairs = jaccard._by_difference(spark.createDataFrame(rows, "hub long, u long, n long, root long, d array<long>, bits array<long>"), 9, 10)
    got = {(r.a, r.b) for r in pairs.collect()}
    want = {(a, b) for a in far for b in far if a < b and jac(far[a], far[b])}
    assert want and want <= got and len(got) < 2 * len(want) + 50

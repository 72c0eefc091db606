"""Every operator against a brute-force version, on odd rows and on the sf0.001 tables."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
import xxhash

from threatlake.llm import chat, decontaminate, line_dedup, mixing, pst, quality, queries, sharding, simhash, suffix_family, toxicity
from threatlake.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


@pytest.fixture(scope="module", params=["odd", "sf", "empty"])
def docs(request, spark, odd, empty):
    return {"odd": odd, "empty": empty, "sf": spark.read.parquet(f"{SF}/documents.parquet")}[request.param]


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def bag(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_rules(docs):
    def expected(i, t):
        w = WORD.findall(t or "")
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        many = Counter(grams)
        inside = {k + j for k, g in enumerate(grams) if many[g] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
        return (i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(inside), failed)
    got = quality.quality_rules(docs).collect()
    assert bag(tuple(r)[:7] for r in got) == bag(expected(*r) for r in rows_of(docs))
    assert not any(r.kept and r.base_failed for r in got)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)


def test_ablation_counts_sole_failures(spark):
    led = spark.createDataFrame([(0,), (1,), (3,), (4,)], "failure_bits long")
    got = {r.rule: (r.n_failed, r.n_only, r.n_passed_all) for r in quality.ablation(led).collect()}
    assert got["short"] == (2, 1, 1) and got["repetitive"] == (1, 0, 1) and got["symbols"] == (1, 1, 1)


def test_audit_takes_verdicts_and_ablation_from_the_stored_ledger(docs, odd, empty):
    for table in (docs, odd):
        got = quality.audit(table).collect()
        assert bag(tuple(r)[:10] for r in got) == bag(quality.quality_rules(table).collect())
        failed = [[n for k, (n, _) in enumerate(quality.RULES) if r.failure_bits >> k & 1 and n in quality.POLICIES[r.policy]] for r in got]
        alone = Counter(f[0] for f in failed if len(f) == 1)
        assert [(r.only_rule, r.n_only) for r in got] == [(f[0], alone[f[0]]) if len(f) == 1 else (None, None) for f in failed]
    audited = quality.audit(odd)
    assert not any("Python" in line or "Arrow" in line for line in audited._jdf.queryExecution().executedPlan().toString().split("\n"))
    assert quality.audit(empty).count() == 0


def brute_fingerprint(t):
    w = WORD.findall(lower(t or ""))
    s = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        root[find(a)] = find(b)
    return [find(x) for x in range(n)]


def test_simhash_components(docs):
    rows = rows_of(docs)
    fp = [brute_fingerprint(t) for _, t in rows]
    root = groups_of(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if bin(fp[a] ^ fp[b]).count("1") <= 2])
    first = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root)}
    got = simhash.simhash_components(docs).collect()
    assert bag(got) == bag((rows[k][0], f"{fp[k]:016x}", first[root[k]]) for k in range(len(rows)))
    kept = simhash.one_per_component(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(first.values())


def test_links_at_two_bits_only(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(40)]
    fps += [x ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for x in fps] + [fps[0] ^ 7, fps[0] ^ (7 << 61)]
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    want = {tuple(sorted((simhash._signed(a), simhash._signed(b)))) for a in fps for b in fps if a != b and bin(a ^ b).count("1") <= 2}
    for blocks in (3, 4):
        assert {tuple(r) for r in simhash.links(df, 2, blocks).collect()} == want


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 501), (501, 502), (500, 502)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, 500: 500, 501: 500, 502: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_contamination(rows, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    patterns = defaultdict(set)
    for name, t in items:
        w = split(t)
        for k in range(max(1, len(w) - 12)) if w else ():
            patterns[tuple(w[k:k + 13])].add("" if name is None else str(name))
    sizes = {len(p) for p in patterns}
    for i, t in rows:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in patterns:
                    hit |= set(range(k, k + n))
                    found |= patterns[tuple(w[k:k + n])]
        yield (i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
               bool(hit) and 20 * len(hit) >= len(w))


def test_contamination(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "One!"), (901, None), (902, ""), (900, "one"), (None, "two WORDS"), (903, "same line here the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = bag(brute_contamination(rows_of(docs), items))
    assert bag(r[:6] for r in decontaminate.contamination(docs, bench).collect()) == want
    # a benchmark over the window bound is scanned in several passes, with the same result
    assert bag(r[:6] for r in decontaminate.contamination(docs, bench, max_windows=2000).collect()) == want
    assert Counter(r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()) == Counter(r[0] for r in want.elements() if not r[5])
    assert decontaminate.contamination(docs, bench.where("false")).where("n_hit > 0").count() == 0


def duck(query, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, pa.Table.from_pylist([r.asDict() for r in df.collect()], df.toArrow().schema))
    return bag(con.execute(query).fetchall())


def test_contamination_sql(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").union(spark.createDataFrame(
        [(900, "One!"), (901, None), (902, ""), (900, "one"), (None, "two WORDS"), (903, "same line here the")], "item_id long, text string"))
    got = decontaminate.contamination(docs, bench).drop("spans")
    assert bag(got.collect()) == duck(decontaminate.ORACLE, documents=docs, benchmark=bench)


def test_chat_sql(spark):
    rows = [(1, 0, "user", "a\nb <|x"), (1, 1, "assistant", "<|im_end|>\n<\\|im_sep|> <<|x %0A"), (1, 1, "assistant", None), (1, None, "assistant", "é"),
            (2, 0, "odd\nrole%25<|", "t"), (2, 0, "odd\nrole%25<|", "t"), (None, None, None, None), (3, 1, "assistant", "<|"), (3, 0, "user", "")]
    schema = "conv_id long, turn long, role string, text string"
    for turns in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema), spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")):
        got = chat.digests(chat.format_chat(turns.unionByName(chat.probe(spark))))
        assert bag(got.collect()) == duck(chat.ORACLE, conversations=turns)


def test_byte_spans_point_at_the_original():
    raw = "Ä b,  C-d".encode()
    assert [raw[a:b] for a, b in decontaminate.byte_spans(raw, [(0, 1), (2, 3)])] == ["Ä b".encode(), b"C-d"]


def test_chat_round_trip(spark):
    nasty = "<|im_end|>\n<\\|im_sep|> <<|x %0A"
    rows = [(1, 0, "user", "a\nb"), (1, 1, "assistant", nasty), (1, 2, "assistant", None), (1, 3, "assistant", "x"), (1, 4, "user", "<"),
            (2, 0, "odd\nrole%25<|", "t"), (2, 0, "odd\nrole%25<|", "t"), (None, None, None, None), (3, 1, "assistant", "<|"), (3, 0, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").unionByName(chat.probe(spark))
    rows += [(-1, k, r, "<|im_end|><|im_start|>assistant ok") for k, r in enumerate(("user", "assistant"))]
    want = defaultdict(list)
    for c, k, r, t in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        want[c].append((r or "", t or ""))
    formatted = chat.format_chat(turns)
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.parse_chat(formatted).collect()}
    assert got == want
    for r in formatted.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        runs = sum(1 for k, t in enumerate(want[r.conv_id]) if not k or t[0] != want[r.conv_id][k - 1][0])
        assert r.formatted.count("<|im_start|>") == runs == r.formatted.count("<|im_end|>")
    for r in chat.digests(formatted).collect():
        said = "".join(t for role, t in want[r.conv_id] if role == "assistant")
        text = "".join(f"{a}\n{b}\n" for a, b in want[r.conv_id])
        assert (r.n_turns, r.turns_sha256) == (len(want[r.conv_id]), hashlib.sha256(text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.format_chat(turns.where("false")).count() == 0


def test_sharding_law(docs):
    rows, got = rows_of(docs), sharding.shard(docs).collect()
    raw = [(t or "").encode() for _, t in rows]
    assert bag((r.doc_id, r.size, r.text_crc32) for r in got) == bag((i, len(b) + 1, zlib.crc32(b)) for (i, _), b in zip(rows, raw))
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in by.values())
    assert set(by) <= set(range(16)) and all(r.law == "bytes" and r.grown_shard is None for r in got)
    if got:
        total, most = sum(r.size for r in got), max(r.size for r in got)
        loads = [sum(r.size for r in by[s]) for s in range(16)]
        assert max(loads) <= total / 16 + most + total / 1600


def test_hot_key_is_subdivided(spark):
    df = spark.range(20000).selectExpr("id doc_id", "if(id % 3 = 0, 'same text everywhere', concat('text ', id)) text")
    loads = Counter()
    for r in sharding.shard(df).collect():
        loads[r.shard] += r.size
    assert len(loads) == 16 and max(loads.values()) < 1.03 * min(loads.values())


def test_many_tiny_rows_are_subdivided_and_stay_together(spark):
    """A third of the rows null (few bytes, many rows): no range takes them all, one shard holds them all."""
    df = spark.range(30000).selectExpr("id doc_id", "if(id % 3 = 0, null, concat(id, repeat(' long text', 800))) text")
    rows = sharding.sizes(df)
    total = rows.agg({"size": "sum"}).first()[0]
    ranged = rows.withColumn("r", sharding._range_of(sharding.boundaries(rows, total, 30000, 256)))
    assert ranged.groupBy("r").count().agg({"count": "max"}).first()[0] < 1000
    got = sharding.shard(df).collect()
    assert len({r.shard for r in got if r.size == 1}) == 1
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in by.values())
    loads = [sum(r.size for r in s) for s in by.values()]
    assert len(loads) == 16 and max(loads) < 1.03 * min(loads)


def test_mixing(docs):
    got = mixing.mixture(docs).collect()
    tokens = lambda t: len(WORD.findall(t or ""))
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    n = Counter()
    for _, s, t in rows:
        n[s] += tokens(t)
    drawn, epochs = Counter(), {}
    for r in got:
        drawn[r.source] += r.n_tokens
        epochs[r.source] = r.epochs
    assert all(1 <= e <= 2.000001 for e in epochs.values())
    for s, e in epochs.items():  # a budget is overrun by one unit at most
        most = max(x.n_tokens for x in got if x.source == s)
        assert e * n[s] - 1e-6 * n[s] <= drawn[s] < e * n[s] + max(most, 1)
    if rows:
        assert abs(sum({r.source: r.weight for r in got}.values()) - 1) < 1e-9
    first = Counter((r.doc_id, r.source) for r in got if r["pass"] == 0 for _ in range(r.n_rows))
    assert first == Counter((i, s) for i, s, _ in rows)  # every row once in the first pass
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.source) for r in out.collect()) == Counter((r.doc_id, r.source) for r in got for _ in range(r.n_rows))


def test_temperature_targets(spark):
    stats = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, n long")
    alpha, budget = mixing.temperature(stats, max_epochs=4.0)
    w = {s: n ** alpha for s, n in (("a", 1000), ("b", 100), ("c", 10))}
    assert abs(budget * w["c"] / sum(w.values()) / 10 - 4) < 1e-3 and abs(budget * w["a"] / sum(w.values()) - 1000) < 1e-6
    alpha, _ = mixing.temperature(stats, budget_tokens=500, entropy=0.8)
    p = [x ** alpha / sum(y ** alpha for y in (1000, 100, 10)) for x in (1000, 100, 10)]
    assert abs(-sum(x * math.log(x) for x in p) - 0.8) < 1e-3
    assert mixing.temperature(stats, max_epochs=1.0)[0] == pytest.approx(1.0)


def test_lm_scores(docs):
    rows, got = rows_of(docs), pst.score(docs, symbols=20, head=40).collect()
    toks = [WORD.findall(lower(t or "")) + ["\n"] for _, t in rows]
    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for t, o in zip(toks, out) if not o for w in t)
    n, v = sum(c.values()), len(c)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3], r[4], round(r[5], 3))
    want = sorted(((i, o, len(t), sum(1 for w in t if c[w]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
                   for (i, _), t, o in zip(rows, toks, out)), key=key)
    got = sorted(map(tuple, got), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) and g[6] <= 1e-9 for g, w in zip(got, want))


def brute_suffix_tree(rows):
    """Scores by a suffix tree over all words, its levels grown until none is retained."""
    toks = [WORD.findall(lower(t or "")) + ["\n"] for _, t in rows]
    train = [t for t, (i, _) in zip(toks, rows) if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t)
    n, once, twice = sum(c.values()), sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
    d = (once + 1) / (once + 2 * twice + 2)
    context = lambda t, i, k: tuple((["\n"] + t)[max(0, i + 1 - k):i + 1])
    tree, depth = {(): c}, 0
    while any(len(s) == depth for s in tree):
        depth += 1
        after = defaultdict(Counter)
        for t in train:
            for i, x in enumerate(t):
                if i + 1 >= depth and context(t, i, depth - 1) in tree:
                    after[context(t, i, depth)][x] += 1
        for s, nx in after.items():
            short = tree[s[1:]]
            gain = sum(k * math.log(k / sum(nx.values()) / (short[x] / sum(short.values()))) for x, k in nx.items())
            if gain > len(nx) / 2 * math.log(max(n, 2)):
                tree[s] = nx

    def log10(t, i):
        p = (c[t[i]] - d) / n if c[t[i]] else d * len(c) / n
        for k in range(1, i + 2):
            nx = tree.get(context(t, i, k))
            if nx is None:
                break
            p = (nx[t[i]] + pst.KAPPA * p) / (sum(nx.values()) + pst.KAPPA)
        return math.log10(p)
    return [sum(log10(t, i) for i in range(len(t))) for t in toks], tree


def test_lm_states_over_the_whole_vocabulary(spark):
    """More words than the 512 that contexts were made of, and states of more than two words."""
    rng = random.Random(5)
    names = [f"n{i}" for i in range(900)]
    rows = []
    for i in range(160):
        say = [f"{w} is{w}" for w in rng.sample(names, 30)]  # a rare word's next word
        say += [rng.choice(["a b c p", "a d c q", "e b c r"]) for _ in range(30)]  # known by three words only
        rng.shuffle(say)
        rows.append((i, " ".join(say) if i % 40 else None))
    rows += [(None, "a b c p n1 isn1"), (7, "A b\tnever c seen"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, tree = brute_suffix_tree(rows)
    assert len({w for s in tree for w in s}) > 512 and max(map(len, tree)) > 2
    key = lambda r: (str(r[0]), round(r[1], 4))
    want = sorted(((i, s) for (i, _), s in zip(rows, want)), key=key)
    for bounds in ({}, {"symbols": 20, "head": 3, "most_states": 5}, {"symbols": 0, "head": 0, "most_states": 0}):
        got = sorted(((r.doc_id, r.score) for r in pst.score(docs, **bounds).collect()), key=key)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1] for g in got] == pytest.approx([w[1] for w in want], rel=1e-9)


def test_suffix_tree_probabilities_sum_to_one(spark):
    text = "x m y z m w " * 40 + "d e"
    docs = spark.createDataFrame([(k, text) for k in range(12)], "doc_id long, text string")
    counts = {bytes(r.word): r.c for r in pst.word_counts(docs).collect()}
    head = sorted(counts, key=lambda w: (-counts[w], w))
    table = pst.Symbols(head, 512)
    n = sum(counts.values())
    roots = spark.createDataFrame([(i, counts[w]) for i, w in enumerate(head)] + [(len(head), 1)], "x long, n long")
    rows = [tuple(r) for r in pst.states(pst.ngram_counts(docs, table), roots, n).collect()]
    import numpy as np
    uni = pst.Unigrams(n, len(counts), 0, 0)
    p = uni.p(np.array([counts[w] for w in head]))
    tree = pst.Tree(len(head) + 1, np.append(p, 1 - p.sum()), rows)
    x = np.arange(len(head) + 1)
    for one in range(len(head)):
        for two in range(len(head)):
            assert (10 ** tree.log10(np.full_like(x, one), np.full_like(x, two), x)).sum() == pytest.approx(1)
    m, y, before = (table.number[w] for w in (b"m", b"y", b"x"))
    assert 10 ** tree.log10(np.array([m]), np.array([before]), np.array([y]))[0] > 0.9  # "x m" is followed by "y"
    assert any(r[1] >= 0 for r in rows)  # contexts of two are retained: "x m" against "m"


def test_subsequence_kernel_against_enumeration():
    from itertools import combinations

    def slow(s, t):
        f = lambda w: [(tuple(w[i] for i in at), at[-1] - at[0] + 1) for at in combinations(range(len(w)), 3)]
        return sum(toxicity.DECAY ** (a + b) for x, a in f(s) for y, b in f(t) if x == y)
    for s, t in (("idiot", "idxiot"), ("abcabc", "acb"), ("moron", "moron"), ("ab", "abc")):
        got = toxicity.subsequence_kernel(toxicity._codes([s]), toxicity._codes([t]))[0]
        assert got == pytest.approx(slow(s, t), rel=1e-4, abs=1e-7)


def test_toxicity_learns_and_tolerates_spellings(spark, odd, empty):
    rng = random.Random(1)
    vocabulary = ["river", "table", "music", "orange", "winter", "garden", "letter", "planet", "silver", "window"]
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(vocabulary) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            w[rng.randrange(40)] = w[rng.randrange(40)] = rng.choice(["numpty", "blockhead"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, lab).collect()}
    held = [i for i in got if got[i].held_out]
    assert held == [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == labels[i][1] for i in held) >= 0.95 * len(held)
    model = toxicity.train(docs, lab)
    plain = " ".join(vocabulary * 3)
    s = model.scores([plain.encode(), *(f"{plain} {x} {x}".encode() for x in ("num-pty", "n u m p t y", "nuumpty", "NUMPTY"))])
    assert s[0] < 0.5 and all(x > 0.5 for x in s[1:])
    assert toxicity.score_with(model, odd).where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.toxicity(odd, lab.where("false")).select("score").distinct().collect()[0][0] == 0
    assert toxicity.toxicity(empty, lab).count() == 0


def brute_passages(rows, n=200):
    seen = Counter(b[k:k + n] for b in rows for k in range(len(b) - n + 1))
    for b in rows:
        gone = set()
        for k in range(len(b) - n + 1):
            if seen[b[k:k + n]] > 1:
                gone |= set(range(k, k + n))
        kept = bytes(x for k, x in enumerate(b) if k not in gone)
        yield len(b), len(gone), sum(1 for k in gone if k - 1 not in gone), hashlib.sha256(kept).hexdigest()


@pytest.fixture(scope="module")
def passages(spark):
    rng = random.Random(5)
    say = lambda n: " ".join("".join(rng.choices("abcdeé ", k=6)) for _ in range(n // 7))
    shared = [say(m) for m in (150, 199, 205, 260, 900)]
    rows = [(i, say(rng.randrange(0, 700)) + rng.choice(shared) + say(rng.randrange(0, 300)) + rng.choice(shared)) for i in range(60)]
    rows += [(100, "z" * 1000), (101, rows[0][1]), (101, rows[0][1]), (None, None), (102, ""), (103, shared[4] * 3), (104, rows[1][1][:-3] + "!" + rows[1][1][-3:])]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("batches", [1, 2, 5])  # five batches merge levels
def test_repeated_passages(passages, batches):
    rows = rows_of(passages)
    want = bag((i, *x) for (i, _), x in zip(rows, brute_passages([(t or "").encode() for _, t in rows])))
    assert bag(suffix_family.repeated_passages(passages, batches).collect()) == want


def test_repeated_passages_on_odd_rows(odd, empty, monkeypatch):
    monkeypatch.setattr(suffix_family, "_PIECE", 5000)  # long texts in several pieces
    rows = rows_of(odd.where("doc_id <> 8 or doc_id is null"))
    want = bag((i, *x) for (i, _), x in zip(rows, brute_passages([(t or "").encode() for _, t in rows])))
    assert bag(suffix_family.repeated_passages(odd.where("doc_id <> 8 or doc_id is null")).collect()) == want
    long = suffix_family.repeated_passages(odd.where("doc_id = 8")).first()
    assert (long.n_removed, long.n_spans) == (long.n_bytes, 1)
    assert suffix_family.repeated_passages(empty).count() == 0


@pytest.mark.parametrize("copies", [40, 300, 900])
def test_rows_of_a_shared_passage_follow_its_copies(spark, monkeypatch, copies):
    rng = random.Random(8)
    say = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = say(700)
    # one class per document at both ends, and some ends that a few documents share
    rows = [(i, say(300) + passage[(i % 3) * 20:700 - (i % 5) * 7] + say(300)) for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes, table = [], suffix_family.written

    def spy(df):
        out = table(df)
        sizes.append(out.count() if "whole" in out.columns else 0)
        return out
    monkeypatch.setattr(suffix_family, "written", spy)
    want = bag((i, *x) for (i, _), x in zip(rows, brute_passages([t.encode() for _, t in rows])))
    assert bag(suffix_family.repeated_passages(docs).collect()) == want
    assert 0 < max(sizes) <= 4 * suffix_family.SPLIT * copies  # of some 300 windows at either end


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j] + 1, row[j + 1] + 1, last + (x != y))
    return row[-1]


def brute_lines(spark, rows, max_bits):
    units = sorted({(i is None, i, t) for i, t in rows}, key=lambda x: (x[0], x[1] or 0, x[2] or ""))
    spots = []  # (unit, position, words)
    for u, (_, _, t) in enumerate(units):
        for pos, line in enumerate((t or "").split("\n")):
            w = [x for x in line.strip("\r").lower().split(" ") if x]
            if w:
                spots.append((u, pos, w))
    words = sorted({x for *_, w in spots for x in w})
    hashed = {r.w: r.h & (1 << 64) - 1 for r in spark.createDataFrame([(x,) for x in words], "w string").selectExpr("w", "xxhash64(w) h").collect()} if words else {}
    order = {r[0]: r[1] for r in spark.createDataFrame([(k, u[2]) for k, u in enumerate(units)], "k long, t string").selectExpr("k", "xxhash64(t)").collect()} if units else {}

    def fp(w):
        s = set(w)
        return sum(1 << b for b in range(64) if 2 * sum(hashed[x] >> b & 1 for x in s) > len(s))
    kinds = sorted({tuple(w) for *_, w in spots})
    fps = [fp(w) for w in kinds]
    near = [(a, b) for a in range(len(kinds)) for b in range(a) if (max_bits is None or bin(fps[a] ^ fps[b]).count("1") <= max_bits)
            and 0.8 * max(len(kinds[a]), len(kinds[b])) <= min(len(kinds[a]), len(kinds[b])) + 1e-9 and _distance(kinds[a], kinds[b]) <= 0.2 * max(len(kinds[a]), len(kinds[b])) + 1e-9]
    root = dict(zip(kinds, groups_of(len(kinds), near)))
    place = lambda s: (units[s[0]][0], units[s[0]][1] or 0, order[s[0]], s[1])
    best = {}
    for s in spots:
        r = root[tuple(s[2])]
        best[r] = min(best.get(r, place(s)), place(s))
    gone = defaultdict(list)
    for s in spots:
        if place(s) != best[root[tuple(s[2])]]:
            gone[units[s[0]][1:]].append(s[1])
    return gone


@pytest.mark.parametrize("max_bits", [None, 2])
def test_line_dedup(spark, docs, max_bits):
    docs = docs.where("coalesce(doc_id, 0) not in (8)").limit(60) if docs.count() > 60 else docs.where("doc_id <> 8 or doc_id is null")
    rows = rows_of(docs)
    gone = brute_lines(spark, rows, max_bits)
    got = line_dedup.line_dedup(docs, max_bits).collect()
    key = lambda r: str(r)
    want = sorted(((i, (t or "").count("\n") + 1, len(gone[(i, t)]), sorted(gone[(i, t)])) for i, t in rows), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want
    cleaned = line_dedup.drop_lines(docs, max_bits)
    assert cleaned.columns == docs.columns
    assert Counter((r.doc_id, (r.text or "").count("\n")) for r in cleaned.collect()) == Counter(
        (i, max((t or "").count("\n") - len(gone[(i, t)]), 0)) for i, t in rows)


def test_lines_link_by_edit_similarity_alone(spark, tmp_path):
    """Against all pairs of lines, without any filter: replaced, dropped and added words."""
    rng = random.Random(11)
    lines = []
    for n in (3, 4, 5, 6, 9, 10, 14, 15, 20, 29, 40, 100):
        for _ in range(6):
            base = [f"w{rng.randrange(300)}" for _ in range(n)]
            lines.append(base)
            for _ in range(3):  # as many edits as the rule allows, or one more
                w = list(base)
                for _ in range(n // 5 + rng.randrange(2)):
                    k = rng.randrange(len(w))
                    w[k:k + 1] = rng.choice(([], ["new"], [w[k], "more"]))
                lines.append(w)
    lines += [[rng.choice("01") for _ in range(12)] for _ in range(30)]  # few different words
    lines = [w for w in lines if w]
    rng.shuffle(lines)
    kinds = sorted({tuple(w) for w in lines})
    linked = [(a, b) for a in range(len(kinds)) for b in range(a)
              if _distance(kinds[a], kinds[b]) <= 0.2 * max(len(kinds[a]), len(kinds[b])) + 1e-9]
    root = dict(zip(kinds, groups_of(len(kinds), linked)))
    first = {}
    for i, w in enumerate(lines):
        first.setdefault(root[tuple(w)], i)
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(lines)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id for r in queries.op2_line_dedup(spark, str(tmp_path)).where("n_removed = 1").collect()}
    assert len(linked) > 150 and got == set(range(len(lines))) - set(first.values())


def test_lines_are_spelled_once(spark, monkeypatch):
    """A text's candidate lines are not taken from it one by one, which splits it once for each."""
    def again(*args):
        raise AssertionError("a text is split for each of its lines")
    monkeypatch.setattr(line_dedup, "_nodes", again)
    lines = [f"a{i} b{i} c{i} d{i} e{i}" for i in range(300)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(x.replace(" e", " other") for x in lines)), (3, "A7 b7 c7 d7 e7\nnew")], "doc_id long, text string")
    assert {r.doc_id: r.removed for r in line_dedup.line_dedup(docs).collect()} == {1: [], 2: list(range(300)), 3: [0]}


def test_unlike_lines_of_a_frequent_word_pair_are_not_compared(spark):
    """Parities of words miss no pair within the rule's edits, and form few of the others."""
    from pyspark.sql import functions as F
    rng = random.Random(5)
    lines = [["of", "the"] + [f"w{rng.randrange(5000)}" for _ in range(18)] for _ in range(150)]
    for w in lines[:50]:
        near = list(w)
        for _ in range(4):
            k = rng.randrange(len(near))
            near[k:k + 1] = rng.choice(([], ["new"], [near[k], "more"]))
        lines.append(near)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(lines)], "doc_id long, text string")
    rows = line_dedup._spelled_lines(docs, 0.8).select(F.lit(0).alias("key"), "doc_id", "h", "n", "s", F.col("h").alias("root"), F.lit(True).alias("apart"))
    rooted = rows.join(line_dedup._parities(rows), "h").drop("doc_id", "s")
    number = {r.h: r.doc_id for r in rows.collect()}
    got = {frozenset((number[r.h1], number[r.h2])) for r in line_dedup._left_over(rooted, 0.8).collect()}
    linked = {frozenset((a, b)) for a in range(len(lines)) for b in range(a)
              if _distance(lines[a], lines[b]) <= 0.2 * max(len(lines[a]), len(lines[b])) + 1e-9}
    assert len(linked) >= 40 and linked <= got and len(got) < 200  # of 19,900


def test_ngrams_are_shuffled_once_for_counts_and_shorter_ngrams(spark):
    docs = spark.createDataFrame([(i, f"a b c{i % 5} a b") for i in range(40)], "doc_id long, text string")
    texts = pst.encoded(docs, pst.Symbols([b"a", b"b", pst.END], 3))
    short = spark.range(10).selectExpr("id as short", "id as p")
    joined = pst.gram_counts(texts, 2, 2, None).join(short.hint("merge"), "short")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2


def test_shuffle_files_go_when_a_table_is_written(spark):
    """They are removed with the write, not when the driver happens to collect its garbage."""
    import time
    from threatlake.llm.components import written
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}
    before = files()
    rows = written(spark.range(1000).repartition(5, "id"))
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left and rows.count() == 1000


def test_line_simhash_of_long_lines(spark, monkeypatch):
    line = " ".join(f"w{i}" for i in range(500))
    docs = spark.createDataFrame([(1, line)], "doc_id long, text string")
    whole = line_dedup._lines(docs).first().fp
    monkeypatch.setattr(line_dedup, "_MOST", 63)  # the same through sums of parts
    assert line_dedup._lines(docs).first().fp == whole


def test_pipeline_against_its_parts(spark):
    import corpus_pipeline
    got = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in quality.quality_rules(docs).where("kept").collect()}
    rows = [(i, t) for i, t in rows_of(docs) if i in kept]
    fp = [brute_fingerprint(t) for _, t in rows]
    root = groups_of(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if bin(fp[a] ^ fp[b]).count("1") <= 2])
    first = {}
    for (i, _), r in zip(rows, root):
        first[r] = min(i, first.get(r, i))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute_contamination([(i, t) for i, t in rows if i in first.values()], bench) if not r[5]}
    assert {r.doc_id for r in got} == clean
    assert max(Counter(r.doc_id for r in got).values()) <= 2 and len({r.shard for r in got}) == 16
    assert len(corpus_pipeline.STAGES) == 5

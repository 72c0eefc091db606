"""Conversation structure repair by iterative-deepening A*.

A conversation's rows stand in turn order (null turns first; ties: role, text). Its repair is the
cheapest sequence of edits after which the role initials read ``(s?(ua)+)?``: Keep costs 0,
Rerole to user or assistant 3, Delete 4, Insert of an empty user or assistant turn 3; blank and
duplicate rows must be deleted, a truncated row that stays adds 3. The grammar has four states
(start, after s, after u, after a), and a state leaves one role only that an Insert or Rerole can
give, so a sequence of edit initials fixes the repaired conversation. ``search`` walks the edits
depth first in ASCII order (D, I, K, R) under a cost bound that rises to the least cost just
beyond it; states (row, grammar state) that failed keep the cost they are known to need, so they
fail at once until the bound allows more. Its first accepting path is the answer: the cheapest,
and of the cheapest the first in ASCII order.

Scale: one conversation may hold a third of all rows, so no task gathers one. Rows are sorted
over all tasks (ranges, so a conversation may span many) and cut into chunks of at most
``CHUNK`` rows of one conversation. A conversation of one chunk is one search. For longer ones
every chunk is searched on its own: first for the cost between each two grammar states, then,
these costs added from the conversation's end, for its path from each state on to the end. Only
a few numbers per chunk pass in order through one task, as a stream. An insert belongs to the
row after it, so no chunk's path is the beginning of another's, and the first paths in ASCII
order of the chunks make the first one of the conversation.

Null ids are one conversation; null roles and texts are one space, as are null ids and turns
in the key of ``damage``. A role counts by its first character; an empty role has none and can't
be kept. Repeated rows are further turns. A conversation without rows is repaired already. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threatlake.llm.components import written

CHUNK_BITS = 5
CHUNK = 1 << CHUNK_BITS
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_WHITE = " \t\n\x0b\x0c\r"

# Grammar states: 0 start, 1 after s, 2 after u, 3 after a.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_GIVEN = ("u", "u", "a", "u")  # what an Insert or Rerole gives in a state
_CLOSING = ("", "II", "I", "")  # edits that end a conversation in a state
ENDS = tuple(INSERT * len(x) for x in _CLOSING)


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row,
    1 empties its text, 2 removes its end marks, 3 repeats it, 4 makes its role user."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    out = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return (out.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.array_repeat(F.lit(1), times).alias("copies"))
            .withColumn("copies", F.explode("copies")).drop("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault, pos) of every row: fault is its first of b(lank),
    d(uplicate), t(runcated), or -; pos grows in conversation order."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    # Rows equal in all four are counted first, then all but the first of equal role and text are duplicates.
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").cast("int").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("timed"), F.col("turn"))
    marked = equal.select("*", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256).alias("said"))
    first = (marked.groupBy(F.col("conv_id").alias("c"), F.col("said").alias("s")).agg(F.min(place).alias("first"), F.count("*").alias("again"))
             .where("again > 1").drop("again"))
    met = marked.join(first, marked["conv_id"].eqNullSafe(first["c"]) & (marked["said"] == first["s"]), "left")
    copies = met.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "n")).alias("copy"),
                        F.coalesce(place != F.col("first"), F.lit(False)).alias("later"))
    last = F.substring(F.rtrim("text", F.lit(_WHITE)), -1, 1)
    fault = (F.when(last == "", "b").when(F.col("later") | (F.col("copy") > 1), "d")
             .when(~last.isin(".", "!", "?"), "t").otherwise("-"))
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("copy")]
    return (copies.orderBy(*order).withColumn("pos", F.monotonically_increasing_id())
            .select("conv_id", "turn", "role", "text", fault.alias("fault"), "pos"))


def search(symbols: str, state: int, ends: tuple) -> tuple[float, str, int]:
    """(cost, edits, grammar state after them) of the cheapest path over rows from a state on;
    ``symbols`` has two characters a row, role initial and fault; ``ends`` is what each state
    still costs after the last row (infinite: not allowed)."""
    rows = [(symbols[i], symbols[i + 1]) for i in range(0, len(symbols), 2)]
    rest, least = [min(ends)], {"b": DELETE, "d": DELETE, "t": TRUNCATED, "-": 0}
    for _, fault in reversed(rows):
        rest.append(rest[-1] + least[fault])
    rest.reverse()
    need: dict[tuple[int, int], float] = {}  # failed states: cost that a path from them is known to need

    def edits(i: int, state: int) -> Iterator[tuple]:
        initial, fault = rows[i]
        given = _NEXT[state][_GIVEN[state]]
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, given
        if fault not in "bd":
            late = TRUNCATED if fault == "t" else 0
            if initial in _NEXT[state]:
                yield "K", late, i + 1, _NEXT[state][initial]
            yield "R", REROLE + late, i + 1, given

    def walk(i: int, state: int, bound: float) -> tuple[str, int] | None:
        if i == len(rows):
            if ends[state] <= bound:
                return "", state
            need[i, state] = ends[state]
            return None
        least = inf
        for edit, cost, j, then in edits(i, state):
            if cost + need.get((j, then), rest[j]) <= bound:
                found = walk(j, then, bound - cost)
                if found is not None:
                    return edit + found[0], found[1]
            least = min(least, cost + need.get((j, then), rest[j]))
        need[i, state] = least
        return None

    bound = rest[0]
    while (found := walk(0, state, bound)) is None:
        bound = need[0, state]
    return bound, *found


def crossing(symbols: str) -> list[list[float]]:
    """Cost of a chunk from each grammar state to each."""
    def reached(a: int, b: int) -> bool:
        return b > 1 or a == b or (a, b) == (0, 1) and any(symbols[i] == "s" and symbols[i + 1] not in "bd" for i in range(0, len(symbols), 2))
    return [[search(symbols, a, tuple(0 if x == b else inf for x in range(4)))[0] if reached(a, b) else inf for b in range(4)]
            for a in range(4)]


def _mapped(fn: Callable, ddl: str, *args: Column) -> Column:
    """A struct column of ``fn`` per row."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(ddl)
    fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields]

    @F.arrow_udf(returnType=schema)
    def run(*columns: pa.Array) -> pa.Array:
        cols = list(zip(*[fn(*row) for row in zip(*(c.to_pylist() for c in columns))])) or [()] * len(fields)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields)], fields=fields)
    return run(*args)


def _streamed(df: DataFrame, fn: Callable, ddl: str, *order: Column) -> DataFrame:
    """Rows of each conversation in order through ``fn(rows)``, an iterator over tuples that
    yields tuples; a task holds one batch at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        held = []
        for out in fn(rows):
            held.append(out)
            if len(held) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, ddl)


def _backwards(rows):
    """(conv_id, chunk, symbols, cost) from the last chunk to the first -> each with the cost
    from every grammar state after it to the conversation's end."""
    conv, ends = object(), ENDS
    for conv_id, chunk, symbols, cost in rows:
        if conv_id != conv:
            conv, ends = conv_id, ENDS
        yield conv_id, chunk, symbols, list(ends)
        ends = tuple(min(c + e for c, e in zip(line, ends)) for line in cost)


def _paths(symbols: str, ends: list) -> tuple:
    """Costs, edits and last states of the cheapest path from each grammar state."""
    return tuple(zip(*[search(symbols, state, tuple(ends)) for state in range(4)]))


def _forwards(rows):
    """Chunks in order -> each with the state it starts in, its path from there and the cost on."""
    conv, state = object(), 0
    for conv_id, chunk, symbols, cost, path, then in rows:
        if conv_id != conv:
            conv, state = conv_id, 0
        yield conv_id, chunk, symbols, cost[state], path[state], state, then[state]
        state = then[state]


_SOLVED = "conv_id {id}, chunk long, symbols string, cost double, path string, state int, then int"


def solve(marked: DataFrame) -> DataFrame:
    """(conv_id, chunk, symbols, cost, path, state, then, start, last) of every chunk of the rows of
    ``faults``: the position of its first row, its rows, the cost from there to the end, the edits of
    its rows, the grammar states before and after; start and last are the conversation's chunks."""
    kind = marked.schema["conv_id"].dataType.simpleString()
    symbol = F.concat(F.rpad(F.substring("role", 1, 1), 1, "-"), F.col("fault"))
    in_order = F.sort_array(F.collect_list(F.struct("pos", symbol.alias("s"))))  # CHUNK rows at most
    chunks = written(marked.groupBy("conv_id", F.shiftright("pos", CHUNK_BITS).alias("k"))
                     .agg(F.min("pos").alias("chunk"), F.array_join(F.transform(in_order, lambda x: x["s"]), "").alias("symbols")).drop("k"))
    spans = chunks.groupBy(F.col("conv_id").alias("c")).agg(F.min("chunk").alias("start"), F.max("chunk").alias("last"))
    spanned = chunks.join(spans, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    short = spanned.where("start = last").withColumn(
        "x", _mapped(lambda s: search(s, 0, ENDS), "cost double, path string, then int", F.col("symbols")))
    short = short.select("conv_id", "chunk", "symbols", "x.cost", "x.path", F.lit(0).alias("state"), "x.then")
    long = spanned.where("start < last").select("conv_id", "chunk", "symbols", _mapped(
        lambda s: (crossing(s),), "cost array<array<double>>", F.col("symbols"))["cost"].alias("cost"))
    back = _streamed(long, _backwards, f"conv_id {kind}, chunk long, symbols string, ends array<double>", F.desc("chunk"))
    paths = back.select("conv_id", "chunk", "symbols", _mapped(
        _paths, "cost array<double>, path array<string>, then array<int>",
        F.col("symbols"), F.col("ends")).alias("x")).select("conv_id", "chunk", "symbols", "x.cost", "x.path", "x.then")
    done = short.union(_streamed(paths, _forwards, _SOLVED.format(id=kind), F.asc("chunk")))
    return written(done.join(spans, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c"))


def _turns(symbols: str, path: str, state: int, then: int, last: bool) -> tuple:
    """The repaired turns of a chunk: (row, given role); row is the number of the kept row in the
    chunk, null for an inserted turn; the role is null where the row keeps its own. With them the
    edits, closing inserts included."""
    out, row = [], 0
    closing = _CLOSING[then] if last else ""
    for edit in path + closing:
        if edit == "D":
            row += 1
            continue
        role = symbols[2 * row] if edit == "K" else _GIVEN[state]
        out.append((None if edit == "I" else row, None if edit == "K" else "user" if role == "u" else "assistant"))
        row += edit != "I"
        state = _NEXT[state][role]
    return out, path + closing


def _turns_of(field: str) -> Column:
    """``turns`` or ``edits`` of the chunks of ``solve``."""
    return _mapped(_turns, "turns array<struct<row:int,role:string>>, edits string", *[F.col(c) for c in ("symbols", "path", "state", "then")],
                   F.col("chunk") == F.col("last"))[field]


def repaired(marked: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv_id, chunk, nr, edit, role, text): the repaired turns, in the order of (chunk, nr)."""
    rows = solved.select("conv_id", "chunk", F.posexplode(_turns_of("turns")).alias("nr", "x")).select("conv_id", "chunk", "nr", "x.row", "x.role")
    rows = rows.withColumn("edit", F.when(F.col("row").isNull(), "I").when(F.col("role").isNull(), "K").otherwise("R"))
    # A chunk's rows have gapless positions from the chunk's own on.
    own = marked.select("pos", F.col("role").alias("was"), "text")
    kept = rows.where("row is not null").join(own, F.col("chunk") + F.col("row") == F.col("pos"))
    names = ["conv_id", "chunk", "nr", "edit"]
    return (kept.select(*names, F.coalesce("role", "was").alias("role"), "text")
            .union(rows.where("row is null").select(*names, "role", F.lit(""))))


def _hashed(rows):
    """(conv_id, role, text) in order -> (conv_id, digest) per conversation."""
    conv, digest = object(), None
    for conv_id, role, text, _, _ in rows:
        if conv_id != conv:
            if digest:
                yield conv, digest.hexdigest()
            conv, digest = conv_id, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(f"{role}:{text}".encode())
    if digest:
        yield conv, digest.hexdigest()


def _audited(rows):
    """Chunks in order -> (conv_id, illegal, cost, audit) per conversation."""
    conv, out, illegal, before, first = object(), [], 0, None, 0.0
    for conv_id, symbols, edits, cost, _ in rows:
        if conv_id != conv:
            if out:
                yield conv, illegal, int(first), "".join(out)
            conv, out, illegal, before, first = conv_id, [], 0, None, cost
        out.append(edits)
        initials = ([] if before is None else [before]) + list(symbols[::2])
        illegal += sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        before = initials[-1]
    if out:
        yield conv, illegal, int(first), "".join(out)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For conversations (conv_id, turn, role, text): one report row per conversation (conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit), and the repaired turns."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    marked = written(faults(rows))
    solved = solve(marked)
    count = lambda f: F.count_if(F.col("fault") == f)
    held = marked.groupBy("conv_id", "turn").agg(*[count(f).alias(f"n{f}") for f in "bdt"])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    tally = held.groupBy(F.col("conv_id").alias("c")).agg(
        gaps.alias("gaps"), *[F.sum(f"n{f[0]}").alias(f) for f in ("blank", "duplicate", "truncated")])
    chunks = solved.select("conv_id", "symbols", _turns_of("edits").alias("edits"), "cost", "chunk")
    audit = _streamed(chunks, _audited, f"conv_id {kind}, illegal long, cost long, audit string", F.asc("chunk"))
    report = audit.join(tally, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, repaired(marked, solved)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the SHA-256 of ``role:text`` of the repaired turns, joined by newlines."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    return _streamed(turns.select("conv_id", "role", "text", "chunk", "nr"), _hashed, f"conv_id {kind}, repaired_sha256 string", F.asc("chunk"), F.asc("nr"))


def audit(original: DataFrame, rows: DataFrame) -> DataFrame:
    """The report, and the digest of the repair of ``rows``, for every conv_id of ``original``."""
    report, turns = repair(rows)
    ids = original.select("conv_id").distinct()
    report, sha = (d.withColumnRenamed("conv_id", k) for d, k in ((report, "_r"), (digests(turns), "_s")))
    out = ids.join(report, F.col("conv_id").eqNullSafe(F.col("_r")), "left").join(sha, F.col("conv_id").eqNullSafe(F.col("_s")), "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c)
                                   for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))

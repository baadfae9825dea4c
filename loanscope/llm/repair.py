"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation's turns must have role initials ``(s?(ua)+)?``.  Walking over its rows, the part told so far is in one of
four states: nothing yet, a system turn, a user turn, an assistant turn.  A row is kept (K), rerolled to
user or assistant (R) or deleted (D), and empty user or assistant turns are inserted (I) before rows or at the end;
in a state, the role of an R or I follows from it, so an audit (the edits' letters) tells the whole repair.
Each row is a 4 x 4 matrix of cheapest costs from the state before to the state after it (inserts before the row
count to it, so every entry's letters end with K, R or D), along with the order of their letters among the states after.
None of these strings is a prefix of another of the same rows, so the order of two concatenations is
that of their first parts unless those are equal: orders compose like costs.

To find the audit-least optimal path, the forward vector (cost and order of the four states) from the start and the backward
vector (cost) from the end meet at the middle row; among the states with the least sum the first in order is crossed; both halves
are solved alike.  That needs memory in proportion to the rows of one block only.

A block is a run of at most ``BLOCK`` rows in the order of one sort by range over all conversations, so a conversation that
holds a large part of all rows is dealt over tasks.  Blocks of a conversation are multiplied to one matrix each, these
to matrices of ``FAN`` blocks and so on until one is left (most conversations are a single block at once);
the same divide and conquer then gives the states between blocks, from the top down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanscope.llm.common import bound_batches, land
from loanscope.session import ship_package
from loanscope.sources.tables import read_table

BLOCK_BITS = 12  # rows of a block, as a power of two
FAN_BITS = 10  # blocks under one matrix of the level above
HELD = 1 << 16  # rows of blocks whose edits a task holds at a time
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
FAULTS = ("", "truncated", "blank", "duplicate")
INITIALS = "sua"
FAR = 1 << 40  # no way
LEGAL = {"su", "ua", "au"}

Step = tuple[tuple[int, ...], tuple[int, ...]]  # costs and orders, 16 each, [4 * before + after]


def spoken(state: int) -> str:
    """Initial of the turn that an insert or a new role makes in ``state``."""
    return "a" if state == USER else "u"


def after(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def letter(fault: int, initial: int) -> str:
    return chr(65 + 4 * fault + initial)


@lru_cache(maxsize=None)
def row_ways(kind: str) -> dict[tuple[int, int], tuple[int, str, str]]:
    """For a row of ``kind`` (``letter``): (before, after) to (cost, edits, what they say: u or a, = for the row's own role)."""
    fault, initial = divmod(ord(kind) - 65, 4)
    own = (INITIALS + "?")[initial]
    extra = TRUNCATED if fault == 1 else 0
    ways: dict[tuple[int, int], tuple[int, str, str]] = {}
    for before, inserts in product(STATES, range(3)):  # more inserts come back to a state
        state, says = before, ""
        for _ in range(inserts):
            says += spoken(state)
            state = after(state, says[-1])
        options = [(state, DELETE, "D", "")]
        if fault < 2:
            role = spoken(state)
            options.append((after(state, role), REROLE + extra, "R", role))
            options.append((after(state, own), KEEP + extra, "K", "="))
        for to, cost, edit, told in options:
            way = (cost + INSERT * inserts, "I" * inserts + edit, says + told)
            if to is not None and way < ways.get((before, to), (FAR,)):
                ways[before, to] = way
    return ways


@lru_cache(maxsize=None)
def row_step(kind: str) -> Step:
    ways = row_ways(kind)
    costs = [ways.get((b, a), (FAR,))[0] for b in STATES for a in STATES]
    orders = []
    for b in STATES:
        edits = sorted(ways[b, a][1] for a in STATES if (b, a) in ways)
        orders += [edits.index(ways[b, a][1]) if (b, a) in ways else 9 for a in STATES]
    return tuple(costs), tuple(orders)


def ending(state: int) -> str:
    """Inserts after the last row that end a conversation in ``state`` well."""
    return {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def enter(state: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Forward vector at the start: costs and orders of the four states."""
    return tuple(0 if s == state else FAR for s in STATES), tuple(0 if s == state else 9 for s in STATES)


def forward(costs: tuple, orders: tuple, step: Step) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The forward vector one step on; costs relative to the least, which ``least`` of the sum leaves as it is."""
    found = []
    for a in STATES:
        best = (FAR, 9, 9)
        for b in STATES:
            if costs[b] < FAR and step[0][4 * b + a] < FAR:
                best = min(best, (costs[b] + step[0][4 * b + a], orders[b], step[1][4 * b + a]))
        found.append(best)
    reached = sorted(f[1:] for f in found if f[0] < FAR)
    return tuple(f[0] for f in found), tuple(reached.index(f[1:]) if f[0] < FAR else 9 for f in found)


def backward(costs: tuple, step: Step) -> tuple[int, ...]:
    return tuple(min(min(step[0][4 * b + a] + costs[a] for a in STATES), FAR) for b in STATES)


@lru_cache(maxsize=1 << 16)
def forward_row(costs: tuple, orders: tuple, kind: str) -> tuple[int, tuple, tuple]:
    costs, orders = forward(costs, orders, row_step(kind))
    least = min(costs)
    return least, tuple(c - least if c < FAR else FAR for c in costs), orders


@lru_cache(maxsize=1 << 16)
def backward_row(costs: tuple, kind: str) -> tuple[int, ...]:
    costs = backward(costs, row_step(kind))
    least = min(costs)
    return tuple(c - least if c < FAR else FAR for c in costs)


def run_forward(steps, low: int, high: int, state: int) -> tuple[int, tuple, tuple]:
    """(base, costs above it, orders) after the steps from ``state``."""
    base, (costs, orders) = 0, enter(state)
    for i in range(low, high):
        if isinstance(steps[i], str):
            least, costs, orders = forward_row(costs, orders, steps[i])
        else:
            costs, orders = forward(costs, orders, steps[i])
            least = min(costs)
            costs = tuple(c - least if c < FAR else FAR for c in costs)
        base += least
    return base, costs, orders


def run_backward(steps, low: int, high: int, costs: tuple) -> tuple[int, ...]:
    for i in range(high - 1, low - 1, -1):
        costs = backward_row(costs, steps[i]) if isinstance(steps[i], str) else backward(costs, steps[i])
    return costs


def product_of(steps) -> Step:
    """One step for all of ``steps``."""
    costs, orders = [], []
    for state in STATES:
        base, c, o = run_forward(steps, 0, len(steps), state)
        costs += [base + x if x < FAR else FAR for x in c]
        orders += o
    return tuple(costs), tuple(orders)


def crossings(steps, start: int, end: int) -> list[int]:
    """States before each step and after the last one on the audit-least of the cheapest ways from ``start`` to ``end``."""
    states = [start] * len(steps) + [end]
    halves = [(0, len(steps))]
    while halves:
        low, high = halves.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        _, ahead, order = run_forward(steps, low, middle, states[low])
        behind = run_backward(steps, middle, high, enter(states[high])[0])
        states[middle] = min((ahead[s] + behind[s], order[s], s) for s in STATES)[2]
        halves += [(low, middle), (middle, high)]
    return states


def last_state(steps) -> int:
    """State after the last row on the audit-least of the cheapest repairs."""
    _, costs, orders = run_forward(steps, 0, len(steps), NOTHING)
    return min((costs[s] + INSERT * len(ending(s)), orders[s], s) for s in STATES)[2]


# Spark: rows to kinds, kinds to blocks, blocks to states, states to edits.

def conversation_key(conv_id: Column) -> Column:
    return F.when(conv_id.isNull(), "").otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def identified_rows(rows: DataFrame) -> DataFrame:
    """key, conv_id, turn, at (turn as text, null as ''), role, text, same: a digest of conversation, role and text.

    Null role and text are one space."""
    role, text = F.coalesce(rows["role"], F.lit(" ")), F.coalesce(rows["text"], F.lit(" "))
    key = conversation_key(rows["conv_id"])
    same = F.unhex(F.sha2(F.concat(F.sha2(key, 256), F.sha2(text, 256), role), 256))
    return rows.select(key.alias("key"), "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("at"),
                       role.alias("role"), text.alias("text"), same.alias("same"))


def marked_rows(rows: DataFrame) -> DataFrame:
    """Rows in order, without texts: key, conv_id, turn, at, role, same, fault, kind, place (a number that
    grows along each conversation by turn, nulls first, then role and text's digest)."""
    r = identified_rows(rows)
    core = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    r = r.select("key", "conv_id", "turn", "at", "role", "same", (core == "").alias("blank"), (~F.right(core, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    # Rows alike in one turn are one row with a count, added up before the shuffle.
    alike = ("key", "same", "at", "conv_id", "turn", "role", "blank", "cut")  # the first three settle the others
    once = land(r.groupBy(*alike).agg(F.count("*").alias("n")), "repair-rows")
    rank = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    said_again = once.groupBy("key", "same").agg(F.min(rank).alias("first"), F.count("*").alias("turns")).filter("turns > 1").drop("turns")
    # Counts to rows in two steps, so that no array holds them all.
    told = once.join(said_again, ["key", "same"], "left").withColumn("h", F.explode(F.expr("sequence(0L, (n - 1) div 65536)")))
    told = told.withColumn("i", F.explode(F.expr("sequence(h * 65536, least(n - 1, h * 65536 + 65535))")))
    again = (F.col("i") > 0) | F.coalesce(rank != F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), 2).when(again, 3).when(F.col("cut"), 1).otherwise(0)
    initial = F.instr(F.lit(INITIALS), F.left("role", F.lit(1)))
    initial = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    told = told.withColumn("fault", F.get(F.array(*[F.lit(f) for f in FAULTS]), fault)).withColumn("kind", F.char((65 + 4 * fault + initial).cast("long")))
    order = ["key", F.asc_nulls_first("turn"), "role", "same", "i"]
    placed = told.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    return land(placed.select("key", "conv_id", "turn", "at", "role", "same", "fault", "kind", "place"), "repair-order")


def blocks_of(marked: DataFrame) -> DataFrame:
    """key, node, start (place of the first row), kinds: a letter for each row of the block."""
    rows = marked.select("key", F.shiftright("place", BLOCK_BITS).alias("node"), "place", "kind").groupBy("key", "node").agg(
        F.sort_array(F.collect_list(F.struct("place", "kind"))).alias("rows"))
    return rows.select("key", "node", F.col("rows")[0]["place"].alias("start"), F.array_join("rows.kind", "").alias("kinds"))


def packed(step: Step) -> list[int]:
    return [*step[0], *step[1]]


def unpacked(numbers: list[int]) -> Step:
    return tuple(numbers[:16]), tuple(numbers[16:])


def multiplied(level: DataFrame, steps_of) -> DataFrame:
    """Each node as one step: key, node, step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = [packed(product_of(steps_of(s.as_py()))) for s in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(steps, pa.list_(pa.int64()))], names=["key", "node", "step"])

    return level.mapInArrow(run, "key string, node long, step array<bigint>")


def row_steps(kinds: str) -> list[str]:
    return list(kinds)


def node_steps(children: list[dict]) -> list[Step]:
    return [unpacked(c["step"]) for c in children]


def solved(level: DataFrame, steps_of, finish, schema: str) -> DataFrame:
    """``finish(key, node, steps, states, column 2's value)`` for every node of ``level`` (key, node, steps, start, end); no end: the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for key, node, raw, start, end in zip(*(batch.column(i) for i in range(5))):
                raw, start, end = raw.as_py(), start.as_py(), end.as_py()
                steps = steps_of(raw)
                end = last_state(steps) if end is None else end
                out += finish(key.as_py(), node.as_py(), raw, crossings(steps, start or NOTHING, end))
                held += len(raw)
                if held >= HELD:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow_schema(schema))
                    out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=arrow_schema(schema))

    return level.mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def children_states(key, node, raw, states) -> list[dict]:
    return [{"key": key, "node": c["node"], "before": states[i], "behind": states[i + 1]} for i, c in enumerate(raw)]


def block_edits(key, node, kinds, states) -> list[dict]:
    ways = [row_ways(k)[states[i], states[i + 1]] for i, k in enumerate(kinds)]
    heads = "".join((INITIALS + "?")[(ord(k) - 65) % 4] for k in kinds)
    return [{"key": key, "node": node, "edits": [w[1] for w in ways], "says": [w[2] for w in ways], "cost": sum(w[0] for w in ways),
             "illegal": sum(heads[i:i + 2] not in LEGAL for i in range(len(heads) - 1)), "head": heads[0], "foot": heads[-1], "state": states[-1]}]


def block_repairs(blocks: DataFrame) -> DataFrame:
    """Per block: key, node, edits and says of each row, cost, illegal (pairs inside), head and foot (first and last initial), state after it."""
    levels, steps_of = [blocks], row_steps
    while True:
        level = levels[-1]
        several = level.groupBy("key").agg(F.count("*").alias("nodes")).filter("nodes > 1")
        if several.isEmpty():
            break
        own = level.select("key", "node", "kinds" if steps_of is row_steps else "children")
        steps = multiplied(own.join(several.select("key"), "key"), steps_of)
        above = steps.groupBy("key", F.shiftright("node", FAN_BITS).alias("parent")).agg(F.sort_array(F.collect_list(F.struct("node", "step"))).alias("children"))
        levels.append(land(above.withColumnRenamed("parent", "node"), "repair-steps"))
        steps_of = node_steps
    states = None
    for level in reversed(levels):
        column = "kinds" if level is blocks else "children"
        open_ended = level.select("key", "node", column)
        if states is None:
            ready = open_ended.withColumn("before", F.lit(None).cast("long")).withColumn("behind", F.lit(None).cast("long"))
        else:  # nodes without a parent are whole conversations
            ready = open_ended.join(states, ["key", "node"], "left").select("key", "node", column, "before", "behind")
        if level is blocks:
            return solved(ready, row_steps, block_edits,
                          "key string, node long, edits array<string>, says array<string>, cost long, illegal long, head string, foot string, state long")
        states = land(solved(ready, node_steps, children_states, "key string, node long, before long, behind long"), "repair-states")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edits, conversations) of ``rows`` (conv_id, turn, role, text).

    edits, one row per row: key, conv_id, turn, at, role, same, fault ('', truncated, blank, duplicate), place, edits (inserts before
    the row, then K, R or D), says.  conversations: key, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, ending
    (inserts after the last row).

    Rows go by turn, nulls first; rows of one turn by role and a digest of the text.  Null role and text are
    one space.  Rows alike are turns of their own, all but the first duplicates.  A null conv_id is one
    conversation.  An empty table gives empty results.  Other columns are not read.
    """
    ship_package(rows.sparkSession)
    bound_batches(rows.sparkSession)
    marked = marked_rows(rows)
    blocks = land(blocks_of(marked), "repair-blocks")
    done = land(block_repairs(blocks.select("key", "node", "kinds")), "repair-edits")
    told = done.join(blocks.select("key", "node", "start"), ["key", "node"])
    per_row = told.select("start", F.posexplode(F.arrays_zip("edits", "says")).alias("i", "e")).select(
        (F.col("start") + F.col("i")).alias("place"), "e.edits", "e.says")
    edits = land(marked.drop("kind").join(per_row, "place"), "repair-plan")

    of = lambda f: F.sum((F.col("fault") == f).cast("long")).alias(f)
    counted = marked.groupBy("key").agg(
        F.first("conv_id").alias("conv_id"), of("blank"), of("duplicate"), of("truncated"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    parts = done.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(
        "node", F.array_join("edits", "").alias("audit"), "head", "foot", "state"))).alias("b"), F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    n = F.size("b")
    legal = F.array(*[F.lit(p) for p in sorted(LEGAL)])
    seams = F.zip_with(F.slice("b", F.lit(1), n - 1), F.slice("b", F.lit(2), n - 1),
                       lambda x, y: F.when(F.array_contains(legal, F.concat(x["foot"], y["head"])), 0).otherwise(1))
    state = F.element_at("b", -1)["state"]
    end = F.get(F.array(*[F.lit(ending(s)) for s in STATES]), state.cast("int"))
    joined = parts.select("key", (F.col("illegal") + F.aggregate(seams, F.lit(0), lambda a, x: a + x)).alias("illegal"),
                          (F.col("cost") + INSERT * F.length(end)).alias("cost"), F.concat(F.array_join("b.audit", ""), end).alias("audit"), end.alias("ending"))
    return edits, counted.join(joined, "key").select("key", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "ending")


def repaired_turns(rows: DataFrame, edits: DataFrame, conversations: DataFrame) -> DataFrame:
    """The repaired conversations' turns: key, conv_id, place, step (both order a conversation's turns), role, text, edit (K, R or I)."""
    own = edits.filter(F.col("edits").rlike("[KR]$"))
    # Of rows alike in one turn one at most stays; any of them has its text.
    alike = Window.partitionBy("same", "at").orderBy(F.lit(0))
    texts = identified_rows(rows).select("same", "at", "text").withColumn("nth", F.row_number().over(alike)).filter("nth = 1").drop("nth")
    told = own.join(texts, ["same", "at"])
    last = F.right("says", F.lit(1))
    by_initial = lambda c: F.when(c == "u", ROLES["u"]).otherwise(ROLES["a"])
    stays = told.select("key", "conv_id", "place", F.length("edits").alias("step"), F.when(last == "=", F.col("role")).otherwise(by_initial(last)).alias("role"),
                        "text", F.right("edits", F.lit(1)).alias("edit"))
    before = edits.filter(F.col("edits").startswith("I")).select("key", "conv_id", "place", "says", F.explode(
        F.sequence(F.lit(1), F.length(F.regexp_replace("edits", "[^I]", "")))).alias("step"))
    inserted = before.select("key", "conv_id", "place", "step", by_initial(F.substring("says", F.col("step"), F.lit(1))).alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    closing = F.when(F.length("ending") == 1, F.array(F.lit("assistant"))).otherwise(F.array(F.lit("user"), F.lit("assistant")))
    ends = conversations.filter("ending <> ''").select("key", "conv_id", F.lit((1 << 63) - 1).alias("place"), F.posexplode(closing).alias("step", "role"))
    return stays.unionByName(inserted).unionByName(ends.withColumn("text", F.lit("")).withColumn("edit", F.lit("I")))


def digests(turns: DataFrame) -> DataFrame:
    """key and sha256 of a conversation's ``role:text``, joined by newlines: one stream over sorted rows, holding one hash at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None

        def told(keys, hashes):
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(hashes, pa.string())], names=["key", "sha"])

        for batch in batches:
            keys, hashes = [], []
            for key, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        hashes.append(sha.hexdigest())
                    now, sha = key, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if keys:
                yield told(keys, hashes)
        if now is not None:
            yield told([now], [sha.hexdigest()])

    placed = turns.repartition("key").sortWithinPartitions("key", "place", "step")
    return placed.select("key", "role", "text").mapInArrow(run, "key string, sha string")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (nulls: one space) with faults by crc32 of ``conv_id:turn``: of 20 remainders 0 drops the row, 1 empties its text,
    2 removes its sentence ends, 3 repeats it, 4 gives it the role user."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    r = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), code.alias("code")).filter("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("code") == 3, 2).otherwise(1)
    return r.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def structure_repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Digest of ``repair(rows)`` for every conversation of ``conversations``; without rows: zeros, an empty audit, the empty string's hash."""
    edits, found = repair(rows)
    found = land(found, "repair-conversations")
    sums = digests(repaired_turns(rows, edits, found))
    every = conversations.select("conv_id", conversation_key(F.col("conv_id")).alias("key")).distinct()
    out = every.join(found.drop("conv_id"), "key", "left").join(sums, "key", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return structure_repair(conversations, damaged(conversations))


def _more(state: str, cost: str, edit: str, turn: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {state}.t || {turn}}}"


def _least(*ways: str) -> str:
    return f"least({', '.join(ways)})"


def op13_sql() -> str:
    """Plain dynamic programming over whole edit strings: for each state the least of {cost, audit, repaired text}."""
    far = "{'c': CAST(1000000000 AS BIGINT), 'a': '', 't': ''}"
    user, assistant, own = "chr(10) || 'user:'", "chr(10) || 'assistant:'", "chr(10) || role || ':' || text"
    new_user, new_assistant = "chr(10) || 'user:' || text", "chr(10) || 'assistant:' || text"
    first = f"SELECT w.*, {_least('s2', *[_more(s, '2', 'I', user) for s in ('s0', 's1', 's3')])} AS u1 FROM w"
    second = f"SELECT f.*, {_least('s3', _more('u1', '2', 'I', assistant))} AS a1 FROM f"
    delete = lambda s: _more(s, "3", "D", "''")
    if_kept = lambda initial, s: f"CASE WHEN NOT gone AND head = '{initial}' THEN {_more(s, 'cut', 'K', own)} ELSE {far} END"
    if_new = lambda s, told: f"CASE WHEN NOT gone THEN {_more(s, '2 + cut', 'R', told)} ELSE {far} END"
    s2 = _least(delete("u1"), *[if_kept("u", s) for s in ("s0", "s1", "a1")], *[if_new(s, new_user) for s in ("s0", "s1", "a1")])
    s3 = _least(delete("a1"), if_kept("a", "u1"), if_new("u1", new_assistant))
    return rf"""
WITH RECURSIVE shown AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
coded AS (
  SELECT *, xor(list_reduce(list_transform(string_split(s, ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
    lambda acc, byte: list_reduce(CAST(range(8) AS BIGINT[]), lambda r, b: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END), xor(acc, byte)),
    4294967295), 4294967295) % 20 AS code FROM shown),
hurt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded),
told AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core, left(role, 1) AS head,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM hurt),
marked AS (
  SELECT *, core = '' OR again AS gone, core = '' AS blank, core <> '' AND again AS duplicate,
         CASE WHEN core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut,
         lag(head) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM told),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0, {far} AS s1, {far} AS s2, {far} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, pos, {delete("s0")} AS n0, {_least(delete("s1"), if_kept("s", "s0"))} AS n1, {s2} AS n2, {s3} AS n3
  FROM (WITH w AS (SELECT m.conv_id, m.pos, m.role, m.text, m.head, m.gone, m.cut, s0, s1, s2, s3
                   FROM walk JOIN marked m ON m.conv_id IS NOT DISTINCT FROM walk.conv_id AND m.pos = walk.pos + 1),
             f AS ({first})
        {second})),
ends AS (
  SELECT conv_id, {_least("s0", "a1")} AS best
  FROM (WITH w AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1), f AS ({first})
        {second})),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, sum(cut) AS truncated,
         count(*) FILTER (pos > 1 AND before || head NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id)
SELECT ends.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
       best.c AS cost, best.a AS audit, sha256(best.t[2:]) AS repaired_sha256
FROM ends LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ends.conv_id
"""

"""Chat formatting: conversations to training windows within a token budget, natively.

Template: each turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Texts cannot forge it: in them a
backslash is doubled and ``<|`` becomes ``<\\|``, which ``unescape`` reverses; roles are URL-encoded.

Windows come from prefix sums of turn costs (tokens plus the template's): with room R = budget -
system turn - history, the turn after P tokens belongs to segment floor(P / R), and a turn that
crosses into the next segment has a window of its own.  So a window's new turns are a run of whole
turns that cost at most R, unless it is a single longer turn (``over_budget`` tells).  Every window
starts with the conversation's system turn and repeats up to ``history`` turns before its first new one, as
far as the history's tokens go.  Loss falls on the new assistant turns' text alone: what is
repeated is masked, so each assistant text is a target once.

Prefix sums go in two levels: within blocks of ``BLOCK_TURNS`` turn numbers and over block totals, and
history comes by an equi-join on (conversation, turn index); so a conversation that holds a large
part of all turns is dealt over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanscope.llm.common import land
from loanscope.sources.tables import read_table

START, END = "<|im_start|>", "<|im_end|>"
BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
TURN_TOKENS = 4  # of the template, for each turn
BLOCK_TURNS = 256
TOKEN = r"[\p{L}\p{M}]{1,8}|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]"  # pieces of words, numbers and marks stand for tokens
PROBE = END + START + "assistant ok"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


def indexed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, role, text, idx, cost, before): turns by position in the conversation, with the
    tokens of the turns before.  Order: turn (null first), then role and text; null role and text are empty."""
    c = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    c = c.withColumn("cost", token_count(F.col("text")) + TURN_TOKENS).withColumn("blk", F.floor(F.col("turn") / BLOCK_TURNS))
    within = Window.partitionBy("conv_id", "blk").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = c.withColumn("n", F.count("*").over(within)).withColumn("p", F.sum("cost").over(within))
    over = Window.partitionBy("conv_id").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = c.groupBy("conv_id", "blk").agg(F.count("*").alias("bn"), F.sum("cost").alias("bp"))
    blocks = blocks.select(F.col("conv_id").alias("b_conv"), F.col("blk").alias("b_blk"), F.coalesce(F.sum("bn").over(over), F.lit(0)).alias("n0"),
                           F.coalesce(F.sum("bp").over(over), F.lit(0)).alias("p0"))
    same = F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("blk").eqNullSafe(F.col("b_blk"))
    return local.join(blocks, same).select(
        "conv_id", "role", "text", (F.col("n0") + F.col("n") - 1).alias("idx"), "cost", (F.col("p0") + F.col("p") - F.col("cost")).alias("before"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """One row per window: conv_id, first (index of its first new turn), n_context, n_new, tokens,
    over_budget, formatted, loss (array of start and length in formatted, code points).

    Null conv_id is one conversation; repeated rows are turns of their own; an empty table gives an
    empty result; other columns are not read.
    """
    turns = land(indexed_turns(conversations), "chat-turns")
    is_system = (F.col("idx") == 0) & (F.col("role") == "system")
    system = turns.filter(is_system).select(F.col("conv_id").alias("s_conv"), F.col("text").alias("s_text"), F.col("cost").alias("s_cost"))
    said = turns.join(system, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left").drop("s_conv")
    s_cost = F.coalesce("s_cost", F.lit(0))
    room = F.greatest(F.lit(1), F.lit(budget - history_tokens) - s_cost)
    at = F.greatest(F.lit(0), F.col("before") - s_cost)  # tokens of the turns before, system turn aside
    # The system turn is told as new in the first window and as context in the others.
    # bround and floor division of longs: no floating point in the segment number.
    seg = F.when(is_system, 0).otherwise(F.expr("at div room"))
    crosses = ~is_system & (F.expr("(at + cost - 1) div room") > F.col("seg"))
    placed = land(said.withColumn("room", room.cast("long")).withColumn("at", at.cast("long")).withColumn("seg", seg.cast("long"))
                  .withColumn("own", crosses).withColumn("system", is_system), "chat-placed")
    new = placed.select("conv_id", "seg", "own", "idx", "role", "text", "cost", F.col("system").alias("system"), F.lit(True).alias("new"))

    firsts = placed.groupBy("conv_id", "seg", "own").agg(
        F.min("idx").alias("first"), F.min("at").alias("p_first"), F.max("system").alias("has_system"),
        F.first("s_text").alias("s_text"), F.first("s_cost").alias("s_cost"))
    head = firsts.filter(F.col("s_text").isNotNull() & ~F.col("has_system")).select(
        "conv_id", "seg", "own", F.lit(0).cast("long").alias("idx"), F.lit("system").alias("role"), F.col("s_text").alias("text"),
        F.col("s_cost").alias("cost"), F.lit(True).alias("system"), F.lit(False).alias("new"))

    back = F.sequence(F.lit(1), F.lit(history)) if history else F.expr("cast(array() as array<int>)")
    wanted = firsts.withColumn("k", F.explode(back)).select(
        F.col("conv_id").alias("h_conv"), "seg", "own", "p_first", (F.col("first") - F.col("k")).alias("h_idx"))
    earlier = placed.filter(~F.col("system")).select("conv_id", "idx", "role", "text", "cost", "at")
    repeat = wanted.join(earlier, F.col("h_conv").eqNullSafe(F.col("conv_id")) & (F.col("h_idx") == F.col("idx"))).filter(
        F.col("p_first") - F.col("at") <= history_tokens).select(
        "conv_id", "seg", "own", "idx", "role", "text", "cost", F.lit(False).alias("system"), F.lit(False).alias("new"))

    rows = new.unionByName(head).unionByName(repeat)
    target = F.col("new") & (F.col("role") == "assistant")
    body = escape(F.col("text"))
    opening = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    part = F.struct(F.col("idx"), (~F.col("system")).alias("later"), F.concat(opening, body, F.lit(END + "\n")).alias("said"),
                    F.when(target, F.length(opening)).alias("from"), F.length(body).alias("n"))
    grouped = rows.groupBy("conv_id", "seg", "own").agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.sum(F.col("new").cast("long")).alias("n_new"),
        F.sum((~F.col("new")).cast("long")).alias("n_context"), F.sum("cost").alias("tokens"),
        F.min(F.when(F.col("new"), F.col("idx"))).alias("first"))
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("loss"))

    def add(acc, p):
        spot = F.struct((acc["at"] + p["from"]).alias("start"), p["n"].alias("length"))
        return F.struct((acc["at"] + F.length(p["said"])).alias("at"),
                        F.when(p["from"].isNull(), acc["loss"]).otherwise(F.concat(acc["loss"], F.array(spot))).alias("loss"))

    return grouped.select("conv_id", "first", "n_context", "n_new", "tokens", (F.col("tokens") > budget).alias("over_budget"),
                          F.array_join(F.transform("parts", lambda p: p["said"]), "").alias("formatted"),
                          F.aggregate("parts", zero, add, lambda acc: acc["loss"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation from its windows' formatted texts alone: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, n_windows."""
    parts = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, 1 << 30)
    told = F.transform(F.slice(parts, F.col("n_context").cast("int") + 1, F.col("n_new").cast("int")), lambda p: F.concat(
        F.url_decode(F.substring_index(p, "\n", 1)), F.lit("\n"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END) - 1)), F.lit("\n")))
    learnt = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    each = formatted.select("conv_id", F.struct("first", F.array_join(told, "").alias("told"), F.array_join(learnt, "").alias("learnt")).alias("w"),
                            "n_new", F.length("formatted").alias("chars"))
    whole = each.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"), F.sum("n_new").alias("n_turns"),
                                        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    told_all = F.array_join(F.transform("ws", lambda w: w["told"]), "")
    learnt_all = F.array_join(F.transform("ws", lambda w: w["learnt"]), "")
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(told_all.cast("binary"), 256).alias("turns_sha256"),
                        F.length(learnt_all).cast("long").alias("loss_chars"), F.sha2(learnt_all.cast("binary"), 256).alias("loss_sha256"),
                        F.col("formatted_chars").cast("long").alias("formatted_chars"), F.col("n_windows").cast("long").alias("n_windows"))


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and number -1, whose two texts hold the template's own control strings."""
    spark = conversations.sparkSession
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return c.unionByName(probe)


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(windows(with_probe(read_table(spark, sf_dir, "conversations"))))


OP9_SQL = f"""
WITH c AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
n AS (SELECT *, row_number() OVER o - 1 AS idx, len(regexp_extract_all(text, '{TOKEN}')) + {TURN_TOKENS} AS cost,
        length(role) + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) + {len(START) + len(END) + 2} AS chars
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
t AS (SELECT *, idx = 0 AND role = 'system' AS system, sum(cost) OVER (PARTITION BY conv_id ORDER BY idx) - cost AS before FROM n),
s AS (SELECT t.*, coalesce(h.cost, 0) AS s_cost, coalesce(h.chars, 0) AS s_chars
      FROM t LEFT JOIN (SELECT conv_id AS i, cost, chars FROM t WHERE system) h ON t.conv_id IS NOT DISTINCT FROM h.i),
a AS (SELECT *, greatest(1, {BUDGET - HISTORY_TOKENS} - s_cost) AS room, greatest(0, before - s_cost) AS pos FROM s),
p AS (SELECT *, CASE WHEN system THEN 0 ELSE pos // room END AS seg, NOT system AND (pos + cost - 1) // room > pos // room AS own FROM a),
w AS (SELECT conv_id, seg, own, min(idx) AS f, min(pos) AS pos, sum(chars) + CASE WHEN bool_or(system) THEN 0 ELSE max(s_chars) END AS chars
      FROM p GROUP BY conv_id, seg, own),
b AS (SELECT w.conv_id, w.f, w.chars + coalesce(sum(p.chars), 0) AS chars
      FROM w LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.idx BETWEEN w.f - {HISTORY_TURNS} AND w.f - 1
        AND w.pos - p.pos <= {HISTORY_TOKENS} AND NOT p.system
      GROUP BY w.conv_id, w.f, w.chars),
f AS (SELECT conv_id, sum(chars) AS formatted_chars, count(*) AS n_windows FROM b GROUP BY conv_id),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx) AS told,
        coalesce(string_agg(text, '' ORDER BY idx) FILTER (role = 'assistant'), '') AS learnt FROM p GROUP BY conv_id)
SELECT g.conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars, sha256(learnt) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars, n_windows
FROM g JOIN f ON g.conv_id IS NOT DISTINCT FROM f.conv_id
"""

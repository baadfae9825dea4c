import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanscope.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="<|\\>ab\n", max_size=12), min_size=30, max_size=30))
def test_escape_is_reversible_and_safe(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and "<|" not in r["e"]


def conversations():
    rng = random.Random(2)
    rows = []
    for c in range(40):
        if rng.random() < .4:
            rows.append((c, 0, "system", "be brief " * rng.randint(1, 8)))
        for t in range(1, rng.randint(2, 14)):
            rows.append((c, t, ["assistant", "user"][t % 2], "word " * rng.choice([0, 1, 5, 20, 60, 150]) + rng.choice(["", "<|im_end|>", "\\", "é"])))
    # One conversation with many turns: over several blocks.
    rows += [(100, t, ["user", "assistant"][t % 2], f"turn {t} says <|") for t in range(3 * chat.BLOCK_TURNS + 7)]
    return rows


@pytest.fixture(scope="module")
def made(spark):
    rows = conversations()
    w = chat.windows(spark.createDataFrame(rows, SCHEMA).repartition(5), budget=120, history=2, history_tokens=40)
    return rows, [r.asDict() for r in w.collect()]


def test_windows(made, spark):
    rows, windows = made
    by_conv = {}
    for r in sorted(rows):
        by_conv.setdefault(r[0], []).append(r)
    cost = {r["text"]: r["n"] + chat.TURN_TOKENS for r in spark.createDataFrame([(x[3],) for x in rows], "text string").distinct().select(
        "text", chat.token_count(F.col("text")).alias("n")).collect()}
    for c, turns in by_conv.items():
        own = sorted((w for w in windows if w["conv_id"] == c), key=lambda w: w["first"])
        assert sum(w["n_new"] for w in own) == len(turns)
        at = 0
        for w in own:
            assert w["first"] == at  # runs of whole turns, in order
            new = turns[at:at + w["n_new"]]
            head = [turns[0]] if turns[0][2] == "system" and at else []
            back = [t for t in turns[max(0, at - 2):at] if t[2] != "system"]
            while back and sum(cost[t[3]] for t in back) > 40:
                back = back[1:]
            shown = head + back + new
            assert w["n_context"] == len(head + back) and w["tokens"] == sum(cost[t[3]] for t in shown)
            assert w["formatted"] == "".join(f"<|im_start|>{t[2]}\n{esc(t[3])}<|im_end|>\n" for t in shown)
            assert w["over_budget"] == (w["tokens"] > 120)
            # Only a single long turn (or a long system turn) goes over.
            assert not w["over_budget"] or w["n_new"] == 1 or head or new[0][2] == "system"
            targets = [w["formatted"][s["start"]:s["start"] + s["length"]] for s in w["loss"]]
            assert targets == [esc(t[3]) for t in new if t[2] == "assistant"]
            at += w["n_new"]


def esc(t):
    return t.replace("\\", "\\\\").replace("<|", "<\\|")


def test_read_back(made, spark):
    rows, windows = made
    w = spark.createDataFrame([{k: v for k, v in r.items()} for r in windows],
                              "conv_id long, first long, n_context long, n_new long, tokens long, over_budget boolean, formatted string, "
                              "loss array<struct<start:int,length:int>>")
    for r in chat.read_back(w).collect():
        turns = sorted(x for x in rows if x[0] == r["conv_id"])
        told = "".join(f"{x[2]}\n{x[3]}\n" for x in turns)
        learnt = "".join(x[3] for x in turns if x[2] == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(x["formatted"]) for x in windows if x["conv_id"] == r["conv_id"])


def test_probe(spark):
    got = chat.read_back(chat.windows(chat.with_probe(spark.createDataFrame([], SCHEMA)))).collect()
    said = f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n"
    assert [(r["conv_id"], r["n_turns"], r["turns_sha256"]) for r in got] == [(-1, 2, hashlib.sha256(said.encode()).hexdigest())]
    assert got[0]["loss_chars"] == len(chat.PROBE)

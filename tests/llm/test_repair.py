import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanscope.llm import repair

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit, turns) by trying every edit: ``rows`` of (role, text, gone, cut).  States are the turns' initials so far, by the grammar's last symbol."""
    states = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            for role in ("user", "assistant"):
                if role[0] in states[state]:
                    c, a, t = best(i, states[state][role[0]], inserted + 1)
                    ways.append((c + 2, "I" + a, ((role, ""),) + t))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            c, a, t = best(i + 1, state, 0)
            ways.append((c + 3, "D" + a, t))
            if not gone:
                for told, cost, letter in [(role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")]:
                    if told[:1] in states[state]:
                        c, a, t = best(i + 1, states[state][told[:1]], 0)
                        ways.append((c + cost + cut, letter + a, ((told, text),) + t))
        return min(ways, key=lambda w: (w[0], w[1])) if ways else (10 ** 9, "", ())

    return best(0, "", 0)


def brute(rows):
    """conv_id to the digest columns of ``rows`` after damage."""
    out = {}
    for conv in dict.fromkeys(r[0] for r in rows):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] if r[2] is not None else " ", order_of(r)))
        told, seen, faults = [], set(), []
        for _, turn, role, text in own:
            role, text = " " if role is None else role, " " if text is None else text
            core = text.rstrip(WHITE)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            told.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        cost, audit, turns = cheapest(tuple(told))
        numbers = [t for _, t, _, _ in own if t is not None]
        heads = [r[0][:1] for r in told]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())
    return out


def order_of(row):
    conv, _, role, text = row
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return sha(sha("" if conv is None else f"={conv}") + sha(" " if text is None else text) + (" " if role is None else role))


def digest(df):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r[c] for c in columns) for r in rows}


def made(seed=3, conversations=60, most=9):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(0, most)):
            text = rng.choice(["Yes.", "No!", "Why?", "so on", "", " \n", None, f"text {rng.randint(0, 3)}", f"told {t}.", "wait.\x0b "])
            rows.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "umpire"]), text))
    rows += [(None, 1, "user", "Hm."), (None, 2, "assistant", "Hm."), (None, 2, "assistant", "Hm."), (None, None, "system", "x")]
    return rows


kinds = st.lists(st.builds(repair.letter, st.integers(0, 3), st.integers(0, 3)), max_size=7)


@given(kinds)
@settings(max_examples=300)
def test_divide_and_conquer_against_every_edit(kinds):
    rows = tuple((("system", "user", "assistant", "tool")[(ord(k) - 65) % 4], "t", (ord(k) - 65) // 4 > 1, int((ord(k) - 65) // 4 == 1)) for k in kinds)
    cost, audit, _ = cheapest(rows)
    end = repair.last_state(kinds)
    states = repair.crossings(kinds, repair.NOTHING, end)
    ways = [repair.row_ways(k)[states[i], states[i + 1]] for i, k in enumerate(kinds)]
    assert "".join(w[1] for w in ways) + repair.ending(end) == audit
    assert sum(w[0] for w in ways) + 2 * len(repair.ending(end)) == cost


@given(st.lists(kinds.filter(len), min_size=1, max_size=4))
def test_products_of_blocks_lead_to_the_same_states(blocks):
    whole = [k for b in blocks for k in b]
    steps = [repair.product_of(b) for b in blocks]
    end = repair.last_state(whole)
    assert repair.last_state(steps) == end
    at = [0]
    for b in blocks:
        at.append(at[-1] + len(b))
    states = repair.crossings(whole, repair.NOTHING, end)
    assert repair.crossings(steps, repair.NOTHING, end) == [states[i] for i in at]


@pytest.mark.parametrize("block_bits,fan_bits", [(12, 10), (1, 1), (0, 2)])
def test_against_every_edit(spark, monkeypatch, block_bits, fan_bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", block_bits)
    monkeypatch.setattr(repair, "FAN_BITS", fan_bits)
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert digest(repair.structure_repair(df, df)) == brute(rows)


def test_a_long_conversation_is_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 3)
    monkeypatch.setattr(repair, "FAN_BITS", 2)
    rng = random.Random(1)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"say {t}" + rng.choice([".", ""])) for t in range(700)] + [(1, 9, "user", "Ok.")] * 300 + [(2, 0, "user", "A.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    edits, _ = repair.repair(df)
    assert edits.count() == len(rows) and edits.select("place").distinct().count() == len(rows)
    got = digest(repair.structure_repair(df, df))
    whole = brute([r for r in rows if r[0] == 2])
    assert got[2] == whole[2] and got[1][2] == 299 and got[1][0] == 0
    monkeypatch.setattr(repair, "BLOCK_BITS", 12)
    assert digest(repair.structure_repair(df, df)) == got


def test_repaired_turns(spark):
    rows = [(5, 0, "system", "Be kind."), (5, 1, "assistant", "cut"), (5, 2, "tool", "Done."), (5, 2, "tool", "Done."), (6, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA)
    edits, found = repair.repair(df)
    turns = repair.repaired_turns(df, edits, found).orderBy("conv_id", "place", "step")
    assert [(r["conv_id"], r["role"], r["text"], r["edit"]) for r in turns.collect()] == [
        (5, "system", "Be kind.", "K"), (5, "user", "cut", "R"), (5, "assistant", "Done.", "R"), (6, "user", "Hi.", "K"), (6, "assistant", "", "I")]
    assert {r["conv_id"]: r["audit"] for r in found.collect()} == {5: "KRRD", 6: "KI"}
    assert sorted((r["turn"], r["fault"]) for r in edits.filter("conv_id = 5").collect()) == [(0, ""), (1, "truncated"), (2, ""), (2, "duplicate")]


def test_damage(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t, r, x in [(i, "assistant", f"A.b! {i}?") for i in range(40)] + [(None, None, None)]]
    got = sorted(map(str, (tuple(r) for r in repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect())))
    want = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else "".join(x for x in text if x not in ".!?") if code == 2 else text
        want += [(c, t, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    assert got == sorted(map(str, want))


def test_empty_dropped_and_clashing(spark):
    none = hashlib.sha256(b"").hexdigest()
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (2, None, None, None)], SCHEMA)
    assert repair.structure_repair(df.limit(0), df.limit(0)).collect() == []
    got = digest(repair.structure_repair(df, df.limit(0)))
    assert got == {1: (0, 0, 0, 0, 0, 0, "", none), 2: (0, 0, 0, 0, 0, 0, "", none)}
    clashes = ["key", "node", "place", "same", "at", "fault", "kind", "edits", "says", "cost", "audit", "n", "i", "h", "code", "copy", "a.b", "state", "nth", "step", "Text"]
    more = df.select("*", *[F.lit("clash").alias(c) for c in clashes if c != "Text"])
    assert digest(repair.structure_repair(more, repair.damaged(more))) == digest(repair.structure_repair(df, repair.damaged(df)))


def test_long_texts_and_many_copies(spark):
    rows = [(1, 0, "user", "word " * 300_000 + "."), (1, 1, "assistant", "x")] + [(1, 1, "assistant", "x")] * 500
    df = spark.createDataFrame(rows, SCHEMA)
    got = digest(repair.structure_repair(df, df))[1]
    assert got[2] == 500 and got[6] == "KK" + "D" * 500 and got[5] == 1501
    assert got[7] == hashlib.sha256(f"user:{rows[0][3]}\nassistant:x".encode()).hexdigest()

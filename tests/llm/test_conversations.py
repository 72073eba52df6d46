"""Conversation repair against a plain dynamic programme that carries every audit along."""
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations as C

WHITE = "\x20\t\n\x0b\x0c\r"
AFTER = {0: 2, 1: 2, 2: 3, 3: 2}
FIT = {0: "su", 1: "u", 2: "a", 3: "u"}


def plain_repair(messages):
    """(cost, audit, repaired) of judged (role, text, forced, cut off), by trying every edit at every place."""
    best = {0: (0, "", [])}

    def better(table, state, found):
        if state not in table or found[:2] < table[state][:2]:
            table[state] = found

    def inserted(table):
        out = dict(table)
        for _ in range(3):
            for state, (cost, audit, said) in list(out.items()):
                better(out, AFTER[state], (cost + 2, audit + "I", said + [("user" if AFTER[state] == 2 else "assistant", "")]))
        return out

    for role, text, forced, cut_off in messages:
        after = {}
        for state, (cost, audit, said) in inserted(best).items():
            better(after, state, (cost + 3, audit + "D", said))
            if not forced:
                to = AFTER[state]
                better(after, to, (cost + 2 + cut_off, audit + "R", said + [("user" if to == 2 else "assistant", text)]))
                if role[:1] and role[:1] in FIT[state]:
                    better(after, {"s": 1, "u": 2, "a": 3}[role[0]], (cost + cut_off, audit + "K", said + [(role, text)]))
        best = after
    ends = [v for s, v in inserted(best).items() if s in (0, 3)]
    return min(ends, key=lambda v: v[:2])


def plain(rows):
    """The whole result of (conv_id, turn, role, text) rows, by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda m: (m[0] is not None, m[0] or 0, hashlib.sha256(f"{m[1]}\0{m[2]}".encode()).digest()))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            last = text.rstrip(WHITE)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault in (0, 1), fault == 2))
        cost, audit, said = plain_repair(judged)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _), (_, b, _) in zip(own, own[1:]))
        shown = "\n".join(f"{r}:{t}" for r, t in said)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(shown.encode()).hexdigest(), said)
    return out


def random_rows(seed, conversations=60):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "agent", "s"]
    texts = ["Yes.", "No", "", " \t", None, "What?", "same text!", "end. ", "trail,", "éü.", "a\nb", "x"]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.choice([1, 2, 3, 5, 8, 13])):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1, 1])[0],
                         rng.choice(texts) if rng.random() < 0.5 else f"{turn} words{rng.choice('.!?,')}"))
    rows += [(1000, t, ("user", "assistant")[t % 2] if rng.random() < 0.9 else "system", f"m{t}{rng.choice(['.', '.', ''])}") for t in range(300)]
    rows += [(1001, 5, "user", "again.")] * 90 + [(1002, None, "assistant", "only")]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_tables_of_long_runs(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, (6, 40, 300)[seed], 30)
    first = np.concatenate([[0], np.cumsum(sizes)])
    codes = rng.choice(9, first[-1], p=[.08, .04, .25, .08, .25, .08, .06, .04, .12])
    block = C.Block(codes, first)
    end = block.ends()
    audits, costs = block.ways(np.zeros(len(sizes), dtype=np.int64), end)
    for i, (lo, hi) in enumerate(zip(first[:-1], first[1:])):
        messages = [("suax"[c // 2] if c < 8 else "u", "", c == 8, c % 2 if c < 8 else 0) for c in codes[lo:hi].tolist()]
        cost, audit, _ = plain_repair(messages)
        assert "".join(C.AUDITS[a] for a in audits[lo:hi]) + C.END[end[i]] == audit
        assert costs[lo:hi].sum() + C.END_COST[end[i]] == cost


@pytest.mark.parametrize("seed, block_rows", [(1, 4096), (2, 7), (3, 1)])
def test_repair_equals_brute_force(workers, seed, block_rows):
    rows = random_rows(seed)
    random.Random(seed).shuffle(rows)
    df = workers.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    for name in ("conv", "part", "id", "sign", "open", "segment", "messages", "cost", "audit", "found", "first"):
        df = df.withColumn(name, F.lit("extra"))
    expected = plain(rows)
    got = {r.conv_id: tuple(r)[1:] for r in C.repair(df, block_rows=block_rows).collect()}
    assert got == {c: v[:-1] for c, v in expected.items()}
    said = {}
    for r in C.repaired(df, block_rows=block_rows).orderBy("part", "position").collect():
        said.setdefault(r.conv_id, []).append((r.role, r.text))
    assert said == {c: v[-1] for c, v in expected.items() if v[-1]}


def test_audits_read_as_a_conversation(workers):
    rows = random_rows(9)
    df = workers.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    said = {}
    for r in C.repaired(df).orderBy("part", "position").collect():
        said.setdefault(r.conv_id, []).append(r.role[:1])
    assert said and all(re.fullmatch("s?(ua)+", "".join(x)) for x in said.values())


def test_empty_and_text_ids(workers):
    empty = workers.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert C.repair(empty).collect() == [] and C.repaired(empty).collect() == []
    rows = [("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes."), ("", 0, "assistant", "So?")]
    got = {r.conv_id: (r.cost, r.audit) for r in C.repair(workers.createDataFrame(rows, empty.schema)).collect()}
    assert got == {"a": (0, "KK"), "": (2, "IK")}


def test_query_drops_whole_conversations(workers, tmp_path):
    from zlib import crc32

    from tidemark.llm.catalog import QUERIES
    gone = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    df = workers.createDataFrame([(gone, 0, "user", "Hello."), (None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in QUERIES["op11_conversations"](workers, str(tmp_path)).collect()}
    assert tuple(got[gone])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and None in got

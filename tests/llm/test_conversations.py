import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest
from pyspark.sql import functions as F

from sortlane.llm import conversations as cv

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GOOD = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if f == 1:
            text = ""
        if f == 2:
            text = re.sub("[.!?]", "", text)
        if f == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_scripts(roles, found, most_inserts):
    """Every edit script with at most some inserts: ``(cost, script, output)``."""
    n = len(roles)
    slots = [s for s in product(range(most_inserts + 1), repeat=n + 1) if sum(s) <= most_inserts]
    for ops in product(*["D" if f in ("blank", "duplicate") else "KRD" for f in found]):
        for ins in slots:
            for fill in product("ua", repeat=sum(ins) + ops.count("R")):
                fill, script, out, cost = list(fill), "", [], 0
                for i in range(n + 1):
                    for _ in range(ins[i]):
                        script, cost = script + "I", cost + 5
                        out.append((fill.pop(), None))
                    if i < n:
                        script += ops[i]
                        cost += {"K": 0, "R": 1, "D": 2}[ops[i]] + 5 * (ops[i] != "D" and found[i] == "truncated")
                        if ops[i] == "K":
                            out.append((roles[i][:1], i))
                        elif ops[i] == "R":
                            out.append((fill.pop(), i))
                if GOOD.fullmatch("".join(r if len(r) == 1 else "?" for r, _ in out)):
                    yield cost, script, ops, out


def brute(rows, most_inserts=2):
    """One conversation by trying every script."""
    rows = damaged(rows)
    found = faults(rows)
    turns = [t for _, t, _, _ in rows if t is not None]
    roles = [r for _, _, r, _ in rows]
    cost, script, ops, out = min(all_scripts(roles, found, most_inserts), key=lambda s: s[:2])
    lines = []
    for r, i in out:
        name = rows[i][2] if i is not None and ops[i] == "K" else {"u": "user", "a": "assistant"}[r]
        lines.append(f"{name}:{'' if i is None else rows[i][3]}")
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"), sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, script,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


@lru_cache(None)
def talks():
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in sorted(rng.sample(range(9), rng.randrange(1, 5))):
            rows.append((conv, turn, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "uncle"]),
                         rng.choice(["Yes.", "No?", "open end", "", " \t\n", "ä!  ", "x. "])))
    return rows


def result(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = cv.repair_damaged(df.withColumn("piece", F.lit("clash")).withColumn("cost", F.lit("clash")), **how).collect()
    assert len(out) == len({r.conv_id for r in out})
    return {r.conv_id: tuple(r)[1:] for r in out}


def test_equals_trying_every_script(spark):
    rows = talks()
    want = {c: brute([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert result(spark, rows) == want


@pytest.mark.parametrize("how", [
    {"giant_rows": 1, "piece_rows": 1}, {"giant_rows": 3, "piece_rows": 2}, {"giant_bytes": 4, "piece_bytes": 1}])
def test_giant_conversations_give_the_same(spark, how):
    rng = random.Random(5)
    rows = list(talks())
    for turn in range(400):  # one conversation of many copies and repeated turn numbers, null ones first
        rows.append((999, rng.choice([None, turn // 2, turn]), rng.choice(["user", "assistant", "system"]),
                     rng.choice(["Same.", "Same.", f"text {rng.randrange(99)}.", "cut"])))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert result(spark, rows, **how) == result(spark, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_steps_forget_no_cheapest_path():
    """The carried states against full strings over long sequences of turns."""
    rng = random.Random(11)
    edits = cv.Edits()
    for _ in range(300):
        state, total, pointers, kinds = cv.Edits.FIRST, 0, [], []
        full = {0: (0, "")}
        for _ in range(rng.randrange(1, 30)):
            kind = (rng.choice("sua?"), rng.random() < 0.2, rng.random() < 0.3)
            kinds.append(kind)
            state, low, p = edits.step(state, *kind)
            total += low
            pointers.append(p)
            new = {}
            for x, (cost, text) in full.items():
                at = x
                for k in range(4):
                    moves = [(2, "D", at)]
                    if not kind[1]:
                        moves.append((1 + 5 * kind[2], "R", cv._NEXT[at]))
                        if (at, kind[0]) in cv._KEEP:
                            moves.append((5 * kind[2], "K", cv._KEEP[at, kind[0]]))
                    for price, op, to in moves:
                        found = (cost + 5 * k + price, text + "I" * k + op)
                        new[to] = min(new.get(to, found), found)
                    at = cv._NEXT[at]
            full = new
        ends = [(c + 5 * k, t + "I" * k) for x, (c, t) in full.items()
                for k in range(4) if (x, k) in ((0, 0), (0, 2), (1, 2), (2, 1), (3, 0))]
        more, last, tail = cv.Edits.end(state)
        done, first = cv.walk_back(pointers, last)
        script = "".join("I" * (e >> 2) + "DKR"[e & 3] for e in done) + "I" * tail
        assert (total + more, script) == min(ends) and first == 0


def test_odd_and_empty_tables(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, None, None, None), (1, None, "user", None),
            (2, 5, "", "no role."), (2, 5, "", "no role."), (2, 9, "assistant", "y." + "z" * 300000),
            (3, -4, "user", "A."), (3, 2**40, "assistant", "B.")]
    rows += [(c, 0, "user", "Only turn.") for c in range(100, 160)]
    got = result(spark, rows)
    for c in {r[0] for r in rows}:
        assert got[c] == brute([r for r in rows if r[0] == c], 1 if c is None else 2)
    gone = [c for c in range(100, 160) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and all(got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
    assert result(spark, [], giant_rows=1) == {}

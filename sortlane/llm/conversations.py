"""Conversation structure repair by secondary-sorted streaming.

Turns are repartitioned by conversation and sorted by turn; a streaming pass
over the Arrow batches carries the state of a dynamic programme from batch to
batch, so a task holds one conversation and one batch.  The programme walks the
automaton of ``(s?(ua)+)?`` with its four states (nothing yet, after s, after u,
after a), keeps per state the cost and the rank of the best edit string, and
one packed number of backpointers per turn.  What a turn does to the states
depends only on their relative costs, so steps are remembered and looked up.

Ranks make ties exact: of two edit strings for the same turns that end with a
turn's own edit, neither is a prefix of the other, so their order stays as it is
whatever follows.

Conversations over ``GIANT_ROWS`` turns or ``GIANT_BYTES`` of text are not held:
the first pass writes their turns and backpointers in pieces to a staged table
in the shared folder, a second pass walks the pieces backwards, a third one
applies the edits forwards.  Every pass is a sorted stream with constant state.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.operators.order import stage

GIANT_ROWS = 1 << 16
GIANT_BYTES = 32 << 20
PIECE_ROWS = 1 << 14
PIECE_BYTES = 8 << 20
#: Costs of the edits; an undeleted truncated turn costs more.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"

_START, _S, _U, _A = range(4)
_NEXT = (_U, _U, _A, _U)  # the state after a user or assistant turn, whichever may follow
_KEEP = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_A, "u"): _U, (_U, "a"): _A}
_OPS = "DKR"
_LEGAL = ("su", "ua", "au")
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TURNS = "array<struct<edit:string,role:string,text:string>>"


class Edits:
    """The dynamic programme's steps, remembered by relative costs and kind of turn."""

    #: Nothing but the start is reached, at cost 0 with the first rank.
    FIRST = ((0, 0), None, None, None)

    def __init__(self):
        self.known = {}

    def step(self, state: tuple, initial: str, must_go: bool, cut: bool) -> tuple[tuple, int, int]:
        """``(states after the turn, cost taken off them, backpointers)``."""
        kind = (state, must_go or initial, cut)
        if kind not in self.known:
            self.known[kind] = self._step(state, initial, must_go, CUT if cut else 0)
        return self.known[kind]

    @staticmethod
    def _step(state, initial, must_go, extra):
        best = {}
        for x, reached in enumerate(state):
            if reached is None:
                continue
            cost, rank = reached
            at, inserted = x, ""
            for k in range(3):  # more inserts before one turn lead to no other state
                moves = [(DELETE, "D", at)]
                if not must_go:
                    if (at, initial) in _KEEP:
                        moves.append((extra, "K", _KEEP[at, initial]))
                    moves.append((REROLE + extra, "R", _NEXT[at]))
                for price, op, to in moves:
                    found = (cost + price, rank, inserted + op, x, k)
                    if to not in best or found < best[to]:
                        best[to] = found
                at, inserted, cost = _NEXT[at], inserted + "I", cost + INSERT
        # States that another reaches for less, its way on included, can't be on a cheapest path.
        cost = {x: f[0] for x, f in best.items()}
        after = min(cost.get(_A, 1 << 30), cost.get(_U, 1 << 30) + INSERT)
        for x, slack in ((_START, DELETE), (_S, DELETE), (_A, 0), (_U, INSERT)):
            if x in cost and cost[x] > after + slack:
                del best[x]
        ranks = {x: r for r, x in enumerate(sorted(best, key=lambda x: best[x][1:3]))}
        low = min(f[0] for f in best.values())
        pointers = 0
        for x, (_, _, edits, parent, k) in best.items():
            pointers |= (parent | k << 2 | _OPS.index(edits[-1]) << 4) << 6 * x
        return tuple((best[x][0] - low, ranks[x]) if x in best else None for x in range(4)), low, pointers

    @staticmethod
    def end(state: tuple) -> tuple[int, int, int]:
        """``(cost, last state, inserts after the last turn)`` of the best complete path."""
        ends = []
        for x, reached in enumerate(state):
            if reached is not None:
                cost, rank = reached
                at, k = x, 0
                while at not in ((_START, _A) if k == 0 else (_A,)):
                    at, k = _NEXT[at], k + 1
                ends.append((cost + INSERT * k, rank, x, k))
        cost, _, x, k = min(ends)
        return cost, x, k


def walk_back(pointers, state: int) -> tuple[bytes, int]:
    """``(edit of each turn as op + 4 * inserts before it, state before them)``."""
    out = bytearray(len(pointers))
    for i in range(len(pointers) - 1, -1, -1):
        p = pointers[i] >> 6 * state & 63
        out[i] = p >> 4 | (p >> 2 & 3) << 2
        state = p & 3
    return bytes(out), state


def apply_edits(state: int, edits: bytes, roles, texts, tail: int = 0) -> tuple[list[dict], int]:
    """The edited turns in order, deleted ones included without a role and text."""
    out = []

    def put(edit, role, text):
        nonlocal state
        if role is None:
            role = "assistant" if state == _U else "user"
            state = _NEXT[state]
        out.append({"edit": edit, "role": role, "text": text})

    for e, role, text in zip(edits, roles, texts):
        for _ in range(e >> 2):
            put("I", None, "")
        op = _OPS[e & 3]
        if op == "D":
            out.append({"edit": "D", "role": None, "text": None})
        elif op == "K":
            put("K", role, text)
            state = _KEEP[state, role[:1]]
        else:
            put("R", None, text)
    for _ in range(tail):
        put("I", None, "")
    return out, state


class Talk:
    """What is known of one conversation while its turns stream by."""

    def __init__(self, conv, edits: Edits):
        self.conv, self.edits = conv, edits
        self.state, self.cost = Edits.FIRST, 0
        self.low = self.high = self.last = self.before = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.seen: set = set()
        self.pointers = array("I")

    def add(self, turn, role: str, text: str, blank: bool, cut: bool, again) -> None:
        """``again``: whether role and text came in an earlier turn, or None to look it up here."""
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        here = (role, text)
        if again is None:
            again = here in self.seen
            self.seen.add(here)
        else:
            again = again or (turn, here) == self.last
            self.last = (turn, here)
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in _LEGAL
        self.before = initial
        self.blank += blank
        self.duplicate += not blank and again
        self.truncated += not blank and not again and cut
        self.state, low, pointers = self.edits.step(self.state, initial, blank or again, cut)
        self.cost += low
        self.pointers.append(pointers)

    def counts(self) -> tuple[dict, int, int]:
        """``(counts, last state, inserts after the last turn)``."""
        more, state, tail = Edits.end(self.state)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        values = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost + more)
        return dict(zip(_COUNTS, values)), state, tail


def _groups(batches, key: str):
    """Runs of rows of one key over sorted batches: ``(key, rows, first, last)``."""
    current, pending = None, None
    for batch in batches:
        names, columns = batch.schema.names, [c.to_pylist() for c in batch.columns]
        keys = columns[names.index(key)]
        lo, n = 0, len(keys)
        while lo < n:
            hi = lo + 1
            while hi < n and keys[hi] == keys[lo]:
                hi += 1
            fresh = current is None or current[0] != keys[lo]
            if pending is not None:
                yield (*pending, fresh)
            current = (keys[lo],)
            pending = (keys[lo], {m: c[lo:hi] for m, c in zip(names, columns)}, fresh)
            lo = hi
    if pending is not None:
        yield (*pending, True)


def _streamer(schema: pa.Schema):
    """Conversations held whole: one row each with its edited turns."""

    def stream(batches):
        edits, talk, rows, size = Edits(), None, [], 0
        for conv, g, first, last in _groups(batches, "conv"):
            if first:
                talk, roles, texts = Talk(conv, edits), [], []
            for here, turn, role, text, blank, cut in zip(g["here"], g["turn"], g["role"], g["text"], g["blank"], g["cut"]):
                if here:
                    talk.add(turn, role, text, blank, cut, None)
                    roles.append(role)
                    texts.append(text)
                    size += len(text)
            if last:
                counts, state, tail = talk.counts()
                done, _ = walk_back(talk.pointers, state)
                turns, _ = apply_edits(_START, done, roles, texts, tail)
                rows.append({"conv": conv, **counts, "turns": turns})
                if len(rows) >= 1000 or size > PIECE_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return stream


def _spiller(schema: pa.Schema, piece_rows: int, piece_bytes: int):
    """Giant conversations, first pass: turns and backpointers in pieces."""

    def stream(batches):
        edits = Edits()
        for conv, g, first, last in _groups(batches, "conv"):
            if first:
                talk, piece, pos, size = Talk(conv, edits), 0, 0, 0
            rows = []
            for here, turn, role, text, blank, cut, again in zip(*(g[c] for c in ("here", "turn", "role", "text", "blank", "cut", "again"))):
                if not here:
                    continue
                if len(talk.pointers) >= piece_rows or size > piece_bytes:
                    rows.append({"conv": conv, "piece": piece, "pointers": talk.pointers.tobytes()})
                    talk.pointers, piece, size = array("I"), piece + 1, 0
                talk.add(turn, role, text, blank, cut, again)
                rows.append({"conv": conv, "piece": piece, "pos": pos, "role": role, "text": text})
                pos, size = pos + 1, size + len(text)
            if last:
                counts, state, tail = talk.counts()
                rows.append({"conv": conv, "piece": piece, "pointers": talk.pointers.tobytes(), **counts, "state": state, "tail": tail})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return stream


def _walker(schema: pa.Schema):
    """Second pass: pieces from the last to the first, backpointers to edits."""

    def stream(batches):
        for conv, g, first, _ in _groups(batches, "conv"):
            rows = []
            for i, raw in enumerate(g["pointers"]):
                if g["state"][i] is not None:
                    state = g["state"][i]
                done, state = walk_back(array("I", raw), state)
                rows.append({"conv": conv, "piece": g["piece"][i], "edits": done, "tail": g["tail"][i],
                             **{c: g[c][i] for c in _COUNTS}})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return stream


def _applier(schema: pa.Schema):
    """Third pass: a piece's edits come before its turns."""

    def stream(batches):
        for _, g, first, _ in _groups(batches, "conv"):
            rows = []
            if first:
                state = _START
            for i, done in enumerate(g["edits"]):
                if done is not None:
                    piece = {"done": done, "roles": [], "texts": [], "row": {c: g[c][i] for c in ("conv", "piece", *_COUNTS)},
                             "tail": g["tail"][i] or 0}
                else:
                    piece["roles"].append(g["role"][i])
                    piece["texts"].append(g["text"][i])
                if len(piece["roles"]) == len(piece["done"]):
                    turns, state = apply_edits(state, piece["done"], piece["roles"], piece["texts"], piece["tail"])
                    rows.append({**piece["row"], "turns": turns})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return stream


def _arrow(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def damage(table: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``(conv, turn, role, text, here)``: faults planted by a checksum of the
    conversation and turn.  Of 20 remainders 0 drops a turn (``here`` is false,
    so that its conversation isn't forgotten), 1 empties its text, 2 removes
    its sentence ends, 3 repeats it, 4 makes it the user's.  Nulls count as one
    space, in the checksum too."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank(conv_col), F.lit(":"), blank(turn_col))) % 20
    text = blank(text_col)
    return table.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(blank(role_col)).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault != 0).alias("here"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def repair(turns: DataFrame, *, giant_rows: int = GIANT_ROWS, giant_bytes: int = GIANT_BYTES,
           piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``(conv, piece, pieces, gaps, blank, duplicate, truncated, illegal, cost, turns)``
    of rows ``(conv, turn, role, text, here)``: the counts of faults and the
    cheapest edits that give role initials ``(s?(ua)+)?``, as edited turns in
    order.  A giant conversation comes in several pieces, the counts with the last.

    A turn's first fault counts: blank (no character but ASCII spaces),
    duplicate (role and text came before), truncated (the last other character
    is no ``.``, ``!`` or ``?``).  Keep costs 0, Rerole 1, Delete 2 (a must for
    blank and duplicate turns), Insert 5; undeleted truncated turns cost 5 more.
    Of equal costs the edits with the least initials in ASCII count.

    Defined results: turns go by number, nulls first, equal numbers by role and
    text; a null conversation is one like any other; rows that aren't ``here``
    only name their conversation, which may be left empty; a table without rows
    gives none; very long texts are carried whole.
    """
    spark = turns.sparkSession
    conv = turns.schema["conv"].dataType.simpleString()
    kind = f"conv {conv}, {', '.join(f'{c} bigint' for c in _COUNTS)}, turns {_TURNS}"
    bare = F.rtrim("text", F.lit(SPACES))
    rows = turns.withColumn("blank", bare == "").withColumn("cut", ~F.right(bare, F.lit(1)).isin(".", "!", "?"))
    by_turn = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    sizes = turns.where("here").groupBy("conv").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("text")).alias("_b"))
    # At most one conversation for each GIANT_ROWS turns or GIANT_BYTES of text.
    giants = stage(sizes.where((F.col("_n") > giant_rows) | (F.col("_b") > giant_bytes)).select(
        F.col("conv").alias("_conv")), "giants")
    is_giant = F.col("conv").eqNullSafe(F.col("_conv"))
    any_giant = bool(giants.head(1))
    small = rows.join(giants, is_giant, "left_anti") if any_giant else rows
    out = small.repartition("conv").sortWithinPartitions(*by_turn).mapInArrow(
        _streamer(_arrow(spark, kind)), kind).withColumn("piece", F.lit(0).cast("bigint")).withColumn(
        "pieces", F.lit(1).cast("bigint"))
    columns = ["conv", "piece", "pieces", *_COUNTS, "turns"]
    if not any_giant:
        return out.select(columns)

    big = rows.join(giants, is_giant, "left_semi").withColumn("_text", F.sha2("text", 256))
    # A duplicate has an earlier turn with its role and text; combined map-side, so copies don't meet in one task.
    first = big.where("here").groupBy(F.col("conv").alias("_c"), F.col("role").alias("_r"), F.col("_text").alias("_t")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("_first"))
    big = big.join(first, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_text") == F.col("_t")), "left")
    big = big.withColumn("again", F.struct(F.col("turn").isNotNull().alias("some"), "turn") > F.col("_first")).select(
        "conv", "turn", "role", "text", "here", "blank", "cut", F.coalesce("again", F.lit(False)).alias("again"))
    state = ", ".join(f"{c} bigint" for c in (*_COUNTS, "state", "tail"))
    spilled = f"conv {conv}, piece bigint, pos bigint, role string, text string, pointers binary, {state}"
    spill = stage(big.repartition("conv").sortWithinPartitions(*by_turn).mapInArrow(
        _spiller(_arrow(spark, spilled), piece_rows, piece_bytes), spilled), "spill")
    edited = f"conv {conv}, piece bigint, edits binary, tail bigint, {', '.join(f'{c} bigint' for c in _COUNTS)}"
    edits = spill.where(F.col("pointers").isNotNull()).drop("pos", "role", "text").repartition("conv").sortWithinPartitions(
        "conv", F.desc("piece")).mapInArrow(_walker(_arrow(spark, edited)), edited)
    parts = spill.where(F.col("pos").isNotNull()).select("conv", "piece", "pos", "role", "text").unionByName(
        edits, allowMissingColumns=True)
    pieced = f"conv {conv}, piece bigint, {', '.join(f'{c} bigint' for c in _COUNTS)}, turns {_TURNS}"
    done = stage(parts.repartition("conv").sortWithinPartitions("conv", "piece", F.col("pos").asc_nulls_first()).mapInArrow(
        _applier(_arrow(spark, pieced)), pieced), "pieces")
    return out.select(columns).unionByName(done.withColumn("pieces", F.lit(2).cast("bigint")).select(columns))


def _digester(schema: pa.Schema):
    """Pieces in order to one row per conversation, the digest carried on."""

    def stream(batches):
        for conv, g, first, last in _groups(batches, "conv"):
            if first:
                digest, audit, any_turn, row = hashlib.sha256(), [], False, {}
            for i, turns in enumerate(g["turns"]):
                audit.append("".join(t["edit"] for t in turns))
                for t in turns:
                    if t["role"] is not None:
                        digest.update((("\n" if any_turn else "") + t["role"] + ":" + t["text"]).encode())
                        any_turn = True
                if g["cost"][i] is not None:
                    row = {c: g[c][i] for c in _COUNTS}
            if last:
                yield pa.RecordBatch.from_pylist(
                    [{"conv_id": conv, **row, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema)

    return stream


def summary(repaired: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``
    per conversation: the initials of its edits in order, and the digest of its
    repaired ``role:text`` lines joined by newlines."""
    whole = repaired.where("pieces = 1")
    stays = F.filter("turns", lambda t: t["role"].isNotNull())
    lines = F.array_join(F.transform(stays, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    out = whole.select(F.col("conv").alias("conv_id"), *_COUNTS,
                       F.array_join(F.transform("turns", lambda t: t["edit"]), "").alias("audit"),
                       F.sha2(lines, 256).alias("repaired_sha256"))
    schema = f"conv_id {repaired.schema['conv'].dataType.simpleString()}, " + ", ".join(
        f"{c} bigint" for c in _COUNTS) + ", audit string, repaired_sha256 string"
    giant = repaired.where("pieces > 1").repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(
        _digester(_arrow(repaired.sparkSession, schema)), schema)
    return out.unionByName(giant)


def repair_damaged(table: DataFrame, **how) -> DataFrame:
    """The query: damage the table, repair it, and sum up each conversation.

    Defined results as in ``damage`` and ``repair``; extra columns are ignored.
    """
    return summary(repair(damage(table), **how))

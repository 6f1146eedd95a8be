"""Differential test: Spark decode vs a direct Python model of the line rules."""

from __future__ import annotations

import random
import re

from sortlane.functions import codec

# White_Space (the trimmed set), as code points.
_WS = set("\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") | {chr(c) for c in range(0x2000, 0x200B)}
_ALPHABET = list("0123456789+-_,ax. ") + ["\t", "\r", "\n", "\x0b", "\u3000", "\xa0", "\x85", "\u200b", "\u2028"]


def model(line: str | None):
    """Reject reason or (id, name, address, continent), straight from the rules."""
    s = "" if line is None else line
    i, j = 0, len(s)
    while i < j and s[i] in _WS:
        i += 1
    while j > i and s[j - 1] in _WS:
        j -= 1
    parts = s[i:j].split(",")
    if len(parts) != 4:
        return "field_count"
    m = re.match(r"[+-]?[0-9]+", parts[0])
    if not m:
        return "id"
    v = int(m.group(0))
    if not -(2**63) <= v < 2**63:
        return "id"
    wrapped = ((v + 2**31) % 2**32) - 2**31
    return (wrapped, parts[1], parts[2], parts[3])


def _random_line(rnd: random.Random) -> str:
    n = rnd.randint(0, 14)
    body = "".join(rnd.choice(_ALPHABET) for _ in range(n))
    if rnd.random() < 0.5:  # bias towards 4-field lines with a numeric head
        digits = "".join(rnd.choice("0123456789") for _ in range(rnd.randint(1, 21)))
        body = rnd.choice(["", "+", "-", " ", "\u3000"]) + digits + rnd.choice(["", "x", "_", " "]) + \
            "," + "".join(rnd.choice(_ALPHABET) for _ in range(rnd.randint(0, 4))) + ",b,c"
    return body


def test_decode_matches_model(spark):
    rnd = random.Random(20261203)
    lines = [_random_line(rnd) for _ in range(4000)] + [None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lines)], "k int, value string")
    got = {r["k"]: r for r in codec.decode(df).collect()}
    mismatches = []
    for k, line in enumerate(lines):
        r = got[k]
        want = model(line)
        have = r["reject_reason"] if r["reject_reason"] else (r["id"], r["name"], r["address"], r["continent"])
        if have != want:
            mismatches.append((line, have, want))
    assert not mismatches, mismatches[:5]

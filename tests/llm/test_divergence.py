import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import DOC_SCHEMA, no_docs, odd_docs

from sortlane.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=3, top=200):
    """All pairs of sources and all kept terms, one by one."""
    df, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = TERM.findall(text.translate(LOWER))
        groups[lang].add(source)
        n[lang, source].update(terms)
        df[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, c in df[lang].items() if c >= min_docs)
        v = len(kept)
        whole = sum((n[lang, s] for s in sources), Counter())

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + v) for t in kept}

        q = shares(whole)
        p = {s: shares(n[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((p[s][x] - p[t][x]) ** 2 // p[t][x] for x in kept), t) for t in sources if t != s]
            terms = [((p[s][x] - q[x]) ** 2 // q[x], x) for x in kept if n[lang, s][x] and p[s][x] > q[x]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda i: (-i[0], i[1].encode()))
                for rank, (value, item) in enumerate(items if part == "pair" else items[:top]):
                    out.add((lang, s, part, item, value, rank + 1))
    return out


def result(df, **how):
    return {tuple(r) for r in dv.divergence(df, **how).collect()}


def some_docs(seed, n=300):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("the", "Wörter", "ça", "x", "Zebra") for b in ("", "a", "é", "ing", "Q")]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "c", None, "a b"])
        pick = words[:rng.randrange(1, len(words))]
        rows.append((" ".join(rng.choice(pick) for _ in range(rng.randrange(60))) + rng.choice(["", ".", "1 2"]), lang, source))
    return rows


@pytest.mark.parametrize("bits, scan_bytes", [(64, 500), (4, 3000), (1, dv.SCAN_BYTES)])
def test_equals_brute_force_also_where_digests_collide(spark, bits, scan_bytes):
    rows = some_docs(bits)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert result(df, digest_bits=bits, scan_bytes=scan_bytes) == brute(rows)


def test_ties_at_the_last_rank_go_by_the_term(spark):
    rows = [(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)), "en", "a")] * 3
    rows += [("zz yy", "en", "b")] * 3
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = result(df, top_terms=7)
    assert got == brute(rows, top=7) and sum(r[2] == "term" for r in got) >= 7


def test_a_term_cut_by_batches_and_pairs_taken_in_pieces(spark, monkeypatch):
    rows = [(f"common word{i % 7} more", "en", f"s{i}") for i in range(40)] * 3
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    monkeypatch.setattr(dv, "_PAIR_ROWS", 50)
    try:
        assert result(df) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_and_empty_tables(spark):
    odd = odd_docs(spark)
    assert result(odd, min_docs=1) == brute([(r.text, r.lang, r.source) for r in odd.collect()], min_docs=1)
    alone = spark.createDataFrame([(1, "1 2 3", "en", "a", 5), (2, None, "en", None, 0)], DOC_SCHEMA)
    assert result(alone) == {("en", "a", "pair", "", 0, 1), ("en", "", "pair", "a", 0, 1)}
    empty = dv.divergence(no_docs(spark))
    assert empty.count() == 0 and empty.columns == ["lang", "source", "part", "item", "value", "rank"]

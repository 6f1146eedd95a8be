"""Source divergence audit with late string materialization.

Which words set a source apart from its language, and which sources differ
most, from exact term counts.  The scan writes one row per (language, source,
term) of a chunk of documents: counts, a 64-bit digest of the term and, once
per language and chunk, the term in a column of its own.  All counting shuffles the fixed-width columns
alone.  Strings come back twice: as the smallest and the largest string of a
kept digest, which differ exactly if two terms share the digest (such digests
are then split and counted by string), and as the names of the terms that are
reported.

Languages and sources travel as digests too; their seed is chosen so that no
two of them collide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortlane.operators.order import stage

from .text import Hasher, ascii_lower, chunks, string_bytes, words

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
SCAN_BYTES = 8 << 20
#: Group tables (one row per source) up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_GROUPS = 100_000
_PAIR_ROWS = 1 << 20  # pairs of one term's sources held at a time


def _scanner(limit: int, bits: int, every: bool):
    """Arrow batches of ``(text, lang, source)`` to term counts per chunk and group;
    the chunk's first row of a language's term holds the string, or every row."""

    def scan(batches):
        hasher, mask = Hasher(), np.uint64((1 << bits) - 1)
        is_term = np.zeros(256, bool)
        is_term[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
        low = ascii_lower()
        for batch in batches:
            langs, sources = batch["lang"].dictionary_encode(), batch["source"].dictionary_encode()
            group = (langs.indices.to_numpy().astype(np.int64) * max(1, len(sources.dictionary))
                     + sources.indices.to_numpy())
            for lo, hi, data, offs in chunks(batch["text"], limit):
                w = words(data, offs, ~is_term)
                if not len(w.start):
                    continue
                ends = np.zeros(len(w.start) + 1, np.int32)
                np.cumsum(w.end - w.start, out=ends[1:])
                packed = low[data[is_term[data]]]
                terms = pa.StringArray.from_buffers(
                    len(w.start), pa.py_buffer(ends), pa.py_buffer(packed)).dictionary_encode()
                codes, n_codes = terms.indices.to_numpy().astype(np.int64), len(terms.dictionary)
                # Occurrences per (document, term), then per (group, term).
                pair, times = np.unique(w.doc * n_codes + codes, return_counts=True)
                kinds, of_doc = np.unique(group[lo:hi], return_inverse=True)
                key = of_doc[pair // n_codes] * n_codes + pair % n_codes
                order = np.argsort(key, kind="stable")
                key = key[order]
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                kind, code = kinds[key[first] // n_codes], key[first] % n_codes
                lang = kind // max(1, len(sources.dictionary))
                raw, ends = string_bytes(terms.dictionary)
                hasher.load(raw[:ends[-1]])
                digest = (hasher.ranges(ends[:-1], ends[1:]) & mask).view(np.int64)
                named = np.full(len(first), every)
                named[np.unique(lang * n_codes + code, return_index=True)[1]] = True
                yield pa.record_batch([
                    langs.dictionary.take(pa.array(lang)),
                    sources.dictionary.take(pa.array(kind % max(1, len(sources.dictionary)))),
                    pa.array(digest[code]),
                    terms.dictionary.take(pa.array(code, mask=~named)),
                    pa.array(np.add.reduceat(times[order], first).astype(np.int64)),
                    pa.array(np.diff(np.r_[first, len(key)]).astype(np.int64))],
                    ["lang", "source", "digest", "term", "n", "df"])

    return scan


def _seed(groups: DataFrame) -> int:
    """A seed under which no two languages and no two groups share a digest."""
    for seed in range(64):
        r = groups.agg(
            F.count(F.lit(1)).alias("g"), F.countDistinct(F.xxhash64("lang", "source", F.lit(seed))).alias("gh"),
            F.countDistinct("lang").alias("l"), F.countDistinct(F.xxhash64("lang", F.lit(seed))).alias("lh")).first()
        if r.g == r.gh and r.l == r.lh:
            return seed
    raise RuntimeError("no seed tells the sources apart")


def _share(n: str, total: str, v: str) -> Column:
    """``1 + floor(SCALE * (n + 1) / (total + v))``, exact at any count."""
    return F.expr(f"1 + (cast({n} + 1 as decimal(20,0)) * cast({SCALE} as decimal(10,0)))"
                  f" div cast({total} + {v} as decimal(20,0))").cast("bigint")


def _gap(p: str, q: str) -> Column:
    """``floor((p - q)^2 / q)``: shares are at most SCALE + 1, so the square fits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def count_terms(docs: DataFrame, seed: int, digest_bits: int = 64, scan_bytes: int = SCAN_BYTES,
                every: bool = False) -> DataFrame:
    """``(lid, gid, digest, n, df, term)``: occurrences and documents of each
    term per chunk of documents and (language, source).  Fewer bits of the
    digest make terms collide, for tests."""
    raw = docs.mapInArrow(_scanner(scan_bytes, digest_bits, every),
                          "lang string, source string, digest bigint, term string, n bigint, df bigint")
    return raw.select(F.xxhash64("lang", F.lit(seed)).alias("lid"), F.xxhash64("lang", "source", F.lit(seed)).alias("gid"),
                      "digest", "n", "df", "term")


def _kept(scan: DataFrame, keys: list[str], min_docs: int) -> DataFrame:
    """Counts per group of the terms in at least ``min_docs`` documents of the
    language, with the language's count; one exchange serves both sums."""
    term = ["lid", *keys]
    w = Window.partitionBy(*term)
    counts = scan.select("gid", *term, "n", "df").repartition(*term).groupBy("gid", *term).agg(
        F.sum("n").alias("n"), F.sum("df").alias("df"))
    return counts.withColumn("lang_df", F.sum("df").over(w)).withColumn("lang_n", F.sum("n").over(w)).where(
        F.col("lang_df") >= min_docs).drop("df", "lang_df")


def vocabulary(scan: DataFrame, again: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """``(counts, names)`` of the kept terms, both keyed by ``(lid, digest, sub)``.

    Counts come from digests alone.  A kept digest whose smallest and largest
    string differ is split: its rows of the scan ``again``, with all strings,
    are counted by string, and ``sub`` numbers its terms.  A digest below the bound holds no term above it.
    """
    kept = stage(_kept(scan, ["digest"], min_docs), "kept").withColumn("sub", F.lit(0))
    ends = scan.where("term IS NOT NULL").groupBy("lid", "digest").agg(F.min("term").alias("term"), F.max("term").alias("last"))  # nulls don't count
    names = stage(ends.join(kept.select("lid", "digest").distinct(), ["lid", "digest"], "left_semi"), "names")
    clash = names.where("term <> last").select("lid", "digest")
    if not clash.head(1):
        return kept, names.select("lid", "digest", F.lit(0).alias("sub"), "term")
    split = _kept(again.join(clash, ["lid", "digest"], "left_semi"), ["digest", "term"], min_docs)
    number = F.dense_rank().over(Window.partitionBy("lid", "digest").orderBy("term"))
    split = stage(split.withColumn("sub", number), "split")
    columns = ["gid", "lid", "digest", "n", "lang_n", "sub"]
    counts = kept.join(clash, ["lid", "digest"], "left_anti").select(columns).unionByName(split.select(columns))
    alone = names.where("term = last").select("lid", "digest", F.lit(0).alias("sub"), "term")
    return stage(counts, "counts"), alone.unionByName(split.select("lid", "digest", "sub", "term").distinct())


def _shared_pairs(batches):
    """Rows ``(lid, digest, sub, s, p, p0)`` sorted by term to ``(lid, s, t, d)``:
    for sources s and t that share terms, what the shared terms add to the sum
    made as if no term were shared.  A term that a batch cuts waits for the next."""

    def gap(p, q):
        return (p - q) ** 2 // q

    def pairs(lid, term, s, p, p0):
        # Rows of one term lie together: row i meets every row of its term.
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        size = np.diff(np.r_[first, len(term)])
        begin, width = np.repeat(first, size), np.repeat(size, size)
        total = np.cumsum(width)
        lo = 0
        while lo < len(term):
            done = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, done + _PAIR_ROWS, side="right")))
            w = width[lo:hi]
            i = np.repeat(np.arange(lo, hi), w)
            j = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(begin[lo:hi], w)
            i, j = i[i != j], j[i != j]
            d = gap(p[i], p[j]) - gap(p[i], p0[j]) - gap(p0[i], p[j]) + gap(p0[i], p0[j])
            order = np.lexsort((s[j], s[i], lid[i]))
            i, j, d = i[order], j[order], d[order]
            if len(i):
                cut = np.flatnonzero(np.r_[True, (lid[i[1:]] != lid[i[:-1]]) | (s[i[1:]] != s[i[:-1]])
                                           | (s[j[1:]] != s[j[:-1]])])
                yield lid[i[cut]], s[i[cut]], s[j[cut]], np.add.reduceat(d, cut)
            lo = hi

    def sums(cols):
        *key, p, p0 = cols
        lid, digest, sub, s = key
        term = np.cumsum(np.r_[0, (lid[1:] != lid[:-1]) | (digest[1:] != digest[:-1]) | (sub[1:] != sub[:-1])])
        for out in pairs(lid, term, s, p, p0):
            yield pa.record_batch([pa.array(c) for c in out], ["lid", "s", "t", "d"])

    names, wait = ["lid", "digest", "sub", "s", "p", "p0"], None
    for batch in batches:
        cols = [batch[n].to_numpy().astype(np.int64) for n in names]
        if not batch.num_rows:
            continue
        if wait is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(wait, cols)]
        last = np.flatnonzero(np.any([c[:-1] != c[1:] for c in cols[:3]], axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield from sums([c[:cut] for c in cols])
        wait = [c[cut:] for c in cols]
    if wait is not None:
        yield from sums(wait)


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *,
               min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, digest_bits: int = 64,
               scan_bytes: int = SCAN_BYTES) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: per (language, source) its
    divergence from every other source of the language (``pair``, all ranks)
    and the terms it uses more than the language does (``term``, ``top_terms``
    ranks).

    Terms are runs of ASCII letters and characters from U+0080 on, A-Z
    lower-cased.  A language keeps the V terms that at least ``min_docs`` of
    its documents hold.  A share is ``1 + floor(10^9 * (count + 1) / (N + V))``
    with N the counts' sum over kept terms; a value is ``floor((p - q)^2 / q)``,
    p the source's share and q the other source's (summed over all kept terms,
    held or not) or the language's.  All arithmetic is exact.

    Defined results: null text, language and source count as empty strings,
    which are values like any other; a source without terms is rated by the
    smallest shares; without kept terms pairs have the value 0 and there are
    no term rows; very long texts are scanned whole (a task holds the longest
    document); repeated rows are documents of their own; equal values rank by
    the UTF-8 bytes of the item; a table without rows gives none; other columns
    are ignored.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(text(text_col).alias("text"), text(lang_col).alias("lang"), text(source_col).alias("source"))
    groups = stage(docs.select("lang", "source").distinct(), "groups")
    seed, n_groups = _seed(groups), groups.count()
    small = F.broadcast if n_groups <= BROADCAST_GROUPS else (lambda df: df)
    scan = stage(count_terms(docs, seed, digest_bits, scan_bytes), "terms")
    counts, names = vocabulary(scan, count_terms(docs, seed, digest_bits, scan_bytes, every=True), min_docs)

    # One row per group: its number in the language, N, V, and the share of a term it doesn't hold.
    sizes = counts.groupBy("gid").agg(F.sum("n").alias("total"))
    kinds = names.groupBy("lid").agg(F.count(F.lit(1)).alias("v"))
    groups = groups.withColumn("lid", F.xxhash64("lang", F.lit(seed))).withColumn(
        "gid", F.xxhash64("lang", "source", F.lit(seed))).join(sizes, "gid", "left").join(kinds, "lid", "left").select(
        "lid", "gid", "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"),
        (F.row_number().over(Window.partitionBy("lid").orderBy("source"))).cast("bigint").alias("s"),
        F.sum(F.coalesce("total", F.lit(0))).over(Window.partitionBy("lid")).alias("lang_total"))
    groups = stage(groups.withColumn("p0", F.when(F.col("v") > 0, _share("0", "total", "v"))), "groups")
    rated = counts.join(small(groups.drop("lang", "source", "lid")), "gid").withColumn("p", _share("n", "total", "v"))
    return _pairs(rated, groups, small).unionByName(_terms(rated, names, groups, top_terms, small))


def _pairs(rated: DataFrame, groups: DataFrame, small) -> DataFrame:
    """Summed over all kept terms, from the terms held: those that neither
    source holds add the same each, those of one depend on its count alone."""
    big = lambda c: c.cast("decimal(38,0)")
    here = groups.select("lid", F.col("s"), F.col("p0").alias("p0"), "v", "lang", "source")
    other = groups.select("lid", F.col("s").alias("t"), F.col("p0").alias("q0"), F.col("source").alias("item"))
    base = here.join(other, "lid").where("s <> t").withColumn(
        "d", F.coalesce(big(_gap("p0", "q0")) * big(F.col("v")), big(F.lit(0))))
    by_share = rated.groupBy("lid", "s", "p", "p0").agg(F.count(F.lit(1)).alias("c"))
    met = by_share.join(small(other.drop("item")), "lid").where("s <> t")
    of_s = met.select("lid", "s", "t", (big(F.col("c")) * big(_gap("p", "q0") - _gap("p0", "q0"))).alias("d"))
    of_t = met.select("lid", F.col("t").alias("s"), F.col("s").alias("t"),
                      (big(F.col("c")) * big(_gap("q0", "p") - _gap("q0", "p0"))).alias("d"))
    term = ["lid", "digest", "sub"]
    both = rated.select(*term, "s", "p", "p0").repartition(*term).sortWithinPartitions(*term).mapInArrow(
        _shared_pairs, "lid bigint, s bigint, t bigint, d bigint").withColumn("d", big(F.col("d")))
    more = of_s.unionByName(of_t).unionByName(both).groupBy("lid", "s", "t").agg(big(F.sum("d")).alias("more"))
    value = (F.col("d") + F.coalesce("more", big(F.lit(0)))).cast("bigint")
    out = base.join(more, ["lid", "s", "t"], "left").select("lang", "source", "item", value.alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return out.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(rated: DataFrame, names: DataFrame, groups: DataFrame, top_terms: int, small) -> DataFrame:
    """The cut value is found on digests; only rows that reach it get their strings."""
    rated = rated.withColumn("q", _share("lang_n", "lang_total", "v")).where("p > q").select(
        "gid", "lid", "digest", "sub", _gap("p", "q").alias("value"))
    first = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), "digest", "sub"))
    cut = rated.withColumn("r", first).where(F.col("r") <= top_terms).groupBy("gid").agg(F.min("value").alias("cut"))
    named = rated.join(small(cut), "gid").where("value >= cut").join(names, ["lid", "digest", "sub"])
    rank = F.row_number().over(Window.partitionBy("gid").orderBy(F.desc("value"), "term"))
    top = named.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return top.join(small(groups.select("gid", "lang", "source")), "gid").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

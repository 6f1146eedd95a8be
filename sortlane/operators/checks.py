"""Data-quality and order checks over log tables.

All checks cover every row (the original scripts looked at a prefix only) and
report every rule instead of stopping at the first failure.

Order checks never put a whole log partition into one window: rows are cut
into offset blocks of ``block`` messages, descents are found inside each block
with ``lag``, and the block seams are compared on a per-block summary (one row
per block) -- the only windows over unbounded-looking groups run on those
summaries, whose size is the row count divided by ``block``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codec import decode
from ..functions.tables import small_table
from ..schema import (ADDRESS_LEN, CONTINENTS, NAME_LEN, REQUIRED_TOPICS, SORT_KEYS,
                      SOURCE_TOPIC)
from .order import stage

#: Offsets per block: bounds the rows of one window group at any scale.
DEFAULT_BLOCK = 1 << 16


# ---- P1-P3: record rules ------------------------------------------------------

def _schema_rules(value: Column) -> list[tuple[str, Column]]:
    """(rule, passes) pairs over a raw line, split like the original checker
    (no trim; the field rules only apply to four-field lines)."""
    parts = F.split(F.coalesce(value, F.lit("")), ",", -1)
    four = F.size(parts) == 4
    name_len = F.char_length(F.get(parts, 1))
    addr_len = F.char_length(F.get(parts, 2))
    return [
        ("field_count", four),
        ("name_length", ~four | name_len.between(*NAME_LEN)),
        ("address_length", ~four | addr_len.between(*ADDRESS_LEN)),
        ("continent_domain", ~four | F.get(parts, 3).isin(*CONTINENTS)),
    ]


def check_schema(log: DataFrame, topic: str = SOURCE_TOPIC) -> DataFrame:
    """Violations per rule over all messages of a topic: ``(rule, violations)``.

    One pass, one boolean per rule, map-side partial sums.
    """
    rules = _schema_rules(F.col("value"))
    counts = log.where(F.col("topic") == topic).agg(
        *[F.sum(F.when(ok, 0).otherwise(1)).cast("bigint").alias(name) for name, ok in rules]
    )
    stack = ", ".join(f"'{name}', {name}" for name, _ in rules)
    return counts.select(F.expr(f"stack({len(rules)}, {stack}) AS (rule, violations)")).select(
        "rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def schema_violations(log: DataFrame, topic: str = SOURCE_TOPIC) -> DataFrame:
    """Every failing (message, rule) pair."""
    rules = _schema_rules(F.col("value"))
    failed = F.filter(
        F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules]), lambda r: r.isNotNull())
    return (
        log.where(F.col("topic") == topic)
        .select("topic", "partition", "offset", "value", F.explode(failed).alias("rule"))
    )


def check_charset(records: DataFrame) -> DataFrame:
    """Generator promises not tested by the original: id >= 0, name a-z,
    address letters/digits/space.  ``(rule, violations)``."""
    counts = records.agg(
        F.sum(F.when(F.col("id") >= 0, 0).otherwise(1)).cast("bigint").alias("id_non_negative"),
        F.sum(F.when(F.col("name").rlike("^[a-z]*$"), 0).otherwise(1)).cast("bigint").alias("name_charset"),
        F.sum(F.when(F.col("address").rlike("^[A-Za-z0-9 ]*$"), 0).otherwise(1)).cast("bigint").alias("address_charset"),
    )
    return counts.select(F.expr(
        "stack(3, 'id_non_negative', id_non_negative, 'name_charset', name_charset, "
        "'address_charset', address_charset) AS (rule, violations)"
    )).select("rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def check_topics(spark: SparkSession, log: DataFrame, required: Sequence[str] = REQUIRED_TOPICS,
                 existing: Sequence[str] | None = None) -> DataFrame:
    """``(topic, present)`` for every required topic.

    ``existing``: the topics of the log table (``sources.log.list_topics``), so
    that an empty topic is present.  Without it a topic exists if it has a
    message.  Both sides have one row per topic.
    """
    want = small_table(spark, [(t,) for t in required], "topic string")
    if existing is not None:
        return want.select("topic", F.col("topic").isin(*existing).alias("present") if existing
                           else F.lit(False).alias("present"))
    have = log.select("topic").distinct().withColumn("present", F.lit(True))
    return want.join(F.broadcast(have), "topic", "left").select(
        "topic", F.coalesce("present", F.lit(False)).alias("present"))


# ---- A1-A3: counts and permutation -------------------------------------------

def count_by_topic(log: DataFrame) -> DataFrame:
    """A1: ``(topic, partition, n)``."""
    return log.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"))


def count_reconcile(log: DataFrame, source: str = SOURCE_TOPIC,
                    required: Sequence[str] = REQUIRED_TOPICS) -> DataFrame:
    """A2: every required topic's message count against the source topic's:
    ``(topic, n, n_source, ok)``; a topic without messages has n = 0."""
    per_topic = log.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    want = small_table(log.sparkSession, [(t,) for t in required], "topic string")
    counts = want.join(F.broadcast(per_topic), "topic", "left").select(
        "topic", F.coalesce("n", F.lit(0)).alias("n"))
    # One row per required topic.
    n_source = F.coalesce(F.max(F.when(F.col("topic") == source, F.col("n"))).over(Window.partitionBy()), F.lit(0))
    return counts.withColumn("n_source", n_source).select(
        "topic", "n", "n_source", (F.col("n") == F.col("n_source")).alias("ok"))


def multiset_reconcile(log: DataFrame, targets: Sequence[str] = tuple(SORT_KEYS),
                       source: str = SOURCE_TOPIC) -> DataFrame:
    """A3: lines whose multiplicity differs between a target topic and the source.

    A sort must be a permutation of its input; counts alone miss a swapped
    value.  Each source line is counted once per target topic (a literal list
    of topic names) and each target line once, in one aggregation keyed by
    ``(topic, value)`` with map-side partial sums -- a hot line is combined
    before the shuffle.  Output ``(topic, value, n_topic, n_source)``, only
    the differences.
    """
    is_src = F.col("topic") == source
    tagged = log.where(is_src | F.col("topic").isin(*targets)).select(
        F.when(is_src, F.array(*[F.lit(t) for t in targets]))
        .otherwise(F.array(F.col("topic"))).alias("_topics"),
        F.coalesce(F.col("value"), F.lit("")).alias("value"),
        is_src.alias("_src"),
    ).select(F.explode("_topics").alias("topic"), "value", "_src")
    agg = tagged.groupBy("topic", "value").agg(
        F.sum(F.when(F.col("_src"), 0).otherwise(1)).cast("bigint").alias("n_topic"),
        F.sum(F.when(F.col("_src"), 1).otherwise(0)).cast("bigint").alias("n_source"),
    )
    return agg.where(F.col("n_topic") != F.col("n_source"))


# ---- W1-W4: order checks -----------------------------------------------------

def _key_struct(key: str) -> Column:
    return F.struct(*[F.col(c) for c in SORT_KEYS[key]])


def _descents(log: DataFrame, key: str, block: int) -> tuple[DataFrame, DataFrame]:
    """Per-row descent flags inside offset blocks, and the per-block summary.

    Rejected lines keep their place with a NULL key and are skipped: each
    valid row is compared with the last valid key before it.  (Filtering them
    out first would make the optimizer evaluate the decode twice.)
    """
    recs = decode(log).select(
        "topic", "partition", "offset",
        F.when(F.col("reject_reason").isNull(), _key_struct(key)).alias("_k"),
        F.floor(F.col("offset") / block).cast("bigint").alias("_blk"))
    w = Window.partitionBy("topic", "partition", "_blk").orderBy("offset").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = recs.withColumn("_desc", F.coalesce(
        (F.col("_k") < F.last("_k", ignorenulls=True).over(w)).cast("int"), F.lit(0)))
    return rows, _block_summary(rows)


def _block_summary(rows: DataFrame) -> DataFrame:
    """One row per offset block: first and last valid key, descents inside and at its seam."""
    valid_at = F.when(F.col("_k").isNotNull(), F.col("offset"))
    blocks = rows.groupBy("topic", "partition", "_blk").agg(
        F.min_by("_k", valid_at).alias("_first"),
        F.max_by("_k", valid_at).alias("_last"),
        F.sum("_desc").alias("_inner"),
    )
    # Seam between a block and the last valid key of the blocks before it
    # (one row per block).
    wb = Window.partitionBy("topic", "partition").orderBy("_blk").rowsBetween(
        Window.unboundedPreceding, -1)
    return blocks.withColumn("_seam", F.coalesce(
        (F.col("_first") < F.last("_last", ignorenulls=True).over(wb)).cast("int"), F.lit(0)))


def check_sorted(log: DataFrame, key: str, block: int = DEFAULT_BLOCK, topic: str | None = None) -> DataFrame:
    """Descents in ``key`` order of its topic: ``(check, topic, scope, violations, ok)``.

    Only that topic (by default the one named after the key) is read.

    ``within``: consecutive messages of one partition.  ``across``: last
    message of partition p against the first of partition p+1 (a sorted topic
    published with contiguous ranges must pass both).  The name and continent
    checks compare ``(field, id)`` so the id tie-break is verified too.  Both
    scopes come from one per-partition summary, so the log is scanned once.
    """
    _, blocks = _descents(log.where(F.col("topic") == (topic or key)), key, block)
    parts = blocks.groupBy("topic", "partition").agg(
        (F.sum("_inner") + F.sum("_seam")).alias("_within"),
        F.min_by("_first", F.when(F.col("_first").isNotNull(), F.col("_blk"))).alias("_first"),
        F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("_blk"))).alias("_last"))
    # One row per log partition.
    wp = Window.partitionBy("topic").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    per_topic = parts.withColumn("_across", F.coalesce(
        (F.col("_first") < F.last("_last", ignorenulls=True).over(wp)).cast("int"), F.lit(0))
    ).groupBy("topic").agg(
        F.sum("_within").cast("bigint").alias("within"), F.sum("_across").cast("bigint").alias("across"))
    out = per_topic.select("topic", F.expr("stack(2, 'within', within, 'across', across) AS (scope, violations)"))
    return out.select(F.lit(f"sorted_{key}").alias("check"), "topic", "scope", "violations",
                      (F.col("violations") == 0).alias("ok"))


def detect_runs(log: DataFrame, key: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Maximal non-descending stretches per partition:
    ``(topic, partition, run_no, first_offset, last_offset, n)`` (valid lines only).

    ``run_no`` = descents before the row = earlier blocks' descents (prefix
    sum over the block summary) + the running count inside the block.
    """
    # Staged: the flagged rows serve the block summary and the numbering.
    flagged, _ = _descents(log, key, block)
    rows = stage(flagged, "flagged")
    blocks = _block_summary(rows)
    wb = Window.partitionBy("topic", "partition").orderBy("_blk").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = blocks.select(
        "topic", "partition", "_blk",
        (F.coalesce(F.sum(F.col("_inner") + F.col("_seam")).over(wb), F.lit(0)) + F.col("_seam")).alias("_base"),
    )
    wr = Window.partitionBy("topic", "partition", "_blk").orderBy("offset").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    numbered = rows.join(bases, ["topic", "partition", "_blk"]).withColumn(
        "run_no", (F.col("_base") + F.sum("_desc").over(wr)).cast("bigint"))
    return numbered.where(F.col("_k").isNotNull()).groupBy("topic", "partition", "run_no").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("n"))


def _print_sums() -> list[Column]:
    """Additive fingerprint of the lines: count and two salted hash sums."""
    v = F.coalesce(F.col("value"), F.lit(""))
    salted = lambda salt: F.sum(F.xxhash64(F.lit(salt), v).cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("n"), salted("first").alias("h1"), salted("second").alias("h2")]


def multiset_fingerprint(log: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Order-free fingerprint per topic: ``(topic, n, h1, h2)``.

    ``h1``/``h2`` are exact (decimal) sums of a 64-bit hash of each line, seeded
    by a salt that is hashed before the line.  Equal multisets always give
    equal fingerprints; different ones collide only by chance.  One scan with
    map-side partial sums; no line is shuffled.
    """
    return log.where(F.col("topic").isin(*topics)).groupBy("topic").agg(*_print_sums())


def validate_all(spark: SparkSession, log: DataFrame, block: int = DEFAULT_BLOCK,
                 existing: Sequence[str] | None = None) -> DataFrame:
    """L3: every check as ``(check, scope, violations, ok)``; all are reported.

    One pass per topic gives topics, counts, record rules and fingerprints; one
    pass of each sorted topic gives its order.  ``permutation`` is decided by
    the fingerprint (equal multisets always pass; that different ones pass is a
    matter of chance, about 2**-64); only topics whose fingerprint differs pay for the exact count of
    differing lines.  ``existing``: see ``check_topics``.
    """
    rules = _schema_rules(F.col("value"))
    got = {r["topic"]: r for r in log.groupBy("topic").agg(*_print_sums(), *[
        F.sum(F.when(ok, 0).otherwise(1)).alias(name) for name, ok in rules]).collect()}  # one row per topic
    of = lambda topic, col, none=0: got[topic][col] if topic in got else none
    there = set(existing) if existing is not None else set(got)
    rows = [("topics", t, 0 if t in there else 1) for t in REQUIRED_TOPICS]
    rows += [("schema", name, of(SOURCE_TOPIC, name)) for name, _ in rules]
    rows += [("counts", t, abs(of(t, "n") - of(SOURCE_TOPIC, "n"))) for t in REQUIRED_TOPICS]
    prints = {t: (of(t, "n"), of(t, "h1", None), of(t, "h2", None)) for t in REQUIRED_TOPICS}
    suspect = [t for t in SORT_KEYS if prints[t] != prints[SOURCE_TOPIC]]
    rows += [("permutation", t, 0) for t in SORT_KEYS if t not in suspect]
    if suspect:
        diffs = multiset_reconcile(log, suspect).groupBy("topic").agg(
            F.sum(F.abs(F.col("n_topic") - F.col("n_source"))).alias("d"))
        exact = {r["topic"]: r["d"] for r in diffs.collect()}  # one row per topic
        rows += [("permutation", t, exact.get(t, 0)) for t in suspect]
    out = small_table(spark, [(c, t, int(v)) for c, t, v in rows], "check string, scope string, violations bigint")
    for key in SORT_KEYS:
        out = out.unionByName(check_sorted(log, key, block).select(
            "check", F.concat_ws(":", "topic", "scope").alias("scope"), "violations"))
    return out.withColumn("ok", F.col("violations") == 0)

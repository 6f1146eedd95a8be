"""Incremental validation of a growing log.

Every check of ``validate_all`` is a fold over messages that can be cut at any
offset: counts and rule violations add up, the multiset fingerprint adds up, and
order needs only the first and last valid key of a stretch and the descents
inside it.  So a stretch of offsets is one summary row, and two neighbouring
stretches combine to one (a seam adds a descent if the second starts below the
end of the first), like the nodes of a segment tree:

* leaf: an offset block of the messages that came since the last call,
* node: a (topic, partition) up to the last call, kept in the state.

A call reads only messages at or after each partition's next offset (the bound
reaches the scan), writes their leaves to a table, and moves the nodes on.  The
leaves stay, so that a fault can be narrowed down to a block afterwards.  State
is a chain of versions with one entry per log partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codec import decode
from ..functions.tables import small_table
from ..schema import REQUIRED_TOPICS, SORT_KEYS, SOURCE_TOPIC
from ..session import remove_folder
from ..sinks.versions import create_state, read_state
from .checks import DEFAULT_BLOCK, _print_sums, _schema_rules, multiset_reconcile

#: The record rules of ``checks.check_schema``, in its order.
RULES = ["field_count", "name_length", "address_length", "continent_domain"]


@dataclass
class Node:
    """Summary of a stretch of one log partition; ``first`` and ``last`` are
    ``[text, id]`` keys of its first and last valid message."""

    next_offset: int
    n: int
    h1: str  # decimal sums of the fingerprint, as text
    h2: str
    descents: int
    first: list | None
    last: list | None
    rules: list[int]

    def then(self, other: "Node") -> "Node":
        """This stretch followed by the other one."""
        return Node(other.next_offset, self.n + other.n, str(Decimal(self.h1) + Decimal(other.h1)),
                    str(Decimal(self.h2) + Decimal(other.h2)),
                    self.descents + other.descents + below(other.first, self.last),
                    self.first if self.first is not None else other.first,
                    other.last if other.last is not None else self.last,
                    [a + b for a, b in zip(self.rules, other.rules)])


def below(key: Sequence | None, before: Sequence | None) -> int:
    """1 if ``key`` sorts before the one it follows (strings by their bytes, as in Spark)."""
    if key is None or before is None:
        return 0
    order = lambda k: ((k[0] or "").encode(), k[1])
    return int(order(key) < order(before))


def block_summaries(log: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Leaves: ``(topic, partition, blk, first_offset, next_offset, n, h1, h2,
    descents, first, last, <rules>)`` per offset block, from one scan.

    ``first`` and ``last`` are ``(text, id)``: the sorted topics' keys (no text
    for the id topic); other topics have none.  A block holds at most ``block``
    messages, which bounds the rows of one window group.
    """
    text = F.when(F.col("topic") == "id", F.lit(""))
    for key, fields in SORT_KEYS.items():
        if len(fields) > 1:
            text = text.when(F.col("topic") == key, F.col(fields[0]))
    ordered = F.col("topic").isin(*SORT_KEYS) & F.col("reject_reason").isNull()
    rows = decode(log.select("topic", "partition", "offset", "value")).select(
        "topic", "partition", "offset", "value", F.floor(F.col("offset") / block).cast("bigint").alias("blk"),
        F.when(ordered, F.struct(text.alias("text"), F.col("id").alias("id"))).alias("_k"))
    before = Window.partitionBy("topic", "partition", "blk").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_desc", F.coalesce((F.col("_k") < F.last("_k", ignorenulls=True).over(before)).cast("int"), F.lit(0)))
    valid_at = F.when(F.col("_k").isNotNull(), F.col("offset"))
    return rows.groupBy("topic", "partition", "blk").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("next_offset"), *_print_sums(),
        F.sum("_desc").cast("bigint").alias("descents"), F.min_by("_k", valid_at).alias("first"),
        F.max_by("_k", valid_at).alias("last"),
        *[F.sum(F.when(ok, 0).otherwise(1)).cast("bigint").alias(name) for name, ok in _schema_rules(F.col("value"))])


def fold_partitions(leaves: DataFrame) -> DataFrame:
    """One row per (topic, partition): its leaves combined in order of offset."""
    before = Window.partitionBy("topic", "partition").orderBy("first_offset").rowsBetween(Window.unboundedPreceding, -1)
    seams = leaves.withColumn("_seam", F.coalesce(
        (F.col("first") < F.last("last", ignorenulls=True).over(before)).cast("int"), F.lit(0)))
    has = F.when(F.col("first").isNotNull(), F.col("first_offset"))
    return seams.groupBy("topic", "partition").agg(
        F.min("first_offset").alias("first_offset"), F.max("next_offset").alias("next_offset"),
        F.sum("n").cast("bigint").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"),
        F.sum(F.col("descents") + F.col("_seam")).cast("bigint").alias("descents"),
        F.min_by("first", has).alias("first"), F.max_by("last", has).alias("last"),
        *[F.sum(r).cast("bigint").alias(r) for r in RULES])


@dataclass
class Validator:
    """Validates one log table again and again, reading what is new."""

    folder: str
    block: int = DEFAULT_BLOCK

    def __post_init__(self) -> None:
        self.folder = self.folder.rstrip("/")

    def state(self, spark: SparkSession) -> tuple[int, dict[str, dict[str, Node]]]:
        number, s = read_state(spark, f"{self.folder}/state")
        return number, {t: {p: Node(**n) for p, n in ps.items()} for t, ps in s.get("topics", {}).items()}

    def unread(self, log: DataFrame, nodes: Mapping[str, Mapping[str, Node]]) -> DataFrame:
        """Messages after the last call.  The least next offset of a topic is a
        plain bound that the scan uses; partitions further on are cut by a join
        with one row per log partition."""
        spark = log.sparkSession
        known = [(t, int(p), n.next_offset) for t, ps in nodes.items() for p, n in ps.items()]
        if not known:
            return log
        least = {t: min(n.next_offset for n in ps.values()) for t, ps in nodes.items()}
        bound = ~F.col("topic").isin(*least)
        for t, o in least.items():
            behind = [int(p) for p in nodes[t]]
            bound = bound | ((F.col("topic") == t) & ((F.col("offset") >= o) | ~F.col("partition").isin(*behind)))
        done = small_table(spark, known, "topic string, partition int, _next bigint")
        return log.where(bound).join(F.broadcast(done), ["topic", "partition"], "left").where(
            F.col("offset") >= F.coalesce(F.col("_next"), F.lit(0))).drop("_next")

    def advance(self, spark: SparkSession, log: DataFrame) -> dict[str, dict[str, Node]]:
        """Read what is new, write its leaves, and move the state on.

        The leaves are written before the version that counts them; a crash
        leaves the version before, and the next call reads the same messages.
        """
        number, nodes = self.state(spark)
        leaves = f"{self.folder}/leaves/version={number + 1}"
        block_summaries(self.unread(log, nodes), self.block).write.mode("overwrite").parquet(leaves)
        rows = fold_partitions(spark.read.parquet(leaves)).collect()  # one row per log partition
        if not rows:
            remove_folder(spark, leaves)
            return nodes
        for r in rows:
            key = lambda k: None if k is None else [k["text"], k["id"]]
            new = Node(r["next_offset"], r["n"], str(r["h1"]), str(r["h2"]), r["descents"], key(r["first"]), key(r["last"]),
                       [r[x] for x in RULES])
            old = nodes.setdefault(r["topic"], {}).get(str(r["partition"]))
            nodes[r["topic"]][str(r["partition"])] = old.then(new) if old else new
        create_state(spark, f"{self.folder}/state", number + 1, {
            "topics": {t: {p: vars(n) for p, n in ps.items()} for t, ps in nodes.items()}})
        return nodes

    def leaves(self, spark: SparkSession) -> DataFrame:
        """Summary rows of all committed calls, to find the block of a fault."""
        number, _ = self.state(spark)
        return spark.read.parquet(f"{self.folder}/leaves").where(F.col("version") <= number)

    def validate(self, spark: SparkSession, log: DataFrame, existing: Sequence[str] | None = None) -> DataFrame:
        """L3 as ``validate_all`` gives it: ``(check, scope, violations, ok)``.

        Only when a topic's fingerprint differs from the source's are the
        differing lines counted, over the whole log.
        """
        nodes = self.advance(spark, log)
        return self.report(spark, log, nodes, existing)

    def report(self, spark: SparkSession, log: DataFrame, nodes: Mapping[str, Mapping[str, Node]],
               existing: Sequence[str] | None = None) -> DataFrame:
        parts = lambda t: [n for _, n in sorted(nodes.get(t, {}).items(), key=lambda x: int(x[0]))]
        count = {t: sum(n.n for n in parts(t)) for t in REQUIRED_TOPICS}
        prints = {t: (count[t], sum(Decimal(n.h1) for n in parts(t)), sum(Decimal(n.h2) for n in parts(t))) for t in REQUIRED_TOPICS}
        there = set(existing) if existing is not None else {t for t in nodes if parts(t)}
        rows = [("topics", t, 0 if t in there else 1) for t in REQUIRED_TOPICS]
        rows += [("schema", r, sum(n.rules[i] for n in parts(SOURCE_TOPIC))) for i, r in enumerate(RULES)]
        rows += [("counts", t, abs(count[t] - count[SOURCE_TOPIC])) for t in REQUIRED_TOPICS]
        suspect = [t for t in SORT_KEYS if prints[t] != prints[SOURCE_TOPIC]]
        exact = {}
        if suspect:
            exact = {r["topic"]: r["d"] for r in multiset_reconcile(log, suspect).groupBy("topic").agg(
                F.sum(F.abs(F.col("n_topic") - F.col("n_source"))).alias("d")).collect()}  # one row per topic
        rows += [("permutation", t, int(exact.get(t, 0))) for t in SORT_KEYS]
        for key in SORT_KEYS:
            if parts(key):
                seams, last = 0, None
                for n in parts(key):
                    seams += below(n.first, last)
                    last = n.last if n.last is not None else last
                rows += [(f"sorted_{key}", f"{key}:within", sum(n.descents for n in parts(key))), (f"sorted_{key}", f"{key}:across", seams)]
        out = small_table(spark, rows, "check string, scope string, violations bigint")
        return out.withColumn("ok", F.col("violations") == 0)

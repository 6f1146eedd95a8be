"""Incremental compaction of streamed runs into one total order per topic (E5, M2).

A topic's store is a list of segments: disjoint key ranges, whose rows carry
their rank inside the segment.  Neighbouring segments share a pack, a folder of
about ``PACK_ROWS`` rows in the order of the segments, so that files grow with
the rows and not with the segments; a segment that is larger has its own.  A
chain of versions (``sinks.versions``) holds the list with each segment's lower
fence, row count and places, so one small file says what the store is.  A call

1. reads the streamed batches that came since the last one, and nothing older;
2. finds each row's segment by binary search over the fences;
3. leaves the rows of a segment that got few as *pending* rows beside it, and
4. merges the others with their segments: only those are read (from their packs,
   by slot), and the result is cut into segments of exact size, whose first keys
   are the new fences.

A segment is rewritten when its pending rows reach ``ratio`` of it, so a row is
rewritten a bounded number of times however large the store grows, and ranges
that got nothing are neither read nor written.  A row's place in the total order
is the count of the segments before it (from the version file) plus its rank;
pending rows are merged when read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import small_table
from ..operators.order import with_position
from ..schema import LOG_PARTITIONS, sort_key_columns
from ..session import list_folder, remove_folder
from ..sinks.publish import hash_partition, publish_sorted
from ..sinks.versions import create_state, read_state
from .runs import OUT_SCHEMA, StreamRuns

SEGMENT_ROWS = 1 << 20
PACK_ROWS = 1 << 18
_TYPES = {c.split()[0]: c.split()[1] for c in OUT_SCHEMA.split(", ")}
_PLACE = ["src_partition", "src_offset"]


def order_columns(topic: str) -> list[str]:
    """The topic's sort key, made unique by the record's place in the source."""
    return [*sort_key_columns(topic), *_PLACE]


def _schema(topic: str) -> str:
    return ", ".join(f"{c} {_TYPES[c]}" for c in [*order_columns(topic), "key", "value"])


def slot_of(key: Sequence[str], fences: Sequence[Sequence]) -> Column:
    """How many of the ascending ``fences`` are at most the row's key: log2 steps a row.

    The fences are one literal; there is one per segment.  A step of the search
    jumps over as many fences as a power of two if the last of them allows it.
    """
    if not fences:
        return F.lit(0)
    types = ", ".join(f"{c}: {_TYPES[c]}" for c in key)
    listed = F.from_json(F.lit(json.dumps([dict(zip(key, f)) for f in fences])), f"array<struct<{types}>>")
    mine = F.struct(*key)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(fences).bit_length()))])
    # Beyond the last fence there is null, which is no jump.
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(listed, at + step - 1) <= mine, at + step).otherwise(at))


def _cut(size: int, pieces: int, piece: int) -> int:
    """Rank at which a piece of a segment begins; pieces differ by at most one row."""
    return -(-piece * size // pieces)


def _firsts(sizes: Mapping[int, int]) -> dict[int, int]:
    """Rows before each segment, in the order of their numbers."""
    slots = sorted(sizes)
    return dict(zip(slots, accumulate([0, *(sizes[i] for i in slots)])))


@dataclass
class Segment:
    """One key range: from ``low`` (None: from the start) to the next segment's.

    ``folder`` and the pending ones name the pack, then the segment's rows in it.
    """

    low: list | None
    rows: int
    folder: str | None
    pending: list = field(default_factory=list)  # [folder, rows], oldest first

    def waiting(self) -> int:
        return sum(n for _, n in self.pending)

    def size(self) -> int:
        return self.rows + self.waiting()

    def folders(self) -> list[str]:
        return [f for f in [self.folder, *(p for p, _ in self.pending)] if f]


@dataclass
class Compacted:
    """What a call did per topic: segments rewritten, rows read from the store, rows that came."""

    version: int
    rewritten: dict[str, int] = field(default_factory=dict)
    kept: dict[str, int] = field(default_factory=dict)
    rows_read: dict[str, int] = field(default_factory=dict)
    rows_new: dict[str, int] = field(default_factory=dict)
    folders_read: list[str] = field(default_factory=list)


@dataclass
class Compactor:
    """The compacted store of a stream's output, and its reader."""

    runner: StreamRuns
    segment_rows: int = SEGMENT_ROWS
    ratio: float = 0.1
    partitions: int = LOG_PARTITIONS

    def __post_init__(self) -> None:
        self.base = f"{self.runner.base}/compact"

    # ---- state -------------------------------------------------------------------

    def state(self, spark: SparkSession) -> tuple[int, int, dict[str, list[Segment]]]:
        """``(version, last batch merged, segments per topic)``."""
        number, s = read_state(spark, f"{self.base}/state")
        topics = {t: [Segment(**x) for x in xs] for t, xs in s.get("topics", {}).items()}
        return number, s.get("upto", -1), {t: topics.get(t) or [Segment(None, 0, None)] for t in self.runner.sort_keys}

    def _arrived(self, spark: SparkSession, after: int, upto: int) -> DataFrame | None:
        """Rows of the streamed batches ``after`` < id <= ``upto``, from their folders alone."""
        names = [f"batch={b}" for b in range(after + 1, upto + 1)]
        there = set(list_folder(spark, f"{self.runner.base}/out")) if names else set()
        paths = [f"{self.runner.base}/out/{n}" for n in names if n in there]
        return spark.read.schema(OUT_SCHEMA).parquet(*paths) if paths else None

    def _stored(self, spark: SparkSession, topic: str, segments: Mapping[int, Segment]) -> DataFrame:
        """Rows of some segments, base and pending, with the number of their segment
        (``_slot``) and, if merged, their ``rank`` in it.  Their folders alone are read."""
        out = small_table(spark, [], f"{_schema(topic)}, rank bigint, _slot int")
        for kind in ("merged", "pending"):
            owner = {f: i for i, s in segments.items() for f in s.folders() if f.startswith(kind + "/")}
            if owner:
                # gen, topic and pack are folders, slot and piece columns; one row per segment says whose rows they are.
                names = [dict(part.split("=", 1) for part in f.split("/")[1:]) for f in owner]
                of = [(int(n["gen"]), int(n["slot"]), int(n["piece"]), i) for n, i in zip(names, owner.values())]
                rows = spark.read.schema(f"{_schema(topic)}, rank bigint, slot int, piece int").option(
                    "basePath", f"{self.base}/{kind}").parquet(*sorted({f"{self.base}/{f.rsplit('/slot=', 1)[0]}" for f in owner}))
                # Rows are in the order of the slots, so the bounds skip parts of a pack.
                slots = [n for _, n, _, _ in of]
                rows = rows.where(F.col("slot").between(min(slots), max(slots)))
                out = out.unionByName(rows.join(small_table(spark, of, "gen int, slot int, piece int, _slot int"),
                                                ["gen", "slot", "piece"]).select(*out.columns))
        return out

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Rows with ``slot``, ``piece``, ``rank`` and ``pack`` as packs in the order of the segments."""
        rows.sortWithinPartitions("pack", "slot", "piece", "rank").write.mode("overwrite").partitionBy("pack").parquet(
            f"{self.base}/{folder}")

    # ---- compaction ---------------------------------------------------------------

    def compact(self, spark: SparkSession, everything: bool = False) -> Compacted:
        """Take in the batches committed since the last call; ``everything``: and merge
        all that is pending.  A crash leaves the version before; a second compactor at
        the same time is refused with ``VersionConflict``."""
        number, upto, topics = self.state(spark)
        last = self.runner.last_committed(spark)
        last = upto if last is None else max(last, upto)
        done = Compacted(number)
        rows = self._arrived(spark, upto, last)
        if rows is None and not (everything and any(s.pending for xs in topics.values() for s in xs)):
            if last > upto:
                done.version = self._commit(spark, number, last, topics)
            return done
        gen, made = number + 1, []
        # The topics are independent jobs, submitted together.
        with ThreadPoolExecutor(max_workers=len(self.runner.sort_keys)) as pool:
            after = dict(zip(self.runner.sort_keys, pool.map(
                lambda t: self._topic(spark, t, topics[t], rows, gen, everything, done, made), self.runner.sort_keys)))
        try:
            done.version = self._commit(spark, number, last, after)
        except Exception:
            for folder in made:
                remove_folder(spark, f"{self.base}/{folder}")
            raise
        return done

    def _commit(self, spark: SparkSession, number: int, upto: int, topics: Mapping[str, list[Segment]]) -> int:
        create_state(spark, f"{self.base}/state", number + 1, {
            "upto": upto, "topics": {t: [vars(s) for s in xs] for t, xs in topics.items()}})
        return number + 1

    def _topic(self, spark, topic, segments, rows, gen, everything, done, made) -> list[Segment]:
        key = order_columns(topic)
        columns = [*key, "key", "value"]
        came: dict[int, int] = {}
        if rows is not None:
            mine = rows.where(F.col("topic") == topic).select(*columns).withColumn(
                "_slot", slot_of(key, [s.low for s in segments[1:]]))
            came = {r["_slot"]: r["n"] for r in mine.groupBy("_slot").agg(
                F.count(F.lit(1)).alias("n")).collect()}  # one row per segment at most
        ripe = {i: s for i, s in enumerate(segments)
                if s.waiting() + came.get(i, 0) >= max(1, 0 if everything else self.ratio * s.rows)}
        out = [Segment(s.low, s.rows, s.folder, list(s.pending)) for s in segments]
        wait = [i for i in came if i not in ripe]
        if wait:
            # Fewer rows than ``ratio`` of a segment for each slot.
            folder = f"pending/gen={gen}/topic={topic}"
            made.append(folder)
            packs = {i: n // PACK_ROWS for i, n in _firsts({i: came[i] for i in wait}).items()}
            plan = small_table(spark, list(packs.items()), "_slot int, pack bigint")
            self._write(mine.join(plan, "_slot").withColumnRenamed("_slot", "slot").withColumn("piece", F.lit(0)).withColumn(
                "rank", F.lit(None).cast("bigint")).repartition("pack"), folder)
            for i in wait:
                out[i].pending.append([f"{folder}/pack={packs[i]}/slot={i}/piece=0", came[i]])
        done.rows_new[topic], done.rewritten[topic] = sum(came.values()), len(ripe)
        done.kept[topic] = sum(1 for i, s in enumerate(segments) if i not in ripe and s.size())
        done.rows_read[topic] = sum(s.size() for s in ripe.values())
        done.folders_read.extend(f for s in ripe.values() for f in s.folders())
        if not ripe:
            return out
        merged = self._stored(spark, topic, ripe).drop("rank")
        if came:
            merged = merged.unionByName(mine.join(small_table(spark, [(i,) for i in ripe], "_slot int"), "_slot", "left_semi"))
        sizes = {i: s.size() + came.get(i, 0) for i, s in ripe.items()}
        pieces = {i: max(1, round(n / self.segment_rows)) for i, n in sizes.items()}
        firsts = _firsts(sizes)
        folder = f"merged/gen={gen}/topic={topic}"
        made.append(folder)
        ranked = self._ranked(spark, merged, key, sizes)
        plan = small_table(spark, [(i, sizes[i], pieces[i], firsts[i]) for i in ripe],
                           "_slot int, _size bigint, _pieces bigint, _first bigint")
        # Cut points are exact ranks; a segment is in the pack where its first row falls.
        cut = ranked.join(plan, "_slot").withColumn("piece", F.expr("(_rank * _pieces) div _size")).withColumn(
            "_cut", F.expr("(piece * _size + _pieces - 1) div _pieces"))
        self._write(cut.select(
            F.col("_slot").alias("slot"), F.col("piece").cast("int").alias("piece"), *columns,
            (F.col("_rank") - F.col("_cut")).alias("rank"), F.expr(f"(_first + _cut) div {PACK_ROWS}").alias("pack")), folder)
        heads = spark.read.schema(f"slot int, piece int, rank bigint, {_schema(topic)}").parquet(f"{self.base}/{folder}").where(
            "rank = 0 AND piece > 0").select("slot", "piece", F.struct(*key).alias("low"))
        lows = {(r["slot"], r["piece"]): list(r["low"]) for r in heads.collect()}  # one row per new segment
        made_of = {i: [Segment(lows[i, j] if j else segments[i].low, _cut(sizes[i], k, j + 1) - _cut(sizes[i], k, j),
                               f"{folder}/pack={(firsts[i] + _cut(sizes[i], k, j)) // PACK_ROWS}/slot={i}/piece={j}")
                       for j in range(k)] for i, k in pieces.items()}
        return [x for i, s in enumerate(out) for x in made_of.get(i, [s])]

    def _ranked(self, spark: SparkSession, rows: DataFrame, key: Sequence[str], sizes: Mapping[int, int]) -> DataFrame:
        """Rows with ``_rank`` in their segment, from one range-partitioned sort of them all."""
        bases = small_table(spark, list(_firsts(sizes).items()), "_slot int, _first bigint")
        # Messages of one place in the source (a repeated offset) keep the order of their run's topic partitions.
        part = lambda n: F.split_part("key", F.lit("-"), F.lit(n)).try_cast("bigint")
        ties = [part(2), hash_partition("key", self.runner.partitions), part(3)]
        return with_position(rows, ["_slot", *key, *ties], "_pos").join(bases, "_slot").withColumn(
            "_rank", F.col("_pos") - F.col("_first")).drop("_first", "_pos")

    # ---- readers -------------------------------------------------------------------

    def ordered(self, spark: SparkSession, topic: str) -> DataFrame:
        """The topic's rows with ``pos``, their place in its total order, and ``_total``.

        Merged segments are read as they are: the version file gives a segment's
        first position, the row its rank.  Only segments with pending rows are sorted.
        """
        _, _, topics = self.state(spark)
        segments = {i: s for i, s in enumerate(topics[topic]) if s.size()}
        bases = small_table(spark, list(_firsts({i: s.size() for i, s in segments.items()}).items()), "_slot int, _base bigint")
        settled = {i: s for i, s in segments.items() if not s.pending}
        waiting = {i: s for i, s in segments.items() if s.pending}
        rows = self._stored(spark, topic, settled).withColumnRenamed("rank", "_rank")
        if waiting:
            rows = rows.unionByName(self._ranked(spark, self._stored(spark, topic, waiting).drop("rank"), order_columns(topic),
                                                 {i: s.size() for i, s in waiting.items()}))
        total = sum(s.size() for s in segments.values())
        return rows.join(bases, "_slot").withColumn("pos", F.col("_base") + F.col("_rank")).drop(
            "_slot", "_base", "_rank").withColumn("_total", F.lit(total).cast("bigint"))

    def log(self, spark: SparkSession) -> DataFrame:
        """All topics in total order, as messages: ``topic, partition, offset, key, value``."""
        return reduce(DataFrame.unionByName, [
            publish_sorted(self.ordered(spark, t), t, self.partitions, key="key") for t in self.runner.sort_keys])

    def remove_old(self, spark: SparkSession) -> list[str]:
        """Delete the generations of a topic that the last version doesn't name."""
        number, _, topics = self.state(spark)
        named = {f.rsplit("/pack=", 1)[0] for xs in topics.values() for s in xs for f in s.folders()}
        gone = []
        for kind in ("merged", "pending"):
            for gen in list_folder(spark, f"{self.base}/{kind}"):
                for topic in list_folder(spark, f"{self.base}/{kind}/{gen}"):
                    folder = f"{kind}/{gen}/{topic}"
                    if folder not in named and int(gen.removeprefix("gen=")) <= number:
                        remove_folder(spark, f"{self.base}/{folder}")
                        gone.append(folder)
        return gone

"""Best-fit packing into bins of several permitted sequence lengths.

Pieces of equal length are interchangeable, so the plan is made on the
histogram of lengths, which has at most ``max(lengths)`` entries however many
documents there are.  Best-fit decreasing runs on it in bulk: a length's
pieces go to the open bins with the least room that fits; when none fits,
every permitted length is tried as a new bin, filled greedily from what is
still to come, and the one of least cost per packed word is opened.  At the
end each bin is downsized to the least permitted length that holds its
contents.

The plan is a table of ranges: pieces ``[from, to)`` of a length go to a run
of consecutive bins, ``per_bin`` at a time.  A piece finds its range by its
rank among pieces of its length, which is its place in one range-cut order, so
a hot length or a repeated piece (a third of all rows) is spread over many tasks.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .places import placed
from .text import WORD

LENGTHS = (512, 1024, 2048, 4096)
#: Fixed cost of a sequence, in words of padding: what one more bin costs besides its length.
OVERHEAD = 16


def _cheapest(size: int, hist: dict[int, int], present: list[int], lengths: Sequence[int], overhead: int) -> int:
    """The permitted length with the least cost per word, when a new bin that
    starts with ``size`` is filled greedily from the pieces still to come."""
    best = None
    for cap in lengths:
        if cap < size:
            continue
        room, first = cap - size, True
        at = bisect.bisect_right(present, min(room, size)) - 1
        while at >= 0 and room > 0:
            s = present[at]
            left = hist[s] - (1 if first and s == size else 0)
            k = min(left, room // s)
            room -= max(0, k) * s
            at = min(at - 1, bisect.bisect_right(present, room) - 1)
        # The bin is downsized in the end, so only what a smaller length would hold as well is wasted.
        held = cap - room
        real = min(c for c in lengths if c >= held)
        cost = ((real + overhead) / held, cap)
        best = min(best, cost) if best else cost
    return best[1]


def plan_bins(counts: dict[int, int], lengths: Sequence[int] = LENGTHS,
              overhead: int = OVERHEAD) -> tuple[list[tuple], list[tuple]]:
    """``(ranges, bins)`` for pieces per length.

    ranges: ``(length, from_rank, to_rank, first_bin, per_bin, offset)``;
    bins: ``(first_bin, end_bin, used, capacity)`` as runs of equal bins.
    """
    lengths = sorted(lengths)
    hist = dict(counts)
    present = sorted(s for s in hist if s > 0 and hist[s] > 0)
    open_: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room: runs (first bin, bins, used)
    rooms: list[int] = []
    ranges: list[tuple] = []
    closed: list[tuple[int, int, int]] = []
    bins = 0

    def add(room: int, run: tuple[int, int, int]) -> None:
        if room <= 0:
            closed.append(run)
            return
        if not open_[room]:
            bisect.insort(rooms, room)
        open_[room].append(run)

    while present:
        s = present[-1]
        c, rank = hist[s], 0
        while c:
            at = bisect.bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                first, n, used = open_[room].pop()
                if not open_[room]:
                    rooms.pop(at)
            else:
                hist[s] = c
                room = _cheapest(s, hist, present, lengths, overhead)
                first, n, used = bins, -(-c // max(1, room // s)), 0
                # Other lengths may be cheaper once the counts have moved on: open a share at a time.
                n = min(n, max(1, n // 2))
                bins += n
            k = room // s
            full = min(n, c // k)
            if full:
                ranges.append((s, rank, rank + full * k, first, k, used))
                add(room - k * s, (first, full, used + k * s))
                rank, c = rank + full * k, c - full * k
            if full < n:
                rest = min(c, k - 1) if c < k else 0
                if rest:
                    ranges.append((s, rank, rank + rest, first + full, rest, used))
                    add(room - rest * s, (first + full, 1, used + rest * s))
                    rank, c, full = rank + rest, c - rest, full + 1
                if full < n:
                    add(room, (first + full, n - full, used))
        present.pop()
        hist[s] = 0
    for runs in open_.values():
        closed.extend(runs)
    out = [(f, f + n, used, next(c for c in lengths if c >= used)) for f, n, used in closed if used]
    return ranges, sorted(out)


def pieces(docs: DataFrame, id_col: str, text_col: str, longest: int) -> DataFrame:
    """``(doc_id, piece, start, length)``: consecutive runs of at most
    ``longest`` words; the last one has one place more for the end mark."""
    n = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)) + 1
    sized = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), n.cast("bigint").alias("n"))
    return sized.select("doc_id", "n", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / longest))).alias("piece")).select(
        "doc_id", "piece", (F.col("piece") * longest).alias("start"),
        F.least(F.lit(longest), F.col("n") - F.col("piece") * longest).cast("bigint").alias("length"))


def pack(items: DataFrame, key_cols: Sequence[str], length_col: str = "length", lengths: Sequence[int] = LENGTHS,
         overhead: int = OVERHEAD, seed: int = 5) -> DataFrame:
    """Add ``bin_id, bin_offset, capacity, used`` to items of 1 to ``max(lengths)``."""
    spark = items.sparkSession
    # In order of length, and of a hash inside a length: an item's rank there is its place less the shorter
    # items.  Range cuts bound a task's items, though a third of them be equal.
    keys = [F.col(c) for c in key_cols]
    ranked = placed(items, [length_col, F.xxhash64(*keys, F.lit(seed)), *keys], "_place").select(*items.columns, "_place")
    # At most max(lengths) rows go to the driver.
    counts = {int(r[0]): int(r[1]) for r in ranked.groupBy(length_col).count().collect()}
    ranges, bins = plan_bins(counts, lengths, overhead)
    shorter = np.zeros(max(lengths) + 2, np.int64)
    for size, n in counts.items():
        shorter[size + 1] = n
    shorter = np.cumsum(shorter)

    # The plan is bounded by the permitted lengths, not by the documents.
    shift = 44
    r = np.array(sorted(ranges) or [(0, 0, 0, 0, 1, 0)], np.int64)
    b = np.array(bins or [(0, 0, 0, 0)], np.int64)
    shared = spark.sparkContext.broadcast((r, (r[:, 0] << shift) + r[:, 1], b, shorter))
    columns = list(items.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, starts_at, runs, before = shared.value
        for batch in batches:
            length = batch.column(columns.index(length_col)).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(len(columns)).to_numpy(zero_copy_only=False) - before[length]
            p = plan[np.searchsorted(starts_at, (length << shift) + rank, side="right") - 1]
            i = rank - p[:, 1]
            bin_id = p[:, 3] + i // p[:, 4]
            run = runs[np.searchsorted(runs[:, 0], bin_id, side="right") - 1]
            added = [bin_id, p[:, 5] + i % p[:, 4] * length, run[:, 3], run[:, 2]]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(x) for x in added],
                                             [*columns, "bin_id", "bin_offset", "capacity", "used"])

    schema = ", ".join(f"`{c}` {t}" for c, t in items.dtypes)
    return ranked.mapInArrow(place, f"{schema}, bin_id bigint, bin_offset bigint, capacity bigint, used bigint")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, seed: int = 5) -> DataFrame:
    """``(doc_id, piece, start, length, bin_id, bin_offset, capacity, used)``.

    A document's length is its words plus one end mark.  Documents longer than
    the largest permitted length are cut into consecutive pieces (nothing is
    dropped); every piece lies whole in one bin.  ``capacity`` is the downsized
    length of the bin, ``used`` the words in it.

    Defined results: a null, empty or blank text is its end mark alone (length
    1); a very long one gives many pieces; repeated rows, ties and null ids are
    packed one by one, be they a third of the table; an empty table gives an
    empty result; other columns are ignored.
    """
    items = pieces(docs, id_col, text_col, max(lengths))
    out = pack(items, ["doc_id", "piece"], "length", lengths, overhead, seed)
    return out.select("doc_id", "piece", "start", "length", "bin_id", "bin_offset", "capacity", "used")

"""WARC fixity audit with Merkle trees over ordered offset ranges.

Records are digested where they are read; only ``(archive, offset, length,
digest)`` moves.  Level 1 of an archive's tree hashes the ordered records of
each 64 KiB range of offsets; each next level hashes 16 neighbouring nodes,
up to one root per archive, and on over the archives up to one root per
replica.  Ranges are cut by the offset written in the index, so a missing or
extra record changes its own branch only.

The audit compares roots and descends: only nodes below parents that differ
are compared, and only records in ranges that differ.  A level's table is
scanned for them by a semi-join; the levels above the records hold a small
share of the rows.  Every group has at most 16 children, or the records of one
range.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortlane.operators.order import stage, with_position

from .places import placed

ARCHIVE_RECORDS = 1024
RANGE_BITS = 16
FAN_BITS = 4
#: Records whose offsets one task sums.
BLOCK_BITS = 16
VERSION = b"WARC/1.0\r\n"
READ_BYTES = 1 << 20
#: A header of more lines is no header.
HEADER_LINES = 10_000
DAMAGE_EVERY = 53


def record_text(page_id: Column, url: Column, html: Column) -> Column:
    """One WARC/1.0 response record; its identifier is a digest of the page id."""
    body = F.coalesce(html.cast("string"), F.lit(""))
    name = F.md5(F.coalesce(page_id.cast("string"), F.lit("")))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:md5:"), name,
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _digits(text: Column) -> Column:
    """The first eight hexadecimal digits of a text's MD5, as a number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def pages_to_records(pages: DataFrame) -> DataFrame:
    """``(page_id, length, digest)`` of a page table's records."""
    record = record_text(F.col("page_id"), F.col("url"), F.col("html"))
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), record.alias("record")).select(
        "page_id", F.octet_length("record").cast("bigint").alias("length"), F.sha2("record", 256).alias("digest"))


def scan_warc(stream) -> Iterator[tuple[int, int, str]]:
    """``(offset, length, digest)`` of each record of a binary stream of uncompressed WARC.

    A record ends where its Content-Length says, so a version line inside a
    payload is no boundary.  Payloads are digested in pieces of ``READ_BYTES``.
    Bytes that are no record (a damaged header, a payload cut short) run up to
    the next version line at a line start and are one entry: damage shows there
    and the records after it keep their places.
    """
    source = _Pushback(stream)
    at, held = 0, None  # held: hash and length of bytes that are no record
    while True:
        head = source.read(len(VERSION))
        if not head:
            break
        if head == VERSION:
            if held:
                yield at - held[1], held[1], held[0].hexdigest()
                held = None
            lines, size = [head], None
            while (line := source.line()) and line != b"\r\n" and len(lines) < HEADER_LINES:
                lines.append(line)
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length" and value.strip().isdigit():
                    size = int(value)
            lines.append(line)
            digest, n = hashlib.sha256(b"".join(lines)), sum(map(len, lines))
            left = size + 4 if size is not None and line == b"\r\n" else 0
            while left and (piece := source.read(min(left, READ_BYTES))):
                digest.update(piece)
                n, left = n + len(piece), left - len(piece)
            if size is not None and not left:
                yield at, n, digest.hexdigest()
            else:
                held = (digest, n)
            at += n
        else:
            source.back(head)
            line = source.line()
            held = held or (hashlib.sha256(), 0)
            held[0].update(line)
            held, at = (held[0], held[1] + len(line)), at + len(line)
    if held:
        yield at - held[1], held[1], held[0].hexdigest()


class _Pushback:
    """Exact reads and bounded lines of a stream, with bytes given back."""

    def __init__(self, stream):
        self.stream, self.left = stream, b""

    def back(self, data: bytes) -> None:
        self.left = data + self.left

    def read(self, n: int) -> bytes:
        while len(self.left) < n and (more := self.stream.read(max(n - len(self.left), 1 << 16))):
            self.left += more
        out, self.left = self.left[:n], self.left[n:]
        return out

    def line(self) -> bytes:
        """Up to a line feed, or ``READ_BYTES`` of a longer line."""
        while (end := self.left.find(b"\n", 0, READ_BYTES)) < 0 and len(self.left) < READ_BYTES:
            if not (more := self.stream.read(1 << 16)):
                break
            self.left += more
        return self.read(end + 1 if end >= 0 else min(len(self.left), READ_BYTES))


def read_warc(spark, path: str) -> DataFrame:
    """``(file, offset, length, digest, page_id)`` of the records of uncompressed
    WARC files under ``path``: file name, true byte offset and length by
    Content-Length.  Records are named by their identifier, so page_id is null.

    Spark lists the files and deals them to tasks; a task streams each of its
    files through ``pyarrow.fs``, one piece in memory at a time.  A folder
    without files gives an empty result.
    """
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")

    def scan(batches):
        from pyarrow import fs

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(_plain_uri(uri))
                with system.open_input_stream(place) as stream:
                    records = scan_warc(stream)
                    while part := list(itertools.islice(records, 4096)):
                        offset, length, digest = (list(x) for x in zip(*part))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([uri.rsplit("/", 1)[-1]] * len(part)), pa.array(offset, pa.int64()),
                             pa.array(length, pa.int64()), pa.array(digest), pa.nulls(len(part), pa.int64())],
                            ["file", "offset", "length", "digest", "page_id"])

    # Large files first, one range each as far as there are tasks.
    dealt = names.repartitionByRange(F.desc("length"), "path").select("path")
    return dealt.mapInArrow(scan, "file string, offset bigint, length bigint, digest string, page_id bigint")


def _plain_uri(uri: str) -> str:
    """Spark writes ``file:/a``, the file system library reads ``file:///a``."""
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def audit_files(spark, first: str, second: str) -> DataFrame:
    """Audit of two folders of WARC files against each other: the rows of
    :func:`audit` and the ``file`` they are in.  Files are matched by name (names
    are told apart within a folder); one that a side lacks shows all its records."""
    sides = [stage(read_warc(spark, p), "warc") for p in (first, second)]
    names = sides[0].select("file").union(sides[1].select("file")).distinct()
    archives = stage(with_position(names, ["file"], "archive"), "archives")
    numbered = [s.join(archives, "file").select("archive", "offset", "length", "digest", "page_id") for s in sides]
    return audit(*numbered).join(archives, "archive")


def layout(sizes: DataFrame, archives: int) -> DataFrame:
    """Add ``archive, offset``: records of an archive in order of id, end to end.

    ``sizes`` has ``page_id, length, digest``; about ``ARCHIVE_RECORDS`` records
    share an archive, chosen by a digest of the id.  Records of a null or
    repeated id make one archive larger, but no task: offsets are sums within
    blocks of ``2**BLOCK_BITS`` neighbouring records plus those of the blocks before.
    """
    spread = _digits(F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    order = ["archive", "page_id", "digest"]
    cut = stage(placed(sizes.withColumn("archive", F.pmod(spread, F.lit(archives))), order, "_n").withColumn(
        "_block", F.shiftright("_n", BLOCK_BITS)), "ordered")
    before = lambda *cols: Window.partitionBy(*cols[:-1]).orderBy(cols[-1]).rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy(F.col("archive").alias("_a"), F.col("_block").alias("_b")).agg(F.sum("length").alias("_l")).select(
        "_a", "_b", F.coalesce(F.sum("_l").over(before("_a", "_b")), F.lit(0)).alias("_start"))
    inside = cut.withColumn("_before", F.coalesce(F.sum("length").over(before("_block", "archive", "_n")), F.lit(0)))
    return inside.join(starts, (F.col("archive") == F.col("_a")) & (F.col("_block") == F.col("_b"))).withColumn(
        "offset", (F.col("_start") + F.col("_before")).cast("bigint")).drop("_a", "_b", "_start", "_before", "_block", "_n")


def build_tree(index: DataFrame) -> list[tuple[DataFrame, str | None]]:
    """Levels of the trees of ``index(replica, archive, offset, length, digest)``, record ranges first.

    Each level is ``(replica, a, slot, hash, records)`` and which column the
    next level joins 16 to one: ``slot`` inside an archive, then ``a``, a run of
    archives.  The last level has one node per replica (None: nothing above).
    """
    top = index.agg(F.max("offset"), F.max("archive")).first()
    if top[0] is None:
        return []
    entry = lambda e: F.concat_ws(":", e["offset"].cast("string"), e["length"].cast("string"), e["digest"])
    child = lambda e: F.concat_ws(":", e["at"].cast("string"), e["hash"])
    joined = lambda items, line: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(items)), line), "\n"), 256)
    level = stage(index.groupBy("replica", F.col("archive").alias("a"),
                                F.shiftright("offset", RANGE_BITS).alias("slot")).agg(
        joined(F.struct("offset", "length", "digest"), entry).alias("hash"),
        F.count(F.lit(1)).alias("records")), "tree")
    left = {"slot": int(top[0]) >> RANGE_BITS, "a": int(top[1])}
    out = []
    for col in ("slot", "a"):
        while left[col]:
            out.append((level, col))
            level = stage(_parents(level, col).groupBy("replica", F.col("_a").alias("a"), F.col("_s").alias("slot")).agg(
                joined(F.struct(F.col(col).alias("at"), "hash"), child).alias("hash"),
                F.sum("records").alias("records")), "tree")
            left[col] >>= FAN_BITS
    return [*out, (level, None)]


def _parents(level: DataFrame, col: str) -> DataFrame:
    """Add the place ``(_a, _s)`` of each node's parent."""
    up = F.shiftright(col, FAN_BITS)
    return level.withColumn("_a", up if col == "a" else F.col("a")).withColumn("_s", up if col == "slot" else F.col("slot"))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records in which two replicas differ.

    Both have ``archive, offset, length, digest, page_id``.  Result:
    ``(archive, offset, end_offset, page_id, kind, expected, found)`` with kind
    ``missing`` (only in the first), ``extra`` (only in the second), ``length``
    or ``content``; end_offset is that of the first where it has the record.
    Nodes below equal ones are not compared.  Rows repeated at one place count by
    their smallest digest.
    """
    cols = ["archive", "offset", "length", "digest", "page_id"]
    index = first.select(F.lit(0).alias("replica"), *cols).unionByName(second.select(F.lit(1).alias("replica"), *cols))
    index = stage(index.groupBy("replica", "archive", "offset").agg(
        F.min(F.struct("digest", "length", "page_id")).alias("r")).select(
        "replica", "archive", "offset", "r.length", "r.digest", "r.page_id"), "index")
    side = lambda r, value: F.max(F.when(F.col("replica") == r, value))
    bad: DataFrame | None = None
    for level, col in reversed(build_tree(index)):
        if bad is not None:
            level = _parents(level, col).join(bad, ["_a", "_s"], "left_semi")
        both = level.groupBy("a", "slot").agg(side(0, F.col("hash")).alias("x"), side(1, F.col("hash")).alias("y"))
        bad = stage(both.where("NOT (x <=> y)").select(F.col("a").alias("_a"), F.col("slot").alias("_s")), "differing")
    rows = index
    if bad is not None:
        rows = index.withColumn("_a", F.col("archive")).withColumn("_s", F.shiftright("offset", RANGE_BITS)).join(
            bad, ["_a", "_s"], "left_semi")
    entry = F.struct("digest", "length", "page_id")
    pair = rows.groupBy("archive", "offset").agg(side(0, entry).alias("x"), side(1, entry).alias("y")).where(
        "NOT (x.digest <=> y.digest AND x.length <=> y.length)")
    kind = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").when(
        F.col("x.length") != F.col("y.length"), "length").otherwise("content")
    return pair.select("archive", "offset", (F.col("offset") + F.coalesce("x.length", "y.length")).alias("end_offset"),
                       F.coalesce("x.page_id", "y.page_id").alias("page_id"), kind.alias("kind"),
                       F.col("x.digest").alias("expected"), F.col("y.digest").alias("found"))


def audit_pages(pages: DataFrame, archive_records: int = ARCHIVE_RECORDS) -> DataFrame:
    """Audit of a damaged replica of all ``pages`` against the intact one.

    The tables hold no second replica, so faults are planted, by a digest of
    the page id: of ``DAMAGE_EVERY`` records one has its middle character
    replaced, one lost its last character, one is missing and one is known to
    the second replica only.

    Defined results: a null url or html counts as empty, a null page id as an
    empty one (such records share an archive and sort first, be they a third of all);
    equal records and ties are separate records; a very long html is digested
    where it is read; an empty table gives an empty result; other columns
    are ignored.
    """
    records = pages.select(F.col("page_id").cast("bigint").alias("page_id"),
                           record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    turn = F.pmod(_digits(F.concat(F.lit("damage:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
                  F.lit(DAMAGE_EVERY))
    copy = F.when(F.col("turn") == 0, F.concat(
        F.expr("substring(record, 1, cast(floor(length(record) / 2) as int))"), F.lit("#"),
        F.expr("substring(record, cast(floor(length(record) / 2) as int) + 2)"))).when(
        F.col("turn") == 1, F.expr("substring(record, 1, length(record) - 1)")).otherwise(F.col("record"))
    digests = records.withColumn("turn", turn).withColumn("copy", copy).select(
        "page_id", "turn", F.octet_length("record").cast("bigint").alias("length"), F.sha2("record", 256).alias("digest"),
        F.octet_length("copy").cast("bigint").alias("_length"), F.sha2("copy", 256).alias("_digest"))
    digests = stage(digests, "digests")
    archives = max(1, -(-digests.count() // archive_records))
    placed = stage(layout(digests, archives), "layout")
    first = placed.where("turn <> 3").select("archive", "offset", "length", "digest", "page_id")
    second = placed.where("turn <> 2").select("archive", "offset", F.col("_length").alias("length"),
                                              F.col("_digest").alias("digest"), "page_id")
    return audit(first, second)

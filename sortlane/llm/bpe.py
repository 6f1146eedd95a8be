"""Byte-level BPE encoding and decoding over distinct words.

A text is cut into pre-tokens, and BPE of a pre-token depends on nothing else,
so each distinct word of the whole corpus is encoded once:

1. runs of whole documents (blocks) are cut; a block's words are numbered, most
   frequent first, and its documents become those numbers in order (the
   positions).  The words go into buckets by hash; a block's words of one bucket
   are one packed row, its documents another.  The two kinds of rows are made by
   a scan each, since cutting again costs less than keeping them; a check sum of
   a block's words in both tells if the scans ever saw different rows.
2. the word rows are shuffled by bucket and sorted, so that a pass over a
   partition meets all words of a bucket, encodes each distinct one once by the
   merge ranks, and gives the ids back to every block that has it.
3. the ids are shuffled by block, where the numbers are replaced by ids,
   position by position.

A word as frequent as one in three is listed once per block, so no word is hot;
a bucket's words are held once each, so give more buckets for more words.
Decoding joins ids with the token-byte table, one row per vocabulary entry; a
table of that proven size is shipped to the tasks and looked up by Arrow batch.

Cutting follows the usual pattern (contractions; letters, digits or other marks
with one space before them; white space up to the last one before a word).
Which characters are letters, digits and white space differs between versions
of Unicode, so the classes are asked of the tokenizer library itself.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortlane.operators.order import stage

from .text import Hasher, chunks, string_bytes

BLOCK_BYTES = 16 << 20
BUCKETS = 256
#: Text bytes cut, and numbers replaced, at a time.
_STEP = 1 << 20
_WORDS = "block bigint, sum binary, bucket int, sizes binary, numbers binary, data binary, n int, n_bytes bigint"
_DOCS = "block bigint, sum binary, numbers binary, n int, doc_ids array<bigint>, counts array<int>"
#: Longer words are merged with a heap, whose time grows with n log n.
LONG_WORD = 1 << 10
_OTHER, _LETTER, _DIGIT, _SPACE = range(4)
_TOKENS = "doc_id bigint, ids array<int>"


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, one base64 word and one number a line."""
    if "://" in path:
        lines = bytes(spark.read.format("binaryFile").load(path).first()["content"])
    else:  # a file of the driver's machine
        with open(path, "rb") as f:
            lines = f.read()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}


def character_classes() -> np.ndarray:
    """Class of every code point as the tokenizer library's own patterns see it."""
    points = np.r_[np.arange(0xD800), np.arange(0xE000, 0x110000)].astype("<u4")
    text = points.tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    one_byte = {bytes([i]): i for i in range(256)}
    for kind, pattern in ((_LETTER, r"\p{L}"), (_DIGIT, r"\p{N}"), (_SPACE, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=one_byte, special_tokens={})
        found = bytes(probe.encode_ordinary(text)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return out


def cut_words(data: np.ndarray, offs: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(byte offsets of the pre-tokens' starts and the end, pre-tokens per
    document)`` of documents that lie end to end in ``data``."""
    at = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
    n = len(at)
    if not n:
        return np.zeros(1, np.int64), np.zeros(len(offs) - 1, np.int64)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    kind = classes[code]
    doc_start = np.zeros(n + 1, bool)
    doc_start[np.searchsorted(at, offs)] = True  # empty documents share a place
    doc_start[n] = True
    start = doc_start[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # White space before a character of its document: the last one stands alone, or goes with what follows if a blank.
    last = np.flatnonzero((kind == _SPACE) & ~doc_start[1:])
    last = last[kind[last + 1] != _SPACE]
    start[last] = True
    blank = last[code[last] == 0x20]
    start[blank + 1] = False
    # Contractions: a lone mark before 's 't 'm 'd 're 've 'll takes those letters.
    c = np.r_[code, np.zeros(3, code.dtype)]
    k = np.r_[kind, np.full(3, 255, np.uint8)]
    stop = np.r_[doc_start, np.ones(3, bool)]
    mark = np.flatnonzero(start & (code == 0x27))
    mark = mark[~stop[mark + 1] & (k[mark + 1] == _LETTER)]
    a, b = c[mark + 1], c[mark + 2]
    two = ~stop[mark + 2] & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
    one = np.isin(a, np.array([ord(x) for x in "stmd"], a.dtype))
    for rows, length in ((mark[one], 1), (mark[two], 2)):
        start[rows + 1] = False
        rest = rows + 1 + length
        rest = rest[~stop[rest]]
        start[rest] = True
    tokens = np.flatnonzero(start)
    first = np.searchsorted(tokens, np.searchsorted(at, offs))
    return np.r_[at[tokens], len(data)], np.diff(first)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """BPE of one word: always the pair of the lowest rank, the leftmost of
    those, from a heap of pairs whose outdated entries are skipped."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts here
    before = list(range(-1, n - 1))
    alive = bytearray(b"\x01") * n

    def pair(i):
        j = end[i]
        return None if j >= n else ranks.get(word[i:end[j]])

    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        j = end[i]
        end[i], alive[j] = stop, 0
        if stop < n:
            before[stop] = i
        for at in (before[i], i):
            if at >= 0 and (rank := pair(at)) is not None:
                heapq.heappush(heap, (rank, at, end[end[at]]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Small numbers in few bytes: byte planes, compressed."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpack_numbers(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


class Block:
    """Documents cut so far: their ids, pre-token counts, and pieces of numbered words."""

    def __init__(self):
        self.ids, self.counts, self.pieces, self.size = [], [], [], 0

    def add(self, doc_ids: pa.Array, data: np.ndarray, offs: np.ndarray, kinds: np.ndarray) -> None:
        starts, per_doc = cut_words(data, offs, kinds)
        self.ids.append(doc_ids)
        self.counts.append(per_doc)
        self.pieces.append(pa.StringArray.from_buffers(
            len(starts) - 1, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode())
        self.size += len(data)

    def rows(self, block: int, buckets: int | None) -> pa.RecordBatch:
        """The block's words, one row per bucket, or its documents as one row (without ``buckets``)."""
        one = pa.chunked_array(self.pieces).unify_dictionaries()
        numbers = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in one.chunks])
        listed = one.chunk(0).dictionary
        by_use = np.argsort(-np.bincount(numbers, minlength=len(listed)), kind="stable")
        raw, ends = string_bytes(listed.take(pa.array(by_use)))
        raw = raw[:ends[-1]]
        check = hashlib.blake2b(ends.tobytes() + raw.tobytes(), digest_size=16).digest()
        if buckets is None:
            rank = np.empty(len(by_use), np.int64)
            rank[by_use] = np.arange(len(by_use))
            whole = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
            return pa.record_batch([
                pa.array([block]), pa.array([check], pa.binary()), pa.array([pack_numbers(rank[numbers])], pa.binary()),
                pa.array([len(numbers)], pa.int32()), whole(pa.concat_arrays(self.ids)),
                whole(pa.array(np.concatenate(self.counts).astype(np.int32)))], [c.split()[0] for c in _DOCS.split(", ")])
        hasher = Hasher()
        hasher.load(raw)
        bucket = (hasher.ranges(ends[:-1], ends[1:]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        used = np.flatnonzero(cuts[1:] > cuts[:-1])
        words = [_packed_words(raw, ends, order[cuts[k]:cuts[k + 1]]) for k in used]
        types = [pa.binary()] * 3 + [pa.int32(), pa.int64()]
        return pa.record_batch([
            pa.array(np.full(len(used), block)), pa.array([check] * len(used), pa.binary()), pa.array(used.astype(np.int32)),
            *[pa.array([w[i] for w in words], t) for i, t in enumerate(types)]], [c.split()[0] for c in _WORDS.split(", ")])


def _gather(ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, ends)`` of the stretches ``at`` of a flat array, laid end to end."""
    size = ends[at + 1] - ends[at]
    to = np.r_[0, np.cumsum(size)]
    return np.arange(to[-1]) - np.repeat(to[:-1], size) + np.repeat(ends[at], size), to


def _packed_words(raw: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes, bytes, int, int]:
    """Words ``at`` (ascending) of a block: their lengths, steps between their numbers, and bytes."""
    place, to = _gather(ends, at)
    return (pack_numbers(np.diff(to)), pack_numbers(np.diff(at, prepend=0)), pa.compress(raw[place].tobytes(), codec="zstd", asbytes=True),
            len(at), int(to[-1]))


def _scanner(classes, limit: int, buckets: int | None):
    """Arrow batches of ``(doc_id, text)`` to the rows of blocks, of words or of documents."""

    def scan(batches):
        kinds, number = np.frombuffer(classes.value, np.uint8), TaskContext.get().partitionId() << 32
        block = Block()
        for batch in batches:
            for lo, hi, data, offs in chunks(batch["text"], min(limit, _STEP)):
                block.add(batch["doc_id"].slice(lo, hi - lo), data, offs, kinds)
                if block.size >= limit:
                    yield block.rows(number, buckets)
                    block, number = Block(), number + 1
        if block.ids:
            yield block.rows(number, buckets)

    return scan


def _encoder(ranks):
    """Word rows sorted by bucket to the same rows with ids for bytes."""

    def encode(batches):
        table = ranks.value
        whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})
        bucket, known = None, {}

        def ids_of(word: bytes) -> list[int]:
            ids = known.get(word)
            if ids is None:
                ids = known[word] = whole.encode_ordinary(word.decode()) if len(word) < LONG_WORD else merge_long(word, table)
            return ids

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in batch.schema.names}
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                data = pa.decompress(row["data"], decompressed_size=row["n_bytes"], codec="zstd", asbytes=True) if row["n_bytes"] else b""
                ends = np.cumsum(unpack_numbers(row["sizes"], row["n"])).tolist()
                lists = [ids_of(data[a:b]) for a, b in zip([0, *ends], ends)]
                ids = np.fromiter((t for ts in lists for t in ts), np.int64)
                yield pa.record_batch([
                    pa.array([row["block"]]), pa.array([row["sum"]], pa.binary()), pa.array([bucket], pa.int32()),
                    pa.array([pack_numbers(np.fromiter(map(len, lists), np.int64, len(lists)))], pa.binary()),
                    pa.array([row["numbers"]], pa.binary()), pa.array([pack_numbers(ids)], pa.binary()),
                    pa.array([row["n"]], pa.int32()), pa.array([len(ids)], pa.int64())], [c.split()[0] for c in _WORDS.split(", ")])

    return encode


def _fill(left: pa.Table, right: pa.Table):
    """A block's documents with the ids of its words in place of their numbers, some documents at a time."""
    rows = right.to_pylist()
    if any(r["sum"] != d["sum"] for r in rows for d in left.to_pylist()):
        raise RuntimeError("the scans saw different rows; stage the documents first (fixed_rows=False)")
    at = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(unpack_numbers(r["numbers"], r["n"]).astype(np.int64)) for r in rows)])
    size = np.concatenate([np.zeros(0, np.int64), *(unpack_numbers(r["sizes"], r["n"]).astype(np.int64) for r in rows)])
    flat = np.concatenate([np.zeros(0, "<u4"), *(unpack_numbers(r["data"], r["n_bytes"]) for r in rows)])
    ends = np.r_[0, np.cumsum(size)]
    place = np.empty(len(at), np.int64)
    place[at] = np.arange(len(at))  # where each number's ids lie
    for row in left.to_pylist():
        doc_ids, counts = pa.array(row["doc_ids"], pa.int64()), np.array(row["counts"], np.int64)
        doc_ends = np.r_[0, np.cumsum(counts)]
        numbers = unpack_numbers(row["numbers"], row["n"])
        lo = 0
        while lo < len(counts):
            hi = min(len(counts), max(lo + 1, int(np.searchsorted(doc_ends, doc_ends[lo] + _STEP, side="right")) - 1))
            found, to = _gather(ends, place[numbers[doc_ends[lo]:doc_ends[hi]]])
            yield pa.record_batch([doc_ids.slice(lo, hi - lo), pa.ListArray.from_arrays(
                pa.array(to[doc_ends[lo:hi + 1] - doc_ends[lo]].astype(np.int32)), pa.array(flat[found].astype(np.int32)))],
                ["doc_id", "ids"])
            lo = hi


def _per_block(then, schema: str):
    """Group function of a block: its encoded documents, passed through ``then`` batch by batch."""
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = list(then(_fill(left, right)))
        return pa.Table.from_batches(out).select(names)

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES, buckets: int = BUCKETS, fixed_rows: bool = False) -> DataFrame:
    """``(doc_id, ids)``: the token ids of each document, special tokens never.

    ``fixed_rows``: the documents are read straight from files, so that two scans
    give the same rows in the same partitions; otherwise they are staged first.

    Defined results: a null or empty text has no ids; rows are encoded one by
    one, so null and repeated ids and repeated rows stay as they are; very long
    texts are encoded whole (a task holds the longest document, and a very long
    word is merged in n log n steps); a table without rows gives none; other
    columns are ignored.
    """
    return _encoded(docs, ranks, id_col, text_col, block_bytes, buckets, fixed_rows, lambda batches: batches, _TOKENS)


def _encoded(docs, ranks, id_col, text_col, block_bytes, buckets, fixed_rows, then, schema: str) -> DataFrame:
    sc = docs.sparkSession.sparkContext
    # Both are of the size of Unicode and of the vocabulary, whatever the data.
    classes, shipped = sc.broadcast(character_classes().tobytes()), sc.broadcast(ranks)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if not fixed_rows:
        rows = stage(rows, "documents")
    words = rows.mapInArrow(_scanner(classes, block_bytes, buckets), _WORDS)
    back = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_encoder(shipped), _WORDS)
    lists = rows.mapInArrow(_scanner(classes, block_bytes, None), _DOCS).withColumnRenamed("block", "of")
    return lists.groupBy("of").cogroup(back.groupBy("block")).applyInArrow(_per_block(then, schema), schema)


def _decoder(table):
    def decode(batches):
        sizes, data = table.value
        ends = np.r_[0, np.cumsum(sizes)]
        for batch in batches:
            lists = batch["ids"]
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            size = sizes[ids]
            to = np.r_[0, np.cumsum(size)]
            place = np.arange(to[-1]) - np.repeat(to[:-1], size) + np.repeat(ends[ids], size)
            doc_ends = to[np.r_[0, np.cumsum(np.diff(lists.offsets.to_numpy()))]]
            raw = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [
                None, pa.py_buffer(doc_ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[place]))])
            yield pa.record_batch([batch["doc_id"], lists, raw.cast(pa.binary())], ["doc_id", "ids", "decoded"])

    return decode


def token_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: length of each id's bytes, and all bytes in order of id."""
    by_id = sorted((i, t) for t, i in ranks.items())
    sizes = np.zeros((by_id[-1][0] if by_id else 0) + 1, np.int64)
    for i, t in by_id:
        sizes[i] = len(t)
    return sizes, np.frombuffer(b"".join(t for _, t in by_id), np.uint8)


def decode(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``(doc_id, ids, decoded)``: the bytes that the ids stand for, joined
    from the token-byte table (one entry per id of the vocabulary)."""
    table = tokens.sparkSession.sparkContext.broadcast(token_bytes(ranks))
    return tokens.select("doc_id", "ids").mapInArrow(_decoder(table), f"{_TOKENS}, decoded binary")


def _digests(batches):
    for batch in batches:
        ids = batch["ids"]
        ends = np.cumsum(np.r_[0, np.diff(ids.offsets.to_numpy())])
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        yield pa.record_batch([
            batch["doc_id"], pa.array(np.diff(ends).astype(np.int64)),
            pa.array([hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:])], pa.string()),
            pa.array([hashlib.sha256(b.as_buffer()).hexdigest() for b in batch["decoded"]], pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip_digests(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text",
                       block_bytes: int = BLOCK_BYTES, buckets: int = BUCKETS, fixed_rows: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of each document
    encoded and decoded again: digests of the ids as little-endian unsigned
    32-bit integers and of the decoded bytes.  Defined results as in ``encode``."""
    table = docs.sparkSession.sparkContext.broadcast(token_bytes(ranks))
    decoder = _decoder(table)
    return _encoded(docs, ranks, id_col, text_col, block_bytes, buckets, fixed_rows, lambda batches: _digests(decoder(batches)),
                    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

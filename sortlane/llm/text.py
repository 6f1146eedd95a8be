"""Vectorised text scanning over Arrow string columns.

A scan works on the raw UTF-8 bytes of a run of whole documents (about
``CHUNK`` bytes at a time, or one longer document), so memory per task is
bounded by the longest single document and no per-word Python code runs.
Word separators are the ASCII bytes 0x20 and 0x09-0x0D, which never occur
inside a multi-byte UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Regular expression of one word, as used by the SQL side.
WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 20


def string_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offs, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(arr: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents: ``(first row, end row, bytes, offsets from 0)``."""
    raw, offs = string_bytes(arr)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def separators() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def ascii_lower() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 32
    return t


class Hasher:
    """Hash of byte ranges of one chunk in O(1) each, from prefix sums.

    ``sum(code[byte] * P**position)`` modulo 2**64, brought back to position 0
    with the inverse power, then mixed with the length.
    """

    P = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, seed: int = 7):
        # A 64-bit code per byte value, from the mixing function.
        self.codes = mix((np.arange(1, 257, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0xD6E8FEB86659FD93))
        inv = pow(int(self.P), -1, 1 << 64)
        self.inverse = np.uint64(inv)
        self._grow(CHUNK + 1)

    def _grow(self, n: int) -> None:
        self.size = n
        for name, base in (("powers", self.P), ("inverses", self.inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def load(self, data: np.ndarray, table: np.ndarray | None = None) -> None:
        """Prefix sums of ``data`` (each byte first mapped through ``table``)."""
        if len(data) + 1 > self.size:
            self._grow(len(data) + 1)
        codes = self.codes if table is None else self.codes[table]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * self.powers[:len(data)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverses[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


@dataclass
class Words:
    """Words of a chunk: byte range and the document (row of the chunk) of each."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # index of each document's first word, and the total last


def words(data: np.ndarray, offs: np.ndarray, is_sep: np.ndarray) -> Words:
    """Split a chunk at separator bytes; a word never crosses documents."""
    n_docs = len(offs) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(n_docs + 1, np.int64))
    inside = ~is_sep[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    full = offs[1:] > offs[:-1]
    firsts, lasts = offs[:-1][full], offs[1:][full] - 1
    begins[firsts] = inside[firsts]
    ends[lasts] = inside[lasts]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offs)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    return Words(start, end, doc, first)


def shingles(word_hash: np.ndarray, w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, doc)`` of every run of ``size`` words; a shorter document gives
    its whole word sequence as one, a document without words none."""
    q = np.uint64(0xC2B2AE3D27D4EB4F)

    def run(at: np.ndarray, k: int) -> np.ndarray:
        h = np.zeros(len(at), np.uint64)
        for j in range(k):
            h = mix(h * q + word_hash[at + j])
        return h + np.uint64(k)

    counts = np.diff(w.first)
    at = np.arange(max(0, len(word_hash) - size + 1))
    at = at[w.doc[at] == w.doc[at + size - 1]] if len(at) else at
    hashes, docs = [run(at, size)], [w.doc[at]]
    for k in range(1, size):
        short = np.flatnonzero(counts == k)
        if len(short):
            hashes.append(run(w.first[short], k))
            docs.append(short)
    return np.concatenate(hashes), np.concatenate(docs)

"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: round after round each feature in turn gets one shallow tree
over its bins, added to that feature's lookup table with a small step; the
strongest feature pairs then get two-way tables the same way.  A score is the
sum of one table entry per feature and pair, looked up for a whole batch at a
time, and the tables are the model's full explanation.

Features come from the text alone; see ``FEATURES``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .classify import TRAIN_ROWS, bin_edges, feature_rows, score_all, sigmoid, to_bins, training_sample
from .text import Hasher, ascii_lower, chunks, separators, words

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "symbol", "stop", "exclaim", "pipe", "line_breaks",
    "repeat_words", "distinct_words", "top_word", "distinct_pairs", "short_words", "long_words", "symbol_end",
    "caps_words", "title_words", "same_byte", "non_ascii", "longest_word",
)
THRESHOLD = 0.3


def _class_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_UPPER = _class_table(bytes(range(0x41, 0x5B)))
_LETTER = _class_table(bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)))
_DIGIT = _class_table(b"0123456789")
_SYMBOL = _class_table(b"#$%&*+/<=>@[\\]^_`{|}~")
_STOP = _class_table(b".,;:")
_EXCLAIM = _class_table(b"!?")
_HIGH = _class_table(bytes(range(0x80, 0x100)))


def _distinct(doc: np.ndarray, key: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: number of distinct keys, and the count of the commonest."""
    if not len(key):
        return np.zeros(n_docs), np.zeros(n_docs)
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(k)))
    most = np.zeros(n_docs)
    np.maximum.at(most, d[at], runs)
    return np.bincount(d[at], minlength=n_docs).astype(float), most


def featurise(text: pa.Array) -> np.ndarray:
    """``(documents, len(FEATURES))``; a text without words is all zeros."""
    out = np.zeros((len(text), len(FEATURES)))
    hasher, lower, sep = Hasher(), ascii_lower(), separators()
    for lo, hi, data, offs in chunks(text):
        n = hi - lo
        w = words(data, offs, sep)
        count = np.diff(w.first)
        size = np.diff(offs)
        hasher.load(data, lower)
        h = hasher.ranges(w.start, w.end)

        def per_doc(mask, data=data, offs=offs):
            sums = np.concatenate([[0], np.cumsum(mask)])
            return (sums[offs[1:]] - sums[offs[:-1]]).astype(float)

        def of_words(mask, w=w, n=n):
            return np.bincount(w.doc[mask], minlength=n).astype(float)

        length = w.end - w.start
        caps = np.concatenate([[0], np.cumsum(_UPPER[data])])
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        n_caps, n_letters = caps[w.end] - caps[w.start], letters[w.end] - letters[w.start]
        follows = np.zeros(len(h), bool)
        follows[1:] = w.doc[1:] == w.doc[:-1]
        again = follows.copy()
        again[1:] &= h[1:] == h[:-1]
        same = np.zeros(len(data), bool)
        same[1:] = data[1:] == data[:-1]
        distinct, most = _distinct(w.doc, h, n)
        pair_at = np.flatnonzero(follows)
        pairs, _ = _distinct(w.doc[pair_at], h[pair_at] * np.uint64(3) + h[pair_at - 1], n)
        longest = np.zeros(n)
        np.maximum.at(longest, w.doc, length)
        some, byte, letter = np.maximum(count, 1), np.maximum(size, 1), np.maximum(per_doc(_LETTER[data]), 1)
        last = data[w.end - 1] if len(h) else np.zeros(0, np.uint8)
        first = data[w.start] if len(h) else np.zeros(0, np.uint8)
        got = np.stack([
            np.log1p(size), np.log1p(count), np.bincount(w.doc, length, minlength=n) / some,
            per_doc(_UPPER[data]) / letter, per_doc(_DIGIT[data]) / byte, per_doc(_SYMBOL[data]) / byte,
            per_doc(_STOP[data]) / some, per_doc(_EXCLAIM[data]) / some, per_doc(data == 0x7C) / some,
            per_doc(data == 0x0A) / some, of_words(again) / some, distinct / some, most / some,
            pairs / np.maximum(count - 1, 1), of_words(length <= 3) / some, of_words(length >= 12) / some,
            of_words(_SYMBOL[last] | _EXCLAIM[last]) / some, of_words((n_caps == n_letters) & (n_caps > 1)) / some,
            of_words(_UPPER[first]) / some, per_doc(same) / byte, per_doc(_HIGH[data]) / byte, np.log1p(longest),
        ], axis=1)
        got[count == 0] = 0
        out[lo:hi] = got
    return out


@dataclass
class Gam:
    """Intercept, one table per feature, and two-way tables of feature pairs."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, c = to_bins(x, self.edges), to_bins(x, self.coarse)
        z = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for i, j, t in self.pairs:
            z += t[c[:, i], c[:, j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def _shallow(g: np.ndarray, h: np.ndarray, leaves: int, reg: float) -> np.ndarray:
    """Piecewise constant step over ordered bins: best cuts until ``leaves`` leaves."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain_of = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + reg)
    cuts = [0, len(g)]
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                m = np.arange(a + 1, b)
                gain = gain_of(a, m) + gain_of(m, b) - gain_of(a, b)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(m[k])), key=lambda t: t[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + reg)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, reg: float) -> tuple[float, np.ndarray]:
    """Best cut of a two-way table into four leaves: its gain and the step."""
    cg = np.zeros((g.shape[0] + 1, g.shape[1] + 1))
    ch = cg.copy()
    cg[1:, 1:], ch[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, b = cg[1:-1, 1:-1], ch[1:-1, 1:-1]  # upper left of every inner cut
    if not a.size:
        return 0.0, np.zeros(g.shape)
    parts = ((a, b), (cg[1:-1, -1:] - a, ch[1:-1, -1:] - b), (cg[-1:, 1:-1] - a, ch[-1:, 1:-1] - b),
             (cg[-1, -1] - cg[1:-1, -1:] - cg[-1:, 1:-1] + a, ch[-1, -1] - ch[1:-1, -1:] - ch[-1:, 1:-1] + b))
    gain = sum(x * x / (y + reg) for x, y in parts) - cg[-1, -1] ** 2 / (ch[-1, -1] + reg)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros(g.shape)
    for (x, y), rows, cols in zip(parts, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)),
                                  (slice(0, j + 1), slice(j + 1, None), slice(0, j + 1), slice(j + 1, None))):
        out[rows, cols] = x[i, j] / (y[i, j] + reg)
    return float(gain[i, j]), out


def fit_gam(x: np.ndarray, y: np.ndarray, *, bins: int = 32, coarse_bins: int = 8, rounds: int = 120,
            pair_rounds: int = 40, pairs: int = 8, leaves: int = 3, rate: float = 0.15, reg: float = 2.0) -> Gam:
    """Fit tables by cyclic boosting of the log loss.  Without both labels the
    model is the constant share of label 1 (a half without any label)."""
    edges, coarse = bin_edges(x, bins), bin_edges(x, coarse_bins)
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5)))
    model = Gam(edges, coarse, base, [np.zeros(len(e) + 1) for e in edges], [])
    if not 0 < share < 1:
        return model
    b, c = to_bins(x, edges), to_bins(x, coarse)
    z = np.full(len(y), base)
    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            p = sigmoid(z)
            g, h = np.bincount(b[:, j], y - p, len(table)), np.bincount(b[:, j], p * (1 - p), len(table))
            step = rate * _shallow(g, h, leaves, reg)
            table += step
            z += step[b[:, j]]
    # Pairs whose best four-leaf cut explains most of what is left.
    p = sigmoid(z)
    width = [len(e) + 1 for e in coarse]

    def sums(i, j, v):
        return np.bincount(c[:, i] * width[j] + c[:, j], v, width[i] * width[j]).reshape(width[i], width[j])

    strength = sorted(((_quadrants(sums(i, j, y - p), sums(i, j, p * (1 - p)), reg)[0], i, j)
                       for i in range(x.shape[1]) for j in range(i + 1, x.shape[1])), reverse=True)
    model.pairs = [(i, j, np.zeros((width[i], width[j]))) for s, i, j in strength[:pairs] if s > 0]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            p = sigmoid(z)
            step = rate * _quadrants(sums(i, j, y - p), sums(i, j, p * (1 - p)), reg)[1]
            table += step
            z += step[c[:, i], c[:, j]]
    return model


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", rows: int = TRAIN_ROWS) -> Gam:
    """Fit on a bounded sample of labelled documents outside the held-out fold."""
    sample = training_sample(docs, labels, label_col, id_col, text_col, rows)
    x, y, _ = feature_rows(sample, featurise)
    return fit_gam(x, y) if len(y) else fit_gam(np.zeros((0, len(FEATURES))), y)


def keeper(model: Gam, threshold: float = THRESHOLD):
    """Function of a text column: which documents reach the threshold."""
    return lambda text: model.score(featurise(text)) >= threshold


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    Fitted on at most ``rows`` labelled documents (those smallest by hash of
    the id) that aren't held out; every document is scored on its whole text.

    Defined results: null, empty and blank texts have all features zero and get
    the model's score for that; repeated rows and equal texts get equal scores;
    a null id is held out; without labels of both kinds the score is the share
    of label 1 (a half without any); an empty table gives an empty result;
    other columns are ignored.
    """
    model = train(docs, labels, "quality", id_col, text_col, rows)
    return score_all(docs, id_col, text_col, lambda text: model.score(featurise(text)), threshold)

"""Toxicity classifier: gradient-boosted trees over dense features.

A lexicon is learnt first: keys (a word's letters, or its first five bytes)
that documents marked toxic hold far more often than others, each with its
log-odds.  Look-alike characters inside a word are folded before, so most
obfuscated spellings meet the same key.  The dense features are lexicon
densities, how close lexicon words stand to second-person words, capitals,
punctuation and obfuscation rates.  Lexicon and calibration are cross-fitted
over folds of the sample, and isotonic regression turns margins into
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.operators.order import stage

from .classify import TRAIN_ROWS, bin_edges, feature_rows, score_all, sigmoid, to_bins, training_sample
from .text import Hasher, ascii_lower, chunks, words

# Second-person words of the four languages of the corpus.
SECOND_PERSON = ("you", "your", "yours", "yourself", "du", "dein", "deine", "dich", "dir", "ihr", "euch", "euer",
                 "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes",
                 "vosotros", "vuestro")
# Characters that stand for letters.
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "u"}

FEATURES = (
    "lexicon_words", "lexicon_stems", "lexicon_weight", "lexicon_most", "lexicon_hits", "second_person", "near_second",
    "upper", "caps_words", "exclaim", "punctuation", "digit_words", "symbol_words", "single_letters", "log_words",
)
THRESHOLD = 0.5
NEAR = 5
LEXICON_ROWS = 4000
LEXICON_SUPPORT = 2
FOLDS = 4
STEM = 5

_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_INSIDE = np.zeros(256, bool)
_INSIDE[[ord(c) for c in "@$!*"]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_UPPERS = np.zeros(256, bool)
_UPPERS[0x41:0x5B] = True


def _fold_table() -> np.ndarray:
    t = ascii_lower()
    for a, b in LOOK_ALIKES.items():
        t[ord(a)] = ord(b)
    return t


def _tokens(text: pa.Array) -> Iterator[tuple]:
    """Per chunk: words of letters, digits and look-alikes inside them, with the
    hash of the folded word and of its first bytes."""
    hasher, fold, is_sep = Hasher(seed=23), _fold_table(), np.array([True, False])
    for lo, hi, data, offs in chunks(text):
        inside = _WORD_BYTES[data]
        odd = np.zeros(len(data), bool)
        if len(data) > 2:
            odd[1:-1] = _INSIDE[data[1:-1]] & inside[:-2] & inside[2:]
        w = words((inside | odd).astype(np.uint8), offs, is_sep)
        hasher.load(data, fold)
        whole = hasher.ranges(w.start, w.end)
        stem = hasher.ranges(w.start, np.minimum(w.end, w.start + STEM))
        yield lo, hi, data, offs, w, whole, stem, odd


def _second_person_keys() -> np.ndarray:
    _, _, _, _, _, whole, _, _ = next(_tokens(pa.array([" ".join(SECOND_PERSON)])))
    return np.unique(whole)


def _keys(w, whole: np.ndarray, stem: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word keys are odd, stem keys (of words longer than a stem) even."""
    one = np.uint64(1)
    long = w.end - w.start > STEM
    return whole | one, np.where(long, stem & ~one, np.uint64(0))


@dataclass
class Lexicon:
    keys: np.ndarray  # sorted
    weight: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Weight of each key, 0 for one that isn't listed."""
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.weight[at], 0.0)


def count_keys(sample: DataFrame) -> DataFrame:
    """``(key, toxic, docs)``: arrays over folds of how many toxic and how many
    documents hold a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for lo, hi, _, _, w, whole, stem, _ in _tokens(batch.column(0)):
                a, b = _keys(w, whole, stem)
                key, doc = np.concatenate([a, b]), np.concatenate([w.doc, w.doc])
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                new &= key != 0
                key, marked, part = key[new], y[lo:hi][doc[new]], fold[lo:hi][doc[new]]
                uniq, at = np.unique(key, return_inverse=True)
                cell = at * FOLDS + part
                sums = [np.bincount(cell, m, len(uniq) * FOLDS).reshape(-1, FOLDS).astype(np.int64)
                        for m in (marked, np.ones(len(cell)))]
                yield pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), *(
                    pa.array(m[:, f]) for m in sums for f in range(FOLDS))], names)

    names = ["key", *(f"{c}{f}" for c in "td" for f in range(FOLDS))]
    got = sample.select("text", "y", "fold").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))
    return stage(got.groupBy("key").agg(*[F.sum(c).alias(c) for c in names[1:]]), "keys")


def learn_lexicon(counts: DataFrame, size: list[tuple[int, int]], without: int | None = None,
                  rows: int = LEXICON_ROWS, support: int = LEXICON_SUPPORT) -> Lexicon:
    """Up to ``rows`` keys that at least ``support`` toxic documents hold and whose log-odds
    of toxic against other documents, less its standard error, is above 1.

    ``size`` has ``(documents, toxic)`` of each fold; fold ``without`` is left out.
    """
    folds = [f for f in range(FOLDS) if f != without]
    n, pos = (sum(size[f][i] for f in folds) for i in range(2))
    if not 0 < pos < n:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    total = lambda c: sum((F.col(f"{c}{f}") for f in folds), F.lit(0))
    two = counts.select("key", total("t").alias("t"), (total("d") - total("t")).alias("c")).where(f"t >= {support}")
    odds = F.log((F.col("t") + 0.5) / (pos + 1.0)) - F.log((F.col("c") + 0.5) / (n - pos + 1.0))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = two.select("key", (odds - error).alias("w"), "t").where("w > 1").orderBy(
        (F.col("w") * F.log1p("t")).desc(), "key").limit(rows).collect()
    keys = np.array([r[0] for r in best], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], np.array([r[1] for r in best], float)[order])


def featurise(text: pa.Array, lexicon: Lexicon, second: np.ndarray) -> np.ndarray:
    """``(documents, len(FEATURES))``; rates are per word, or per byte for characters."""
    out = np.zeros((len(text), len(FEATURES)))
    for lo, hi, data, offs, w, whole, stem, odd in _tokens(text):
        n = hi - lo
        count = np.diff(w.first)
        some, byte = np.maximum(count, 1), np.maximum(np.diff(offs), 1)
        a, b = _keys(w, whole, stem)
        as_word, as_stem = lexicon.of(a), lexicon.of(b)
        weight = np.maximum(as_word, as_stem)
        hit = weight > 0
        you = np.isin(whole, second)
        # Words since the last and until the next second-person word, over documents' bounds too; then the bounds.
        at = np.arange(len(whole))
        marks = np.flatnonzero(you)
        near = np.zeros(len(whole), bool)
        if len(marks):
            k = np.searchsorted(marks, at)
            for side in (np.maximum(k - 1, 0), np.minimum(k, len(marks) - 1)):
                near |= (np.abs(marks[side] - at) <= NEAR) & (w.doc[marks[side]] == w.doc)

        def sums(mask):
            s = np.concatenate([[0], np.cumsum(mask)])
            return s

        def per_doc(mask, offs=offs):
            s = sums(mask)
            return (s[offs[1:]] - s[offs[:-1]]).astype(float)

        def in_words(mask, w=w):
            s = sums(mask)
            return s[w.end] - s[w.start]

        def of_words(v, w=w, n=n):
            return np.bincount(w.doc, v, minlength=n)

        most = np.zeros(n)
        np.maximum.at(most, w.doc, weight)
        caps, letters = in_words(_UPPERS[data]), in_words(_LETTERS[data])
        digits = in_words((data >= 0x30) & (data <= 0x39))
        length = w.end - w.start
        single = length == 1
        runs = np.zeros(len(single), bool)
        runs[2:] = single[2:] & single[1:-1] & single[:-2] & (w.doc[2:] == w.doc[:-2])
        got = np.stack([
            of_words(as_word > 0) / some, of_words(as_stem > 0) / some, of_words(weight) / some, most,
            np.log1p(of_words(hit)), of_words(you) / some, of_words(hit & near) / some,
            per_doc(_UPPERS[data]) / byte, of_words((caps == letters) & (caps > 1)) / some,
            per_doc((data == 0x21) | (data == 0x3F)) / some, per_doc(~_WORD_BYTES[data] & (data > 0x20)) / byte,
            of_words((digits > 0) & (letters > 0)) / some, of_words(in_words(odd) > 0) / some, of_words(runs) / some,
            np.log1p(count),
        ], axis=1)
        out[lo:hi] = got
    return out


@dataclass
class Trees:
    """Boosted trees as arrays: per tree and inner node the feature and cut, per leaf a value."""

    edges: list[np.ndarray]
    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = to_bins(x, self.edges)
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (b[rows, f[at]] > c[at])
            z += v[at - (2 ** self.depth - 1)]
        return z


def fit_trees(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 3, bins: int = 32, rate: float = 0.15,
              reg: float = 2.0) -> Trees:
    """Gradient boosting of the log loss with full trees grown level by level on bins."""
    edges = bin_edges(x, bins)
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5)))
    inner, n_leaf = 2 ** depth - 1, 2 ** depth
    feature, cut, leaf = [], [], []
    if 0 < share < 1:
        b, z = to_bins(x, edges), np.full(len(y), base)
        for _ in range(trees):
            p = sigmoid(z)
            g, h = y - p, p * (1 - p)
            f_, c_ = np.zeros(inner, np.int64), np.full(inner, bins, np.int64)
            at = np.zeros(len(y), np.int64)
            for level in range(depth):
                k, start = 2 ** level, 2 ** level - 1
                best = np.full(k, 1e-9)
                for j in range(x.shape[1]):
                    cell = (at - start) * (bins + 1) + b[:, j]
                    cg = np.bincount(cell, g, k * (bins + 1)).reshape(k, -1).cumsum(1)
                    ch = np.bincount(cell, h, k * (bins + 1)).reshape(k, -1).cumsum(1)
                    all_g, all_h = cg[:, -1:], ch[:, -1:]
                    gain = cg ** 2 / (ch + reg) + (all_g - cg) ** 2 / (all_h - ch + reg) - all_g ** 2 / (all_h + reg)
                    pick = gain.argmax(1)
                    top = gain[np.arange(k), pick]
                    up = top > best
                    best[up] = top[up]
                    f_[start:start + k][up], c_[start:start + k][up] = j, pick[up]
                at = 2 * at + 1 + (b[np.arange(len(y)), f_[at]] > c_[at])
            cell = at - inner
            v = rate * np.bincount(cell, g, n_leaf) / (np.bincount(cell, h, n_leaf) + reg)
            z += v[cell]
            feature.append(f_)
            cut.append(c_)
            leaf.append(v)
    shape = (len(feature), inner)
    return Trees(edges, base, depth, np.array(feature, np.int64).reshape(shape), np.array(cut, np.int64).reshape(shape),
                 np.array(leaf, float).reshape(len(leaf), n_leaf))


def fit_isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing fit of ``y`` on ``z`` (pool adjacent violators);
    one made-up success and failure at the ends keep it inside (0, 1)."""
    if not len(z):
        return np.array([-1.0, 1.0]), np.array([0.0, 1.0])
    order = np.argsort(z, kind="stable")
    pools: list[list[float]] = [[float(z[order[0]]) - 1, 0.0, 1.0, float(z[order[0]]) - 1]]
    for a, b in [*zip(z[order], y[order]), (float(z[order[-1]]) + 1, 1.0)]:
        pools.append([float(a), float(b), 1.0, float(a)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [pools[-1][0], pools[-1][1] + last[1], pools[-1][2] + last[2], last[3]]
    at = [v for p in pools for v in (p[0], p[3])]
    return np.array(at), np.array([p[1] / p[2] for p in pools for _ in range(2)])


@dataclass
class Model:
    lexicon: Lexicon
    second: np.ndarray
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, text: pa.Array) -> np.ndarray:
        z = self.trees.margin(featurise(text, self.lexicon, self.second))
        return np.clip(np.interp(z, *self.knots), 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample outside the held-out fold.

    Each fold of the sample is featurised with a lexicon learnt from the other
    folds, so the trees see lexicon hits as they are on new documents; each
    half is calibrated with trees fitted on the other half.  The model keeps
    the lexicon and the trees of the whole sample.
    """
    sample = training_sample(docs, labels, label_col, id_col, text_col, rows)
    sample = stage(sample.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(77)), F.lit(FOLDS)).cast("int")), "folds")
    got = {r[0]: (int(r[1]), int(r[2])) for r in sample.groupBy("fold").agg(F.count(F.lit(1)), F.sum("y")).collect()}
    size = [got.get(f, (0, 0)) for f in range(FOLDS)]
    counts = count_keys(sample)
    second = _second_person_keys()
    lexicon = learn_lexicon(counts, size)
    parts = []
    for f in range(FOLDS):
        lex = learn_lexicon(counts, size, without=f)
        parts.append(feature_rows(sample.where(F.col("fold") == f), lambda text, lex=lex: featurise(text, lex, second)))
    parts = [p for p in parts if len(p[1])]
    if not parts:
        return Model(lexicon, second, fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0)),
                     (np.array([0.0, 1.0]), np.array([0.5, 0.5])))
    x, y, ids = (np.concatenate([p[i] for p in parts]) for i in range(3))
    half = _parity(ids)
    z = np.zeros(len(y))
    for side in (half, ~half):
        z[~side] = fit_trees(x[side], y[side]).margin(x[~side]) if side.any() else 0.0
    return Model(lexicon, second, fit_trees(x, y), fit_isotonic(z, y))


def _parity(ids: np.ndarray) -> np.ndarray:
    """A pseudo-random half of the ids."""
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(63)).astype(bool)


def keeper(model: Model, threshold: float = THRESHOLD):
    """Function of a text column: which documents stay below the threshold."""
    return lambda text: model.score(text) < threshold


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    Fitted on at most ``rows`` labelled documents (those smallest by hash of
    the id) that aren't held out; every document is scored on its whole text.

    Defined results: null, empty and blank texts have all features zero and get
    the model's score for that; repeated rows and equal texts get equal scores;
    a null id is held out; without any label the score is a half; an empty
    table gives an empty result; other columns are ignored.
    """
    model = train(docs, labels, "toxic", id_col, text_col, rows)
    return score_all(docs, id_col, text_col, model.score, threshold)

import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_MID
from helpers import no_docs, odd_docs
from pyspark.sql import functions as F

from sortlane.llm import quality, toxicity


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    for v in np.unique(score):
        at = np.flatnonzero(score[order] == v)
        rank[order[at]] = at.mean() + 1
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def read(spark, name):
    return spark.read.parquet(f"{SF_MID}/{name}.parquet")


@pytest.mark.parametrize("fn, col, floor", [(quality.score_quality, "quality", 0.98), (toxicity.score_toxicity, "toxic", 0.9)])
def test_held_out_accuracy_and_columns(spark, fn, col, floor):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    out = fn(docs, labels).cache()
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").collect()
    for r in rows[:50]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert auc(np.array([r.score for r in held]), np.array([r[col] for r in held])) >= floor
    out.unpersist()


@pytest.mark.parametrize("fn, threshold", [(quality.score_quality, 0.3), (toxicity.score_toxicity, 0.5)])
def test_odd_rows(spark, fn, threshold):
    labels = read(spark, "labels")
    train = read(spark, "documents").where("doc_id > 10")
    odd = odd_docs(spark).select(train.columns)
    got = fn(train.unionByName(odd), labels).where("doc_id is null or doc_id <= 10").collect()
    assert len(got) == 11
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score == by[3].score and by[None].held_out
    assert len({r.score for r in got if r.doc_id == 6}) == 1 and by[8].score == by[9].score
    none = labels.limit(0)
    assert {r.score for r in fn(odd_docs(spark), none).collect()} == {0.5}
    assert fn(no_docs(spark), labels).count() == 0


def test_labels_of_the_held_out_fold_are_never_seen(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.score_quality(docs, turned).collect()}
    assert a == b


def test_gam_finds_steps_and_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    y = np.where(rng.random(4000) < 0.02, 1 - y, y)
    model = quality.fit_gam(x, y)
    assert {(i, j) for i, j, _ in model.pairs[:1]} == {(0, 1)}
    test = rng.random((2000, 4))
    assert ((model.score(test) > 0.5) == ((test[:, 0] > 0.5) ^ (test[:, 1] > 0.5))).mean() > 0.9
    # The score is the sum of table entries.
    b, c = quality.to_bins(test, model.edges), quality.to_bins(test, model.coarse)
    one = model.base + sum(t[b[0, j]] for j, t in enumerate(model.tables)) + sum(t[c[0, i], c[0, j]] for i, j, t in model.pairs)
    assert abs(one - model.margin(test)[0]) < 1e-9


def test_trees_match_walking_them_one_by_one():
    rng = np.random.default_rng(2)
    x = rng.random((1500, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 2] < 0.5)).astype(float)
    t = toxicity.fit_trees(x, y, trees=20)
    b = toxicity.to_bins(x, t.edges)
    for i in range(20):
        z = t.base
        for f, c, v in zip(t.feature, t.cut, t.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + 1 + int(b[i, f[at]] > c[at])
            z += v[at - len(f)]
        assert abs(z - t.margin(x[i:i + 1])[0]) < 1e-9
    assert (((toxicity.sigmoid(t.margin(x))) > 0.5) == y).mean() > 0.97


def test_isotonic_is_increasing_and_pools():
    z = np.array([0.0, 1, 2, 3, 4, 5])
    at, p = toxicity.fit_isotonic(z, np.array([0, 1, 0, 0, 1, 1.0]))
    assert (np.diff(p) >= 0).all() and (np.diff(at) >= 0).all()
    mid = np.interp([1, 2, 3], at, p)
    assert np.allclose(mid, mid[0])


def test_features_of_one_text():
    f = dict(zip(quality.FEATURES, quality.featurise(pa.array(["THE!! THE!! the a"]))[0]))
    assert abs(f["log_words"] - np.log(5)) < 1e-9 and f["caps_words"] == 0.5 and f["repeat_words"] == 0.25
    assert f["exclaim"] == 1.0 and f["title_words"] == 0.5
    assert (quality.featurise(pa.array([None, "", " \n"])) == 0).all()


def test_look_alikes_meet_the_plain_word():
    words = ["trash", "tr@sh", "tra5h", "TRASH", "trasj"]
    keys = [next(toxicity._tokens(pa.array([w])))[5][0] for w in words]
    assert keys[0] == keys[1] == keys[2] == keys[3] != keys[4]

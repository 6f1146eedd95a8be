import corpus_pipeline as cp
import pytest
from conftest import SF_MID, SF_SMALL
from helpers import odd_docs
from pyspark.sql import functions as F
from test_near_dedup import brute

from sortlane.llm import quality, toxicity


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of each stage at the middle size."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = [("documents", docs)]
    for name, step in cp.STAGES:
        step(spark, docs, SF_MID).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out.append((name, docs))
    return out


def test_stages_are_the_dealt_ones_and_keep_the_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["quality", "toxicity", "near_dedup", "mix", "pack"]
    for _, docs in steps[:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_classifier_stages_remove_what_the_operators_reject(spark, steps):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    for i, (score, keep) in enumerate([(quality.score_quality, 1), (toxicity.score_toxicity, 0)]):
        want = {r.doc_id for r in score(steps[i][1], labels).where(F.col("predicted") == keep).collect()}
        assert {r.doc_id for r in steps[i + 1][1].collect()} == want
    clean = labels.where("quality = 1 and toxic = 0").select("doc_id")
    lost = clean.join(steps[2][1], "doc_id", "left_anti").count()
    assert lost <= 0.02 * clean.count()


def test_one_document_of_each_group_stays(steps):
    before = [(r.doc_id, r.text) for r in steps[2][1].collect()]
    after = sorted(r.doc_id for r in steps[3][1].collect())
    # One row per group; rows without words are linked with nothing.
    assert after == sorted({c for _, _, c in brute(before, cp.NEAR_PERCENT)})
    assert len(after) == len(set(after))


def test_mix_repeats_rows_and_packing_keeps_them_all(steps):
    mixed = steps[4][1].groupBy("doc_id").count()
    assert mixed.agg(F.max("count")).first()[0] <= 2
    words = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)) + 1
    assert steps[5][1].agg(F.sum("length")).first()[0] == steps[4][1].agg(F.sum(words)).first()[0]


def test_run_is_the_same_at_every_run(spark):
    a, b = (sorted(map(tuple, cp.run(spark, SF_SMALL).collect())) for _ in range(2))
    assert a == b and a


@pytest.mark.parametrize("name, step", cp.STAGES)
def test_odd_and_empty_tables(spark, name, step):
    odd = odd_docs(spark)
    out = step(spark, odd, SF_SMALL)
    kept = [(r["doc_id"], r["text"]) for r in out.collect()] if "text" in out.columns else None
    given = [(r["doc_id"], r["text"]) for r in odd.collect()]
    if name in ("quality", "toxicity"):
        assert set(kept) <= set(given) and all(kept.count(r) in (0, given.count(r)) for r in set(given))
    elif name == "near_dedup":
        # Copies go (texts that differ by case alone too); rows without words stay.
        assert sorted(map(str, kept)) == sorted(str(r) for r in given if r[0] not in (6, 9))
    elif name == "mix":
        assert all(0 <= kept.count(r) <= 2 * given.count(r) for r in set(given)) and set(kept) <= set(given)
    else:
        assert {r["doc_id"] for r in out.collect()} <= {r[0] for r in given} and out.count() >= 1
    assert step(spark, odd.limit(0), SF_SMALL).count() == 0

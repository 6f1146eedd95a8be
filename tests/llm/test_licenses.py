import random

from conftest import SF_MID
from helpers import no_docs, odd_docs
from pyspark.sql import functions as F

from sortlane.llm import licenses

# The license lines of the given documents and their families.
PLANTED = (("CC BY-NC 4.0", "CC-BY-NC-4.0"), ("GNU General Public License, version 3", "GPL-3.0"),
           ("Apache License, Version 2.0", "Apache-2.0"), ("MIT License", "MIT"), ("All rights reserved.", "Proprietary"))


def test_planted_lines_are_found_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert len(out) == docs.count()
    for d in docs.collect():
        want = sorted({f for line, f in PLANTED if line in d.text})
        assert out[d.doc_id].families == want
        assert out[d.doc_id].n_paragraphs == len(d.text.split("\n"))
        for hit in out[d.doc_id].found:
            assert any(line in d.text.split("\n")[hit.paragraph] for line, _ in PLANTED)


def test_variations_near_misses_and_odd_rows(spark):
    base = spark.read.parquet(f"{SF_MID}/documents.parquet").where("doc_id > 200").select("doc_id", "text")
    rows = [(101, "intro\nthis library is licensed under the Apache License, Version 2.0 by its authors"),
            (102, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the "
                  "Software without restriction, including the rights to use, copy, modify, merge, publish, distribute, "
                  "sublicense, and/or sell copies of the Software"),
            (103, "You must hold a license to drive this truck.\nThe general public may visit."),
            (104, "LICENSED UNDER CC BY-SA 4.0\r\nplain words")]
    more = spark.createDataFrame(rows, "doc_id bigint, text string")
    odd = odd_docs(spark).select("doc_id", "text")
    got = licenses.scan_licenses(base.unionByName(more).unionByName(odd)).where(
        "doc_id is null or doc_id <= 104").collect()
    by = {r.doc_id: r for r in got}
    assert by[101].families == ["Apache-2.0"] and by[101].found[0].paragraph == 1
    assert by[102].families == ["MIT"] and by[103].families == [] and by[104].families == ["CC-BY-SA-4.0"]
    assert all(r.n_licensed == 0 for r in got if r.doc_id is None or r.doc_id <= 10)
    assert by[1].n_paragraphs == 0 and by[2].n_paragraphs == 1 and len(got) == 15


def test_tables_without_words(spark):
    clash = odd_docs(spark).withColumn("paragraph", F.lit("clash")).withColumn("family", F.lit("clash"))
    assert all(r.n_licensed == 0 for r in licenses.scan_licenses(clash).collect())
    assert licenses.scan_licenses(no_docs(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    plan = licenses.scan_licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_unknown_is_calibrated_on_lines_like_those_scored(spark):
    words = ["software", "public", "library", "source", "copy", "version", "license", "terms", "notice", "copies"]
    rng = random.Random(8)
    rows = [(i, "\n".join("a {} came to some {} near the {} river".format(*rng.sample(words, 3)) for _ in range(5)))
            for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    model = licenses.train(spark, docs)
    assert model.held_plain >= 20 and model.held_alarms <= 0.02 * model.held_plain
    again = licenses.train(spark, docs.repartition(2))
    # The same lines; the order of equally frequent n-grams is free.
    assert (again.held_plain, sorted(again.grams)) == (model.held_plain, sorted(model.grams))
    few = licenses.train(spark, docs, plain_lines=40)
    assert 0 < few.held_plain < 40
    assert all(r.n_licensed == 0 for r in licenses.scan_licenses(docs).collect())

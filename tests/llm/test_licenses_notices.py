"""Short notices of each family, the publisher's included."""

import re

import pytest
from conftest import SF_MID

from sortlane.llm import licenses

SHORT = [(f, t) for f, t in licenses.TEMPLATES if len(t) <= 80]


def rows_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)


def test_all_rights_reserved_is_found_in_every_document(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    want = {d.doc_id: [i for i, line in enumerate(d.text.split("\n")) if "All rights reserved" in line]
            for d in docs.where("text like '%All rights reserved%'").collect()}
    out = licenses.scan_licenses(docs).where("array_contains(families, 'Proprietary')").collect()
    assert want and {r.doc_id: [h.paragraph for h in r.found if h.family == "Proprietary"] for r in out} == want


@pytest.fixture(scope="module")
def short_found(spark):
    plain = ["You need a license to drive.", "Rights of way are reserved for residents.", "All seats were reserved.",
             "All the rights that he reserved were his.", "It was released under the bridge.", "Licensed under a patent."]
    shown = [t for _, t in SHORT] + plain
    got = {r.doc_id: r for r in licenses.scan_licenses(rows_of(spark, shown)).collect()}
    return shown, got


def test_each_familys_short_notices_are_found(short_found):
    shown, got = short_found
    assert {f for f, _ in SHORT} == {f for f, _ in licenses.TEMPLATES}
    assert [(t, got[i].families) for i, (f, t) in enumerate(SHORT) if got[i].families != [f]] == []
    assert [shown[i] for i in range(len(SHORT), len(shown)) if got[i].families] == []


def test_the_phrase_keeps_the_lines():
    text = "all rights\n * reserved.\nx"
    assert re.sub(licenses.PHRASE, licenses.PHRASE_WORD + r"\1\2", text).count("\n") == 2

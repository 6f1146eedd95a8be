"""Notices wrapped over several lines."""

import textwrap

from sortlane.llm import licenses


def test_each_template_is_found_when_wrapped(spark):
    cases = []
    for family, text in licenses.TEMPLATES:
        for width in (60, 70, 80):
            for mark in ("", " * "):
                lines = textwrap.wrap(text, width - len(mark), break_long_words=False, break_on_hyphens=False)
                if len(lines) > 1:
                    cases.append((family, width, 2, [mark + x for x in lines]))
    texts = ["\n".join(["An introduction.", "", *lines, "", "The end of the page.", "A person came."]) for *_, lines in cases]
    # Between lines of prose, no blank lines around.
    cases += [(f, w, 1, lines) for f, w, _, lines in cases]
    texts += ["\n".join(["You may use the source of this river.", *lines, "The general public came free of charge."])
              for *_, lines in cases[:len(texts)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert {f for f, *_ in cases} >= {"MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL", "BSD-3-Clause", "MPL-2.0", "ISC",
                                      "CC0-1.0", "Unlicense", "Proprietary"}
    assert [(f, w, got[i].families, texts[i]) for i, (f, w, _, _) in enumerate(cases) if got[i].families != [f]] == []
    for i, (_, _, first, lines) in enumerate(cases):
        assert all(first - 1 <= h.paragraph < first + len(lines) for h in got[i].found)


def test_several_wrapped_notices_and_prose(spark):
    mit, isc = (textwrap.wrap(t, 72) for f, t in licenses.TEMPLATES if t.startswith("Permission "))
    prose = textwrap.wrap("You need a permission of the city to sell copies. The general public may use the library free of charge, "
                          "and the software of the museum was released in a second version. " * 6, 72)
    texts = ["\n".join([*mit, "", *isc]), "\n".join([*prose, *mit, *prose, *isc]), "\n".join(prose), "\n".join(mit * 2),
             "All rights\nreserved.", "All rights\n\n\n\nof way are reserved."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert [got[i].families for i in range(6)] == [["ISC", "MIT"], ["ISC", "MIT"], [], ["MIT"], ["Proprietary"], []]
    assert [got[i].n_licensed for i in range(6)] == [2, 2, 0, 2, 1, 0]


def test_long_runs_between_words(spark):
    texts = ["Released under the " + gap + " MIT License." for gap in ("\u3042" * 200000, ". " * 100000, "\u00e9-" * 100000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert [r.families for r in licenses.scan_licenses(docs).collect()] == [["MIT"]] * 3


def test_any_number_of_lines_and_blank_lines(spark):
    long = [(f, t) for f, t in licenses.TEMPLATES if t.startswith(("Permission ", "Redistribution "))]
    assert sorted(f for f, _ in long) == ["BSD-3-Clause", "ISC", "MIT"]
    cases = [(f, textwrap.wrap(t, width), gap) for f, t in long for width, gap in ((14, 0), (10, 0), (72, 2), (72, 3), (60, 9), (24, 2))]
    assert max(len(lines) for _, lines, _ in cases) > 31
    texts = ["A river.\n\n" + ("\n" * (gap + 1)).join(lines) + "\n\nA person came." for _, lines, gap in cases]
    # Stop words between, comment marks instead of blank lines.
    texts += ["\n//\n# \n".join(textwrap.wrap(t, 40)) for _, t in long]
    want = [f for f, *_ in cases] + [f for f, _ in long]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.families for r in licenses.scan_licenses(docs).collect()}
    assert [(i, got[i], f) for i, f in enumerate(want) if got[i] != [f]] == []


def test_a_notice_far_down_a_run_of_vocabulary_lines(spark):
    mit = next(t for f, t in licenses.TEMPLATES if t.startswith("Permission is"))
    prose = ["the public museum had copies of a source", "software from the city was used"] * 300
    text = "\n".join([*prose, *textwrap.wrap(mit, 50), *prose])
    docs = spark.createDataFrame([(1, text), (2, "\n".join(prose))], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert got[1].families == ["MIT"] and got[2].families == []
    assert 598 <= got[1].found[0].paragraph < 602 + len(textwrap.wrap(mit, 50)) and got[1].n_licensed == 1

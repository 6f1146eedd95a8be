"""Decode/encode corpus (FIXTURES.md section 3) and int32 wrap."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sortlane.functions import codec

GOOD = [
    ("1,ab,cd,Asia", (1, "ab", "cd", "Asia")),
    (" 7,ab, cd ,Asia \r\n", (7, "ab", " cd ", "Asia")),
    ("\u00a01,ab,cd,Asia\u00a0", (1, "ab", "cd", "Asia")),
    ("\u30001,ab,cd,Asia\u3000", (1, "ab", "cd", "Asia")),
    ("\u00851,ab,cd,Asia\u0085", (1, "ab", "cd", "Asia")),
    ("\x0b\t1,ab,cd,Asia\f", (1, "ab", "cd", "Asia")),
    ("+5,a,b,c", (5, "a", "b", "c")),
    ("12abc,a,b,c", (12, "a", "b", "c")),
    ("007,a,b,c", (7, "a", "b", "c")),
    ("2147483648,a,b,c", (-2147483648, "a", "b", "c")),
    ("-2147483649,a,b,c", (2147483647, "a", "b", "c")),
    ("9223372036854775807,a,b,c", (-1, "a", "b", "c")),
    ("1,,,", (1, "", "", "")),
    ("1,a b,c\u200bd,Asia", (1, "a b", "c\u200bd", "Asia")),  # zero-width space is not white space
]
BAD = [
    ("9223372036854775808,a,b,c", "id"),
    ("x,a,b,c", "id"),
    (",a,b,c", "id"),
    ("-,a,b,c", "id"),
    ("_1,a,b,c", "id"),
    ("1,2,3", "field_count"),
    ("1,a,b,c,d", "field_count"),
    ("", "field_count"),
    ("   ", "field_count"),
    (None, "field_count"),
]


def _lines(spark, lines):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")


def test_tolerant_decodes_good_lines(spark):
    df = codec.decode(_lines(spark, [v for v, _ in GOOD])).orderBy("i").collect()
    for row, (_, want) in zip(df, GOOD):
        assert row["reject_reason"] is None
        assert (row["id"], row["name"], row["address"], row["continent"]) == want


def test_rejects_carry_reason(spark):
    df = codec.decode(_lines(spark, [v for v, _ in BAD])).orderBy("i").collect()
    for row, (line, reason) in zip(df, BAD):
        assert row["reject_reason"] == reason, line
        assert row["id"] is None and row["name"] is None


def test_tolerant_and_rejects_partition_the_input(spark):
    src = _lines(spark, [v for v, _ in GOOD + BAD])
    assert codec.decode_tolerant(src).count() == len(GOOD)
    assert codec.decode_rejects(src).count() == len(BAD)


def test_strict_passes_clean_input(spark):
    src = _lines(spark, [v for v, _ in GOOD])
    assert codec.decode_strict(src).count() == len(GOOD)


@pytest.mark.parametrize("bad", ["x,a,b,c", "1,2,3", ""])
def test_strict_fails_on_bad_line(spark, bad):
    src = _lines(spark, ["1,a,b,c", bad])
    with pytest.raises(PySparkException):
        codec.decode_strict(src).select("name").collect()


def test_int32_wrap(spark):
    vals = [0, 1, -1, 2147483647, 2147483648, -2147483648, -2147483649, 4294967296, 9223372036854775807]
    df = spark.createDataFrame([(v,) for v in vals], "v bigint")
    got = [r[0] for r in df.select(codec.int32_wrap("v")).collect()]
    want = [((v + 2**31) % 2**32) - 2**31 for v in vals]
    assert got == want


def test_encode_null_field_gives_null_line(spark):
    df = spark.createDataFrame([(1, "a", None, "Asia"), (2, "b", "c", "Europe")],
                               "id int, name string, address string, continent string")
    got = [r[0] for r in df.orderBy("id").select(codec.encode_line()).collect()]
    assert got == [None, "2,b,c,Europe"]


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame([(5, "nm", "ad dr", "Asia"), (-3, "", "", "")],
                               "id int, name string, address string, continent string")
    back = codec.decode_tolerant(df.select(codec.encode_line().alias("value")))
    assert sorted(map(tuple, back.select("id", "name", "address", "continent").collect())) == \
        sorted(map(tuple, df.collect()))


def test_decode_keeps_other_columns(spark):
    df = spark.createDataFrame([(3, 9, "1,a,b,c")], "partition int, offset bigint, value string")
    out = codec.decode(df)
    assert out.columns[:2] == ["partition", "offset"]
    assert out.where(F.col("offset") == 9).count() == 1

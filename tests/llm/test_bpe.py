import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from conftest import SF_MID
from helpers import no_docs, odd_docs
from pyspark.sql import functions as F

from sortlane.llm import bpe


@pytest.fixture(scope="module")
def ranks(spark):
    return bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def wanted(library, doc_id, text):
    ids = library.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def texts(seed, n=400):
    """Words, marks, contractions and white space of many kinds in any order."""
    rng = random.Random(seed)
    bits = ["the", "Wort", "\u00e7a", "'", "'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'S", "\u2019s", " ", " ", "  ", "\n", "\t",
            "\r\n", "\u00a0", "\u2003", "\u3000", "\u0085", "\x1c", "12", "\u0663", "\u00bd", "!", "--", "\U0001f600", "e\u0301",
            "\u0558", "\u2091", "\u2177", "\u65e5\u672c", "\x00", "<|endoftext|>", "\u1c8a", "\U0001e5f0", "lll", "relve", "a" * 30]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(n)]


def result(df, ranks, **how):
    return sorted(tuple(r) for r in bpe.round_trip_digests(df, ranks, **how).collect())


@pytest.mark.parametrize("block, buckets", [(bpe.BLOCK_BYTES, bpe.BUCKETS), (64, 3), (700, 1)])
def test_equals_the_library(spark, ranks, library, block, buckets):
    rows = list(enumerate(texts(block)))
    got = result(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), ranks, block_bytes=block,
                 buckets=buckets)
    assert got == sorted(wanted(library, i, t) for i, t in rows)


def test_whole_table_and_general_outputs(spark, ranks, library):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs, ranks, fixed_rows=True) == sorted(wanted(library, i, t) for i, t in rows)
    tokens = bpe.encode(docs, ranks)
    assert {r.doc_id: r.ids for r in tokens.collect()} == {i: library.encode_ordinary(t) for i, t in rows}
    back = bpe.decode(tokens, ranks)
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == dict(rows)


def test_every_code_point_is_cut_as_the_library_cuts_it(library):
    classes = bpe.character_classes()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(2)
    rng.shuffle(points)
    text = "".join(points[:200000])
    data = np.frombuffer(text.encode(), np.uint8)
    starts, per_doc = bpe.cut_words(data, np.array([0, len(data)]), classes)
    words = [data[a:b].tobytes() for a, b in zip(starts, starts[1:])]
    assert per_doc[0] == len(words) and b"".join(words) == text.encode()
    known = {k: set(map(chr, np.flatnonzero(classes == k))) for k in (1, 2, 3)}
    # Where the regular expression library knows the same characters, it cuts the same words.
    same = "".join(c for c in text if (c in known[1]) == bool(regex.match(r"\p{L}", c)) and (c in known[2]) == bool(regex.match(r"\p{N}", c)))
    data = np.frombuffer(same.encode(), np.uint8)
    starts, _ = bpe.cut_words(data, np.array([0, len(data)]), classes)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, starts[1:])] == regex.findall(public_tokenizers.PATTERN, same)


def test_long_words_are_merged_like_short_ones(ranks, library):
    rng = random.Random(4)
    for w in ["x" * 1500, "ab" * 900, "".join(rng.choice("etaoinshr") for _ in range(3000)), "é" * 1200, "a", "the"]:
        assert bpe.merge_long(w.encode(), ranks) == library.encode_ordinary(w)


def test_odd_and_empty_tables(spark, ranks, library):
    odd = odd_docs(spark).withColumn("ids", F.lit("clash")).withColumn("block", F.lit("clash"))
    assert sorted(map(str, result_rows(odd, ranks))) == sorted(str(wanted(library, r.doc_id, r.text)) for r in odd.collect())
    assert bpe.round_trip_digests(no_docs(spark), ranks).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert result(blank, ranks) == [wanted(library, 1, ""), wanted(library, 2, "")]


def result_rows(df, ranks):
    return [tuple(r) for r in bpe.round_trip_digests(df, ranks).collect()]


def test_scans_that_see_different_rows_are_noticed(spark, ranks):
    fresh = F.udf(lambda i: f"word {os.urandom(8).hex()}").asNondeterministic()
    docs = spark.range(300).select(F.col("id").alias("doc_id"), fresh("id").alias("text"))
    with pytest.raises(Exception, match="different rows"):
        bpe.round_trip_digests(docs, ranks, fixed_rows=True).collect()
    assert bpe.round_trip_digests(docs, ranks).count() == 300

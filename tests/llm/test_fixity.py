import hashlib

from pyspark.sql import functions as F

from sortlane.llm import fixity


def table(spark, rows):
    return spark.createDataFrame(rows, "archive bigint, offset bigint, length bigint, digest string, page_id bigint")


def replica(n=400):
    out, at = [], 0
    for i in range(n):
        size = 1000 + 37 * (i % 11)
        out.append((i // 200, at % (1 << 40), size, f"d{i}", i))
        at = 0 if i % 200 == 199 else at + size
    return out


def test_equal_replicas_show_nothing(spark):
    assert fixity.audit(table(spark, replica()), table(spark, replica())).count() == 0


def test_each_kind_is_located(spark):
    a = replica()
    b = list(a)
    b[7] = (*a[7][:3], "other", a[7][4])
    b[250] = (*a[250][:2], a[250][2] - 1, "cut", a[250][4])
    del b[300]
    b.append((1, 10**7, 5, "new", 999))
    got = {(r.page_id, r.kind, r.archive, r.offset, r.end_offset) for r in fixity.audit(table(spark, a), table(spark, b)).collect()}
    want = {(7, "content", 0, a[7][1], a[7][1] + a[7][2]), (250, "length", 1, a[250][1], a[250][1] + a[250][2]),
            (300, "missing", 1, a[300][1], a[300][1] + a[300][2]), (999, "extra", 1, 10**7, 10**7 + 5)}
    assert got == want


def test_tree_has_one_root_and_bounded_fan_out(spark):
    index = table(spark, replica()).withColumn("replica", F.lit(0))
    levels = fixity.build_tree(index)
    assert levels[-1][0].count() == 1 and levels[-1][1] is None
    assert levels[-1][0].first().records == 400
    for level, col in levels[:-1]:
        up = fixity._parents(level, col)
        assert up.groupBy("replica", "_a", "_s").count().agg(F.max("count")).first()[0] <= 16
    assert fixity.build_tree(index.limit(0)) == []


def test_odd_pages(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://a", "<p>x</p>"), (2, "", ""), (3, "u", "é" * 70000), (4, "u", "b")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for name in ("archive", "offset", "digest", "turn", "copy", "hash"):
        pages = pages.withColumn(name, F.lit("clash"))
    # More ids, so that each planted fault occurs.
    more = pages.unionByName(pages.where("page_id = 4").select(
        F.explode(F.sequence(F.lit(5).cast("bigint"), F.lit(400).cast("bigint"))).alias("page_id"), *pages.columns[1:]))
    out = fixity.audit_pages(more).collect()
    assert {r.kind for r in out} == {"content", "length", "missing", "extra"}
    faulty = {i for i in [None, *range(1, 401)] if int(hashlib.md5(f"damage:{'' if i is None else i}".encode()).hexdigest()[:8], 16) % 53 < 4}
    assert {r.page_id for r in out} == faulty
    assert fixity.audit_pages(pages.limit(0)).count() == 0


def test_records_survive_a_file_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>page\n{i}</p>\r\n") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    text = pages.orderBy("page_id").select(fixity.record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("v"))
    path = tmp_path / "a.warc"
    path.write_bytes("".join(r.v for r in text.collect()).encode())
    got = sorted(r.digest for r in fixity.read_warc(spark, str(path)).collect())
    assert got == sorted(r.digest for r in fixity.pages_to_records(pages).collect())


def warc(i, body):
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:md5:{i}>\r\ncontent-length:  {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def bodies(n):
    # Payloads that hold the version line, none, or several pieces of a read.
    return [b"", b"WARC/1.0\r\nno record\r\n", b"x" * 2_500_000, *(f"<p>{i}</p>\r\n".encode() * (i % 5) for i in range(n))]


def test_offsets_of_records_in_files(spark, tmp_path):
    want = []
    for name in ("a.warc", "b.warc"):
        records = [warc(i, b) for i, b in enumerate(bodies(40))]
        (tmp_path / name).write_bytes(b"".join(records))
        at = 0
        for r in records:
            want.append((name, at, len(r), hashlib.sha256(r).hexdigest(), None))
            at += len(r)
    assert sorted(map(tuple, fixity.read_warc(spark, str(tmp_path)).collect())) == sorted(want)


def test_damaged_copy_of_files(spark, tmp_path):
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    records = [warc(i, b) for i, b in enumerate(bodies(60))]
    starts = [sum(map(len, records[:i])) for i in range(len(records))]
    for name in ("a.warc", "b.warc", "c.warc"):
        (first / name).write_bytes(b"".join(records))
    (second / "a.warc").write_bytes(b"".join(records))
    # b: a byte inside a payload, and a header that no longer gives its length.
    raw = bytearray(b"".join(records))
    raw[starts[2] + 2_000_000] ^= 1
    raw[starts[20]:starts[20] + len(records[20])] = records[20].replace(b"content-length", b"content_length")
    (second / "b.warc").write_bytes(bytes(raw))
    # c: cut short inside its last payload.
    (second / "c.warc").write_bytes(b"".join(records)[:-6])
    got = {(r.file, r.offset, r.kind) for r in fixity.audit_files(spark, str(first), str(second)).collect()}
    assert got == {("b.warc", starts[2], "content"), ("b.warc", starts[20], "content"), ("c.warc", starts[-1], "length")}
    (second / "c.warc").unlink()
    lost = fixity.audit_files(spark, str(first), str(second)).where("file = 'c.warc'").collect()
    assert len(lost) == len(records) and {r.kind for r in lost} == {"missing"}

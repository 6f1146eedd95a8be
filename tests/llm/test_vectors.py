import duckdb
import numpy as np
import pytest
from conftest import SF_MID
from pyspark.sql import functions as F

from sortlane.llm import ann, grid, registry, topk

SCHEMA = "vec_id bigint, embedding array<float>"


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], SCHEMA)


def brute_dots(x, ids, k=5, every=50):
    """(query id, rank, id, score) of every query row against all other rows."""
    y = np.floor(256 * x.astype(np.float32).astype(float)).astype(np.int64)
    out = []
    for q in np.flatnonzero(ids % every == 0):
        s = y @ y[q]
        keep = [i for i in range(len(ids)) if i != q]
        for rank, i in enumerate(sorted(keep, key=lambda i: (-s[i], ids[i]))[:k]):
            out.append((int(ids[q]), rank + 1, int(ids[i]), int(s[i])))
    return sorted(out)


def results(out):
    return sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("shard, leaf", [(4096, 64), (60, 8)])
def test_top_k_equals_all_products(spark, monkeypatch, shard, leaf):
    monkeypatch.setattr(grid, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "LEAF", leaf)
    rng = np.random.default_rng(4)
    x = rng.normal(0, 0.15, (400, 16))
    x[100:160] = x[100]  # many ties
    ids = rng.permutation(400)
    out = topk.exact_top_k(frame(spark, x, ids))
    assert results(out) == brute_dots(x, ids)


def repeated(seed, n=300):
    """A third of the rows have one id, a divisible one; others come twice with unlike or equal vectors."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.15, (n, 8))
    ids = rng.integers(0, 120, n)
    ids[::3] = 50
    x[3:30:3] = x[0]
    return x, ids


def test_rows_that_share_an_id_are_rows_of_their_own(spark, monkeypatch, tmp_path):
    small = frame(spark, np.array([(1.0, 0), (0.5, 0), (0.9, 0), (0.1, 0)]), [0, 1, 1, 2])
    assert results(topk.exact_top_k(small)) == [(0, 1, 1, 58880), (0, 2, 1, 32768), (0, 3, 2, 6400)]
    monkeypatch.setattr(grid, "SHARD_ROWS", 50)
    monkeypatch.setattr(grid, "BLOCK_QUERIES", 30)
    x, ids = repeated(3)
    table = frame(spark, x, ids)
    want = brute_dots(x, ids)
    assert results(topk.exact_top_k(table)) == want
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert sorted(con.sql(registry.OP6_SQL).fetchall()) == want
    got = ann.nearest(table).collect()
    z = x.astype(np.float32).astype(float)
    hit = total = 0
    for q in sorted(set(ids[ids % 100 == 0])):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        for row in np.flatnonzero(ids == q):
            d = np.delete(np.sqrt(((z - z[row]) ** 2).sum(axis=1)), row)
            best = sorted(zip(d, np.delete(ids, row)))[:10]
            hit += sum(any(abs(s - b) < 1e-12 and v == i for _, v, s in mine) for b, i in best)
            total += 10
        assert len(mine) == 10 * (ids == q).sum()
    assert hit >= 0.9 * total


def dealt(spark, x, ids, k=5):
    rows = grid.clean_vectors(frame(spark, x, ids), "vec_id", "embedding", lambda v: v).withColumn(
        "row", F.monotonically_increasing_id()).cache()
    return grid.deal(rows, k, x.shape[1])


def test_a_repeated_id_does_not_fill_one_shard(spark, monkeypatch):
    monkeypatch.setattr(grid, "SHARD_ROWS", 50)
    x, ids = repeated(5, 1500)
    x[300:800] = x[0]  # and a third are one vector: six of them can be among any query's best
    table, shards = dealt(spark, x, ids)
    sizes = [r["count"] for r in table.groupBy("shard").count().collect()]
    others = np.delete(np.arange(1500), np.r_[0:30:3, 300:800])
    assert max(sizes) == 50 and sum(sizes) == len(others) + 6 and len(sizes) == shards == -(-sum(sizes) // 50)
    copies = sorted((i, r) for r, i in enumerate(ids) if r in range(0, 30, 3) or 300 <= r < 800)
    kept = sorted(r.vec_id for r in table.where(F.col("v") == F.array(*map(F.lit, map(float, x[0].astype(np.float32))))).collect())
    assert kept == [i for i, _ in copies[:6]]


@pytest.mark.parametrize("fan", [64, 4])
def test_queries_go_only_to_shards_that_reach_them(spark, monkeypatch, fan):
    monkeypatch.setattr(grid, "SHARD_ROWS", 100)
    monkeypatch.setattr(grid, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(grid, "FAN_OUT", fan)
    sent, route = [], grid.route
    monkeypatch.setattr(grid, "route", lambda *a: (sent.append((a[1], route(*a))), sent[-1][1])[1])
    rng = np.random.default_rng(12)
    centres = rng.normal(0, 1, (30, 12))
    x = centres[rng.integers(0, 30, 4000)] + rng.normal(0, 0.01, (4000, 12))
    ids = rng.permutation(4000)
    assert results(topk.exact_top_k(frame(spark, x, ids))) == brute_dots(x, ids)
    assert ann.nearest(frame(spark, x, ids)).count() == 400
    (shards, dots), (_, near) = sent
    assert shards == 40
    # Each query to every shard would be 80 x 39 and 40 x 39.
    assert dots.count() < 80 * 39 / 4 and near.count() < 40 * 39 / 4
    cells = dots.select("node", "block").distinct().count()
    assert cells <= dots.count()


def test_equal_vectors_ask_once_and_leave_their_own_row_out(spark, monkeypatch):
    monkeypatch.setattr(grid, "SHARD_ROWS", 20)
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(0, 0.2, (4, 6)), 75, axis=0)
    ids = rng.permutation(300)
    assert results(topk.exact_top_k(frame(spark, x, ids))) == brute_dots(x, ids)
    got = {}
    for r in ann.nearest(frame(spark, x, ids)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (0, 100, 200):
        row = int(np.flatnonzero(ids == q)[0])
        group = sorted(int(i) for i in ids[row // 75 * 75:row // 75 * 75 + 75] if i != q)
        assert sorted(got[q]) == [(n + 1, i, 0.0) for n, i in enumerate(group[:10])]


def test_few_candidates_and_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (7, None), (8, [1.0, None]), (9, [float("nan"), 1.0]), (10, [float("inf"), 0.0]),
            (None, [1.0, 1.0]), (11, []), (12, [0.0, 0.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("clash")).withColumn("shard", F.lit(1))
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in topk.exact_top_k(df).collect()}
    low = 256 * 128 + 512 * -256
    assert got == {(0, 1, 0, 256 ** 2 + 512 ** 2), (0, 2, 11, 0), (0, 3, 12, 0), (0, 4, 50, low),
                   (50, 1, 11, 0), (50, 2, 12, 0), (50, 3, 0, low), (50, 4, 0, low)}
    near = {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in ann.nearest(df).collect()}
    assert near == {(0, 1, 0, 0.0), (0, 2, 50, round((0.25 + 9) ** 0.5, 9))}
    for fn in (topk.exact_top_k, ann.nearest):
        assert fn(df.limit(0)).count() == 0


def test_nearest_recall_and_exact_distances(spark, monkeypatch):
    monkeypatch.setattr(grid, "SHARD_ROWS", 500)
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (40, 32))
    x = (centres[rng.integers(0, 40, 4000)] + rng.normal(0, 0.3, (4000, 32))).astype(np.float32).astype(float)
    got = ann.nearest(frame(spark, x)).collect()
    hit = 0
    queries = range(0, 4000, 100)
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert all(abs(r.score - d[r.vec_id]) < 1e-12 for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hit += len({r.vec_id for r in mine} & set(np.argsort(d, kind="stable")[:10]))
    assert hit >= 0.9 * 10 * len(queries)


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = ann.nearest(table).collect()
    hit = 0
    queries = [i for i in range(len(ids)) if ids[i] % 100 == 0]
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = set(ids[np.lexsort((ids, d))[:10]])
        hit += len(best & {r.vec_id for r in got if r.query_id == ids[q]})
    assert hit >= 0.9 * 10 * len(queries)


def test_stopping_test_skips_far_leaves():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 0.05, (200, 16)), rng.normal(30, 0.05, (2000, 16))])
    seen = []
    index = ann.Boxes(ann.LEAF, ann.PROJECTIONS, ann.CONFIDENCE, 9)
    key = index.key
    index.key = lambda q, rows: (seen.append(len(rows)), key(q, rows))[1]
    grid.tree_search(index, 5, x, x[:1], np.array([np.inf]))
    assert 5 <= sum(seen) <= 400


def test_chi_square_matches_known_values():
    assert abs(float(ann.chi_square(np.array([15.507]), 8)[0]) - 0.95) < 1e-4
    assert abs(ann.stop_ratio(8, 0.95) - 15.507) < 1e-2

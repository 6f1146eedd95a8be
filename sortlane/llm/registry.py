"""Queries of the subpackage: ``(spark, sf_dir) -> DataFrame`` and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, conversations, dedup, divergence, fixity, licenses, mixing, packing, quality, sharding, topk, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.audit_pages(_table(spark, sf_dir, "pages"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op9_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    import public_tokenizers  # vocabularies of this machine; their files are a parameter

    return bpe.round_trip_digests(_table(spark, sf_dir, "documents"), bpe.read_ranks(spark, public_tokenizers.path(ranks)),
                                  fixed_rows=True)


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_near_dedup, op2_warc_audit, op3_mix_sources, op4_quality, op5_licenses, op6_top_k, op7_toxicity,
        op8_nearest, op9_shuffle_shards, op10_pack, op11_repair, op12_divergence, op13_bpe)}


#: Words of a text, and its set of distinct five-word runs (fewer words: the whole sequence).
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

OP1_SQL = rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN []
        ELSE list_sort(list_distinct([array_to_string(ws[i:i + 4], ' ')
             for i in range(1, greatest(len(ws) - 3, 2))])) END AS sh FROM w),
g AS (SELECT sh, len(sh) AS n, min(rid) AS node FROM s WHERE len(sh) > 0 GROUP BY sh),
e AS (SELECT node, n, unnest(sh) AS x FROM g),
p AS (SELECT a.node AS a, b.node AS b, a.n AS na, b.n AS nb, count(*) AS c
      FROM e a JOIN e b ON a.x = b.x AND a.node <> b.node GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
r(a, b) AS (SELECT node, node FROM g UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT s.doc_id, g.node FROM s JOIN g ON s.sh = g.sh),
c AS (SELECT r.a AS node, min(m.doc_id) AS component_id FROM r JOIN m ON r.b = m.node GROUP BY 1)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles,
       coalesce(c.component_id, s.doc_id) AS component_id,
       coalesce(c.component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN g ON s.sh = g.sh LEFT JOIN c ON g.node = c.node
"""


OP2_SQL = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.0' || e'\r\n' || 'WARC-Type: response' || e'\r\n' || 'WARC-Record-ID: <urn:md5:'
    || md5(coalesce(CAST(page_id AS VARCHAR), '')) || '>' || e'\r\n' || 'WARC-Target-URI: ' || coalesce(url, '')
    || e'\r\n' || 'Content-Type: text/html' || e'\r\n' || 'Content-Length: ' || strlen(coalesce(html, ''))
    || e'\r\n\r\n' || coalesce(html, '') || e'\r\n\r\n' AS rec,
    CAST('0x' || substr(md5('damage:' || coalesce(CAST(page_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 53 AS turn,
    CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 8) AS BIGINT)
      % greatest(1, (SELECT CAST(ceil(count(*) / 1024.0) AS BIGINT) FROM pages)) AS archive
  FROM pages),
c AS (SELECT *, CASE turn WHEN 0 THEN substr(rec, 1, length(rec) // 2) || '#' || substr(rec, length(rec) // 2 + 2)
                          WHEN 1 THEN substr(rec, 1, length(rec) - 1) ELSE rec END AS cop FROM r),
d AS (SELECT page_id, archive, turn, CAST(strlen(rec) AS BIGINT) AS n, sha256(rec) AS x, CAST(strlen(cop) AS BIGINT) AS m,
             sha256(cop) AS y FROM c),
o AS (SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY archive ORDER BY page_id, x
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM d)
SELECT archive, "offset", "offset" + CASE WHEN turn = 3 THEN m ELSE n END AS end_offset, page_id,
  CASE WHEN turn = 2 THEN 'missing' WHEN turn = 3 THEN 'extra' WHEN n <> m THEN 'length' ELSE 'content' END AS kind,
  CASE WHEN turn <> 3 THEN x END AS expected, CASE WHEN turn <> 2 THEN y END AS found
FROM o WHERE turn IN (2, 3) OR x <> y OR n <> m
"""

OP6_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.rid, q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.c, v.c) AS BIGINT) AS score
  FROM v q JOIN v ON q.rid <> v.rid WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INT) AS "rank",
  vec_id, score FROM p)
SELECT * FROM r WHERE "rank" <= 5
"""

#: CRC-32 of ASCII text, byte by byte.
_CRC = """xor(4294967295, list_reduce([CAST(4294967295 AS UBIGINT)] || list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS UBIGINT)),
  lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

OP11_SQL = rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f
  FROM conversations),
dam AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE f WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM src WHERE f <> 0),
o AS (SELECT conv_id, turn, role, text, substr(role, 1, 1) AS init, rtrim(text, e' \t\n\x0B\f\r') AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dam),
q AS (SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(init) OVER (PARTITION BY conv_id ORDER BY i) || init AS pair FROM o),
t AS (SELECT *, NOT blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut FROM q),
ins(st, k, st2, more) AS (VALUES (0, 0, 0, []), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']),
  (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
  (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']),
  (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])),
mv(f, op, init, goes, price) AS (VALUES (0, 'D', NULL, 0, 2), (1, 'D', NULL, 1, 2), (2, 'D', NULL, 2, 2), (3, 'D', NULL, 3, 2),
  (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0),
  (0, 'R', NULL, 2, 1), (1, 'R', NULL, 2, 1), (3, 'R', NULL, 2, 1), (2, 'R', NULL, 3, 1)),
p(conv_id, i, st, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM src
  UNION ALL
  SELECT conv_id, i, goes, price, script, lined FROM (
    SELECT p.conv_id, t.i, goes, p.cost + 5 * k + mv.price + CASE WHEN op <> 'D' AND cut THEN 5 ELSE 0 END AS price,
      audit || repeat('I', k) || op AS script,
      lines || more || CASE op WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
        ELSE [CASE goes WHEN 2 THEN 'user:' ELSE 'assistant:' END || text] END AS lined
    FROM p JOIN t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1 JOIN ins ON ins.st = p.st
    JOIN mv ON mv.f = ins.st2 AND (op = 'D' OR (NOT blank AND NOT again AND (op = 'R' OR mv.init = t.init)))) w
  QUALIFY row_number() OVER (PARTITION BY conv_id, goes ORDER BY price, script) = 1),
n AS (SELECT src.conv_id, count(t.i) AS n FROM (SELECT DISTINCT conv_id FROM src) src
      LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM src.conv_id GROUP BY 1),
e AS (SELECT * FROM (SELECT p.conv_id, cost + 5 * k AS price, audit || repeat('I', k) AS script, lines || more AS lined
  FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.n = p.i JOIN ins ON ins.st = p.st
  WHERE st2 = 3 OR (st2 = 0 AND k = 0)) w
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY price, script) = 1),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
  count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
  count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM t GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(price AS BIGINT) AS cost, script AS audit,
  sha256(array_to_string(lined, chr(10))) AS repaired_sha256
FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT rid, lang, source, unnest(ws) AS term FROM d),
k AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
lt AS (SELECT lang, count(*) AS v, sum(ln) AS ltotal FROM k GROUP BY lang),
gt AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.ln, lt.v, lt.ltotal,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
       FROM g JOIN k ON g.lang = k.lang JOIN lt ON g.lang = lt.lang
       LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, CAST(1 + 1000000000 * CAST(n + 1 AS HUGEINT) // (total + v) AS BIGINT) AS p,
         CAST(1 + 1000000000 * CAST(ln + 1 AS HUGEINT) // (ltotal + v) AS BIGINT) AS q FROM gt),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
tm AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
       FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS "rank"
      FROM (SELECT * FROM pr UNION ALL SELECT * FROM tm))
SELECT lang, source, part, item, value, "rank" FROM r WHERE part = 'pair' OR "rank" <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_near_dedup": OP1_SQL, "op2_warc_audit": OP2_SQL, "op6_top_k": OP6_SQL,
            "op11_repair": OP11_SQL, "op12_divergence": OP12_SQL}

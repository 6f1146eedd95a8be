"""

``entry(spark)`` runs the flagship batch pipeline on sf0.001; ``queries()``
callable; ``oracle_sql()`` gives the DuckDB statement each one must equal
(same column names, same multiset of rows).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sortlane.plans import catalog

try:  # the training-data operators, where they are installed
    import corpus_pipeline
    from sortlane.llm import registry as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "sortlane.llm"):
        raise
    llm = corpus_pipeline = None

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return catalog.q_batch_job(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    names = [
        # sources: S1 S2 S3 S4 S5 S6 S7
        "generate_records", "log_read_first_n", "log_read_gaps", "log_read_resume", "log_read_partition",
        "topic_offsets", "log_head", "read_lines", "group_read", "stream_first_n",
        # sinks: K1 K2 K3 K4 K5
        "publish_balanced", "publish_hash_keyed", "publish_sorted", "stage_snapshot",
        "publish_idempotent", "publish_atomic",
        # codecs: T1 T2 T3 T4 T5
        "encode_line", "decode_strict", "decode_tolerant", "decode_rejects", "int32_wrap",
        # checks: P1 P2 P3 P4
        "check_schema", "schema_violations", "check_charset", "check_topics",
        # sorts: E1 E2 E3 E4 E5 E6 E7 (E8, key selection, raises on an unknown key: tests)
        "sort_by_id", "sort_by_name", "sort_by_continent", "sorted_runs", "merge_runs",
        "sort_position", "sort_fanout",
        # aggregations: A1 A2 A3 A4 A5
        "count_by_topic", "count_reconcile", "multiset_reconcile", "multiset_diff_sketch", "run_counters", "run_report",
        # windows: W1 W2 W3 W4
        "check_sorted_id", "check_sorted_name", "check_sorted_continent", "detect_runs",
        # streaming: M1 M2 M3 M4 M5 M6 M7 M8
        "stream_runs", "stream_fanout", "stream_keyed_publish", "stream_rejects",
        "stream_resume", "stream_tail_flush", "stream_progress", "stream_detect_runs", "stream_compact",
        "stream_metrics", "stream_continuous",
        # end-to-end jobs: L1 L2 L3
        "batch_job", "batch_resume", "stream_job", "validate_all", "validate_incremental",
    ]
    out = {n: getattr(catalog, f"q_{n}") for n in names}
    if llm is not None:
        out |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return out


# ---- oracle building blocks (DuckDB) ----------------------------------------

# F1 records.
_RECORDS = """
SELECT o_orderkey AS rid, CAST(o_custkey AS INT) AS id, o_orderpriority AS name,
       c_mktsegment AS address, r_name AS continent
FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
"""

_CONT = """CASE user_id % 6 WHEN 0 THEN 'North America' WHEN 1 THEN 'Asia'
  WHEN 2 THEN 'South America' WHEN 3 THEN 'Europe' WHEN 4 THEN 'Africa' ELSE 'Australia' END"""

_CLEAN = f"CAST(user_id AS VARCHAR) || ',' || event_type || ',' || props || ',' || {_CONT}"

# F2 log.
_LOG = f"""
SELECT 'source' AS topic, CAST(event_id % 4 AS INT) AS "partition",
       CAST(event_id // 4 AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS key,
       {_CLEAN} AS value
FROM events
"""

# F3 dirty log.
_DIRTY = f"""
SELECT 'source' AS topic, CAST(event_id % 4 AS INT) AS "partition",
       CAST(event_id // 4 AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS key,
       CASE
         WHEN event_id % 97 = 0 THEN CAST(user_id AS VARCHAR) || ',' || event_type || ',' || props
         WHEN event_id % 89 = 0 THEN 'x' || {_CLEAN}
         WHEN event_id % 83 = 0 THEN CAST(user_id + 2147483648 AS VARCHAR) || ',' || event_type
                                     || ',' || props || ',' || {_CONT}
         WHEN event_id % 79 = 0 THEN ''
         WHEN event_id % 73 = 0 THEN '  ' || CAST(user_id AS VARCHAR) || 'abc,' || event_type || ', '
                                     || props || ' ,' || {_CONT} || ' '
         WHEN event_id % 71 = 0 THEN '99999999999999999999,' || event_type || ',' || props || ',' || {_CONT}
         WHEN event_id % 67 = 0 THEN CAST(user_id AS VARCHAR) || '_000,' || event_type || ',' || props || ',' || {_CONT}
         ELSE {_CLEAN}
       END AS value
FROM events
"""

_WS = r"[\t\n\x0B\f\r \x{85}\p{Z}]"


def _decoded(src: str) -> str:
    """All rows of ``src`` with id/name/address/continent/reject_reason (+ id64)."""
    return f"""
    (WITH d0 AS (
       SELECT *, string_split(regexp_replace(coalesce(value, ''), '^{_WS}+|{_WS}+$', '', 'g'), ',') AS _p
       FROM ({src})),
     d1 AS (
       SELECT *, regexp_extract(_p[1], '^([+-]?[0-9]+)', 1) AS _digits FROM d0),
     d2 AS (SELECT *, try_cast(nullif(_digits, '') AS BIGINT) AS id64 FROM d1)
     SELECT * EXCLUDE (_p, _digits, id64),
            CASE WHEN len(_p) <> 4 THEN 'field_count' WHEN id64 IS NULL THEN 'id' END AS reject_reason,
            CASE WHEN len(_p) = 4 AND id64 IS NOT NULL
                 THEN CAST(xor(id64 & 4294967295, 2147483648) - 2147483648 AS INT) END AS id,
            CASE WHEN len(_p) = 4 AND id64 IS NOT NULL THEN _p[2] END AS name,
            CASE WHEN len(_p) = 4 AND id64 IS NOT NULL THEN _p[3] END AS address,
            CASE WHEN len(_p) = 4 AND id64 IS NOT NULL THEN _p[4] END AS continent,
            CASE WHEN len(_p) = 4 THEN id64 END AS id64
     FROM d2)
    """


def _accepted(src: str) -> str:
    return f"(SELECT * EXCLUDE (reject_reason, id64) FROM {_decoded(src)} WHERE reject_reason IS NULL)"


def _sorted(key_cols: str) -> str:
    return f"""SELECT rid, id, name, address, continent,
       row_number() OVER (ORDER BY {key_cols}) - 1 AS pos FROM ({_RECORDS})"""


_ENC = "CAST(id AS VARCHAR) || ',' || name || ',' || address || ',' || continent"
_CONTINENT_LIST = "['North America', 'Asia', 'South America', 'Europe', 'Africa', 'Australia']"


# S1 generator over the order keys.
_GENERATED = f"""
WITH g AS (
  SELECT o_orderkey AS rid,
         md5('42:' || CAST(o_orderkey AS VARCHAR) || ':a') AS ha,
         md5('42:' || CAST(o_orderkey AS VARCHAR) || ':b') AS hb,
         md5('42:' || CAST(o_orderkey AS VARCHAR) || ':c') AS hc,
         md5('42:' || CAST(o_orderkey AS VARCHAR) || ':d') AS hd
  FROM orders),
b AS (SELECT *, CAST(('0x' || substr(hc, 9, 6)) AS INTEGER) AS c456 FROM g)
SELECT rid,
  CAST(CAST(('0x' || substr(hc, 17, 8)) AS BIGINT) % 2147483648 AS INT) AS id,
  substr(rpad(translate(lower(to_base64(unhex(ha || hd))), '0123456789+/=', ''), 43, 'a'), 1, 10 + (c456 >> 16) % 6) AS name,
  substr(translate(to_base64(unhex(hb || hd)), '+/=', ' '), 1, 15 + ((c456 >> 8) & 255) % 6) AS address,
  ({_CONTINENT_LIST})[(c456 & 255) % 6 + 1] AS continent
FROM b
"""


def _published(src: str) -> str:
    """L1: source topic + three sorted topics with contiguous partition ranges."""
    return f"""
    (WITH src AS ({src}),
     rec AS (SELECT "partition" AS sp, "offset" AS so, id, name, address, continent
             FROM {_accepted('SELECT * FROM src')}),
     srt AS (
       SELECT 'id' AS topic, *, row_number() OVER (ORDER BY id, sp, so) - 1 AS pos FROM rec
       UNION ALL
       SELECT 'name' AS topic, *, row_number() OVER (ORDER BY name, id, sp, so) - 1 AS pos FROM rec
       UNION ALL
       SELECT 'continent' AS topic, *, row_number() OVER (ORDER BY continent, id, sp, so) - 1 AS pos FROM rec),
     lay AS (SELECT *, (pos * 4) // (SELECT count(*) FROM rec) AS p, (SELECT count(*) FROM rec) AS total FROM srt)
     SELECT topic, "partition", "offset", key, value FROM src
     UNION ALL
     SELECT topic, CAST(p AS INT) AS "partition", CAST(pos - (p * total + 3) // 4 AS BIGINT) AS "offset",
            CAST(NULL AS VARCHAR) AS key, {_ENC} AS value
     FROM lay)
    """


_KEYS = {"id": ["id"], "name": ["name", "id"], "continent": ["continent", "id"]}


def _less(a: list[str], b: list[str]) -> str:
    """Lexicographic a < b over column lists."""
    if len(a) == 1:
        return f"({a[0]} < {b[0]})"
    return f"({a[0]} < {b[0]} OR ({a[0]} = {b[0]} AND {_less(a[1:], b[1:])}))"


def _check_sorted(key: str, log: str) -> str:
    cols = _KEYS[key]
    prev = [f"lag({c}) OVER w AS prev_{c}" for c in cols]
    firsts = [f"arg_min({c}, \"offset\") AS first_{c}" for c in cols]
    lasts = [f"arg_max({c}, \"offset\") AS last_{c}" for c in cols]
    plast = [f"lag(last_{c}) OVER (PARTITION BY topic ORDER BY \"partition\") AS pl_{c}" for c in cols]
    return f"""
    WITH d AS (SELECT topic, "partition", "offset", {', '.join(cols)}
               FROM {_decoded(log)} WHERE reject_reason IS NULL AND topic = '{key}'),
    l AS (SELECT *, {', '.join(prev)} FROM d
          WINDOW w AS (PARTITION BY topic, "partition" ORDER BY "offset")),
    within AS (SELECT topic, CAST(sum(CASE WHEN {_less(cols, ['prev_' + c for c in cols])} THEN 1 ELSE 0 END)
                      AS BIGINT) AS violations FROM l GROUP BY topic),
    fl AS (SELECT topic, "partition", {', '.join(firsts + lasts)} FROM d GROUP BY topic, "partition"),
    fl2 AS (SELECT *, {', '.join(plast)} FROM fl),
    across AS (SELECT topic, CAST(sum(CASE WHEN {_less(['first_' + c for c in cols], ['pl_' + c for c in cols])}
                      THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM fl2 GROUP BY topic)
    SELECT 'sorted_{key}' AS "check", topic, 'within' AS scope, violations, violations = 0 AS ok FROM within
    UNION ALL
    SELECT 'sorted_{key}' AS "check", topic, 'across' AS scope, violations, violations = 0 AS ok FROM across
    """


_SCHEMA_RULES = [
    ("field_count", "len(p) = 4"),
    ("name_length", "len(p) <> 4 OR length(p[2]) BETWEEN 10 AND 15"),
    ("address_length", "len(p) <> 4 OR length(p[3]) BETWEEN 15 AND 20"),
    ("continent_domain", f"len(p) <> 4 OR list_contains({_CONTINENT_LIST}, p[4])"),
]


def _schema_split(log: str) -> str:
    return f"""(SELECT *, string_split(coalesce(value, ''), ',') AS p FROM ({log}) WHERE topic = 'source')"""


def _check_schema(log: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(coalesce(sum(CASE WHEN {ok} THEN 0 ELSE 1 END), 0) AS BIGINT) AS violations"
        f" FROM {_schema_split(log)}"
        for name, ok in _SCHEMA_RULES
    )


_REQUIRED = "['source', 'id', 'name', 'continent']"


def _count_reconcile(log: str) -> str:
    return f"""
    WITH p AS {log},
    c AS (SELECT t.topic, count(p.topic) AS n FROM (SELECT unnest({_REQUIRED}) AS topic) t
          LEFT JOIN p ON p.topic = t.topic GROUP BY t.topic),
    s AS (SELECT coalesce(max(n) FILTER (WHERE topic = 'source'), 0) AS n_source FROM c)
    SELECT topic, n, n_source, n = n_source AS ok FROM c, s"""


def _multiset(log: str) -> str:
    return f"""
    WITH p AS {log},
    t AS (SELECT topic, coalesce(value, '') AS v, count(*) AS c FROM p
          WHERE topic IN ('id', 'name', 'continent') GROUP BY ALL),
    s AS (SELECT unnest(['id', 'name', 'continent']) AS topic, v, c FROM
            (SELECT coalesce(value, '') AS v, count(*) AS c FROM p WHERE topic = 'source' GROUP BY ALL))
    SELECT coalesce(t.topic, s.topic) AS topic, coalesce(t.v, s.v) AS value,
           CAST(coalesce(t.c, 0) AS BIGINT) AS n_topic, CAST(coalesce(s.c, 0) AS BIGINT) AS n_source
    FROM t FULL OUTER JOIN s ON t.topic = s.topic AND t.v = s.v
    WHERE coalesce(t.c, 0) <> coalesce(s.c, 0)"""


def _validate_all(log_expr: str) -> str:
    """L3 over a parenthesized log expression."""
    plog = f"SELECT * FROM {log_expr}"
    parts = [
        f"""SELECT 'topics' AS "check", topic AS scope,
                   CAST(CASE WHEN topic IN (SELECT DISTINCT topic FROM {log_expr}) THEN 0 ELSE 1 END AS BIGINT)
                   AS violations FROM (SELECT unnest({_REQUIRED}) AS topic)""",
        f"""SELECT 'schema' AS "check", rule AS scope, violations FROM ({_check_schema(plog)})""",
        f"""SELECT 'counts' AS "check", topic AS scope, CAST(abs(n - n_source) AS BIGINT) AS violations
            FROM ({_count_reconcile(log_expr)})""",
        f"""SELECT 'permutation' AS "check", tt.topic AS scope,
                   CAST(coalesce(sum(abs(m.n_topic - m.n_source)), 0) AS BIGINT) AS violations
            FROM (SELECT unnest(['id', 'name', 'continent']) AS topic) tt
            LEFT JOIN ({_multiset(log_expr)}) m ON m.topic = tt.topic GROUP BY tt.topic""",
    ]
    for key in ("id", "name", "continent"):
        parts.append(f"""SELECT "check", topic || ':' || scope AS scope, violations
            FROM ({_check_sorted(key, f"SELECT * FROM {log_expr} WHERE topic = '{key}'")})""")
    return "SELECT *, violations = 0 AS ok FROM (" + " UNION ALL ".join(parts) + ")"



def _stream(closed_only: bool) -> str:
    """Runs of 300 valid records per source partition of the dirty log, sorted three ways."""
    cond = "WHERE (run_id + 1) * 300 <= n_p" if closed_only else ""
    return f"""
    (WITH v AS (SELECT "partition", "offset", id, name, address, continent FROM {_accepted(_DIRTY)}),
     s AS (SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1 AS seq,
                  count(*) OVER (PARTITION BY "partition") AS n_p FROM v),
     r AS (SELECT *, seq // 300 AS run_id FROM s),
     t AS (SELECT unnest(['id', 'name', 'continent']) AS sort_key, * FROM r {cond}),
     o AS (SELECT sort_key, "partition" AS src_partition, run_id,
                  row_number() OVER (PARTITION BY sort_key, "partition", run_id
                                     ORDER BY CASE sort_key WHEN 'name' THEN name
                                                            WHEN 'continent' THEN continent ELSE '' END,
                                              id, "offset") - 1 AS pos,
                  id, name, address, continent, "offset" AS src_offset FROM t)
     SELECT *, CAST(src_partition AS VARCHAR) || '-' || CAST(run_id AS VARCHAR) || '-' || CAST(pos AS VARCHAR) AS key
     FROM o)
    """


def _topics(closed_only: bool) -> str:
    """The runs as topics: offsets follow the batch that closed a run (the flush
    last), then source partition, run and position."""
    return f"""
    (WITH h AS (SELECT max("offset") + 1 AS n FROM ({_DIRTY})),
     o AS (SELECT * FROM {_stream(closed_only)}),
     z AS (SELECT src_partition, run_id, max(src_offset) AS hi, count(*) // 3 AS n_run FROM o GROUP BY ALL),
     b AS (SELECT *, (SELECT n FROM h) AS n,
             CASE WHEN hi >= (SELECT n FROM h) * 1 // 4 THEN 1 ELSE 0 END
           + CASE WHEN hi >= (SELECT n FROM h) * 2 // 4 THEN 1 ELSE 0 END
           + CASE WHEN hi >= (SELECT n FROM h) * 3 // 4 THEN 1 ELSE 0 END AS arr FROM z),
     c AS (SELECT src_partition, run_id,
             CASE WHEN n_run < 300 THEN 99 WHEN src_partition = 3 AND arr = 1 THEN 2 ELSE arr END AS batch FROM b),
     k AS (SELECT o.*, c.batch, CAST(CAST(('0x' || substr(md5(o.key), 1, 8)) AS BIGINT) % 4 AS INT) AS part
           FROM o JOIN c ON o.src_partition = c.src_partition AND o.run_id = c.run_id)
     SELECT sort_key AS topic, part AS "partition",
            row_number() OVER (PARTITION BY sort_key, part ORDER BY batch, src_partition, run_id, pos) - 1 AS "offset",
            key, {_ENC} AS value FROM k)"""


def _detect(log: str) -> str:
    return f"""
            WITH d AS (SELECT topic, "partition", "offset", id FROM {_decoded(log)} WHERE reject_reason IS NULL),
            l AS (SELECT *, CASE WHEN id < lag(id) OVER w THEN 1 ELSE 0 END AS dsc FROM d
                  WINDOW w AS (PARTITION BY topic, "partition" ORDER BY "offset")),
            r AS (SELECT *, sum(dsc) OVER (PARTITION BY topic, "partition" ORDER BY "offset"
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_no FROM l)
            SELECT topic, "partition", CAST(run_no AS BIGINT) AS run_no, min("offset") AS first_offset,
                   max("offset") AS last_offset, count(*) AS n FROM r GROUP BY topic, "partition", run_no"""


_FANOUT = "sort_key, src_partition, run_id, pos, id, name, address, continent, src_offset"



# M8: per-batch counters of the stream run (4 equal-width offset arrivals,
# partition 3 held back from arrival 1 to arrival 2, runs of 300).
_PROGRESS = f"""
WITH d AS {_decoded(_DIRTY)},
h AS (SELECT max("offset") + 1 AS n FROM d),
a AS (SELECT d.*,
        (CASE WHEN "offset" >= (SELECT n FROM h) * 1 // 4 THEN 1 ELSE 0 END)
      + (CASE WHEN "offset" >= (SELECT n FROM h) * 2 // 4 THEN 1 ELSE 0 END)
      + (CASE WHEN "offset" >= (SELECT n FROM h) * 3 // 4 THEN 1 ELSE 0 END) AS arr FROM d),
b AS (SELECT *, CASE WHEN "partition" = 3 AND arr = 1 THEN 2 ELSE arr END AS batch_id FROM a),
pb AS (SELECT batch_id, "partition", count(*) FILTER (WHERE reject_reason IS NULL) AS v FROM b GROUP BY ALL),
pc AS (SELECT *, sum(v) OVER (PARTITION BY "partition" ORDER BY batch_id) AS cum FROM pb),
rc AS (SELECT batch_id, sum(cum // 300 - (cum - v) // 300) AS runs_closed FROM pc GROUP BY batch_id),
bt AS (SELECT batch_id, count(*) AS consumed,
              count(*) FILTER (WHERE reject_reason IS NULL) AS accepted,
              count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected FROM b GROUP BY batch_id)
SELECT CAST(bt.batch_id AS BIGINT) AS batch_id, CAST(consumed AS BIGINT) AS consumed,
       CAST(accepted AS BIGINT) AS accepted, CAST(rejected AS BIGINT) AS rejected,
       CAST(runs_closed AS BIGINT) AS runs_closed, CAST(900 * runs_closed AS BIGINT) AS rows_out
FROM bt JOIN rc ON bt.batch_id = rc.batch_id
"""


# Two runs of a consumer group, appended to the sorted topics.
_RESUMED = f"""
            WITH src AS (SELECT *, row_number() OVER (ORDER BY "partition", "offset") > 6001 AS late FROM ({_LOG})),
            rec AS (SELECT "partition" AS sp, "offset" AS so, late, id, name, address, continent
                    FROM {_accepted('SELECT * FROM src')}),
            srt AS (
              SELECT 'id' AS topic, *, row_number() OVER (PARTITION BY late ORDER BY id, sp, so) - 1 AS pos FROM rec
              UNION ALL
              SELECT 'name', *, row_number() OVER (PARTITION BY late ORDER BY name, id, sp, so) - 1 FROM rec
              UNION ALL
              SELECT 'continent', *, row_number() OVER (PARTITION BY late ORDER BY continent, id, sp, so) - 1 FROM rec),
            lay AS (SELECT *, (pos * 4) // count(*) OVER (PARTITION BY topic, late) AS p FROM srt)
            SELECT topic, CAST(p AS INT) AS "partition",
                   row_number() OVER (PARTITION BY topic, p ORDER BY late, pos) - 1 AS "offset",
                   CAST(NULL AS VARCHAR) AS key, {_ENC} AS value FROM lay"""


def oracle_sql() -> dict[str, str]:
    out = _library_sql()
    if llm is not None:
        out |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def _library_sql() -> dict[str, str]:
    return {
        "sort_by_id": _sorted("id, rid"),
        "sort_by_name": _sorted("name, id, rid"),
        "sort_by_continent": _sorted("continent, id, rid"),
        "sort_position": f"""
            SELECT "partition", "offset", id, name, address, continent,
                   row_number() OVER (ORDER BY address, id, "partition", "offset") - 1 AS pos
            FROM {_accepted(_DIRTY)}""",
        "sort_fanout": " UNION ALL ".join(
            f"SELECT '{k}' AS sort_key, * FROM ({_sorted(cols)})"
            for k, cols in [("id", "id, rid"), ("name", "name, id, rid"),
                            ("continent", "continent, id, rid")]
        ),
        "encode_line": f"""
            SELECT rid, CAST(id AS VARCHAR) || ',' || name || ',' || address || ',' || continent AS value
            FROM ({_RECORDS})""",
        "decode_strict": f"""SELECT "partition", "offset", id, name, address, continent
            FROM {_accepted(_LOG)}""",
        "decode_tolerant": f"""SELECT "partition", "offset", id, name, address, continent
            FROM {_accepted(_DIRTY)}""",
        "decode_rejects": f"""SELECT "partition", "offset", value, reject_reason
            FROM {_decoded(_DIRTY)} WHERE reject_reason IS NOT NULL""",
        "int32_wrap": f"""SELECT "partition", "offset", id64, id AS id32
            FROM {_decoded(_DIRTY)} WHERE reject_reason IS NULL""",
        # sources
        "generate_records": _GENERATED,
        "log_read_first_n": f"""SELECT * FROM ({_LOG})
            QUALIFY row_number() OVER (ORDER BY "partition", "offset") <= 6001""",
        "log_read_gaps": f"""SELECT * REPLACE ("offset" * 10 AS "offset") FROM ({_LOG})
            QUALIFY row_number() OVER (ORDER BY "partition", "offset") <= 6001""",
        "log_read_resume": f"""SELECT * FROM ({_LOG})
            QUALIFY row_number() OVER (ORDER BY "partition", "offset") > 6001""",
        "log_read_partition": f"""SELECT * FROM ({_LOG}) WHERE "partition" = 2""",
        "topic_offsets": f"""SELECT topic, "partition", min("offset") AS first_offset,
            max("offset") + 1 AS next_offset, count(*) AS n FROM {_published(_LOG)} GROUP BY topic, "partition" """,
        "log_head": f"""SELECT * FROM ({_LOG}) ORDER BY "partition", "offset" LIMIT 1000""",
        "read_lines": f"""SELECT value, id, name, address, continent, reject_reason FROM {_decoded(_DIRTY)}""",
        # sinks
        "publish_balanced": f"""
            WITH r AS (SELECT *, row_number() OVER (ORDER BY rid) - 1 AS idx FROM ({_RECORDS}))
            SELECT 'source' AS topic, CAST(idx % 4 AS INT) AS "partition", CAST(idx // 4 AS BIGINT) AS "offset",
                   CAST(NULL AS VARCHAR) AS key, {_ENC} AS value FROM r""",
        "publish_hash_keyed": f"""
            WITH r AS (SELECT *, CAST(CAST(('0x' || substr(md5(coalesce(name, '')), 1, 8)) AS BIGINT) % 4 AS INT) AS hp
                       FROM ({_RECORDS}))
            SELECT 'name' AS topic, hp AS "partition",
                   row_number() OVER (PARTITION BY hp ORDER BY rid) - 1 AS "offset",
                   name AS key, {_ENC} AS value FROM r""",
        "publish_sorted": f"""
            WITH r AS (SELECT *, row_number() OVER (ORDER BY name, id, rid) - 1 AS pos, count(*) OVER () AS total
                       FROM ({_RECORDS})),
            l AS (SELECT *, (pos * 4) // total AS p FROM r)
            SELECT 'name' AS topic, CAST(p AS INT) AS "partition", CAST(pos - (p * total + 3) // 4 AS BIGINT) AS "offset",
                   CAST(NULL AS VARCHAR) AS key, {_ENC} AS value FROM l""",
        "stage_snapshot": f"""SELECT "partition", "offset", value FROM ({_LOG})""",
        "publish_idempotent": f"""
            WITH r AS (SELECT *, row_number() OVER (ORDER BY name, id, rid) - 1 AS pos, count(*) OVER () AS total
                       FROM ({_RECORDS})),
            l AS (SELECT *, (pos * 4) // total AS p FROM r)
            SELECT 'name' AS topic, CAST(p AS INT) AS "partition", CAST(pos - (p * total + 3) // 4 AS BIGINT) AS "offset",
                   CAST(NULL AS VARCHAR) AS key, {_ENC} AS value FROM l WHERE p < 2""",
        # checks
        "check_schema": _check_schema(_DIRTY),
        "schema_violations": " UNION ALL ".join(
            f"""SELECT "partition", "offset", '{name}' AS rule FROM {_schema_split(_DIRTY)} WHERE NOT ({ok})"""
            for name, ok in _SCHEMA_RULES),
        "check_charset": f"""
            WITH r AS {_accepted(_DIRTY)}
            SELECT 'id_non_negative' AS rule, CAST(count(*) FILTER (WHERE NOT (id >= 0)) AS BIGINT) AS violations FROM r
            UNION ALL SELECT 'name_charset', CAST(count(*) FILTER (WHERE NOT regexp_full_match(name, '[a-z]*')) AS BIGINT) FROM r
            UNION ALL SELECT 'address_charset', CAST(count(*) FILTER (WHERE NOT regexp_full_match(address, '[A-Za-z0-9 ]*')) AS BIGINT) FROM r""",
        "check_topics": f"""
            SELECT topic, topic IN (SELECT DISTINCT topic FROM {_published(_LOG)}) AS present
            FROM (SELECT unnest({_REQUIRED}) AS topic)""",
        # runs
        "sorted_runs": f"""
            WITH r AS (SELECT *, row_number() OVER (ORDER BY rid) - 1 AS seq FROM ({_RECORDS})),
            r2 AS (SELECT *, seq // 4000 AS run_id FROM r)
            SELECT rid, id, name, address, continent, seq, run_id,
                   row_number() OVER (PARTITION BY run_id ORDER BY name, id, rid) - 1 AS pos FROM r2""",
        "merge_runs": f"""
            WITH r AS (SELECT *, (row_number() OVER (ORDER BY rid) - 1) // 4000 AS run_id FROM ({_RECORDS}))
            SELECT rid, id, name, address, continent, run_id,
                   row_number() OVER (ORDER BY name, id, rid) - 1 AS pos FROM r""",
        # aggregations
        "count_by_topic": f"""SELECT topic, "partition", count(*) AS n FROM {_published(_LOG)} GROUP BY topic, "partition" """,
        "count_reconcile": _count_reconcile(_published(_DIRTY)),
        "multiset_reconcile": _multiset(_published(_DIRTY)),
        "multiset_diff_sketch": _multiset(_published(_DIRTY)),
        "run_counters": f"""
            WITH d AS {_decoded(_DIRTY)}
            SELECT 'generated' AS counter, CAST(0 AS BIGINT) AS value
            UNION ALL SELECT 'consumed', count(*) FROM d
            UNION ALL SELECT 'rejected', count(*) FILTER (WHERE reject_reason IS NOT NULL) FROM d
            UNION ALL SELECT 'sorted', 3 * count(*) FILTER (WHERE reject_reason IS NULL) FROM d
            UNION ALL SELECT 'produced', 3 * count(*) FILTER (WHERE reject_reason IS NULL) FROM d
            UNION ALL SELECT unnest(['generation_errors', 'sorting_errors', 'production_errors']), 0""",
        "run_report": f"""
            WITH d AS (SELECT count(*) AS n, count(*) FILTER (WHERE reject_reason IS NULL) AS good FROM {_decoded(_DIRTY)})
            SELECT 'snapshot' AS stage, n AS "rows", true AS timed FROM d
            UNION ALL SELECT unnest(['sort_id', 'sort_name', 'sort_continent', 'publish_id', 'publish_name',
                                     'publish_continent']), good, true FROM d
            UNION ALL SELECT 'overall', 3 * good, true FROM d""",
        # windows
        "check_sorted_id": _check_sorted("id", f"SELECT * FROM {_published(_LOG)}"),
        "check_sorted_name": _check_sorted("name", f"SELECT * FROM {_published(_LOG)}"),
        "check_sorted_continent": _check_sorted("continent", f"SELECT * FROM {_published(_LOG)}"),
        "detect_runs": _detect(_DIRTY),
        "stream_detect_runs": _detect(f"SELECT * FROM {_topics(True)} WHERE topic = 'id'"),
        # end-to-end jobs
        "batch_job": f"SELECT * FROM {_published(_LOG)}",
        "batch_resume": _RESUMED,
        "publish_atomic": f"SELECT * FROM ({_RESUMED}) UNION ALL SELECT * FROM ({_LOG})",
        "group_read": f"""
            WITH l AS ({_LOG}), e AS (SELECT max("offset") + 1 AS n FROM l)
            SELECT CASE WHEN "offset" < e.n // 2 OR "partition" < 2 THEN 'a' ELSE 'b' END AS member,
                   CASE WHEN "offset" < e.n // 2 THEN 1 ELSE 2 END AS generation, "partition", "offset", value FROM l, e""",
        "stream_first_n": f"""
            WITH l AS ({_LOG}), h AS (SELECT max("offset") + 1 AS n, count(*) AS c FROM l),
            a AS (SELECT l.*, c, row_number() OVER (ORDER BY
                    CASE WHEN "offset" >= n * 1 // 4 THEN 1 ELSE 0 END + CASE WHEN "offset" >= n * 2 // 4 THEN 1 ELSE 0 END
                    + CASE WHEN "offset" >= n * 3 // 4 THEN 1 ELSE 0 END, "partition", "offset") AS i FROM l, h)
            SELECT CAST(CASE WHEN i <= c * 6 // 10 + 1 THEN 0 ELSE 1 END AS INT) AS read, "partition", "offset", value
            FROM a WHERE i <= c * 6 // 10 + 1 + c * 2 // 10""",
        "validate_incremental": _validate_all(_published(_LOG)),
        "validate_all": _validate_all(_published(_LOG)),
        # streaming
        "stream_runs": f"""
            WITH v AS (SELECT "partition", "offset" FROM {_accepted(_DIRTY)})
            SELECT "partition" AS src_partition, "offset" AS src_offset,
                   row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1 AS seq,
                   (row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1) // 300 AS run_id
            FROM v""",
        "stream_fanout": f"SELECT {_FANOUT} FROM {_stream(True)}",
        "stream_keyed_publish": f"SELECT * FROM {_topics(True)}",
        "stream_rejects": f"""SELECT "partition", "offset", value, reject_reason
            FROM {_decoded(_DIRTY)} WHERE reject_reason IS NOT NULL""",
        "stream_resume": f"SELECT {_FANOUT} FROM {_stream(True)}",
        "stream_tail_flush": f"SELECT {_FANOUT} FROM {_stream(False)}",
        "stream_progress": _PROGRESS,
        "stream_metrics": f"""SELECT *, CAST(CASE batch_id WHEN 2 THEN 1 ELSE 0 END AS BIGINT) AS failures, true AS timed,
            true AS rated FROM ({_PROGRESS})""",
        "stream_continuous": f"SELECT * FROM {_topics(False)}",
        "stream_compact": f"""
            WITH o AS (SELECT *, row_number() OVER (PARTITION BY sort_key ORDER BY
                         CASE sort_key WHEN 'name' THEN name WHEN 'continent' THEN continent ELSE '' END,
                         id, src_partition, src_offset) - 1 AS place, count(*) OVER (PARTITION BY sort_key) AS total
                       FROM {_stream(True)}),
            l AS (SELECT *, (place * 4) // total AS p FROM o)
            SELECT sort_key AS topic, CAST(p AS INT) AS "partition", CAST(place - (p * total + 3) // 4 AS BIGINT) AS "offset",
                   key, {_ENC} AS value FROM l""",
        "stream_job": f"SELECT * FROM {_topics(False)}",
    }

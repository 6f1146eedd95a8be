"""Line codec as built-in column expressions (T1-T5); no Python on the row path.

Decode rules (each one a fixed behaviour of the original line format):

1. Trim Unicode white space from both ends of the *line* only; fields keep
   their inner spaces.  Plain ``trim`` strips U+0020 only, so the
   two-argument ``trim`` is given the whole White_Space set.
2. Split on every comma keeping empty fields; exactly 4 fields, else the line
   is rejected with ``field_count`` (an empty line has one field).
3. The id is an optional sign followed by the leading decimal digits; trailing
   text after the digits is ignored (``12abc`` -> 12, ``1_000`` -> 1).  No
   digits or a value beyond 64 bits -> ``id``.
4. The 64-bit value narrows to 32 bits by two's-complement wrap-around
   (``2147483648`` -> ``-2147483648``); Spark's ANSI cast would raise instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import RECORD_FIELDS

# The White_Space characters trimmed from the line ends
# (U+0009-U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028,
# U+2029, U+202F, U+205F, U+3000), i.e. ASCII controls, NEL and category Z.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Optional sign, then the digits up to the first other character.
ID_PATTERN = r"^([+-]?[0-9]+)"

REJECT_FIELD_COUNT = "field_count"
REJECT_ID = "id"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_trim(c: str | Column) -> Column:
    """Strip White_Space from both ends; a character-set trim, no regex."""
    return F.trim(_col(c), F.lit(WHITE_SPACE))


def line_fields(value: str | Column) -> Column:
    """Array of the comma-separated fields of a trimmed line (NULL -> [''])."""
    return F.split(unicode_trim(F.coalesce(_col(value), F.lit(""))), ",", -1)


def parse_id64(field: str | Column) -> Column:
    """Leading signed integer of a field as BIGINT, NULL when not parseable."""
    digits = F.regexp_extract(_col(field), ID_PATTERN, 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def int32_wrap(v: str | Column) -> Column:
    """T5: two's-complement narrowing of a BIGINT to INT (no ANSI overflow)."""
    return F.shiftright(F.shiftleft(_col(v), 32), 32).cast("int")


def encode_line(id_col: str | Column = "id", name: str | Column = "name",
                address: str | Column = "address",
                continent: str | Column = "continent") -> Column:
    """``id,name,address,continent``; any NULL field gives a NULL line.

    ``concat`` is used on purpose: ``concat_ws`` would silently drop a NULL
    field and produce a three-field line.
    """
    return F.concat(
        _col(id_col).cast("string"), F.lit(","), _col(name), F.lit(","),
        _col(address), F.lit(","), _col(continent),
    )


def decode(df: DataFrame, value: str = "value", keep_id64: bool = False) -> DataFrame:
    """Add ``id, name, address, continent, reject_reason`` decoded from ``value``.

    Every input row is kept; ``reject_reason`` is NULL for accepted lines and
    ``field_count`` / ``id`` otherwise (the record fields are then NULL).
    """
    out = df.withColumn("_parts", line_fields(value))
    out = out.withColumn("_id64", parse_id64(F.get(F.col("_parts"), 0)))
    out = out.withColumn(
        "reject_reason",
        F.when(F.size("_parts") != 4, F.lit(REJECT_FIELD_COUNT))
        .when(F.col("_id64").isNull(), F.lit(REJECT_ID)),
    )
    ok = F.col("reject_reason").isNull()
    out = out.select(
        *[c for c in df.columns if c not in RECORD_FIELDS and c != "reject_reason"],
        F.when(ok, int32_wrap("_id64")).alias("id"),
        F.when(ok, F.get("_parts", 1)).alias("name"),
        F.when(ok, F.get("_parts", 2)).alias("address"),
        F.when(ok, F.get("_parts", 3)).alias("continent"),
        "reject_reason",
        *(["_id64"] if keep_id64 else []),
    )
    return out.withColumnRenamed("_id64", "id64") if keep_id64 else out


def decode_tolerant(df: DataFrame, value: str = "value") -> DataFrame:
    """Accepted records only; bad lines are skipped (and counted by T4)."""
    return decode(df, value).where(F.col("reject_reason").isNull()).drop("reject_reason")


def decode_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """T4: the complement of T3, with the reason of each rejected line."""
    return (
        decode(df, value)
        .where(F.col("reject_reason").isNotNull())
        .drop(*RECORD_FIELDS)
    )


def fail_on_reject(decoded: DataFrame, value: str = "value") -> DataFrame:
    """Keep the decoded rows but fail the job at the first rejected line.

    The check sits in a filter so column pruning can never drop it.
    """
    guard = F.when(F.col("reject_reason").isNull(), F.lit(True)).otherwise(
        F.raise_error(
            F.concat(
                F.lit("invalid record ("), F.col("reject_reason"), F.lit("): "),
                F.coalesce(F.col(value), F.lit("<null>")),
            )
        )
    )
    return decoded.where(guard)


def decode_strict(df: DataFrame, value: str = "value") -> DataFrame:
    """Like T3, but the job fails on the first bad line."""
    return fail_on_reject(decode(df, value), value).drop("reject_reason")

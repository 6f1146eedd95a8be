"""Schemas, sort keys and fixed domain values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Record: the fixed four-field row carried by every log line.
RECORD_FIELDS = ["id", "name", "address", "continent"]
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("address", T.StringType(), False),
        T.StructField("continent", T.StringType(), False),
    ]
)

# Log table: one row per message, mirroring the columns of Spark's Kafka source
# (key/value as strings; cast at the edge when a real broker is used).
LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
    ]
)
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]

# Fixed values that must equal the original pipeline's for right results:
# the continent domain (in its original order), the topic names, the number of
# partitions per topic, the default run length and the generator field bounds.
CONTINENTS = [
    "North America",
    "Asia",
    "South America",
    "Europe",
    "Africa",
    "Australia",
]
SOURCE_TOPIC = "source"
SORTED_TOPICS = ["id", "name", "continent"]
REQUIRED_TOPICS = [SOURCE_TOPIC] + SORTED_TOPICS
LOG_PARTITIONS = 4
DEFAULT_RUN_LENGTH = 1_000_000
NAME_LEN = (10, 15)
ADDRESS_LEN = (15, 20)

# Sort keys: field order of each published ordering. A total tie-break
# (row id or source position) is always appended by the caller, which is
# one of the orders an unstable sort on these fields may produce.
SORT_KEYS: dict[str, list[str]] = {
    "id": ["id"],
    "name": ["name", "id"],
    "continent": ["continent", "id"],
}


def sort_key_columns(key: str) -> list[str]:
    """Field list of a named ordering; an unknown name is an error."""
    try:
        return list(SORT_KEYS[key])
    except KeyError:
        raise ValueError(
            f"unknown sort key {key!r}; expected one of {sorted(SORT_KEYS)}"
        ) from None


def run_length(chunk: int | None) -> int:
    """Run length rule shared by batch and streaming: <= 0 means the default."""
    if chunk is None or chunk <= 0:
        return DEFAULT_RUN_LENGTH
    return int(chunk)

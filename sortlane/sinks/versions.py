"""Versioned tables: one small file per version, made by compare-and-swap.

A version is a JSON file ``<folder>/v=<number>.json`` that names the data
folders (and whatever else belongs to the state).  It is written whole under
another name and renamed without overwriting, so a version either exists
complete or not at all, and of two writers that build on the same version one
is refused.  Data folders that no version names are never read.

The rename is atomic on HDFS and on stores whose Hadoop connector renames or
creates conditionally; on an object store without that, give versions a folder
on one that has it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import small_table
from ..schema import LOG_COLUMNS
from ..session import _folder, list_folder, remove_folder

VERSIONS = "_versions"
DATA = "data"
_MESSAGE = "partition int, offset bigint, key string, value string"


class VersionConflict(RuntimeError):
    """Another writer made the version first."""


def list_versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(f[2:-5]) for f in list_folder(spark, folder) if f.startswith("v=") and f.endswith(".json"))


def _path(folder: str, version: int) -> str:
    return f"{folder.rstrip('/')}/v={version:012d}.json"


def read_state(spark: SparkSession, folder: str, version: int | None = None) -> tuple[int, dict]:
    """``(number, content)`` of a version, the last one by default; ``(-1, {})`` before the first."""
    if version is None:
        known = list_versions(spark, folder)
        if not known:
            return -1, {}
        version = known[-1]
    fs, where = _folder(spark, _path(folder, version))
    stream = fs.open(where)
    try:
        return version, json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_state(spark: SparkSession, folder: str, version: int, content: Mapping) -> None:
    """Make ``version``; refused with ``VersionConflict`` if it exists or its predecessor doesn't."""
    known = list_versions(spark, folder)
    if version != (known[-1] + 1 if known else 0):
        raise VersionConflict(f"version {version} of {folder} can't follow {known[-1:]}")
    jvm = spark.sparkContext._jvm
    fs, target = _folder(spark, _path(folder, version))
    _, draft = _folder(spark, f"{folder.rstrip('/')}/.draft-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), no_overwrite)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise VersionConflict(f"version {version} of {folder} was made by another writer") from e
        raise


@dataclass
class Publication:
    """Topics written for one version; nothing is seen before ``commit``.

    Built on the version that was the last when it began: if another one was
    made meanwhile, ``commit`` is refused and takes its own folders away.
    """

    spark: SparkSession
    base: str
    token: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def __post_init__(self) -> None:
        self.base = self.base.rstrip("/")
        self.number, self.before = read_state(self.spark, f"{self.base}/{VERSIONS}")
        if self.number < 0:
            # Topics written without versions belong to the first one.
            self.before = {"topics": {f.removeprefix("topic="): [f] for f in list_folder(self.spark, self.base)
                                      if f.startswith("topic=")}, "groups": {}}
        self.topics = {t: list(p) for t, p in self.before["topics"].items()}
        self.written: list[str] = []

    def write(self, rows: DataFrame, topic: str, append: bool = False) -> int:
        """Write a topic's messages, in place of it or after it; returns their number."""
        folder = f"{DATA}/topic={topic}/run={self.token}"
        self.written.append(folder)
        seen = Observation(f"publish-{topic}-{uuid.uuid4().hex[:6]}")
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).select(
            *[c for c in LOG_COLUMNS if c != "topic"]).write.mode("overwrite").parquet(f"{self.base}/{folder}")
        self.topics[topic] = [*(self.topics.get(topic, []) if append else []), folder]
        return int(seen.get.get("rows") or 0)

    def read(self, topic: str, published: bool = False) -> DataFrame:
        """A topic as this publication has it so far, or as it was published before."""
        return _read_folders(self.spark, self.base, {topic: (self.before["topics"] if published else self.topics).get(topic, [])})

    def commit(self, groups: Mapping[str, Mapping] | None = None) -> int:
        """Make the version that holds all written topics and the groups' offsets."""
        content = {"topics": self.topics, "groups": {**self.before["groups"], **(groups or {})}}
        try:
            create_state(self.spark, f"{self.base}/{VERSIONS}", self.number + 1, content)
        except VersionConflict:
            self.abandon()
            raise
        self.written = []
        return self.number + 1

    def abandon(self) -> None:
        """Remove what was written and isn't part of a version."""
        for folder in self.written:
            remove_folder(self.spark, f"{self.base}/{folder}")
        self.written = []


def publish_atomic(spark: SparkSession, base: str, topics: Mapping[str, DataFrame], append: Sequence[str] = (),
                   groups: Mapping[str, Mapping] | None = None) -> int:
    """K5/L1: publish several topics and the groups' offsets as one version; returns its number.

    ``append``: topics whose messages follow those already there.
    """
    made = Publication(spark, base)
    try:
        for topic, rows in topics.items():
            made.write(rows, topic, topic in append)
        return made.commit(groups)
    finally:
        made.abandon()


def _read_folders(spark: SparkSession, base: str, topics: Mapping[str, Sequence[str]]) -> DataFrame:
    out = small_table(spark, [], f"topic string, {_MESSAGE}")
    for topic, folders in sorted(topics.items()):
        if folders:
            rows = spark.read.schema(_MESSAGE).parquet(*[f"{base.rstrip('/')}/{f}" for f in folders])
            out = out.unionByName(rows.withColumn("topic", F.lit(topic)).select(*LOG_COLUMNS))
    return out


def read_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The messages of one version (the last one by default), whatever is published later."""
    number, content = read_state(spark, f"{base.rstrip('/')}/{VERSIONS}", version)
    if number < 0:
        raise RuntimeError(f"no version under {base}")
    return _read_folders(spark, base, content["topics"])


def remove_old_versions(spark: SparkSession, base: str, keep: int = 2, older_than: float = 86400.0) -> list[str]:
    """Delete data folders that none of the last ``keep`` versions names and that
    were not changed for ``older_than`` seconds (a writer at work has newer ones);
    version files stay.  Returns the folders."""
    folder = f"{base.rstrip('/')}/{VERSIONS}"
    named = {f for v in list_versions(spark, folder)[-keep:] for fs in read_state(spark, folder, v)[1]["topics"].values() for f in fs}
    gone = []
    for topic in list_folder(spark, f"{base.rstrip('/')}/{DATA}"):
        for run in list_folder(spark, f"{base.rstrip('/')}/{DATA}/{topic}"):
            path = f"{DATA}/{topic}/{run}"
            fs, where = _folder(spark, f"{base.rstrip('/')}/{path}")
            if path not in named and time.time() - fs.getFileStatus(where).getModificationTime() / 1000 >= older_than:
                remove_folder(spark, f"{base.rstrip('/')}/{path}")
                gone.append(path)
    return gone

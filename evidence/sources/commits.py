"""Which folders of a run count: commit records, live attempts, clearing up.

A run is made of parts (a first pass, each resume, each batch of a stream). Every attempt at a
part writes folders of its own, ``<base>/<stream>/run=<run>/part=<attempt>``, which nothing else
ever writes to. When all its folders are complete, one commit record is written: the part,
the attempt, and the attempts it replaces. Readers take the folders of live attempts only, those
with a record that no other record replaces. So

* an attempt that broke off, wherever, is not seen by anybody;
* a part that is repeated replaces its earlier attempt at the moment of its commit;
* a forced or full repeat of the run replaces all attempts at that moment.

A record is one small file, written by Spark's own commit protocol into a folder of its own,
on any file system Spark can write to. Two writers of the same part at the same time are not
arbitrated: both are committed, and neither replaces the other.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = ("kind string, run string, part string, attempt string, replaces array<string>, "
          "generation long, counters map<string, long>, committed_at timestamp")


@dataclass(frozen=True)
class Part:
    """An attempt at a part of a run, from its beginning to its commit."""

    base: str
    kind: str
    run: str
    part: str
    attempt: str
    replaces: tuple[str, ...] = ()
    generation: int = 1

    def folder(self, stream: str) -> str:
        return folder(self.base, stream, self.run, self.attempt)


def folder(base: str, stream: str, run: str, attempt: str) -> str:
    return f"{base.rstrip('/')}/{stream}/run={run}/part={attempt}"


def _records_folder(base: str, kind: str, run: str) -> str:
    return f"{base.rstrip('/')}/commits/{kind}/run={run}"


def history(spark: SparkSession, base: str, kind: str, run: str) -> DataFrame:
    """All commit records of a run, with ``live``."""
    try:
        found = (spark.read.schema(RECORD).option("recursiveFileLookup", "true")
                 .json(_records_folder(base, kind, run)))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], RECORD)
    gone = found.select(F.explode("replaces").alias("attempt")).distinct()
    return found.join(gone.withColumn("_gone", F.lit(True)), "attempt", "left") \
        .withColumn("live", F.col("_gone").isNull()).drop("_gone")


def live(spark: SparkSession, base: str, kind: str, run: str) -> list:
    """Records of the live attempts, one per part of the run."""
    return sorted(history(spark, base, kind, run).filter("live").collect(),
                  key=lambda r: (r.generation, r.committed_at, r.attempt))


def begin(spark: SparkSession, base: str, kind: str, run: str, part: str | None = None,
          resume: bool = False, generation: int | None = None) -> Part:
    """A new attempt.

    Without a name, a resume is a part of its own and anything else is the whole run, which
    replaces all that is live. With a name, an attempt replaces the live one of that name; a resume
    under a live name is refused, since what it leaves out would be lost with the part. An attempt
    of a newer ``generation`` replaces what is live of older ones.
    """
    held = live(spark, base, kind, run)
    now = max([r.generation for r in held], default=1)
    if part is not None and resume and any(r.part == part for r in held):
        raise ValueError(f"part {part} of run {run} is committed: a resume that replaced it would lose its rows")
    if part is None and not resume:
        gone = [r.attempt for r in held]
        now = now + bool(held)
    else:
        gone = [r.attempt for r in held if r.part == part]
    if generation is not None:
        gone += [r.attempt for r in held if r.generation < generation and r.attempt not in gone]
        now = generation
    named = part or (uuid.uuid4().hex if resume else "0")
    return Part(base, kind, run, named, f"{named}-{uuid.uuid4().hex[:12]}", tuple(gone), now)


def commit(spark: SparkSession, own: Part, counters: Mapping[str, int] | None = None,
           keep_replaced: bool = False) -> None:
    """Make an attempt count; to be called when all its folders are complete.

    Folders of replaced attempts are removed after that, unless somebody may still read them.
    """
    row = (own.kind, own.run, own.part, own.attempt, list(own.replaces), own.generation,
           dict(counters or {}), datetime.datetime.now(datetime.timezone.utc))
    spark.createDataFrame([row], RECORD).coalesce(1).write.json(
        f"{_records_folder(own.base, own.kind, own.run)}/{own.attempt}")
    if not keep_replaced and own.replaces:
        _remove(spark, own.base, own.run, lambda attempt, _: attempt in own.replaces)


def paths(spark: SparkSession, base: str, kind: str, run: str, stream: str,
          without: Iterable[str] = ()) -> list[str]:
    """Folders of a stream that count; attempts in ``without`` are left out."""
    skipped = set(without)
    return [folder(base, stream, run, r.attempt) for r in live(spark, base, kind, run)
            if r.attempt not in skipped]


def read(spark: SparkSession, base: str, kind: str, run: str, stream: str, schema: str,
         fmt: str = "parquet", without: Iterable[str] = ()) -> DataFrame:
    """Committed rows of a stream with the columns of ``schema``, an empty frame where there are none."""
    found = paths(spark, base, kind, run, stream, without)
    if not found:
        return spark.createDataFrame([], schema)
    rows = read_folders(spark, found, f"{base.rstrip('/')}/{stream}", schema, fmt)
    return rows.select(*spark.createDataFrame([], schema).columns)


def read_folders(spark: SparkSession, found: list[str], root: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Folders below ``root``, whose folder names may hold columns of the schema."""
    return spark.read.schema(schema).option("basePath", root).format(fmt).load(found)


def read_with(spark: SparkSession, found: list[str], reader: Callable[[list[str]], DataFrame],
              schema) -> DataFrame:
    """reader(found), or an empty frame of ``schema`` where nothing is committed."""
    return reader(found) if found else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, base: str, run: str, kinds: Iterable[str],
           older_than_hours: float = 24.0) -> int:
    """Remove attempts that are not live and were last written to so many hours ago or earlier.

    Younger ones may belong to a writer that is still at work. ``kinds`` must name all kinds
    that write below ``base``. Returns the number of folders removed.
    """
    kept = {r.attempt for kind in kinds for r in live(spark, base, kind, run)}
    limit = (datetime.datetime.now().timestamp() - older_than_hours * 3600) * 1000
    return _remove(spark, base, run, lambda attempt, at: attempt not in kept and at <= limit)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that only its writer knows."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _remove(spark: SparkSession, base: str, run: str, wanted: Callable[[str, int], bool]) -> int:
    """Remove attempt folders below base, at most two folders deep."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for depth in ("*", "*/*"):
        pattern = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{depth}/run={run}/part=*")
        fs = pattern.getFileSystem(conf)
        for status in fs.globStatus(pattern) or []:
            at = status.getPath()
            if wanted(at.getName().removeprefix("part="), status.getModificationTime()):
                removed += bool(fs.delete(at, True))
    return removed

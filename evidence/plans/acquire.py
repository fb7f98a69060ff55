"""Corpus acquisition: records in, filtered, one row per id, cut into date chunks.

`run_acquire` does this for a folder that grows: each call takes the files that no committed
part has read yet, leaves out ids that are already there, and commits its chunks, the ids, and
a manifest of files with the records found in each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunks, records, screen
from ..schema import (ARTICLE_TYPE, CHUNK_ROWS, CORPUS_EXCLUDED_TYPES, CORPUS_GROUPS, CORPUS_YEARS,
                      SHARD_ROWS)
from ..sources import article_xml, commits, sinks


def acquire(articles: DataFrame, groups: Sequence[Sequence[str]] = CORPUS_GROUPS,
            years: tuple[int, int] | None = CORPUS_YEARS,
            excluded_types: Sequence[str] = CORPUS_EXCLUDED_TYPES,
            max_rows: int = CHUNK_ROWS, stored: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Matching articles with ``chunk_id`` and ``part``; one row per id.

    Chunks are planned from counts of the same rows: with ``stored``, which writes rows and reads
    them back, their texts go through one shuffle for both.
    """
    hits = screen.corpus_filter(articles, groups, years, excluded_types)
    # one order for equal ids, whatever task read them
    order = [c for c in ("pub_date", "title", "abstract", "doi") if c in hits.columns]
    unique = records.dedupe_first(hits, scope="global", order=order)
    if stored is not None:
        unique = stored(unique)
    return chunks.plan_chunks(unique, max_rows=max_rows, years=years or CORPUS_YEARS)


def acquire_xml(spark: SparkSession, source: str, target: str, rows: int = SHARD_ROWS,
                **options) -> DataFrame:
    """XML folder to chunked JSON lines; returns the manifest."""
    chunked = acquire(article_xml.read_article_xml(spark, source), **options)
    chunks.write_chunks(chunked, target, rows)
    written = spark.read.schema(f"{ARTICLE_TYPE}, chunk_id string").json(target)
    return chunks.manifest(written)


FILE_TYPE = "file string, bytes long, modified timestamp, records long, kept long"
_COUNT_TYPE = "chunk_id string, n long"


def listed_files(spark: SparkSession, source: str, glob: str = "*.xml*") -> DataFrame:
    """file, bytes, modified and path of the files of a folder; their content is not read.

    ``file`` is the name that records carry, ``path`` the one to read by.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(source)
            .select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"),
                    F.col("modificationTime").alias("modified"), "path"))


def run_acquire(spark: SparkSession, source: str, base: str, run: str, rows: int = SHARD_ROWS,
                glob: str = "*.xml*", force: bool = False, **options) -> DataFrame:
    """Acquire the files of a folder that this run has not read; returns the manifest of chunks.

    A file counts as read with its size and modification time, so one that was changed is
    read again; what it holds under known ids is left out. ``force`` reads everything anew and
    replaces the run. Which rows share a chunk is decided per call: a chunk's rows are those of
    that name in all parts. ``options`` are those of `acquire`.
    """
    held = [] if force else commits.live(spark, base, "acquire", run)
    files = listed_files(spark, source, glob)
    if held:
        files = files.join(read_files(spark, base, run), ["file", "bytes", "modified"], "left_anti")
    # names of new files, which the reader needs on the driver anyway
    todo = sorted(r.path for r in files.select("path").distinct().collect())
    own = commits.begin(spark, base, "acquire", run, resume=bool(held))
    if todo:
        records_ = sinks.stage_rows(article_xml.read_article_xml(spark, todo, glob, file="_file"),
                                    f"{base.rstrip('/')}/parsed", run, own.attempt)
        known = commits.read(spark, base, "acquire", run, "ids", "pmid string", without=own.replaces)
        scratch = f"{base.rstrip('/')}/unique"
        chunked = acquire(records.pending(records_, known).drop("_file"),
                          stored=lambda df: sinks.stage_rows(df, scratch, run, own.attempt), **options)
        chunks.write_chunks(chunked, own.folder("chunks"), rows, packed=True)
        commits.drop_folder(spark, commits.folder(scratch, "rows", run, own.attempt))
        chunked = spark.read.schema(f"{ARTICLE_TYPE}, chunk_id string").json(own.folder("chunks"))
        chunked.select("pmid").filter("pmid <> ''").distinct().write.mode("overwrite").parquet(own.folder("ids"))
        chunks.manifest(chunked).write.mode("overwrite").parquet(own.folder("manifest"))
        first = records_.select("pmid", "_file").join(
            spark.read.schema("pmid string").parquet(own.folder("ids")), "pmid", "left_semi") \
            .groupBy("pmid").agg(F.min("_file").alias("_file"))
        found = records_.groupBy("_file").agg(F.count("*").alias("records")).withColumn("kept", F.lit(0).cast("long"))
        kept = first.groupBy("_file").agg(F.count("*").alias("kept")).withColumn("records", F.lit(0).cast("long"))
        counted = found.unionByName(kept).groupBy(F.col("_file").alias("file")).agg(
            F.sum("records").alias("records"), F.sum("kept").alias("kept"))
        files.join(counted, "file", "left").select(
            "file", "bytes", "modified", F.coalesce("records", F.lit(0)).alias("records"),
            F.coalesce("kept", F.lit(0)).alias("kept")).write.mode("overwrite").parquet(own.folder("files"))
        commits.commit(spark, own, {"files": len(todo)})
        commits.drop_folder(spark, commits.folder(f"{base.rstrip('/')}/parsed", "rows", run, own.attempt))
    return read_manifest(spark, base, run)


def read_files(spark: SparkSession, base: str, run: str) -> DataFrame:
    """The files a run has read: size, time, records in each, and ids first kept from each."""
    return commits.read(spark, base, "acquire", run, "files", FILE_TYPE)


def read_manifest(spark: SparkSession, base: str, run: str) -> DataFrame:
    """Rows per chunk over all committed parts."""
    return commits.read(spark, base, "acquire", run, "manifest", _COUNT_TYPE).groupBy("chunk_id").agg(F.sum("n").alias("n"))


def read_chunks(spark: SparkSession, base: str, run: str) -> DataFrame:
    """Committed articles with their chunk."""
    return commits.read(spark, base, "acquire", run, "chunks", f"{ARTICLE_TYPE}, chunk_id string", "json")

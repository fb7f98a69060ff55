"""Sinks: sharded JSON lines, the three extraction streams, CSV and summary records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_SCHEMA, SHARD_ROWS, ExtractionSchema
from ..session import FEW_SHARDS


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows as JSON lines; nulls are written as ``null``."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


#: packed JSON lines; names and empty fields repeat in each line, so the fastest level does
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_sharded(df: DataFrame, path: str, rows: int = SHARD_ROWS, order: Sequence[str] = (),
                  mode: str = "overwrite", packed: bool = False) -> None:
    """JSON lines with at most ``rows`` records per file, ranged by ``order`` if given.

    A hash of the row ends the range key, so a value that many rows share is spread too.
    """
    if order:
        df = df.repartitionByRange(*order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    (df.write.mode(mode).option("maxRecordsPerFile", rows).options(**(PACKED if packed else {}))
     .option("ignoreNullFields", "false").json(path))


def few_shards(df: DataFrame, shard: str = "shard") -> bool:
    """Whether there are so few shards that a task can write to all of them.

    Rows without a shard are read back with the number in their file's name, so where there are such
    rows, files stay as few as a rebalance makes them.
    """
    found = df.select(shard).distinct().limit(FEW_SHARDS + 1).collect()
    return len(found) <= FEW_SHARDS and not any(r[0] in (None, "") for r in found)


def write_by_shard(df: DataFrame, path: str, shard: str = "shard", mode: str = "append",
                   rows: int | None = None, packed: bool = False, few: bool = False) -> None:
    """One folder per shard.

    Rows are rebalanced by shard: a large shard is written by many tasks, small ones share a
    task, so files are few. Where the shards themselves are ``few``, each task writes its rows to
    all of them, and whole documents need no shuffle.
    """
    dealt = df if few else df.hint("rebalance", F.col(shard))
    writer = dealt.write.mode(mode).partitionBy(shard).option("ignoreNullFields", "false")
    if rows:
        writer = writer.option("maxRecordsPerFile", rows)
    if packed:
        writer = writer.options(**PACKED)
    writer.json(path)


def document_columns(schema: ExtractionSchema = DEFAULT_SCHEMA) -> list[Column]:
    """Top-level keys of a written document."""
    return [F.col(f"doc.{k}").alias(k)
            for k in (schema.article_key, schema.entity_key, "normalization", "quality_flags")]


def extraction_streams(rows: DataFrame, review: DataFrame,
                       schema: ExtractionSchema = DEFAULT_SCHEMA) -> dict[str, DataFrame]:
    """The three outputs of one run: extracted, review and audit."""
    docs = document_columns(schema)
    return {"extracted": rows.select("pmid", *docs, "needs_review", "shard"),
            "review": review.select("pmid", *docs, "shard"),
            "audit": rows.select("audit.*", "shard")}


def run_folder(base: str, name: str, run: str, part: str | None = None) -> str:
    """Where one run (or one part of it) keeps a stream."""
    path = f"{base.rstrip('/')}/{name}/run={run}"
    return path if part is None else f"{path}/part={part}"


def stage_rows(rows: DataFrame, base: str, run: str, part: str | None = None) -> DataFrame:
    """Rows of one run as a stored table, computed once for all sinks that follow.

    Writing replaces the folder of that part of the run, so a repeated part leaves no double
    rows, and a lost executor costs a re-read instead of a re-run.
    """
    path = run_folder(base, "rows", run, part)
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_streams(streams: dict[str, DataFrame], base: str, run: str,
                  part: str | None = None) -> None:
    """One folder per stream, run and part, shards inside; packed, as documents repeat all names."""
    few = few_shards(next(iter(streams.values())))  # the first stream has all rows
    for name, df in streams.items():
        write_by_shard(df, run_folder(base, name, run, part), mode="overwrite", packed=True, few=few)


def write_prompts(prompts: DataFrame, path: str) -> None:
    """Prompt table for whoever runs the prompts; `jsonl.read_responses` takes the answers in."""
    write_jsonl(prompts, path, mode="overwrite")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Full export as Parquet or CSV."""
    writer = df.write.mode(mode)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """Run summary, a row per shard; a repeated part of a run replaces its own."""
    write_jsonl(df, path, mode="overwrite")

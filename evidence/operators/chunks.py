"""Date chunks, id sets, sorting, paging and shard numbering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import CHUNK_ROWS, CORPUS_YEARS, PAGE_ROWS, SHARD_ROWS
from ..session import cut_lineage
from ..sources.sinks import PACKED

DEEP_ROWS = 100_000
BLOCK_ROWS = 100_000
UNDATED = "undated"
WHOLE = "all"


def plan_chunks(df: DataFrame, date: str = "pub_date", max_rows: int = CHUNK_ROWS,
                years: tuple[int, int] = CORPUS_YEARS, spread: Sequence[str] | None = None
                ) -> DataFrame:
    """Add ``chunk_id`` and ``part`` so that chunks stay near ``max_rows`` rows.

    One chunk if everything fits, else months, and days for months that are too big.  A
    bare year is a chunk of its own; dates outside ``years`` go to ``undated``.  A chunk
    that is still too big is spread over hash parts of the whole row (or of ``spread``),
    so rows that lack an id are spread too.  No row is lost.

    The counts hold one row per date of the year range; Spark broadcasts them if they are small.
    """
    hashed = [F.col(c) for c in spread or hashable(df)]
    text = F.col(date).cast("string")
    in_range = F.coalesce(F.substring(text, 1, 4).try_cast("int").between(*years), F.lit(False))
    well_formed = F.rlike(text, F.lit(r"^\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?)?"))
    day = F.when(in_range & F.coalesce(well_formed, F.lit(False)),
                 F.regexp_extract(text, r"^\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?)?", 0)
                 ).otherwise(F.lit(UNDATED))
    marked = df.withColumn("_day", day)

    days = marked.groupBy("_day").agg(F.count("*").alias("_n"))
    by_month = Window.partitionBy(F.substring("_day", 1, 7))
    sized = days.withColumns({
        "_month": F.when(F.col("_day") == UNDATED, F.col("_day"))
                  .otherwise(F.substring("_day", 1, 7)),
        "_month_n": F.sum("_n").over(by_month),
        "_total": F.lit(days.agg(F.sum("_n")).scalar()),
    })
    plan = sized.select(
        "_day",
        F.when(F.col("_total") <= max_rows, F.lit(WHOLE))
        .when(F.col("_month_n") <= max_rows, F.col("_month")).otherwise(F.col("_day"))
        .alias("chunk_id"),
        F.when((F.col("_total") > max_rows) & (F.col("_month_n") > max_rows),
               F.ceil(F.col("_n") / F.lit(max_rows))).otherwise(F.lit(1)).cast("int")
        .alias("_parts"))
    return (marked.join(plan, "_day")
            .withColumn("part", F.pmod(F.xxhash64(*hashed), F.col("_parts")).cast("int"))
            .drop("_day", "_parts"))


def hashable(df: DataFrame) -> list[str]:
    """Columns that a row hash can be made of."""
    return [f.name for f in df.schema
            if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]


def manifest(chunked: DataFrame) -> DataFrame:
    """Rows per chunk; empty chunks do not appear."""
    return chunked.groupBy("chunk_id").agg(F.count("*").alias("n"))


def write_chunks(chunked: DataFrame, path: str, rows: int = SHARD_ROWS, packed: bool = False) -> None:
    """One folder per chunk, at most ``rows`` records per file.

    Rows are rebalanced by chunk and part: large parts are split, small ones are merged.
    """
    (chunked.hint("rebalance", F.col("chunk_id"), F.col("part")).write.mode("overwrite")
     .partitionBy("chunk_id").option("maxRecordsPerFile", rows).options(**(PACKED if packed else {}))
     .option("ignoreNullFields", "false").json(path))


def hit_count(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate).agg(F.count("*").alias("n"))


def union_ids(frames: Sequence[DataFrame], key: str = "pmid") -> DataFrame:
    """Distinct ids of several results."""
    return reduce(DataFrame.unionByName, [f.select(key) for f in frames]).distinct()


def union_shards(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of several shards."""
    return reduce(DataFrame.unionByName, frames)


def sorted_by(df: DataFrame, *order: str | Column, tie: Sequence[str] = ("pmid",)) -> DataFrame:
    """Global sort with a tie-break, so that equal dates can go to several ranges."""
    return df.orderBy(*order, *tie)


def page(df: DataFrame, order: Sequence[str], start: int = 0, size: int = PAGE_ROWS) -> DataFrame:
    """One page of the sorted rows: ``size`` rows after the first ``start`` ones.

    The first pages are a top-k.  Beyond ``DEEP_ROWS`` the rows are numbered instead, so no
    task holds all that comes before the page.  A row hash ends the order either way, so pages
    of equal keys neither repeat nor lose rows.  Who reads many pages should store the order
    (`store_order`) instead of sorting again for each.
    """
    if start + size <= DEEP_ROWS:
        return df.orderBy(*order, F.xxhash64(*hashable(df))).offset(start).limit(size)
    numbered = number_rows(df, order)
    return (numbered.filter(F.col("row_no").between(start + 1, start + size))
            .orderBy("row_no").drop("row_no"))


def store_order(df: DataFrame, path: str, order: Sequence[str], block_rows: int = BLOCK_ROWS) -> None:
    """Write the rows in order, numbered, in folders of ``block_rows`` consecutive rows.

    One sort serves all pages: a row's folder follows from its number.
    """
    numbered = number_rows(df, order)
    block = F.floor((F.col("row_no") - 1) / F.lit(block_rows)).cast("long")
    (numbered.withColumn("block", block).write.mode("overwrite").partitionBy("block").parquet(f"{path}/rows"))
    # what the folders were cut by, and an empty file with the columns, for tables without rows
    df.sparkSession.createDataFrame([(block_rows,)], "block_rows long").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/cut")
    numbered.limit(0).write.mode("overwrite").parquet(f"{path}/columns")


def stored_page(spark: SparkSession, path: str, start: int = 0, size: int = PAGE_ROWS) -> DataFrame:
    """Rows ``start + 1 .. start + size`` of a stored order; only their folders are read."""
    cut = spark.read.parquet(f"{path}/cut").first().block_rows
    schema = spark.read.parquet(f"{path}/columns").schema.add("block", "long")
    blocks = F.col("block").between(start // cut, (start + max(size, 1) - 1) // cut)
    rows = F.col("row_no").between(start + 1, start + size)
    return spark.read.schema(schema).parquet(f"{path}/rows").filter(blocks & rows).orderBy("row_no").drop("block", "row_no")


def number_rows(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Add ``row_no`` 1..n in global order without a single-task window.

    Rows are ranged and sorted in their tasks and stored; the rows before each range come
    from one count per range, a table of ``partitions`` rows.  A row hash ends the range key,
    so rows of equal keys are split too; their numbers follow that hash.
    """
    order = [*order, F.xxhash64(*hashable(df))]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_range").agg(F.count("*").alias("_n"))
               .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (placed.join(offsets, "_range")
            .withColumn("row_no", F.col("_before") + F.col("_pos") + 1)
            .drop("_range", "_pos", "_before"))


def number_shards(df: DataFrame, order: Sequence[str], rows: int = SHARD_ROWS,
                  partitions: int | None = None) -> DataFrame:
    """Add ``shard_no``: consecutive groups of ``rows`` records in global order, from 0."""
    return (number_rows(df, order, partitions)
            .withColumn("shard_no", F.floor((F.col("row_no") - 1) / F.lit(rows)).cast("bigint"))
            .drop("row_no"))

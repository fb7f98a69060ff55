"""Line deduplication that returns per-document keep bitmaps.

Line hashes are range-partitioned and sorted within their range by document and position;
one streaming pass marks the first occurrence and each change of document. What is handed
on is no text: a document's drops are 64-bit words, kept only where a line goes.

Hot lines: the range key ends in a slice of the document, so that a line that fills a third
of all rows is spread over SLICES ranges. The slices' counts are added up per line (with
map-side combine) and joined back; a hot key of that join is split by AQE.

Defined cases: null or empty text is one empty line. Lines whose key has fewer than
``min_chars`` code points are always kept. A document is its (doc_id, text) pair: repeated
rows count once and get equal bitmaps, rows that share only an id count apart, a null id is
an id like any other. An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence.llm.base import ROW, WHITE, ascii_lower, digest_pair, keyed, same_row

SLICES = 64
WORD_BITS = 64
HASH = ("h1", "h2")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per line that can be dropped: row identity, pos (from 0), h1, h2."""
    lines = keyed(docs).select(*ROW, F.posexplode(lines_of(F.col("text"))).alias("pos", "line")) \
        .select(*ROW, "pos", line_key(F.col("line")).alias("key"))
    return lines.filter(F.length("key") >= max(min_chars, 1)) \
        .select(*ROW, "pos", *digest_pair(F.col("key")))


def repeated_lines(rows: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """The rows whose line occurs in at least min_docs documents, without the first occurrence
    if that is to stay."""
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64(*ROW), F.lit(SLICES)))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = sliced.repartitionByRange(parts, *HASH, "slice")
    stream = Window.partitionBy(*HASH, "slice").orderBy(*ROW, "pos")
    here, before = F.struct(*ROW), F.lag(F.struct(*ROW)).over(stream)
    seen = ranged.select(
        "*", F.row_number().over(stream).alias("nth"),
        F.when(F.row_number().over(stream) == 1, 1)
        .when(here.eqNullSafe(before), 0).otherwise(1).alias("new_document"))
    # one row per line: the head of each slice carries the earliest place in it
    totals = seen.groupBy(*HASH).agg(
        F.sum("new_document").alias("n_docs"),
        F.min(F.when(F.col("nth") == 1, F.struct(*ROW, "pos"))).alias("first"))
    totals = totals.filter(F.col("n_docs") >= min_docs)
    hit = seen.join(totals, list(HASH))
    if keep_first:
        hit = hit.filter(~F.struct(*ROW, "pos").eqNullSafe(F.col("first")))
    return hit.select(*ROW, "pos")


def keep_bitmaps(docs: DataFrame, min_docs: int = 2, keep_first: bool = True,
                 min_chars: int = 1) -> DataFrame:
    """doc_id, text_hash, keep: array of (word, bits), ascending, for documents that lose a line.

    Bit b of word w tells whether line 64 * w + b stays. Words of all ones are left out.
    """
    drops = repeated_lines(line_rows(docs, min_chars), min_docs, keep_first)
    bits = drops.groupBy(*ROW, (F.col("pos") / WORD_BITS).cast("int").alias("word")).agg(
        F.bitwise_not(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD_BITS})"))).alias("bits"))
    return bits.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def dropped_positions(keep: Column) -> Column:
    """Line numbers (from 0) that a bitmap drops; none for null."""
    def of(word: Column) -> Column:
        zeros = F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)),
                         lambda b: F.getbit(word["bits"], b) == 0)
        return F.transform(zeros, lambda b: word["word"] * WORD_BITS + b)
    return F.coalesce(F.flatten(F.transform(keep, of)), F.array().cast("array<int>"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text of every row of docs."""
    d, b = keyed(docs), bitmaps
    both = d.join(b, same_row(d, b), "left").select(
        d["doc_id"], lines_of(d["text"]).alias("lines"), dropped_positions(b["keep"]).alias("gone"))
    # array_except works with a hash set, so very long documents stay linear
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(every, F.col("gone")), lambda i: F.get(F.col("lines"), i))
    return both.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.array_join("lines", "\n"))
        .otherwise(F.array_join(kept, "\n")).alias("kept_text"))

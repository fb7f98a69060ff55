"""Column helpers that several operators of this subpackage share.

Row identity. Operators address a row by ``doc_id`` and ``text_hash`` (both kept null-safe),
so null or repeated ids need no numbering: rows that agree in id and text have the same
result, rows that share only the id keep results of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: the six ASCII white-space characters
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROW = ("doc_id", "text_hash")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_hash() -> Column:
    return F.xxhash64("text").alias("text_hash")


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text_hash, text and the columns named; whatever else is there stays out."""
    return docs.select("doc_id", text_hash(), "text", *more)


def same_row(a: DataFrame, b: DataFrame, names: tuple[str, ...] = ROW) -> Column:
    """Null-safe equality of the row identity of two frames, usable as an equi-join."""
    out = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        out = out & a[n].eqNullSafe(b[n])
    return out


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once per row however often use() mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The white-space separated words; an empty array for null or blank text."""
    inner = F.btrim(text, F.lit(WHITE))
    return F.when(F.coalesce(F.length(inner), F.lit(0)) == 0, F.array().cast("array<string>")) \
        .otherwise(F.split(inner, WHITE_RUN))


def digest_pair(value: Column, names: tuple[str, str] = ("h1", "h2")) -> list[Column]:
    """128 bits as two columns; 64 would collide among the lines of a very large corpus."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(7), value).alias(names[1])]

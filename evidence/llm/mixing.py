"""Mixing sources to target weights.

Words are added up per source. Targets are found by water-filling: sources are taken in the
order of cap over weight, running sums give the level at which the rest is shared by weight,
and whoever would stand above its cap stays at it. A source's repetition rate is target over
size; a document is emitted floor(rate) times, plus one copy with probability equal to the
fraction, drawn from a hash of seed, id and text.

One window runs over one row per source, nothing else is brought together. Documents meet
their source's rate in a join that AQE broadcasts when the rates are small and splits when
a source is hot; no text crosses it.

Defined cases: null text has size 0; a null source is a source of its own, the last one. A
source of size 0 has target 0. Rows that agree in id and text share their draw. Columns of
docs that are named like a column made here stay as they are in ``emit`` .
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence.llm.base import WORD

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 17
DRAW_BITS = 52


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """Uniform in [0, 1), the same for the same id and text in every run."""
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")),
                      F.md5(F.coalesce(text, F.lit(""))))
    bits = F.conv(F.substring(F.md5(key), 1, DRAW_BITS // 4), 16, 10).cast("double")
    return bits / float(1 << DRAW_BITS)


def source_sizes(docs: DataFrame) -> DataFrame:
    return docs.select("source", size(F.col("text")).alias("size")) \
        .groupBy("source").agg(F.sum("size").alias("source_size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            cap: float = CAP) -> DataFrame:
    """source, source_size, target. One row per source; weights go round in source order."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.get(
        cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    weighed = weighed.withColumn("cap", F.lit(cap) * F.col("source_size"))
    fill = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    lower = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    levels = weighed.withColumn("level", (
        F.lit(share) * F.sum("source_size").over(whole)
        - F.coalesce(F.sum("cap").over(lower), F.lit(0.0)))
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(lower), F.lit(0.0))))
    # the level of the first source that is not full at it; where all are full there is none
    fits = F.col("cap") >= F.col("weight") * F.col("level")
    level = F.min(F.when(fits, F.struct((F.col("cap") / F.col("weight")).alias("at"), "source",
                                        "level"))).over(whole)["level"]
    return levels.select("source", "source_size", F.least(
        F.col("cap"), F.coalesce(F.col("weight") * level, F.col("cap"))).alias("target"))


def rate(t: DataFrame) -> Column:
    return F.when(t["source_size"] > 0, t["target"] / t["source_size"]).otherwise(0.0)


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
           cap: float = CAP, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies of every row of docs."""
    t = targets(source_sizes(docs), weights, share, cap)
    d = docs.select("doc_id", "source", size(F.col("text")).alias("size"),
                    draw(F.col("doc_id"), F.col("text"), seed).alias("u"))
    whole = F.floor(rate(t))
    return d.join(t, d["source"].eqNullSafe(t["source"])).select(
        d["doc_id"], d["size"], t["source_size"], t["target"],
        (whole + (d["u"] < rate(t) - whole).cast("long")).alias("copies"))


def emit(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
         cap: float = CAP, seed: int = SEED) -> DataFrame:
    """docs, each row as often as the mix takes it, with its columns as they were."""
    t = targets(source_sizes(docs), weights, share, cap) \
        .select(F.col("source").alias("__mix_source"), "source_size", "target")
    t = t.select("__mix_source", rate(t).alias("__mix_rate"))
    whole = F.floor(F.col("__mix_rate"))
    n = whole + (draw(docs["doc_id"], docs["text"], seed) < F.col("__mix_rate") - whole).cast("long")
    both = docs.join(t, docs["source"].eqNullSafe(t["__mix_source"]))
    held = both.select(*[docs[c] for c in docs.columns], n.cast("int").alias("__mix_copies"))
    return held.filter("__mix_copies > 0").select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))).alias("__mix_nth")) \
        .drop("__mix_nth")

"""Hard negatives of anchors by slot-decomposed selection.

Components are whole numbers: each x becomes floor(256 * x). A row's score is its inner
product with an anchor; higher scores come first, ties by smaller vec_id. An anchor's
positives are its first ``positives`` other rows of the same label; each positive of score p
has the window low_percent * p <= 100 * score <= high_percent * p, of which the first
``negatives`` rows of another label are wanted.

The windows of an anchor overlap, so no window is selected by itself. The upper limits of its
positives, in descending order, cut the scores into disjoint slots: slot i holds what is at
most limit i and above limit i + 1. A task keeps the best rows of each slot (a row is in one
slot only), one window per slot merges the tasks' rows, and a positive's answer is read off the
slots from its own one downwards: they follow each other in descending order, so their first
``negatives`` rows are the first below the upper limit, and the lower limit cuts their tail.

Anchors meet all rows in blocks: a block is bounded in rows and bytes, streamed through the
driver and broadcast; the rows are never shuffled, only the best of each task are. A hot label
changes nothing: rows are dealt as they are stored.

Inner products are made in float64 where no sum can reach 2**53, else in whole numbers of any
size; a score beyond 64 bits raises OverflowError.

Defined cases: rows with a null vec_id, label or vector, or a null or non-finite component
take no part. Vectors of different lengths are compared as if the shorter one ended in
zeros; an empty one scores 0. Repeated rows: equal anchors are one anchor, all other rows count as
often as they occur; a row with the anchor's vec_id is not another row. Anchors without
positives, and windows without rows, have no row in the result. An empty table gives an empty
result; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence.llm.graph import Stage

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT = 30
HIGH_PERCENT = 90
#: what is broadcast at once
BLOCK_ROWS = 8192
BLOCK_BYTES = 16 << 20
#: scores in memory at once
SCORES = 1 << 21
EXACT = float(1 << 53)
NONE = np.iinfo(np.int64).min
RESULT = ("anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, "
          "positive_score long, negative_score long")


def whole(vectors: DataFrame, label: Column | None = None) -> DataFrame:
    """vec_id, label, q of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"), "embedding",
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite) \
        .select("vec_id", "label", F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("q"))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column, filled up with zeros."""
    rows = column if isinstance(column, pa.Array) else column.combine_chunks()
    values, stops = rows.flatten().to_numpy(), rows.value_lengths().to_numpy().cumsum()
    sizes = np.diff(stops, prepend=0)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(rows), width)
    out = np.zeros((len(rows), width), np.int64)
    out[np.repeat(np.arange(len(rows)), sizes), np.arange(len(values)) - np.repeat(stops - sizes, sizes)] = values
    return out


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products, rows by anchors."""
    width = min(rows.shape[1], anchors.shape[1])
    a, b = rows[:, :width], anchors[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(rows), len(anchors)))
    most = [max(-float(x.min()), float(x.max())) for x in (a, b)]
    if most[0] * most[1] * width < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


class Best:
    """The first ``keep`` (score descending, id ascending) of each of ``n`` groups."""

    def __init__(self, n: int, keep: int):
        self.keep = keep
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        #: the least score with which a row can still get in
        self.least = np.full(n, NONE)

    def add(self, group: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(group):
            return
        every = [np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, id_))]
        order = np.lexsort((every[2], -every[1], every[0]))
        g = every[0][order]
        first = np.flatnonzero(np.diff(g, prepend=-1))
        place = np.arange(len(g)) - np.repeat(first, np.diff(first, append=len(g)))
        stay = place < self.keep
        self.group, self.score, self.id = (x[order][stay] for x in every)
        last = place[stay] == self.keep - 1
        self.least[self.group[last]] = self.score[last]


class Block:
    """Anchors that are broadcast together."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors

    def scored(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """ids, labels and scores by anchor of a few rows at a time."""
        step = max(1, SCORES // max(1, len(self.ids)))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                yield (part.column("vec_id").to_numpy(), part.column("label").to_numpy(),
                       products(matrix(part.column("q")), self.vectors))


def blocks(anchors: DataFrame) -> Iterator[Block]:
    """The anchors in blocks of bounded size, one partition at a time on the driver."""
    held: list[tuple] = []
    size = 0
    for row in anchors.toLocalIterator():
        held.append(row)
        size += 8 * len(row.q) + 16
        if len(held) == BLOCK_ROWS or size >= BLOCK_BYTES:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def packed(rows: list) -> Block:
    return Block(np.array([r.vec_id for r in rows], np.int64), np.array([r.label for r in rows], np.int64),
                 matrix(pa.array([r.q for r in rows], pa.list_(pa.int64()))))


def first(df: DataFrame, by: tuple[str, ...], keep: int) -> DataFrame:
    """The first ``keep`` rows of each group; Spark limits groups before it shuffles."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)


def best_same(rows: DataFrame, block, keep: int) -> DataFrame:
    """anchor, score, vec_id, place: the first rows of the anchor's own label."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Block = block.value
        best = Best(len(own.ids), keep)
        for ids, labels, scores in own.scored(batches):
            r, a = np.nonzero((scores >= best.least) & (labels[:, None] == own.labels) & (ids[:, None] != own.ids))
            best.add(a, scores[r, a].astype(np.int64), ids[r])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.group), pa.array(best.score), pa.array(best.id)], names=["anchor", "score", "vec_id"])
    return first(rows.mapInArrow(work, "anchor long, score long, vec_id long"), ("anchor",), keep)


def percent(score: np.ndarray, of: int) -> np.ndarray:
    """floor(of * score / 100) without a product that leaves 64 bits."""
    return score // 100 * of + score % 100 * of // 100


def lower_limit(score: np.ndarray, of: int) -> np.ndarray:
    """ceil(of * score / 100)."""
    return -percent(-score, of)


def best_by_slot(rows: DataFrame, block, limits, keep: int) -> DataFrame:
    """anchor, slot, score, vec_id: the first rows of another label in each slot."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Block = block.value
        upper, low = limits.value
        slots = upper.shape[1]
        # what lies above the next limit down, and not below every window
        above = np.maximum(np.concatenate([upper[:, 1:] + 1, np.full((len(upper), 1), NONE)], axis=1), low[:, None])
        best = Best(upper.size, keep)
        for ids, labels, scores in own.scored(batches):
            least = np.maximum(above, best.least.reshape(upper.shape))
            found = [[], [], []]
            for s in range(slots):
                r, a = np.nonzero((scores <= upper[:, s]) & (scores >= least[:, s]))
                other = labels[r] != own.labels[a]
                r, a = r[other], a[other]
                for out, x in zip(found, (a * slots + s, scores[r, a].astype(np.int64), ids[r]), strict=True):
                    out.append(x)
            best.add(*map(np.concatenate, found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.group // slots), pa.array((best.group % slots).astype(np.int32)),
             pa.array(best.score), pa.array(best.id)], names=["anchor", "slot", "score", "vec_id"])
    return first(rows.mapInArrow(work, "anchor long, slot int, score long, vec_id long"), ("anchor", "slot"), keep)


def limits_of(positives: pa.Table, n: int, width: int, low_percent: int, high_percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper limits by anchor in descending order, and the least lower limit of each anchor."""
    upper, low = np.full((n, width), NONE), np.full(n, np.iinfo(np.int64).max)
    anchor, place, score = (positives.column(c).to_numpy() for c in ("anchor", "place", "score"))
    upper[anchor, place - 1] = percent(score, high_percent)
    open_ = score >= 0  # a negative positive's limits are the wrong way round: no score lies between
    np.minimum.at(low, anchor[open_], lower_limit(score[open_], low_percent))
    return upper, low


def windows(slots: DataFrame, positives: DataFrame, negatives: int) -> DataFrame:
    """The first rows of each positive's window, from the best of the slots."""
    held = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        F.struct((-F.col("score")).alias("down"), F.col("vec_id").alias("vec_id")).alias("at"), "slot"))).alias("best"))
    down = F.filter("best", lambda x: x["slot"] >= F.col("place") - 1)
    p = F.col("positive_score")
    inside = F.filter(F.slice(down, 1, negatives), lambda x: -x["at"]["down"] >= F.col("low"))
    return positives.join(held, "anchor").filter(p >= 0).select(
        "anchor_id", "positive_id", F.col("place").alias("positive_rank"), p, F.posexplode(inside).alias("k", "x")) \
        .select("anchor_id", "positive_id", "positive_rank", (F.col("k") + 1).alias("rank"),
                F.col("x.at.vec_id").alias("negative_id"), "positive_score", (-F.col("x.at.down")).alias("negative_score"))


def mine(vectors: DataFrame, is_anchor: Callable[[Column], Column], label: Column | None = None,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
         high_percent: int = HIGH_PERCENT) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` says of vec_id which rows are anchors, ``label`` replaces the column label.
    """
    if not 0 <= low_percent <= high_percent:
        raise ValueError("0 <= low_percent <= high_percent is needed")
    spark, stage = vectors.sparkSession, Stage(vectors.sparkSession, "negatives")
    rows = stage(whole(vectors, label))
    anchors = stage(rows.filter(is_anchor(F.col("vec_id"))).distinct())
    out = spark.createDataFrame([], RESULT)
    for block in blocks(anchors):
        sent = spark.sparkContext.broadcast(block)
        same = best_same(rows, sent, positives).select("anchor", "place", "score", "vec_id").toArrow()
        if not same.num_rows:
            continue
        limits = spark.sparkContext.broadcast(
            limits_of(same, len(block.ids), positives, low_percent, high_percent))
        own = spark.createDataFrame(pa.table({
            "anchor": same.column("anchor"), "place": same.column("place"),
            "anchor_id": pa.array(block.ids[same.column("anchor").to_numpy()]),
            "positive_id": same.column("vec_id"), "positive_score": same.column("score"),
            "low": pa.array(lower_limit(same.column("score").to_numpy(), low_percent))}))
        slots = best_by_slot(rows, sent, limits, negatives)
        out = out.unionByName(stage(windows(slots, own, negatives)))
        sent.unpersist()
        limits.unpersist()
    stage.free(rows, anchors)
    return out

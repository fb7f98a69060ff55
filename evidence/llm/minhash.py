"""MinHash near-duplicate detection with sequential Bayesian verification.

1. One pass over the texts makes each document's set of word shingles, its fingerprint and a
   MinHash signature. Documents of equal sets are one class from then on, however many.
2. Signatures are banded; the classes of a band's bucket are candidates. Each is compared
   with the bucket's leader (its smallest class), never all with all.
3. Verification: signatures are compared batch by batch; after each one the posterior
   probability that the similarity reaches the threshold (uniform prior) decides: pairs below
   ``miss`` are given up. Survivors are verified exactly on their full sets.
4. Buckets whose members are not yet one component are looked at again: every pair of
   classes of different components, other than those with the leader, is compared inside a
   task, in blocks of bounded size; only links that join something are emitted. This is the
   exact way for what leaders miss, so no link is lost.
5. Components of all links give the groups.

The number of rows per band is the largest for which a pair at the threshold shares no band
with a probability of at most ``miss``.

Defined cases: null, empty and blank texts have an empty set, link with nothing and are
their own component. A null doc_id is never a component's name unless all its documents lack
one. Repeated rows are equal sets. Extra columns are left out of ``groups`` and kept by
``keep_one``; there, a group's row with the smallest (doc_id, text hash) stays, once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidence.llm.base import ROW, WHITE, keyed
from evidence.llm.graph import Stage, components

SHINGLE = 5
PERCENT = 80
HASHES = 120
BATCH = 24
MISS = 1e-6
BLOCK = 1024
SEED = 20
SIGNED = "doc_id long, text_hash long, n_shingles long, class binary, signature binary"


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The sorted set of hashes of a text's runs of ``width`` words."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(own))
    n = len(own) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ own[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return np.unique(out)


def multipliers(hashes: int) -> np.ndarray:
    drawn = np.random.default_rng(SEED).integers(0, 1 << 63, hashes, dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def signature(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest 32-bit value of each hash function over the set."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(own), 2048):
        np.minimum(low, (factors[:, None] * own[a:a + 2048]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def signed(docs: DataFrame, width: int, hashes: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = multipliers(hashes)
        for batch in batches:
            sizes, classes, signatures = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                own = shingles(text.as_py(), width)
                sizes.append(len(own))
                classes.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                signatures.append(signature(own, factors).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                 pa.array(classes, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "class", "signature"])
    return keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(work, SIGNED)


def band_rows(percent: int, hashes: int, miss: float) -> int:
    fit = [r for r in range(1, hashes + 1) if (1 - (percent / 100) ** r) ** (hashes // r) <= miss]
    return max(fit, default=1)


def least_matches(percent: int, hashes: int, miss: float) -> list[tuple[int, int]]:
    """(n, m): with fewer than m matches among the first n hashes, the posterior probability
    of a similarity of at least percent is below miss."""
    t, out = percent / 100, []
    for n in range(BATCH, hashes + 1, BATCH):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def alike(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices survive all batches."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in bounds:
        matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
        alive, matches, done = alive[matches >= least], matches[matches >= least], n
    return alive


def matrix(column: pa.Array, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, hashes)


def bands(classes: DataFrame, rows: int, hashes: int) -> DataFrame:
    """bucket, class: one row per band."""
    keys = [F.xxhash64(F.lit(k), F.substring("signature", 4 * k * rows + 1, 4 * rows))
            for k in range(hashes // rows)]
    return classes.select("class", F.explode(F.array(*keys)).alias("bucket"))


def plausible(pairs: DataFrame, classes: DataFrame, percent: int, hashes: int, miss: float) -> DataFrame:
    """The pairs a, b that sequential comparison of their signatures does not give up."""
    bounds = least_matches(percent, hashes, miss)
    side = classes.select("class", "n_shingles", "signature")
    both = pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b") \
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                on = alike(matrix(batch.column("sa"), hashes), matrix(batch.column("sb"), hashes), bounds)
                yield batch.select(["a", "b"]).take(pa.array(on))
    return both.mapInArrow(work, "a binary, b binary")


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """class, own: the sorted shingle hashes of each wanted class, made from its first document."""
    held = classes.join(wanted, "class").select("class", F.col("doc_id").alias("__id"),
                                                F.col("text_hash").alias("__hash"))
    d = keyed(docs)
    texts = d.join(held, d["doc_id"].eqNullSafe(held["__id"]) & (d["text_hash"] == held["__hash"])) \
        .select("class", "text").dropDuplicates(["class"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                own = [shingles(t.as_py(), width).tobytes() for t in part.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("class"), pa.array(own, pa.binary())],
                                                 names=["class", "own"])
    return texts.mapInArrow(work, "class binary, own binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb"), strict=True):
                one, two = (np.frombuffer(x.as_buffer(), np.uint64) for x in (sa, sb))
                common = len(np.intersect1d(one, two, assume_unique=True))
                on.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select(["a", "b"]).filter(pa.array(on, pa.bool_()))
    return both.mapInArrow(work, "a binary, b binary")


def unsettled(members: DataFrame, labels: DataFrame, stage: Stage) -> DataFrame:
    """bucket, class, label, n of the buckets in which members other than the leader are of
    different components."""
    named = stage(members.join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
                  .select("bucket", "class", F.coalesce("label", "class").alias("label")))
    open_ = named.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                        F.count("*").alias("n")).filter("lo != hi")
    return named.join(stage(open_.select("bucket", "n")), "bucket")


def compared(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, hashes: int,
             miss: float) -> DataFrame:
    """Links between different labels of a bucket, compared in blocks inside tasks.

    A task keeps track of what its links have joined and emits only links that join more,
    fewer than it has rows.
    """
    bounds = least_matches(percent, hashes, miss)
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class"), n_blocks).cast("int")
    # a block meets each block: of each pair of blocks (i <= j) both are sent to one place
    dealt = members.withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), n_blocks - 1))).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "class", "label")
    sides = dealt.join(classes.select("class", "signature"), "class").join(sets, "class")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = sides.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "class")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (part for batch in batches for part in (batch.slice(a, 256) for a in range(0, batch.num_rows, 256)))
        for group in groups_of(small, ("bucket", "i", "j")):
            name = group.column("class").to_pylist()
            links = [(name[a], name[b]) for a, b in block_links(group, percent, hashes, bounds)]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)],
                                                 names=["a", "b"])
    return ordered.mapInArrow(work, "a binary, b binary").distinct()


def block_links(group: pa.Table, percent: int, hashes: int,
                bounds: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Verified links of a group of rows that join what is not joined yet."""
    s = matrix(group.column("signature"), hashes)
    label = np.unique(np.array(group.column("label").to_pylist(), object), return_inverse=True)[1]
    block = group.column("block").to_numpy()
    across = group.column("i")[0].as_py() != group.column("j")[0].as_py()
    own = [np.frombuffer(x, np.uint64) for x in group.column("own").to_pylist()]
    size = np.array([len(x) for x in own])
    stop = np.cumsum(size)
    start = stop - size
    number = np.unique(np.concatenate(own), return_inverse=True)[1]
    present = np.zeros(int(number.max()) + 1, bool)
    for k in range(len(s) - 1):
        rest = np.arange(k + 1, len(s))
        rest = rest[(label[rest] != label[k]) & ((block[rest] != block[k]) | (not across))
                    & (100 * np.minimum(size[rest], size[k]) >= percent * np.maximum(size[rest], size[k]))]
        if not len(rest):
            continue
        rest = rest[alike(s[rest], np.broadcast_to(s[k], (len(rest), hashes)), bounds)]
        mine = number[start[k]:stop[k]]
        present[mine] = True
        for b in rest.tolist():
            if label[b] != label[k]:
                common = int(np.count_nonzero(present[number[start[b]:stop[b]]]))
                if 100 * common >= percent * (size[k] + size[b] - common):
                    yield k, b
                    label[label == label[b]] = label[k]
        present[mine] = False


def groups_of(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, also across batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            cut[1:] |= v[1:] != v[:-1]
        if held:
            cut[0] = any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys)
        starts = np.flatnonzero(cut).tolist()
        at = 0
        for s in [*starts, None]:
            if s is not None and s > at:
                held.append(batch.slice(at, s - at))
            if s is None:
                held.append(batch.slice(at))
            elif held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            at = s or at
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def groups(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, hashes: int = HASHES,
           miss: float = MISS) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, first (text hash of the component's first row)."""
    stage = Stage(docs.sparkSession, "minhash")
    sets = stage(signed(docs, width, hashes))
    first: Column = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *ROW))
    classes = stage(sets.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.any_value("n_shingles").alias("n_shingles"), first.alias("first"),
        F.any_value("signature").alias("signature")).select("class", "n_shingles", "first.*", "signature"))
    members = bands(classes, band_rows(percent, hashes, miss), hashes)
    # aggregates are written before they are joined: a join right on top of one cannot be split
    shared = stage(members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("class").alias("leader"))
                   .filter("n > 1"))
    members = stage(members.join(shared, "bucket"))
    led = members.filter("class != leader").select(F.col("leader").alias("a"), F.col("class").alias("b")).distinct()
    survivors = stage(plausible(led, classes, percent, hashes, miss))
    wanted = members.filter("class != leader").select("class").union(members.select("leader")).distinct()
    full = stage(full_sets(docs, classes, wanted, width))
    links = stage(verified(survivors, full, percent))
    labels = components(links, stage)
    rest = stage(unsettled(members.filter("class != leader AND n > 2").select("bucket", "class"), labels, stage))
    more = stage(compared(rest, classes, full, percent, hashes, miss))
    if not more.isEmpty():
        labels = components(links.union(more), stage)
    named = classes.join(labels.toDF("class", "label"), "class", "left") \
        .select("class", F.coalesce("label", "class").alias("label"), F.struct("no_id", *ROW).alias("first"))
    firsts = stage(named.groupBy("label").agg(F.min("first").alias("head")))
    heads = named.join(firsts, "label").select("class", "head")
    out = sets.join(heads, "class", "left")
    return out.select(
        *ROW, "n_shingles",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.when(F.col("class").isNull(), F.col("text_hash")).otherwise(F.col("head.text_hash")).alias("first"))


def keep_one(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, **more) -> DataFrame:
    """docs without the rows of each group but its first one, with all their columns."""
    found = groups(docs, width, percent, **more)
    empty = F.col("n_shingles") == 0
    stays = found.filter(~empty & F.col("doc_id").eqNullSafe(F.col("component_id"))
                         & (F.col("text_hash") == F.col("first"))).select(
        F.col("doc_id").alias("__keep_id"), F.col("text_hash").alias("__keep_hash")).distinct()
    own = docs.withColumn("__text_hash", F.xxhash64("text"))
    blank = F.length(F.btrim(F.coalesce(F.col("text"), F.lit("")), F.lit(WHITE))) == 0
    full = own.filter(~blank)
    held = full.join(stays, full["doc_id"].eqNullSafe(stays["__keep_id"])
                     & (full["__text_hash"] == stays["__keep_hash"])).drop("__keep_id", "__keep_hash")
    # fully repeated rows of the one that stays: one of them
    held = held.dropDuplicates(["doc_id", "__text_hash"])
    return held.drop("__text_hash").unionByName(docs.filter(blank))

"""Removal of repeated byte strings with column-wise Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts earlier (in a smaller
(doc_id, text hash), or before in the same text). All strings are judged on the input.

1. Texts become segments: the smallest hash among the k-byte words of a string is its anchor,
   and a maximal run of strings with one anchor is a segment. Equal strings have equal anchors,
   so only segments whose anchor occurs twice can repeat anything.
2. Equal segments are aggregated (with map-side combine); all but the first go as a whole.
3. The different segments of an anchor that agree on half of what a shared string needs
   (pigeonhole: one side of the anchor) form collections of bounded size. Each collection's
   transform is built column by column: a round inserts one symbol of every segment, where
   the last round's transform says (one sequential pass over it). Walking the finished
   transform back ranks all suffixes; neighbours are compared over ``length`` bytes.
4. Anchors with more than HOT different segments do not go to one task: their strings are
   hashed (128 bits) and aggregated one by one, which is exact as well.

Tables between the steps are written to the shared folder. Text crosses the network twice,
compressed: once for the segments, once to apply the removals.

Defined cases: null text is empty; texts shorter than ``length`` lose nothing. Null ids sort
first. Rows of equal id and text are one document with one result; rows that share only the
id are ordered by text hash. Extra columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence.llm.base import ROW, keyed
from evidence.llm.graph import Stage
from evidence.llm.minhash import groups_of

LENGTH = 100
WORD = 16
HOT = 4096
COLLECTION_BYTES = 1 << 20
CHUNK = 8 << 20
PLACE_BITS = 24
SLICE_ROWS, SLICE_BYTES = 256, 2 << 20
_TABLE = np.random.default_rng(10).integers(1, 1 << 63, 256, dtype=np.uint64)
PLACED = "doc_id long, text_hash long, start int, size int, at int"
INTERVAL = "doc_id long, text_hash long, start int, stop int"
SEGMENT_KEYS = ("anchor", "content", "size", "at")


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about SLICE_BYTES, so that what is made of them stays small."""
    for batch in batches:
        rows = max(1, min(SLICE_ROWS, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes)))
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def word_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes (a power of two) from each place on."""
    h, factor, n = _TABLE[data], 0x9E3779B97F4A7C15, 1
    while n < width:
        h = h[:-n] * np.uint64(factor) + h[n:]
        factor, n = factor * factor % (1 << 64), 2 * n
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def segments(text: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """anchor, start, size, place of the anchor in the segment, of the segments of a text."""
    low = np.uint64((1 << PLACE_BITS) - 1)
    width = length - WORD + 1
    for base in range(0, len(text) - length + 1, CHUNK):
        data = np.frombuffer(text, np.uint8, min(CHUNK + length - 1, len(text) - base), base)
        h = word_hashes(data, WORD)
        best, n = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
        while 2 * n <= width:
            best, n = np.minimum(best[:-n], best[n:]), 2 * n
        if width > n:
            best = np.minimum(best[:n - width], best[width - n:])
        place = (best & low).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        stop = np.concatenate([start[1:], [len(place)]])
        yield h[place[start]].view(np.int64), base + start, stop - start + length - 1, place[start] - start


def numbered(docs: DataFrame, stage: Stage) -> DataFrame:
    """doc_id, text_hash, text; the hash is 0 but for ids that several texts share.

    A constant takes no room in the many rows that name their document.
    """
    d = keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    shared = stage(d.groupBy("doc_id").agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi"))
                   .filter("lo <> hi").select(F.col("doc_id").alias("__id"), F.lit(True).alias("__shared")))
    return d.join(shared, d["doc_id"].eqNullSafe(shared["__id"]), "left").select(
        "doc_id", F.when(F.col("__shared"), F.col("text_hash")).otherwise(F.lit(0)).alias("text_hash"), "text")


def placed(docs: DataFrame, length: int) -> DataFrame:
    """One row per segment: document, start, size, at, anchor, content (hash of its bytes)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = [[], [], [], [], [], []]
            for k, text in enumerate(batch.column("text").cast(pa.binary())):
                data = text.as_py() or b""
                if len(data) < length:
                    continue
                for anchor, start, size, at in segments(data, length):
                    content = np.fromiter((xxhash.xxh3_64_intdigest(data[s:s + n]) for s, n in zip(
                        start.tolist(), size.tolist(), strict=True)), np.uint64, len(start)).view(np.int64)
                    for to, x in zip(rows, (np.full(len(start), k), start, size, at, anchor, content), strict=True):
                        to.append(x)
            if rows[0]:
                of, start, size, at, anchor, content = map(np.concatenate, rows)
                take = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("text_hash").take(take),
                     pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)),
                     pa.array(at.astype(np.int32)), pa.array(anchor), pa.array(content)],
                    names=["doc_id", "text_hash", "start", "size", "at", "anchor", "content"])
    return docs.mapInArrow(work, f"{PLACED}, anchor long, content long")


def with_texts(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """doc_id, text_hash, packed text and the lists of a document; texts travel compressed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in small(batches):
            texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([codec.compress(t, asbytes=True) if t else b"" for t in texts], pa.binary())],
                names=["doc_id", "text_hash", "n_bytes", "packed"])
    d = docs.mapInArrow(pack, "doc_id long, text_hash long, n_bytes long, packed binary")
    own = lists.withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    return d.join(own, d["doc_id"].eqNullSafe(own["__id"]) & (d["text_hash"] == own["__hash"]), how) \
        .drop("__id", "__hash")


def unpacked(batch: pa.RecordBatch) -> Iterator[bytes]:
    codec = pa.Codec("zstd")
    for n, packed in zip(batch.column("n_bytes").to_pylist(), batch.column("packed"), strict=True):
        yield codec.decompress(packed.as_py(), n, asbytes=True) if n else b""


def cut_out(docs: DataFrame, live: DataFrame) -> DataFrame:
    """The segments in live with their bytes."""
    lists = live.groupBy(*ROW).agg(F.collect_list(F.struct("anchor", "start", "size", "at")).alias("s"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found, take = batch.column("s").flatten(), batch.column("s").value_parent_indices()
            own = {c: found.field(i) for i, c in enumerate(("anchor", "start", "size", "at"))}
            of, start, size = take.to_numpy(), own["start"].to_numpy(), own["size"].to_numpy()
            bounds = np.searchsorted(of, np.arange(batch.num_rows + 1))
            cut: list[bytes] = []
            for k, text in enumerate(unpacked(batch)):
                a, b = bounds[k], bounds[k + 1]
                cut += [text[x:y] for x, y in zip(start[a:b].tolist(), (start[a:b] + size[a:b]).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("text_hash").take(take),
                 own["start"], own["size"], own["at"], own["anchor"], pa.array(cut, pa.binary())],
                names=["doc_id", "text_hash", "start", "size", "at", "anchor", "bytes"])
    return with_texts(docs, lists, "inner").mapInArrow(work, f"{PLACED}, anchor long, bytes binary")


def transform(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The collection's transform (0: begin of a text) and the place of each text's end in it.

    Round r inserts the r-th symbol from the right of every text that has one.
    """
    m = len(texts)
    size = np.array([len(t) for t in texts])
    codes = np.frombuffer(b"".join(texts), np.uint8)
    alphabet, codes = np.unique(codes, return_inverse=True)
    kind = np.uint8 if len(alphabet) < 255 else np.uint16
    codes = codes.astype(kind) + kind(1)
    last = np.cumsum(size) - 1
    # round 0: the empty suffixes, in order of their texts, each before its last symbol
    bwt = codes[last]
    new, owner = np.ones(m, bool), np.arange(m)
    for r in range(1, int(size.max()) + 1):
        order = np.argsort(bwt, kind="stable")
        ended = int(np.searchsorted(bwt, 0, "right", sorter=order))
        order = order[ended:]
        moved = np.flatnonzero(new[order])
        # texts in the order of their new suffix; owner is in the order of the old ones
        owner = owner[np.searchsorted(np.flatnonzero(new), order[moved])]
        more = size[owner] > r
        symbol = np.where(more, codes[np.maximum(last[owner] - r, 0)], kind(0))
        grown = np.empty(len(bwt) + len(moved), kind)
        new = np.zeros(len(grown), bool)
        new[m + moved] = True
        grown[new], grown[~new] = symbol, bwt
        bwt = grown
        if not more.all():
            new[np.flatnonzero(new)[~more]] = False
            owner = owner[more]
            if not len(owner):
                break
    return bwt, np.arange(m)


def ranks(bwt: np.ndarray, ends: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rank of every suffix, per text from its first byte on, texts one after the other."""
    order = np.argsort(bwt, kind="stable")
    follow = np.empty(len(bwt), np.int64)
    follow[order] = np.arange(len(bwt)) - int((bwt == 0).sum()) + len(ends)
    stop = np.cumsum(size)
    out = np.empty(int(stop[-1]), np.int64)
    at, active = ends.copy(), np.arange(len(size))
    for r in range(1, int(size.max()) + 1):
        active = active[size[active] >= r]
        at[active] = follow[at[active]]
        out[stop[active] - r] = at[active]
    return out


def repeated_in(texts: list[bytes], place: np.ndarray, length: int) -> np.ndarray:
    """Flags, per byte of the joined texts, of strings that start there and earlier elsewhere.

    place: the order of each text's first byte among all (document, start), as comparable rows.
    """
    size = np.array([len(t) for t in texts])
    rank = ranks(*transform(texts), size)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    inner = np.arange(len(joined)) - np.repeat(np.cumsum(size) - size, size)
    whole = np.flatnonzero(np.repeat(size, size) - inner >= length)
    whole = whole[np.argsort(rank[whole])]
    same = np.zeros(len(whole), bool)
    span = np.arange(length)
    for a in range(1, len(whole), 8192):
        b = min(a + 8192, len(whole))
        same[a:b] = (joined[whole[a:b, None] + span] == joined[whole[a - 1:b - 1, None] + span]).all(axis=1)
    owner = np.repeat(np.arange(len(size)), size)[whole]
    order = np.lexsort((place[owner, 1] + inner[whole], place[owner, 0], np.cumsum(~same)))
    out = np.zeros(len(joined), bool)
    if len(order):
        kind = np.cumsum(~same)[order]
        heads = np.concatenate([[True], np.diff(kind) != 0])
        head = order[np.flatnonzero(heads)[np.cumsum(heads) - 1]]
        # a row that is there again has its strings at the same place, which is no earlier one
        later = (place[owner[order], 0] != place[owner[head], 0]) \
            | (place[owner[order], 1] + inner[whole[order]] != place[owner[head], 1] + inner[whole[head]])
        out[whole[order[later]]] = True
    return out


def plausible(group: dict, length: int) -> np.ndarray:
    """Segments that agree with another one of their anchor on one side of it, far enough that
    a common string is possible."""
    side = -(-(length - WORD) // 2)
    keys = []
    for anchor, data, at in zip(group["anchor"], group["bytes"], group["at"], strict=True):
        keys.append(((anchor, 0, data[at - side:at + WORD]) if at >= side else None,
                     (anchor, 1, data[at:at + WORD + side]) if at + WORD + side <= len(data) else None))
    seen = Counter(k for pair in keys for k in pair if k)
    return np.array([any(k and seen[k] > 1 for k in pair) for pair in keys], bool)


def judged(cut: DataFrame, length: int) -> DataFrame:
    """Intervals to remove among the segments of anchors that fit a task."""
    parts = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut.repartition(parts, "anchor").sortWithinPartitions("anchor")

    def settle(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        group = pa.concat_tables(tables).to_pydict()
        stay = np.flatnonzero(plausible(group, length))
        if not len(stay):
            return
        ids = [group["doc_id"][k] for k in stay]
        hashes, start = (np.array([group[c][k] for k in stay], np.int64) for c in ("text_hash", "start"))
        texts = [group["bytes"][k] for k in stay]
        named = np.array([np.iinfo(np.int64).min if x is None else x for x in ids], np.int64)
        null = np.array([x is not None for x in ids], np.int64)
        order = np.lexsort((hashes, named, null))
        step = np.ones(len(order), np.int64)
        step[1:] = (np.diff(named[order]) != 0) | (np.diff(hashes[order]) != 0) | (np.diff(null[order]) != 0)
        document = np.empty(len(order), np.int64)
        document[order] = np.cumsum(step)
        gone = repeated_in(texts, np.stack([document, start], axis=1), length)
        size = np.array([len(t) for t in texts])
        base = np.cumsum(size) - size
        # no string starts in the last bytes of a segment, so runs never join two of them
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        first, behind = edges[::2], edges[1::2]
        of = np.searchsorted(base, first, "right") - 1
        if len(of):
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[k] for k in of], pa.int64()), pa.array(hashes[of]),
                 pa.array((start[of] + first - base[of]).astype(np.int32)),
                 pa.array((start[of] + behind - 1 + length - base[of]).astype(np.int32))],
                names=["doc_id", "text_hash", "start", "stop"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, most = [], 0
        for group in groups_of(small(batches), ("anchor",)):
            held.append(group)
            most += group.column("bytes").nbytes
            if most >= COLLECTION_BYTES:
                yield from settle(held)
                held, most = [], 0
        if held:
            yield from settle(held)
    return ordered.mapInArrow(work, INTERVAL)


def hot_strings(cut: DataFrame, length: int, stage: Stage) -> DataFrame:
    """Intervals to remove among the segments of very frequent anchors, string by string."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            of, start, names = [], [], []
            for k, (at, data) in enumerate(zip(batch.column("start").to_pylist(),
                                               batch.column("bytes").to_pylist(), strict=True)):
                n = len(data) - length + 1
                of += [k] * n
                start += range(at, at + n)
                names += [xxhash.xxh3_128_digest(data[i:i + length]) for i in range(n)]
            take = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("text_hash").take(take),
                 pa.array(start, pa.int32()), pa.array(names, pa.binary())],
                names=["doc_id", "text_hash", "start", "name"])
    every = stage(cut.mapInArrow(work, "doc_id long, text_hash long, start int, name binary"))
    place = F.struct(*ROW, "start")
    firsts = stage(every.groupBy("name").agg(F.min(place).alias("first"), F.count("*").alias("n"))
                   .filter("n > 1").drop("n"))
    return every.join(firsts, "name").filter(~place.eqNullSafe(F.col("first"))) \
        .select(*ROW, "start", (F.col("start") + length).alias("stop"))


def repeated_intervals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text_hash, start, stop of removals, in bytes; they may overlap.

    docs: as ``numbered`` gives them.
    """
    stage = Stage(docs.sparkSession, "suffix")
    place = F.struct(*ROW, "start")
    all_ = stage(placed(docs, length))
    shared = stage(all_.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
    every = stage(all_.join(shared, "anchor"))
    stage.free(all_, shared)
    kinds = stage(every.groupBy(*SEGMENT_KEYS).agg(F.min(place).alias("first"), F.count("*").alias("n")))
    again = kinds.filter("n > 1").drop("n")
    copies = stage(every.join(again, list(SEGMENT_KEYS)).filter(~place.eqNullSafe(F.col("first")))
                   .select(*ROW, "start", (F.col("start") + F.col("size")).alias("stop")))
    stage.free(every)
    mixed = stage(kinds.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"))
    live = stage(kinds.drop("n").join(mixed, "anchor").select("anchor", "size", "at", "first.*", "n"))
    stage.free(kinds, mixed)
    hot = live.filter(F.col("n") > HOT)
    found = stage(judged(cut_out(docs, live.filter(F.col("n") <= HOT)), length)).unionByName(copies)
    if not hot.isEmpty():
        found = found.unionByName(hot_strings(cut_out(docs, hot), length, stage))
    return found


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) of every row."""
    stage = Stage(docs.sparkSession, "suffix")
    docs = numbered(docs, stage)
    # a list is as long as its text at most; it is written so that it is joined by itself
    lists = stage(repeated_intervals(docs, length).groupBy(*ROW).agg(
        F.collect_set(F.struct("start", "stop")).alias("gone")))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            removed, n_spans, kept = [], [], []
            for text, gone in zip(unpacked(batch), batch.column("gone"), strict=True):
                spans = merged(gone.values) if gone.is_valid else []
                at, left = 0, []
                for a, b in spans:
                    left.append(text[at:a])
                    at = b
                kept.append(b"".join([*left, text[at:]]))
                removed.append(len(text) - len(kept[-1]))
                n_spans.append(len(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return with_texts(docs, lists, "left").select("doc_id", "n_bytes", "packed", "gone").mapInArrow(work, schema)


def merged(spans: pa.StructArray) -> list[tuple[int, int]]:
    """Maximal runs of bytes in a list of intervals."""
    start, stop = (spans.field(k).to_numpy() for k in (0, 1))
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    cut = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return list(zip(start[cut].tolist(), reach[np.concatenate([cut[1:] - 1, [len(reach) - 1]])].tolist(), strict=True))

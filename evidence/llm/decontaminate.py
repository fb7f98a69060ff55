"""Benchmark decontamination with suffix arrays of training shards.

A shard is a batch of documents inside a task. Its words become numbers of the benchmark's
vocabulary (0 for any other word), stretches in which some pair of neighbours is no pair of
the benchmark are cut out (no window can lie across such a pair), and the suffix array of
what is left is sorted. Every benchmark suffix is then searched in it: an interval of
suffixes is narrowed word by word with binary searches until it is empty, which gives the
longest verbatim match and all its places. Intervals at the depth of a window are hits.

Documents stay where they are: no shuffle, one pass. The benchmark goes to the tasks in
blocks of at most ``block_bytes`` of text; one pass over the documents for each block, so a
benchmark of any size has bounded broadcasts.

Defined cases: null or wordless texts have no words and no hits; null or wordless items have
no window; an item without id counts as the item ''. Repeated documents are judged alike, repeated item ids count once per document.
Extra columns pass through ``remove_contaminated`` unchanged and are left out of ``scan``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 16 << 20
PAIR_BITS = 22
#: A-Z to lower case; bytes that are no part of a word to a blank
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))
SCAN = "doc_id long, n_words long, n_hit long, items array<string>, longest long, longest_at long, spans array<bigint>"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Benchmark:
    """The suffixes of a block of items, as arrays."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        lists = [(i, w) for i, t in items if (w := words(t))]
        number = self.vocabulary
        coded = [[number.setdefault(x, len(number) + 1) for x in w] for _, w in lists]
        self.ids = [i for i, _ in lists]
        lengths = np.array([len(c) for c in coded], np.int64)
        self.text = np.array([x for c in coded for x in [*c, 0]], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1].astype(np.int64)
        #: of each suffix: where it begins, how many words it has, its item, its window (0: none)
        self.at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths, strict=True)]) \
            if len(lists) else np.zeros(0, np.int64)
        self.item = np.repeat(np.arange(len(lists)), lengths)
        self.left = np.repeat(starts + lengths, lengths) - self.at
        whole = np.repeat(lengths, lengths)
        offset = whole - self.left
        self.window = np.where(self.left >= window, window, np.where(
            (whole < window) & (offset == 0), whole, 0))
        self.least = int(self.window[self.window > 0].min()) if len(lists) else 0
        self.pairs = np.zeros(1 << PAIR_BITS, bool)
        inside = (self.text[:-1] > 0) & (self.text[1:] > 0)
        self.pairs[self.pair(self.text[:-1][inside], self.text[1:][inside])] = True

    @staticmethod
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = (a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return mixed >> np.uint64(64 - PAIR_BITS)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of non-zero text in the order of their first depth numbers."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth:
        second = np.zeros(n, np.int64)
        second[:n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(np.diff(key[order]) != 0)
        if new[order[-1]] == n - 1:
            break
        rank, k = new, 2 * k
    return order


def bound(text, order, low, high, depth, word, right: bool) -> np.ndarray:
    """Of each interval, where the suffixes' number at depth is >= word (> word if right)."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        seen = text[order[np.minimum(middle, len(order) - 1)] + depth]
        below = open_ & ((seen <= word) if right else (seen < word))
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def match(text: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the benchmark in text: (place, window length, item), and the longest match per place."""
    deepest = int(bench.left.max())
    order = suffix_array(text, deepest)
    order = order[text[order] > 0]
    padded = np.concatenate([text, np.zeros(deepest + 1, np.int64)])
    active = np.arange(len(bench.at))
    low, high = np.zeros(len(active), np.int64), np.full(len(active), len(order))
    longest = np.zeros(len(text), np.int64)
    found = []
    for depth in range(deepest):
        on = bench.left[active] > depth
        active, low, high = active[on], low[on], high[on]
        word = bench.text[bench.at[active] + depth]
        start = bound(padded, order, low, high, depth, word, False)
        high = bound(padded, order, start, high, depth, word, True)
        on = start < high
        active, low, high = active[on], start[on], high[on]
        if not len(active):
            break
        if depth + 1 >= bench.least:
            # equal intervals of several suffixes are marked once
            edges = np.zeros(len(order) + 1, np.int64)
            np.add.at(edges, low, 1)
            np.add.at(edges, high, -1)
            longest[order[np.cumsum(edges[:-1]) > 0]] = depth + 1
        for k in np.flatnonzero(bench.window[active] == depth + 1):
            found.append((low[k], high[k], depth + 1, bench.item[active[k]]))
    return order, np.array(found, np.int64).reshape(-1, 4), longest, padded


def scan_shard(texts: list[bytes | None], bench: Benchmark) -> list[tuple[int, list, set, int, int]]:
    """Per text: words, hit spans [(start, end)], items, longest match, its place."""
    number = bench.vocabulary
    coded = []
    for t in texts:
        w = words(t)
        coded.append(np.fromiter((number.get(x, 0) for x in w), np.int64, len(w)))
    sizes = [len(c) for c in coded]
    out = [[n, [], set(), 0, -1] for n in sizes]
    if not sum(sizes) or not len(bench.at):
        return out
    text = np.concatenate([x for c in coded for x in (c, [0])]).astype(np.int64)
    doc = np.repeat(np.arange(len(coded)), np.array(sizes) + 1)
    first = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)])[:-1]
    # keep runs of words whose neighbours all are pairs of the benchmark
    near = np.zeros(len(text), bool)
    near[:-1] = (text[:-1] > 0) & (text[1:] > 0) & bench.pairs[Benchmark.pair(text[:-1], text[1:])]
    run = np.concatenate([[0], np.cumsum(~np.concatenate([[False], near[:-1]]))])[1:]
    lengths = np.bincount(run)
    stay = (lengths[run] >= bench.least) & (text > 0)
    if not stay.any():
        return out
    places = np.flatnonzero(stay)
    gap = np.concatenate([[False], run[places[1:]] != run[places[:-1]]])
    target = np.arange(len(places)) + np.cumsum(gap)
    small = np.zeros(target[-1] + 2, np.int64)
    small[target] = text[places]
    back = np.zeros(len(small), np.int64)
    back[target] = places
    order, found, longest, _ = match(small, bench)
    mark = np.zeros(len(text) + 1, np.int64)
    intervals: dict[tuple[int, int, int], list[int]] = {}
    for lo, hi, n, item in found.tolist():
        intervals.setdefault((lo, hi, n), []).append(item)
    for (lo, hi, n), items in intervals.items():
        at = back[order[lo:hi]]
        np.add.at(mark, at, 1)
        np.add.at(mark, at + n, -1)
        for d in np.unique(doc[at]).tolist():
            out[d][2].update(items)
    hit = np.cumsum(mark[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        d = doc[a]
        out[d][1].append((a - int(first[d]), b - int(first[d])))
    matched = np.flatnonzero(longest)
    owner = doc[back[matched]]
    ranked = np.lexsort((matched, -longest[matched], owner))
    for k in ranked[np.unique(owner[ranked], return_index=True)[1]].tolist():
        p, d = matched[k], owner[k]
        out[d][3], out[d][4] = int(longest[p]), int(back[p] - first[d])
    for d in out:
        d[2] = {bench.ids[k] for k in d[2]}
    return out


def shards(texts: list[bytes | None], most: int = SHARD_BYTES) -> Iterator[slice]:
    start = held = 0
    for k, t in enumerate(texts):
        held += len(t or b"")
        if held >= most:
            yield slice(start, k + 1)
            start, held = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def blocks(benchmark: DataFrame, window: int = WINDOW,
           block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[Benchmark, bool]]:
    """The benchmark in parts of about block_bytes of text each, and whether it is the last one."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.encode(F.col("text"), "UTF-8").alias("text")).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield Benchmark([(r["item_id"], bytes(r["text"])) for r in part], window), k == n - 1


def _merged(a: list[int], b: list[tuple[int, int]]) -> list[int]:
    flat: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2], strict=True), *b]):
        if flat and s <= flat[-1]:
            flat[-1] = max(flat[-1], e)
        else:
            flat += [s, e]
    return flat


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, items, longest match in words and its place, hit spans
    (starts and ends in words, one after the other)."""
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").selectExpr(
        "doc_id", "text", "0L AS n_words", "0L AS n_hit", "array() AS items", "0L AS longest",
        "-1L AS longest_at", "CAST(array() AS array<bigint>) AS spans") \
        .withColumn("items", F.col("items").cast("array<string>"))
    for bench, last in blocks(benchmark, window, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(bench)

        def look(batches, sent=sent, last=last):
            for batch in batches:
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                old, new = batch.drop_columns(["text"]).to_pylist(), []
                for s in shards(texts):
                    for o, (n, spans, items, longest, at) in zip(old[s], scan_shard(texts[s], sent.value), strict=True):
                        flat = _merged(o["spans"], spans)
                        o |= {"n_words": n, "spans": flat, "n_hit": sum(flat[1::2]) - sum(flat[::2]),
                              "items": sorted({*o["items"], *items})}
                        if longest > o["longest"]:
                            o |= {"longest": longest, "longest_at": at}
                        new.append(o)
                out = pa.RecordBatch.from_pylist(new, schema=batch.drop_columns(["text"]).schema)
                # the text goes on to the next block only
                text = pa.nulls(batch.num_rows, pa.string()) if last else batch.column("text")
                yield out.add_column(1, "text", text)
        held = held.mapInArrow(look, held.schema)
    return held.drop("text")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs in which no window of the benchmark occurs, with all their columns."""
    for bench, _ in blocks(benchmark, window, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(bench)
        at = docs.columns.index("text")

        def clean(batches, sent=sent, at=at):
            for batch in batches:
                texts = batch.column(at).cast(pa.binary()).to_pylist()
                stay = [not d[1] for s in shards(texts) for d in scan_shard(texts[s], sent.value)]
                yield batch.filter(pa.array(stay, pa.bool_()))
        docs = docs.mapInArrow(clean, docs.schema)
    return docs

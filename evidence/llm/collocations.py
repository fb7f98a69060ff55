"""Phrase collocation mining over Rabin-Karp fingerprints.

Texts are lower-cased (A-Z) and cut into pieces at ``[.,;:!?\\x0A-\\x0D]``, pieces into words at
spaces and tabs. A phrase is a run of words inside a piece, written with one space between
them; everything is counted per language.

1. Numpy prefix polynomials over the bytes of many texts give the fingerprint of every run of
   words as a difference of two prefixes; no phrase is made as a text for that.
2. Runs grow by one word per pass over the texts: a run is counted only if both runs of one
   word less were frequent. That is asked of a bitmap of 2**FILTER_BITS bits (16 MB, whatever
   the corpus), in which every frequent fingerprint is set; what it lets through by chance costs
   a row, and nothing frequent is ever kept out. These passes shuffle the first 40 bits of a
   fingerprint and a count: equal ones only make a run look more frequent than it is.
3. The last pass takes the runs that the bitmap of their own length lets through. A shuffle sums
   up their whole fingerprints, with a pointer to one occurrence (row, place, length) and the least
   and greatest value of a second, independent polynomial.
4. Frequent fingerprints are read from the text at their pointers, and both polynomials are made
   again from what is read there. Fingerprints whose second values differ belong to more than
   one phrase: these are counted once more by their texts. So only frequent phrases become text.
5. Phrases, parts and longer phrases then meet by equi-joins on their texts.

A candidate is a phrase of ``2..longest`` words that occurs ``least`` times or more. Cutting it
after k words gives floor(1000000 * a * a / (l * r)) from the counts of phrase, first and
second part; its lowest cut counts. Candidates inside a longer candidate that occurs in at
least ``within_percent`` of their own occurrences are dropped.

Defined cases: null and empty texts have no words. A null language is ``und``. Repeated rows
count as often as they occur. Ties end at the phrase, in byte order. Texts longer than ``PART``
bytes are worked on piece by piece. An empty table gives an empty result; extra columns are
left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidence.llm.base import keyed
from evidence.llm.graph import Stage

LEAST = 10
LONGEST = 3
WITHIN_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
FILTER_BITS, KEY_BITS = 27, 40
SLICE = 1 << 18
PART = 4 << 20  # a part fills a slice
#: what a task holds before it combines it, and of combined rows before it sends them
PENDING_BYTES, HELD_BYTES = 12 << 20, 40 << 20
SENT_ROWS = 1 << 15
SEED = 12
MIX = np.uint64(0xD6E8FEB86659FD93)
DELIMITER = re.compile(rb"[.,;:!?\x0A-\x0D]")

_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[_KIND > 0] = 32


class Polynomial:
    """Prefix sums of byte values times powers, modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 40, 1 << 61)) * 2 + 1
        self.powers = self.inverses = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            self.powers, self.inverses = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (np.uint64(self.base), np.uint64(pow(self.base, -1, 1 << 64))))

    def at(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Prefixes at starts and stops, and the factor that moves a start to the origin."""
        self.reach(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:len(data)], out=sums[1:])
        return sums[start], sums[stop], self.inverses[start]


class Slice:
    """Words of several texts in one buffer: each followed by one space, pieces marked."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        kind = _KIND[raw]
        word = kind == 0
        before = np.concatenate([[False], word[:-1]])
        behind = before & ~word
        kept = word | behind
        first, last = np.flatnonzero(word & ~before), np.flatnonzero(behind)
        self.data = _FOLD[raw[kept]]
        self.stop = np.flatnonzero(behind[kept])
        self.start = np.concatenate([np.zeros(min(1, len(self.stop)), np.int64), self.stop[:-1] + 1])
        cuts = np.cumsum(kind == 2)
        #: whether the next word is in the same piece
        self.joined = np.zeros(len(first), bool)
        if len(first):
            self.joined[:-1] = cuts[first[1:]] == cuts[last[:-1] - 1]
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        self.text = np.searchsorted(begins, first, "right") - 1
        #: bytes of the buffer before each text
        self.base = np.concatenate([[0], np.cumsum(kept)])[begins]

    def runs(self, words: int) -> np.ndarray:
        """First words of the runs of so many words."""
        if len(self.stop) < words:
            return np.zeros(0, np.int64)
        whole = np.ones(len(self.stop) - words + 1, bool)
        for k in range(words - 1):
            whole &= self.joined[k:k + len(whole)]
        return np.flatnonzero(whole)


class Prints:
    """Fingerprints and second values of the runs of a slice."""

    def __init__(self, bits: int = 64):
        self.first, self.second = Polynomial(SEED), Polynomial(SEED + 1)
        self.mask = np.uint64(((1 << bits) - 1) << (64 - bits))

    def over(self, part: Slice, salts: np.ndarray) -> None:
        """Take up a slice; salts name the language of each word."""
        self.part, self.salts = part, salts
        self.one, self.two = (p.at(part.data, part.start, part.stop) for p in (self.first, self.second))

    def of(self, prefixes: tuple, run: np.ndarray, words: int) -> np.ndarray:
        begin, end, back = prefixes
        h = (end[run + words - 1] - begin[run]) * back[run] ^ self.salts[run]
        h ^= h >> np.uint64(32)
        h *= MIX
        h ^= h >> np.uint64(32)
        return h * MIX

    def prints(self, run: np.ndarray, words: int) -> np.ndarray:
        return self.of(self.one, run, words) & self.mask

    def checks(self, run: np.ndarray, words: int) -> np.ndarray:
        return (self.of(self.two, run, words) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def likely(self, words: int, filters: list) -> tuple[np.ndarray, np.ndarray]:
        """Runs, with their fingerprints, that the filters of shorter runs and of this length let
        through."""
        run = self.part.runs(words)
        if words > 1:
            shorter = filters[words - 2]
            run = run[passes(self.prints(run, words - 1), shorter)]
            run = run[passes(self.prints(run + 1, words - 1), shorter)]
        own = self.prints(run, words)
        if len(filters) >= words:
            on = passes(own, filters[words - 1])
            run, own = run[on], own[on]
        return run, own


def passes(prints: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    at = prints >> np.uint64(64 - FILTER_BITS)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def salt(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), SEED)


def parts(text: bytes) -> Iterator[bytes]:
    """The text, or pieces of about PART bytes, each but the last ending in a delimiter."""
    at = 0
    while len(text) - at > PART:
        found = DELIMITER.search(text, at + PART)
        if found is None:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Slice, list[tuple[pa.RecordBatch, int, int]]]]:
    """Slices with the rows of their texts: (batch, row, place of the part in the row's words)."""
    texts: list[bytes] = []
    rows: list[tuple[pa.RecordBatch, int, int]] = []
    size = 0
    for batch in batches:
        for k, text in enumerate(batch.column("text").cast(pa.binary())):
            base = 0
            for part in parts(text.as_py() or b""):
                texts.append(part)
                rows.append((batch, k, base))
                size += len(part)
                if size >= SLICE:
                    done = Slice(texts)
                    yield done, rows
                    base += len(done.data) - int(done.base[-1])
                    texts, rows, size = [], [], 0
    if texts:
        yield Slice(texts), rows


def combined(columns: list[np.ndarray], keys: int) -> list[np.ndarray]:
    """One row per key: the sum of the column behind the keys, any one value of the others."""
    if not len(columns[0]):
        return columns
    order = np.argsort(columns[0], kind="stable")
    new = np.diff(columns[0][order], prepend=~columns[0][order[:1]]) != 0
    if keys > 1 and any((np.diff(c[order]) != 0)[~new[1:]].any() for c in columns[1:keys]):
        order = np.lexsort(columns[:keys][::-1])
        new = np.ones(len(order), bool)
        new[1:] = np.any([np.diff(c[order]) != 0 for c in columns[:keys]], axis=0)
    at = np.flatnonzero(new)
    out = [c[order[at]] for c in columns]
    out[keys] = np.add.reduceat(columns[keys][order], at)
    return out


class Combined:
    """Counts by key columns, combined before they are sent and bounded in bytes."""

    def __init__(self, keys: int):
        self.keys, self.size = keys, 0
        self.pending: list[list[np.ndarray]] = []
        self.held: list[np.ndarray] | None = None

    def add(self, *columns: np.ndarray) -> Iterator[list[np.ndarray]]:
        """Keys, count, further columns; gives rows when too many are held."""
        self.pending.append(combined(list(columns), self.keys))
        self.size += sum(c.nbytes for c in self.pending[-1])
        if self.size >= PENDING_BYTES:
            self.combine()
            if sum(c.nbytes for c in self.held) >= HELD_BYTES:
                yield from self.rest()

    def combine(self) -> None:
        sets = [*self.pending, self.held] if self.held else self.pending
        self.pending, self.size, self.held = [], 0, None
        columns = [np.concatenate(c) for c in zip(*sets, strict=True)]
        del sets
        self.held = combined(columns, self.keys)

    def rest(self) -> Iterator[list[np.ndarray]]:
        if self.pending:
            self.combine()
        held, self.held = self.held, None
        for a in range(0, len(held[0]) if held else 0, SENT_ROWS):
            yield [c[a:a + SENT_ROWS] for c in held]


def texts_of(docs: DataFrame) -> DataFrame:
    """row, text, lang; what shares a row key is told apart by its text."""
    return keyed(docs, F.coalesce("lang", F.lit("und")).alias("lang")).select(
        F.coalesce(F.col("doc_id").cast("long"), "text_hash").alias("row"), "text", "lang")


def salted(part: Slice, rows: list) -> tuple[np.ndarray, list[str]]:
    """The salt of each word, and the language of each text."""
    langs = [batch.column("lang")[k].as_py() for batch, k, _ in rows]
    return np.array([salt(x) for x in langs], np.uint64)[part.text], langs


def counted(docs: DataFrame, words: int, filters: list, bits: int) -> DataFrame:
    """lang, key, c: occurrences by the first KEY_BITS of the fingerprints of runs of so many words;
    with one word also the words of each language (key is null there, lang elsewhere)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, own, totals = Prints(bits), Combined(1), Counter()
        seen = [f.value for f in filters]

        def sent(found: Iterator[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for key, c in found:
                yield pa.RecordBatch.from_arrays([pa.nulls(len(key), pa.string()), pa.array(key), pa.array(c)],
                                                 names=["lang", "key", "c"])
        for part, rows in slices(batches):
            salts, langs = salted(part, rows)
            prints.over(part, salts)
            _, fp = prints.likely(words, seen)
            yield from sent(own.add((fp >> np.uint64(64 - KEY_BITS)).view(np.int64), np.ones(len(fp), np.int64)))
            if words == 1:
                for lang, n in zip(langs, np.bincount(part.text, minlength=len(rows)).tolist(), strict=True):
                    totals[lang] += n
        yield from sent(own.rest())
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), pa.nulls(len(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())],
                names=["lang", "key", "c"])
    return docs.select("text", "lang").mapInArrow(work, "lang string, key long, c long") \
        .groupBy("lang", "key").agg(F.sum("c").alias("c"))


def bitmap(prints: DataFrame, column: str, bits: int) -> np.ndarray:
    """2**FILTER_BITS bits, those of the column's numbers (of so many bits) set; this many bytes
    however many there are."""
    at = prints.select(F.shiftrightunsigned(column, bits - FILTER_BITS).alias("at"))
    rows = at.groupBy(F.shiftright("at", 6).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow()
    cells = np.zeros(1 << (FILTER_BITS - 6), "<i8")
    cells[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy()
    return cells.view(np.uint8)


POINTED = "fp long, c long, check int, row long, at long, length int"


def pointed(docs: DataFrame, longest: int, filters: list, bits: int) -> DataFrame:
    """fp, c, lo, hi and one occurrence of every run that the filters let through."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, own = Prints(bits), Combined(2)
        seen = [f.value for f in filters]

        def sent(found: Iterator[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for fp, check, c, row, at, length in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp.view(np.int64)), pa.array(c), pa.array(check), pa.array(row), pa.array(at), pa.array(length)],
                    names=["fp", "c", "check", "row", "at", "length"])
        for part, rows in slices(batches):
            prints.over(part, salted(part, rows)[0])
            row = np.array([batch.column("row")[k].as_py() for batch, k, _ in rows], np.int64)
            # the first text of a slice may be the rest of a longer one
            moved = np.array([base for _, _, base in rows]) - part.base
            for words in range(1, longest + 1):
                run, fp = prints.likely(words, seen)
                text, start = part.text[run], part.start[run]
                yield from sent(own.add(
                    fp, prints.checks(run, words), np.ones(len(run), np.int64), row[text], start + moved[text],
                    (part.stop[run + words - 1] - start).astype(np.int32)))
        yield from sent(own.rest())
    # first() of several columns is one row's: all take the first row that comes
    return docs.select("row", "text", "lang").mapInArrow(work, POINTED).groupBy("fp").agg(
        F.sum("c").alias("c"), F.min("check").alias("lo"), F.max("check").alias("hi"),
        *[F.first(x).alias(x) for x in ("row", "at", "length")])


PHRASES = "lang string, phrase string, words int, a long"


def written(docs: DataFrame, sure: DataFrame, bits: int) -> DataFrame:
    """The phrases at the pointers, where both polynomials agree with what is read there."""
    held = sure.groupBy("row").agg(F.collect_list(F.struct(
        "at", "length", "fp", F.col("lo").alias("check"), "c")).alias("found"))
    both = docs.join(held, "row").select("text", "lang", "found")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Prints(bits)
        for part, rows in slices(batches):
            salts, langs = salted(part, rows)
            prints.over(part, salts)
            ends = np.append(part.base[1:], len(part.data))
            columns, owner = [], []
            for e, (batch, k, base) in enumerate(rows):
                found = batch.column("found")[k].values
                own = [found.field(i).to_numpy() for i in range(5)]
                here = (own[0] >= base) & (own[0] < base + ends[e] - part.base[e])
                own = [c[here] for c in own]
                columns.append([own[0] - base + part.base[e], *own[1:]])
                owner.append(np.full(len(own[0]), e))
            at, length, fp, check, c = map(np.concatenate, zip(*columns, strict=True))
            owner = np.concatenate(owner)
            # another text under the same row key may have no word there
            run, last = np.searchsorted(part.start, at), np.searchsorted(part.stop, at + length)
            good = (run < len(part.start)) & (last < len(part.stop))
            run, last = np.where(good, run, 0), np.where(good, last, 0)
            good &= (last >= run) & (part.start[run] == at) & (part.stop[last] == at + length)
            words = (last - run + 1).astype(np.int32)
            for n in np.unique(words[good]).tolist():
                of = np.flatnonzero(good & (words == n))
                good[of] = (prints.prints(run[of], n).view(np.int64) == fp[of]) & (prints.checks(run[of], n) == check[of])
            data, good = part.data.tobytes(), np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[e] for e in owner[good].tolist()], pa.string()),
                 pa.array([data[a:b] for a, b in zip(at[good].tolist(), (at[good] + length[good]).tolist(), strict=True)],
                          pa.binary()).cast(pa.string()),
                 pa.array(words[good]), pa.array(c[good])], names=["lang", "phrase", "words", "a"])
    # rows of equal key and text write the same phrases
    return both.mapInArrow(work, PHRASES).groupBy("lang", "phrase").agg(F.max("words").alias("words"), F.max("a").alias("a"))


def counted_by_text(docs: DataFrame, collided: DataFrame, suspects, longest: int, filters: list, least: int,
                    bits: int) -> DataFrame:
    """Phrases whose fingerprints several phrases share, counted by their texts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, seen = Prints(bits), [f.value for f in filters]
        for part, rows in slices(batches):
            salts, langs = salted(part, rows)
            prints.over(part, salts)
            data, out = part.data.tobytes(), Counter()
            for words in range(1, longest + 1):
                run, fp = prints.likely(words, seen)
                on = passes(fp, suspects.value)
                run, fp = run[on], fp[on].view(np.int64)
                for f, t, a, b in zip(fp.tolist(), part.text[run].tolist(), part.start[run].tolist(),
                                      part.stop[run + words - 1].tolist(), strict=True):
                    out[langs[t], f, data[a:b], words] += 1
            if out:
                lang, f, phrase, words = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang, pa.string()), pa.array(f, pa.int64()), pa.array(phrase, pa.binary()).cast(pa.string()),
                     pa.array(words, pa.int32()), pa.array(list(out.values()), pa.int64())],
                    names=["lang", "fp", "phrase", "words", "a"])
    every = docs.select("text", "lang").mapInArrow(work, "lang string, fp long, phrase string, words int, a long")
    return every.join(collided.select("fp"), "fp", "left_semi").groupBy("lang", "phrase").agg(
        F.max("words").alias("words"), F.sum("a").alias("a")).filter(F.col("a") >= least)


def frequent(docs: DataFrame, stage: Stage, longest: int = LONGEST, least: int = LEAST,
             bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) of all runs of 1..longest words with a >= least, and (lang, n)."""
    spark, texts = docs.sparkSession, texts_of(docs)
    filters, totals = [], None
    for words in range(1, longest + 1):
        found = counted(texts, words, filters, bits)
        if words == 1:
            found = stage(found.filter((F.col("c") >= least) | F.col("key").isNull()))
            totals = found.filter(F.col("key").isNull()).select("lang", F.col("c").alias("n"))
        enough = found.filter(F.col("key").isNotNull() & (F.col("c") >= least))
        filters.append(spark.sparkContext.broadcast(bitmap(enough, "key", KEY_BITS)))
    every = stage(pointed(texts, longest, filters, bits).filter(F.col("c") >= least))
    sure, collided = every.filter("lo = hi"), every.filter("lo <> hi")
    out = stage(written(texts, sure, bits))
    if out.count() != sure.count():
        raise RuntimeError("a pointer does not lead to its phrase: the table changed while it was read")
    if not collided.isEmpty():
        suspects = spark.sparkContext.broadcast(bitmap(collided, "fp", 64))
        out = stage(out.unionByName(counted_by_text(texts, collided, suspects, longest, filters, least, bits)))
    return out, totals


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, within_percent: int = WITHIN_PERCENT,
         top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut: the first ``top`` phrases of each language."""
    if longest < 2:
        raise ValueError("a phrase has two words or more")
    stage = Stage(docs.sparkSession, "phrases")
    counts, totals = frequent(docs, stage, longest, least, bits)
    candidates = counts.filter("words > 1").withColumn("w", F.split("phrase", " "))
    inner = candidates.filter("words > 2").select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1), "
        "i -> array_join(slice(w, i, s), ' '))))")).alias("phrase"))
    longer = stage(inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    alone = candidates.join(longer, ["lang", "phrase"], "left") \
        .filter(F.col("longer").isNull() | (100 * F.col("longer") < within_percent * F.col("a")))
    cuts = alone.select("lang", "phrase", "a", F.explode(F.expr(
        "transform(sequence(1, words - 1), k -> struct(k AS cut, array_join(slice(w, 1, k), ' ') AS head, "
        "array_join(slice(w, k + 1, words), ' ') AS tail))")).alias("x")).select("lang", "phrase", "a", "x.*")
    cuts = stage(cuts)
    parts_ = counts.select("lang", "phrase", "a")
    both = cuts.join(parts_.toDF("lang", "head", "l"), ["lang", "head"]).join(parts_.toDF("lang", "tail", "r"), ["lang", "tail"])
    # decimals of 38 digits hold the products of counts up to 10**15 exactly; div drops the fraction
    exact = {x: f"CAST({x} AS DECIMAL(19, 0))" for x in ("a", "l", "r")}
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(7, 0)) * {exact['a']} * {exact['a']}) div ({exact['l']} * {exact['r']})")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("low"), F.max("a").alias("a"))
    lowest = stage(lowest.select("lang", "phrase", "a", "low.*"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")

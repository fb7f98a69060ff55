"""Substring deduplication by sliding spans of sentences.

From every sentence on, the shortest run of at least ``span`` sentences that has at least
``min_words`` words is a span; so every sentence starts one, and none is skipped for being short.
Spans are hashed (128 bits) and joined over all documents; a span's first occurrence is the one
of the smallest (doc_id, text_hash, position). Sentences that any other occurrence covers are
removed.

One pass cuts and hashes; its spans are written once. Hashes are counted first, by half of
their bits: only spans of a hash that occurs more than once go on. Everything that is
aggregated is written before it is joined, so a span that a third of the corpus holds is split
at run time (AQE); only numbers cross these joins.

A sentence ends after ``.``, ``!`` or ``?`` followed by white space, after a full stop of a
script that puts none behind it (Chinese, Japanese, Arabic, Hindi and others), and at a line
break; closing quotes and brackets belong to it. It is compared without the white space at its
ends. Blank pieces are no sentences and stay. A character of a script that puts no spaces between
words counts as a word.

Defined cases: null or empty text has no sentence and is returned as an empty text. A text
that is too short for a span is one span of all its sentences, which only a whole text can
repeat. Repeated rows: rows of equal id and text are one document, each returned with the same
result (the first occurrence stays in each). Spans that overlap an earlier occurrence of
themselves in the same document are removed too. An empty table gives an empty result; extra
columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence.llm.base import ROW, WHITE, keyed, same_row
from evidence.llm.graph import Stage

SPAN = 3
MIN_WORDS = 10
SLICE = 256
#: white space beyond ASCII that may follow or surround a sentence
WIDE = "\x85\xa0\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
TRIMMED = WHITE + WIDE
#: ends of sentences that need no white space behind them
STOPS = "。！？｡؟۔।॥።፧၊။។៕"
CLOSERS = r"\"'”’»)\]」』）】》"
#: scripts that put no spaces between words
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
CUT = re.compile(rf"[.!?][{CLOSERS}]{{0,3}}[\x20\x09-\x0D{WIDE}]|[{STOPS}][{CLOSERS}]{{0,3}}(?![{CLOSERS}{STOPS}])"
                 "|\r\n|[\n\x0b\x0c\r\x85\u2028\u2029]")
SPANS = "h1 long, h2 long, doc_id long, text_hash long, at int, until int"


def pieces(text: str) -> list[str]:
    """The text cut behind each sentence; joined, they give the text again."""
    at = [0, *(m.end() for m in CUT.finditer(text))]
    if at[-1] < len(text):
        at.append(len(text))
    return [text[a:b] for a, b in zip(at, at[1:], strict=False)]


def size(sentence: str) -> int:
    n = len(sentence.split())
    return n if sentence.isascii() else n + len(UNSPACED.findall(sentence))


def spans_of(text: str, span: int, min_words: int) -> Iterator[tuple[bytes, int, int]]:
    """Hash, first and last piece of each span."""
    real, sizes, hashes = [], [0], []
    for k, piece in enumerate(pieces(text)):
        key = piece.strip(TRIMMED)
        if key:
            real.append(k)
            sizes.append(size(key) if min_words else 1)
            hashes.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass")))
    n, words = len(real), np.cumsum(sizes)
    enough = np.searchsorted(words, words[:-1] + min_words)
    for i, end in enumerate(np.maximum(enough, np.arange(n) + span).tolist()):
        if end > n:
            if i:
                break
            end = n
        yield xxhash.xxh3_128_digest(b"".join(hashes[i:end])), real[i], real[end - 1]


def texts_of(docs: DataFrame) -> DataFrame:
    return keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long"))


def spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per span: h1, h2, row identity, at and until (pieces)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                row, found = [], []
                for k, text in enumerate(part.column("text").to_pylist()):
                    own = list(spans_of(text or "", span, min_words))
                    row += [k] * len(own)
                    found += own
                hashes = np.frombuffer(b"".join(x[0] for x in found), "<i8").reshape(-1, 2)
                at = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), part.column("doc_id").take(at), part.column("text_hash").take(at),
                     pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.int32())],
                    names=["h1", "h2", "doc_id", "text_hash", "at", "until"])
    return texts_of(docs).mapInArrow(work, SPANS)


def repeated_spans(docs: DataFrame, stage: Stage, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """The spans that are not the first of their hash: row identity, at, until."""
    every = stage(spans(docs, span, min_words))
    often = stage(every.groupBy("h1").agg(F.count("*").alias("n")).filter("n > 1").select("h1"))
    hits = stage(every.join(often, "h1", "left_semi"))
    place = F.struct(*ROW, "at")
    firsts = stage(hits.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                   .filter(~F.col("first").eqNullSafe(F.col("last"))).drop("last"))
    stage.free(every, often)
    return hits.join(firsts, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first"))).select(*ROW, "at", "until")


def drop_repeated_spans(docs: DataFrame, span: int = SPAN, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_sentences, n_removed, kept_text of every row."""
    stage = Stage(docs.sparkSession, "sentences")
    gone = stage(repeated_spans(docs, stage, span, min_words).groupBy(*ROW).agg(
        F.collect_list(F.struct("at", "until")).alias("covered")))
    d = texts_of(docs)
    both = d.join(gone, same_row(d, gone), "left").select(d["doc_id"], d["text"], gone["covered"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                found = [kept(t or "", c.values if c.is_valid else None) for t, c in
                         zip(part.column("text").to_pylist(), part.column("covered"), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([x[0] for x in found], pa.int64()),
                     pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.string())],
                    names=["doc_id", "n_sentences", "n_removed", "kept_text"])
    return both.mapInArrow(work, "doc_id long, n_sentences long, n_removed long, kept_text string")


def kept(text: str, covered: pa.StructArray | None) -> tuple[int, int, str]:
    """Sentences, removed ones, and what is left; blank pieces inside a span stay."""
    own = pieces(text)
    real = np.array([bool(p.strip(TRIMMED)) for p in own], bool)
    if covered is None:
        return int(real.sum()), 0, text
    depth = np.zeros(len(own) + 1, np.int64)
    np.add.at(depth, covered.field(0).to_numpy(), 1)
    np.add.at(depth, covered.field(1).to_numpy() + 1, -1)
    gone = (np.cumsum(depth[:-1]) > 0) & real
    return int(real.sum()), int(gone.sum()), "".join(p for p, g in zip(own, gone.tolist(), strict=True) if not g)

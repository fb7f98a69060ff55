"""Language identification with segmentation-marginalised unigrams.

Each language has probabilities over the pieces of a fixed public vocabulary. A text's score
is the sum over its words of log P(word), and P(word) sums over all ways to cut the word into
pieces (forward algorithm). The probabilities are learned by expectation maximisation: the
expected use of each piece over all segmentations of a language's words, weighed by how often
the words occur.

Training reads a bounded sample, ``sample_rows`` labelled documents of each language (the
smallest hashes, found without moving a text); its word counts are a Spark aggregation, each
EM step a pass over distinct words whose partial sums (languages x vocabulary at most) are added up by Spark. Prediction
is one pass over all texts without a shuffle: a worker scores each new word once, all
segmentations of thousands of words at a time, and remembers words up to a bound.

Defined cases: text that is null or has no letter gets ``und`` and score 0; so does every
text if nothing can be learned. Ties go to the language that sorts first. Null labels are
not learned from; a null doc_id counts as the text '' in the held-out rule. Repeated rows
are scored alike. Extra columns are left out of ``predict`` and kept by ``keep_languages``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence.llm.base import words
from evidence.llm.graph import Stage

SAMPLE_ROWS = 1000
ROUNDS = 2
SMOOTHING = 0.1
MAX_LANGUAGES = 1000
REMEMBERED_BYTES = 96 << 20
#: a dictionary entry, a bytes object without what it holds, and a number
ENTRY_BYTES = 165
LATTICE_CHARS = 150_000
SLICE = 256
UNDETERMINED = "und"
SPACE = "▁"
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


class Vocabulary:
    """Pieces of a vocabulary file, found in many words at a time by hashes of their characters."""

    def __init__(self, file: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.size = model.get_piece_size()
        pieces = {model.id_to_piece(i): i for i in range(self.size)
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        self.unknown = model.unk_id()
        self.tables = []
        prefixes = {p[:n] for p in pieces for n in range(1, len(p) + 1)}
        for n in range(1, max(map(len, pieces)) + 1):
            some = sorted(p for p in prefixes if len(p) == n)
            keys = self.hashed(np.array([[ord(c) for c in p] for p in some], np.uint64))
            ids = np.array([pieces.get(p, -1) for p in some], np.int64)
            at = np.argsort(keys)
            self.tables.append((keys[at], ids[at]))

    @staticmethod
    def hashed(chars: np.ndarray) -> np.ndarray:
        out = np.zeros(len(chars), np.uint64)
        for k in range(chars.shape[1]):
            out = Vocabulary.step(out, chars[:, k])
        return out

    @staticmethod
    def step(h: np.ndarray, chars: np.ndarray) -> np.ndarray:
        h = (h ^ (chars + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))

    def lattice(self, some: list[str]) -> Lattice:
        """Every piece of the vocabulary at every place of the words."""
        joined = "".join(SPACE + w for w in some)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.array([len(w) + 1 for w in some])
        first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        inner = np.arange(len(chars)) - np.repeat(first, sizes)
        left = np.repeat(sizes, sizes) - inner
        live, h = np.arange(len(chars)), np.zeros(len(chars), np.uint64)
        starts, lengths, ids = [], [], []
        for n, (keys, of) in enumerate(self.tables, 1):
            on = left[live] >= n
            live, h = live[on], h[on]
            h = self.step(h, chars[live + n - 1])
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            if n == 1:  # a character that is no piece stands for the unknown piece
                lone = live[~hit | (of[at] < 0)]
                starts.append(lone), lengths.append(np.ones(len(lone), np.int64))
                ids.append(np.full(len(lone), self.unknown))
            live, h, at = live[hit], h[hit], at[hit]
            real = of[at] >= 0
            starts.append(live[real]), lengths.append(np.full(int(real.sum()), n)), ids.append(of[at[real]])
            if not len(live):
                break
        start, length, piece = map(np.concatenate, (starts, lengths, ids))
        # nodes: one before each character and one behind each word
        node = start + np.repeat(np.arange(len(some)), sizes)[start] if len(start) else start
        end_in_word = inner[start] + length
        order = np.argsort(end_in_word * 32 + length, kind="stable")
        heads = first + np.arange(len(some))
        return Lattice(node[order], node[order] + length[order], piece[order],
                       (end_in_word * 32 + length)[order], heads, heads + sizes, len(chars) + len(some))


@lru_cache(maxsize=1)
def loaded(file: str) -> Vocabulary:
    """One per worker process, whatever number of tasks it runs."""
    return Vocabulary(file)


@dataclass
class Lattice:
    """Edges source -> target with a piece each, ordered by where they end in their word."""
    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    order: np.ndarray
    heads: np.ndarray
    tails: np.ndarray
    nodes: int

    def groups(self) -> list[tuple[int, int]]:
        """Runs of edges no two of which share an end."""
        cut = np.flatnonzero(np.diff(self.order)) + 1
        return list(zip([0, *cut], [*cut, len(self.order)], strict=True)) if len(self.order) else []

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """log of the summed probability of all ways to each node; logp: languages x pieces."""
        alpha = np.full((self.nodes, len(logp)), -np.inf)
        alpha[self.heads] = 0
        weights = logp.T
        for a, b in self.groups():
            to = self.target[a:b]
            alpha[to] = np.logaddexp(alpha[to], alpha[self.source[a:b]] + weights[self.piece[a:b]])
        return alpha

    def expected(self, logp: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """How often each piece is used over all segmentations; one language (logp: pieces)."""
        alpha = self.forward(logp[None])[:, 0]
        beta = np.full(self.nodes, -np.inf)
        beta[self.tails] = 0
        # backwards, edges in order of their source: those of a word from its end on
        from_end = np.repeat(self.tails, self.tails - self.heads + 1)[self.source] - self.source
        length = self.target - self.source
        key = from_end * 32 + length
        order = np.argsort(key, kind="stable")
        cut = np.flatnonzero(np.diff(key[order])) + 1
        for run in np.split(order, cut):
            at = self.source[run]
            beta[at] = np.logaddexp(beta[at], beta[self.target[run]] + logp[self.piece[run]])
        owner = np.repeat(np.arange(len(self.heads)), self.tails - self.heads + 1)[self.source]
        use = np.exp(alpha[self.source] + logp[self.piece] + beta[self.target]
                     - alpha[self.tails][owner]) * counts[owner]
        return np.bincount(self.piece, use, len(logp))


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray
    vocabulary_file: str


def training_rows(docs: DataFrame, sample_rows: int, stage: Stage) -> DataFrame:
    """lang, text of the sample: the documents with the smallest hashes of each language.

    The hashes are ranked alone (Spark limits each task's part of a language first); the
    largest one taken of each language then filters the texts where they are.
    """
    own = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))) \
        .select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    order = Window.partitionBy("lang").orderBy("h")
    ranked = own.select("lang", "h").distinct().withColumn("n", F.row_number().over(order))
    last = stage(ranked.filter(F.col("n") <= sample_rows).groupBy("lang").agg(F.max("h").alias("last")))
    # repeated rows have one hash, so what is left of them is bounded too
    return own.join(last, "lang").filter("h <= last").groupBy("lang", "h").agg(
        F.any_value("text").alias("text")).select("lang", "text")


def train(docs: DataFrame, vocabulary_file: str, sample_rows: int = SAMPLE_ROWS,
          rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language among the labelled documents that are not held out."""
    spark = docs.sparkSession
    stage = Stage(spark, "language")
    counts = stage(training_rows(docs, sample_rows, stage).select(
        "lang", F.explode(words(F.col("text"))).alias("word")).groupBy("lang", "word").count())
    languages = sorted(r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model would not fit a task")
    size = loaded(vocabulary_file).size
    logp = np.full((len(languages), size), -np.log(size))
    for _ in range(rounds if languages else 0):
        sent = spark.sparkContext.broadcast((languages, logp))

        def step(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            vocabulary = loaded(vocabulary_file)
            names, now = sent.value
            total = np.zeros(now.shape)
            for frame in frames:
                for lang, part in frame.groupby("lang"):
                    k = names.index(lang)
                    for a in range(0, len(part), 20_000):
                        some = part.iloc[a:a + 20_000]
                        total[k] += vocabulary.lattice(list(some["word"])).expected(
                            now[k], some["count"].to_numpy(float))
            k, piece = np.nonzero(total)
            yield pd.DataFrame({"k": k, "piece": piece, "used": total[k, piece]})
        used = counts.mapInPandas(step, "k int, piece int, used double") \
            .groupBy("k", "piece").agg(F.sum("used").alias("used")).toPandas()
        now = np.full((len(languages), size), SMOOTHING)
        now[used["k"], used["piece"]] += used["used"]
        logp = np.log(now / now.sum(axis=1, keepdims=True))
    return Model(languages, logp, vocabulary_file)


class Scorer:
    """Scores of texts; remembers words up to a bound in bytes."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, loaded(model.vocabulary_file)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.values = np.zeros((1024, len(self.model.languages)))
        self.size = 0

    def learn(self, new: list[bytes]) -> None:
        at = 0
        while at < len(new):
            # a lattice takes memory for every character of its words
            stop, chars = at, 0
            while stop < len(new) and (chars < LATTICE_CHARS or stop == at):
                chars += len(new[stop])
                stop += 1
            some = new[at:stop]
            lattice = self.vocabulary.lattice([w.decode("utf-8", "replace") for w in some])
            n = len(self.known)
            if n + len(some) > len(self.values):
                grown = np.zeros((max(2 * len(self.values), n + len(some)), self.values.shape[1]))
                grown[:n] = self.values[:n]
                self.values = grown
            self.values[n:n + len(some)] = lattice.forward(self.model.logp)[lattice.tails]
            self.known.update(zip(some, range(n, n + len(some)), strict=True))
            self.size += chars + len(some) * (ENTRY_BYTES + 16 * self.values.shape[1])
            at = stop

    def score(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """Language and its share of the likelihood, per text; meant for a few texts at a time."""
        out = []
        split = [(t or b"").split() for t in texts]
        if self.size > REMEMBERED_BYTES:
            self.forget()
        new = set().union(*split).difference(self.known)
        if new:
            self.learn(list(new))
        for text, ws in zip(texts, split, strict=True):
            if not self.model.languages or not ws or not has_letter(text):
                out.append((UNDETERMINED, 0.0))
                continue
            rows = np.fromiter(map(self.known.__getitem__, ws), np.int64, len(ws))
            total = self.values[rows].sum(0)
            best = int(total.argmax())
            out.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out

    def slices(self, batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[str, float]]]]:
        """Parts of the batches, each with what is said of its texts (column ``at``)."""
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                yield part, self.score(part.column(at).cast(pa.binary()).to_pylist())


def scorer(model: Model) -> Scorer:
    """One per worker process and model: what it has learned serves all its tasks."""
    if not hasattr(model, "scorer"):
        model.scorer = Scorer(model)
    return model.scorer


def has_letter(text: bytes | None) -> bool:
    return text is not None and any(map(str.isalpha, text.decode("utf-8", "replace")))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, said in scorer(sent.value).slices(batches, 2):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array([x[0] for x in said], pa.string()),
                 pa.array([x[1] for x in said], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(work, PREDICTED)


def keep_languages(docs: DataFrame, model: Model, languages: tuple[str, ...] | None = None,
                   min_score: float = 0.5, times_chance: float | None = None) -> DataFrame:
    """The rows whose language is one of those given (any learned one for None) and sure enough.

    With ``times_chance`` the floor is so many times the score that chance gives, one part in the
    number of languages, instead of ``min_score``. Where no language was learned, nothing can be
    judged, and all rows stay.
    """
    if not model.languages:
        return docs
    floor = min_score if times_chance is None else times_chance / len(model.languages)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, said in scorer(sent.value).slices(batches, at):
            yield part.filter(pa.array([
                x != UNDETERMINED and (languages is None or x in languages) and p >= floor
                for x, p in said], pa.bool_()))
    return docs.mapInArrow(work, docs.schema)

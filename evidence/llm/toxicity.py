"""Toxicity by a weighted finite-state grammar of clauses.

Words become classes: insults (a weighted lexicon), harm, intent, target, negation and reported
speech (fixed words of four languages), and marks that end clauses or sentences. Four
transducers read the classes and pass them on with a mark:

* negation: an insult or a harm within three words behind a negation is denied;
* reported speech: what stands between quotes, or behind a verb of saying up to the end of the
  sentence, is reported;
* target: an insult within four words behind a target, or two before one, is aimed;
* threat: intent, harm and target in one clause, in any order, are a threat.

Their composition is one machine, written out as a table over its reachable states. It turns a
text into matched clauses of six kinds; a clause counts with the greatest lexical weight among its
matches of a kind, so repeating a word inside a clause adds nothing. A text's score is the
logistic function of the kinds' weights times log(1 + sum of its clauses). Words outside such
matches have no influence.

What is learned, from labelled documents that are not held out: the lexicon (beginnings of words
that stand in labelled documents far more often than chance allows), and the weights of the
kinds, towards fixed ones. Learning takes a bounded sample: of each label the ``sample_rows``
documents with the smallest hashes, of which near copies (equal smallest hashes of five-word
runs) are left out, so that one copied text cannot fill the lexicon with its words. Everything
else reads all rows, in one pass without a shuffle.

Defined cases: null, empty and blank texts have no clause; their score is that of any text
without a match. A null doc_id is not held out and has no label; label rows that disagree about a
document are left out. Without labels of both kinds, fixed lexicon and weights score. Repeated
rows are scored each. An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidence.llm.base import bind, words
from evidence.llm.graph import Stage

SAMPLE_ROWS = 10_000
#: beginnings of words that are looked at, in characters
SHORTEST, LONGEST = 3, 10
#: an entry is this much likelier (log odds) in labelled texts; expected number of chance entries
LEAST_WEIGHT, CHANCE = 2.0, 0.5
#: an entry gives way to a longer one with this share of what it has beyond chance
NEARLY = 0.9
NEGATED_SPAN, TARGET_BEFORE, TARGET_BEHIND = 3, 4, 2
RIDGE = 1.0
REMEMBERED_BYTES = 16 << 20
SLICE = 256
SCORED = "doc_id long, held_out boolean, score double, predicted int, n_clauses long"

OTHER, INTENT, TARGET, NEGATION, REPORT, QUOTE, SOFT, STOP, HARM, INSULT = range(10)
PLAIN, AIMED, DENIED, REPORTED, THREAT, REPORTED_THREAT = range(6)
#: weights of the kinds before anything is learned, and what a text without a match has
PRIOR = np.array([1.6, 2.0, 0.3, 0.6, 2.0, 0.8])
PRIOR_BASE = -3.0
PRIOR_LEXICAL = 6.0

# Words of the classes in English, German, French and Spanish.
WORDS = {
    INTENT: "will shall gonna going i'll we'll want werde werden wird wirst will vais va allons veux voy vamos vas quiero",
    TARGET: "you your yours yourself you're they them their those these people du dich dir dein deine ihr euch euer "
            "sie tu toi te ton ta vous votre usted ustedes tus os vosotros",
    NEGATION: "not no never none nobody nothing isn't aren't wasn't don't doesn't didn't nor without kein keine keinen "
              "nicht nie niemals niemand ohne pas jamais aucun aucune rien sans nunca nadie ninguno ninguna sin jamás",
    REPORT: "said says say told tells called calls wrote writes quoted quote claims claimed sagte sagt schrieb nannte nennt "
            "meinte zitierte dit disait appelé appelle écrit écrivait dijo dice llamó llama escribió",
    HARM: "kill murder hurt beat shoot stab punch strangle burn destroy töten töte umbringen schlagen erschießen erstechen "
          "tuer tuerai frapper égorger buter matar mataré golpear apuñalar",
    INSULT: "idiot moron imbecile scum stupid worthless pathetic dummkopf arschloch abschaum schwachkopf imbécile crétin "
            "connard abruti idiota imbécil estúpido",
}
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”„«»]|[.!?\n\r。！？]|[,;:()–—…]")
QUOTES, SOFT_MARKS = "\"“”„«»", ",;:()–—…"


@dataclass(frozen=True)
class Transducer:
    """A machine that reads (class, marks) and passes it on, possibly with a mark more."""
    start: object
    step: Callable[[object, tuple], tuple[object, tuple]]

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one passes on is what the other one reads."""
        def step(states, symbol):
            own, passed = self.step(states[0], symbol)
            others, passed = other.step(states[1], passed)
            return (own, others), passed
        return Transducer((self.start, other.start), step)


def ends(symbol: tuple) -> bool:
    return symbol[0] in (SOFT, STOP)


def marked(symbol: tuple, mark: str) -> tuple:
    return (symbol[0], symbol[1] | {mark})


def negation(span: int = NEGATED_SPAN) -> Transducer:
    def step(left: int, symbol: tuple) -> tuple[int, tuple]:
        if symbol[0] == NEGATION:
            return span, symbol
        if ends(symbol):
            return 0, symbol
        hit = left > 0 and symbol[0] in (INSULT, HARM)
        return max(left - (symbol[0] != QUOTE), 0), marked(symbol, "denied") if hit else symbol
    return Transducer(0, step)


def reported_speech() -> Transducer:
    def step(state: tuple, symbol: tuple) -> tuple[tuple, tuple]:
        said, quoted = state
        if symbol[0] == REPORT:
            return (True, quoted), symbol
        if symbol[0] == QUOTE:
            return (said, not quoted), symbol
        if symbol[0] == STOP:
            return (False, False), symbol
        return state, marked(symbol, "reported") if said or quoted else symbol
    return Transducer((False, False), step)


def target(before: int = TARGET_BEFORE, behind: int = TARGET_BEHIND) -> Transducer:
    def step(state: tuple, symbol: tuple) -> tuple[tuple, tuple]:
        near, open_ = state
        if ends(symbol):
            return (0, 0), symbol
        if symbol[0] == TARGET:
            return (before, 0), marked(symbol, "behind") if open_ else symbol
        if symbol[0] == INSULT:
            return (max(near - 1, 0), behind), marked(symbol, "aimed") if near else symbol
        used = symbol[0] != QUOTE
        return (max(near - used, 0), max(open_ - used, 0)), symbol
    return Transducer((0, 0), step)


def threat() -> Transducer:
    def step(seen: frozenset, symbol: tuple) -> tuple[frozenset, tuple]:
        if ends(symbol):
            return frozenset(), symbol
        if symbol[0] in (INTENT, HARM, TARGET) and "denied" not in symbol[1]:
            more = seen | {symbol[0]}
            if len(more) == 3 and len(seen) < 3:
                return more, marked(symbol, "threat")
            return more, symbol
        return seen, symbol
    return Transducer(frozenset(), step)


def kind(symbol: tuple) -> int:
    """What a symbol that has passed all machines says, -1 for nothing."""
    cls, marks = symbol
    if "threat" in marks:
        return REPORTED_THREAT if "reported" in marks else THREAT
    if cls == TARGET and "behind" in marks:
        return REPORTED if "reported" in marks else AIMED
    if cls != INSULT:
        return -1
    return DENIED if "denied" in marks else REPORTED if "reported" in marks else AIMED if "aimed" in marks else PLAIN


def table() -> tuple[list[list[int]], list[list[int]]]:
    """The composed machine: next state and kind by state and class."""
    machine = negation().then(reported_speech()).then(target()).then(threat())
    number, after, said = {machine.start: 0}, [], []
    waiting = [machine.start]
    for state in waiting:
        steps = [machine.step(state, (cls, frozenset())) for cls in range(10)]
        for new, _ in steps:
            if new not in number:
                number[new] = len(number)
                waiting.append(new)
        after.append([number[new] for new, _ in steps])
        said.append([kind(symbol) for _, symbol in steps])
    return after, said


@dataclass
class Model:
    """Lexicon (beginnings of words and their weights) and weights of the kinds."""
    lexicon: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=PRIOR.copy)
    base: float = PRIOR_BASE


class Lookup(dict):
    """Codes of tokens: a class, or INSULT + the number of a lexicon entry. Bounded in bytes."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.entries = list(lexicon)
        self.number = {e: INSULT + k for k, e in enumerate(self.entries)}
        self.lengths = sorted({len(e) for e in self.entries}, reverse=True)
        self.fixed = {w: cls for cls, listed in WORDS.items() for w in listed.split() if cls != INSULT}
        self.fixed |= {m: QUOTE for m in QUOTES} | {m: SOFT for m in SOFT_MARKS} | {m: STOP for m in ".!?\n\r。！？"}
        self.size = 0

    def __missing__(self, token: str) -> int:
        code = next((self.number[token[:n]] for n in self.lengths if token[:n] in self.number), None)
        if code is None:
            code = self.fixed.get(token.replace("’", "'"), OTHER)
        self.size += 120 + 4 * len(token)
        if self.size > REMEMBERED_BYTES:
            self.clear()
            self.size = 0
        self[token] = code
        return code


class Grammar:
    """Matched clauses of texts."""

    def __init__(self, lexicon: dict[str, float]):
        self.after, self.said = table()
        self.code = Lookup(lexicon)
        self.weight = [lexicon[e] for e in self.code.entries]

    def clauses(self, text: str) -> list[dict[int, float]]:
        """For each clause with a match: kind -> greatest weight."""
        codes = list(map(self.code.__getitem__, TOKEN.findall(text.lower())))
        if max(codes, default=0) < HARM:
            return []
        out, now, state, last = [], {}, 0, PRIOR_LEXICAL
        for code in codes:
            cls = min(code, INSULT)
            if cls == INSULT:
                last = self.weight[code - INSULT]
            found = self.said[state][cls]
            if found >= 0:
                weight = PRIOR_LEXICAL if found >= THREAT else last
                if weight > now.get(found, 0.0):
                    now[found] = weight
            elif (cls == SOFT or cls == STOP) and now:
                out.append(now)
                now = {}
            state = self.after[state][cls]
        return [*out, now] if now else out

    def features(self, text: str | None) -> tuple[np.ndarray, int]:
        sums = np.zeros(len(PRIOR))
        found = self.clauses(text or "")
        for clause in found:
            for k, w in clause.items():
                sums[k] += w
        return np.log1p(sums), len(found)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def labelled(docs: DataFrame, labels: DataFrame, sample_rows: int, stage: Stage) -> tuple[DataFrame, dict[int, int]]:
    """toxic, text of the sample, and how many rows each label has.

    Hashes alone are joined with the labels and ranked; those above the share that is wanted are left
    out before, so no task gets more of a label than a little over the sample.
    """
    said = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("most")) \
        .filter("toxic = most").drop("most")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h")) \
        .filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    rows = stage(own.select("doc_id", "h").join(said, "doc_id").groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id")))
    counts = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    wanted = sample_rows + 6 * math.sqrt(sample_rows) + 10
    share = F.when(F.col("toxic") == 1, wanted / max(1, counts.get(1, 0))).otherwise(wanted / max(1, counts.get(0, 0)))
    ranked = rows.filter((F.col("h") / 2.0 ** 64 + 0.5) <= share).withColumn(
        "place", F.row_number().over(Window.partitionBy("toxic").orderBy("h")))
    # at most 2 * sample_rows rows of three numbers
    keys = F.broadcast(stage(ranked.filter(F.col("place") <= sample_rows).select("doc_id", "h", "toxic")))
    texts = own.join(keys, ["doc_id", "h"]).groupBy("toxic", "h").agg(F.any_value("text").alias("text"))
    for seed in range(3):
        texts = texts.withColumn("copy", copy_key(F.col("text"), seed)).dropDuplicates(["copy"])
    return stage(texts.select("toxic", "text")), counts


def copy_key(text: Column, seed: int) -> Column:
    """The smallest hash of five words running: most near copies agree in it."""
    def least(w: Column) -> Column:
        return F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 4, F.lit(1))),
                                       lambda i: F.xxhash64(F.lit(seed), F.array_join(F.slice(w, i, 5), " "))))
    return bind(words(F.lower(text)), least)


def learn_lexicon(sample: DataFrame, totals: dict[int, int], stage: Stage) -> dict[str, float]:
    """Fixed insults, and beginnings of words that stand in more labelled texts than chance allows.

    An entry needs log odds of LEAST_WEIGHT, and a binomial tail (Chernoff's bound) so small
    that CHANCE entries of all those looked at are expected to pass it by chance.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part, found = batch.slice(a, SLICE), Counter()
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                    found.update((w[:LONGEST], toxic) for w in set(TOKEN.findall(text.lower())) if len(w) >= SHORTEST)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in found], pa.string()), pa.array([y for _, y in found], pa.int32()),
                     pa.array(list(found.values()), pa.int64())], names=["word", "toxic", "n"])
    counted = sample.mapInArrow(work, "word string, toxic int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    begun = counted.select(F.explode(F.transform(
        F.sequence(F.lit(SHORTEST), F.length("word")), lambda n: F.substr(F.col("word"), F.lit(1), n))).alias("entry"), "t", "c") \
        .groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    every, ill = totals[0] + totals[1], totals[1]
    t, c, p = F.col("t"), F.col("c"), ill / every
    q = t / (t + c)
    weight = F.log((t + 0.5) / (ill + 1)) - F.log((c + 0.5) / (totals[0] + 1))
    bound = (t + c) * (q * F.log(q / p) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0))
    begun = stage(begun)
    tried = max(1, begun.filter("t > 0").count())
    weighed = begun.withColumn("w", weight)
    passed = weighed.filter("t > 0").filter((F.col("w") >= LEAST_WEIGHT) & (bound >= math.log(tried / CHANCE)))
    known = WORDS[INSULT].split()
    # a fixed insult that clean texts use as well is none here
    common = {r.entry for r in weighed.filter(F.col("entry").isin(known) & (F.col("w") < LEAST_WEIGHT) & (F.col("c") > 2)).collect()}
    return {w: PRIOR_LEXICAL for w in known if w not in common} | chosen({r.entry: (r.w, r.t, r.c) for r in passed.toLocalIterator()}, ill / totals[0])


def chosen(entries: dict[str, tuple[float, int, int]], odds: float) -> dict[str, float]:
    """Of nested entries: one gives way to a longer one that holds nearly all of the labelled
    texts it has beyond chance (odds times its clean ones); of what is left the shortest stays."""
    def beyond(entry: str) -> float:
        return entries[entry][1] - odds * entries[entry][2]

    gives_way = {entry[:n] for entry in entries for n in range(SHORTEST, len(entry))
                 if entry[:n] in entries and beyond(entry) >= NEARLY * beyond(entry[:n])}
    out: dict[str, float] = {}
    for entry in sorted(entries, key=lambda e: (len(e), e)):
        if entry not in gives_way and not any(entry[:n] in out for n in range(SHORTEST, len(entry))):
            out[entry] = float(entries[entry][0])
    return out


def fit(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and base of a logistic regression, drawn towards the fixed ones; no weight is negative."""
    prior = np.append(PRIOR, PRIOR_BASE)
    x, now = np.column_stack([x, np.ones(len(x))]), prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ now, -30, 30)))
        slope = x.T @ (w * (y - p)) - RIDGE * (now - prior)
        bend = (x * (w * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(now))
        move = np.linalg.solve(bend, slope)
        now = now + move * min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-6:
            break
    return np.maximum(now[:-1], 0.0), float(now[-1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and weights from the labelled documents that are not held out."""
    stage = Stage(docs.sparkSession, "toxicity")
    sample, counts = labelled(docs, labels, sample_rows, stage)
    held = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(held) < 2:
        return Model({w: PRIOR_LEXICAL for w in WORDS[INSULT].split()})
    lexicon = learn_lexicon(sample, held, stage)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(sent.value)
        for batch in batches:
            x = [grammar.features(t.as_py())[0] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"])
    rows = sample.select("toxic", "text").mapInArrow(work, "toxic int, x array<double>").toArrow()
    y = rows.column("toxic").to_numpy()
    x = np.array(rows.column("x").to_pylist(), float).reshape(len(y), len(PRIOR))
    # the sample holds the labels in another ratio than the corpus does
    weights, base = fit(x, y, np.where(y == 1, counts[1] / held[1], counts[0] / held[0]))
    stage.free(sample)
    return Model(lexicon, weights, base)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_clauses of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = sent.value
        grammar = Grammar(own.lexicon)
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                found = [grammar.features(t.as_py()) for t in part.column("text")]
                logit = np.array([x for x, _ in found]) @ own.weights + own.base
                likely = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(likely),
                     pa.array((likely >= 0.5).astype(np.int32)), pa.array([n for _, n in found], pa.int64())],
                    names=["doc_id", "held_out", "score", "predicted", "n_clauses"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text") \
        .mapInArrow(work, SCORED)

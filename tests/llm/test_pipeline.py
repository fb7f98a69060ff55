"""The pipeline's stages, each against what its own input says."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import sentencepiece
from helpers import PASSAGE, empty, frame, odd
from test_corpus_operators import PIECES, hits, near
from test_text_operators import waterfill

from evidence.llm import language_id, mixing


class PlainScorer:
    """All segmentations of a word, character by character, one language at a time."""

    def __init__(self, model):
        self.model, words = model, sentencepiece.SentencePieceProcessor(model_file=PIECES)
        self.unknown = words.unk_id()
        self.number = {words.id_to_piece(i): i for i in range(words.get_piece_size())
                       if not (words.is_control(i) or words.is_unknown(i) or words.is_byte(i))}
        self.longest, self.known = max(map(len, self.number)), {}

    def word(self, w):
        if w not in self.known:
            chars = "\u2581" + w
            ways = np.full((len(chars) + 1, len(self.model.languages)), -np.inf)
            ways[0] = 0
            for end in range(1, len(chars) + 1):
                for n in range(1, min(end, self.longest) + 1):
                    piece = self.number.get(chars[end - n:end], self.unknown if n == 1 else None)
                    if piece is not None:
                        ways[end] = np.logaddexp(ways[end], ways[end - n] + self.model.logp[:, piece])
            self.known[w] = ways[-1]
        return self.known[w]

    def text(self, t):
        words = [w.decode() for w in (t or "").encode().split()]
        if not words or not any(map(str.isalpha, t)):
            return "und", 0.0
        total = np.sum([self.word(w) for w in words], axis=0)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def drawn(doc_id, text, seed=mixing.SEED):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    return int(hashlib.md5(f"{seed}|{'' if doc_id is None else doc_id}|{inner}".encode()).hexdigest()[:13], 16) / 2**52


def mixed_by_hand(rows):
    """doc_id -> copies of rows (doc_id, text, source)."""
    size, out = defaultdict(int), Counter()
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = waterfill(size, mixing.WEIGHTS, mixing.SHARE, mixing.CAP)
    for doc_id, text, source in rows:
        rate = target[source] / size[source] if size[source] else 0.0
        out[doc_id] += math.floor(rate) + (drawn(doc_id, text) < rate - math.floor(rate))
    return +out


def test_prediction_equals_a_plain_forward_scorer(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.train(docs, PIECES)
    plain = PlainScorer(model)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    want = {r.doc_id: plain.text(r.text) for r in docs.select("doc_id", "text").collect()}
    assert {d: x[0] for d, x in got.items()} == {d: x[0] for d, x in want.items()}
    assert all(math.isclose(got[d][1], want[d][1], rel_tol=1e-6, abs_tol=1e-9) for d in want)


def test_stages_on_a_small_corpus(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = {}
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        if name != "token_files":
            assert out.columns == docs.columns
        held[name] = (docs, docs := spark.read.parquet(f"{tmp_path}/{name}"))
    before, after = held["language_id"]
    model = language_id.train(before, PIECES)
    plain, floor = PlainScorer(model), corpus_pipeline.TIMES_CHANCE / len(model.languages)
    said = {r.doc_id: plain.text(r.text) for r in before.collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, (lang, p) in said.items() if lang != "und" and p >= floor}
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in held["near_dedup"])
    rows = sorted(before.items())
    _, group = near(rows, 5, 80)
    assert set(after) == {min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in set(group)}
    before, after = ({r.doc_id: r.text for r in x.collect()} for x in held["decontamination"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert set(after) == {d for d, t in before.items() if not hits(t, items)[1]}
    before, after = (x.collect() for x in held["mixing"])
    after = Counter(r.doc_id for r in after)
    assert after == mixed_by_hand([(r.doc_id, r.text, r.source) for r in before])
    files = held["token_files"][1].collect()
    assert Counter(r.doc_id for r in files) == after
    assert corpus_pipeline.run(spark, sf).count() == len(files)


def test_stages_on_odd_and_empty_rows(spark, sf, tmp_path):
    for k, docs in enumerate((odd(spark), empty(spark), frame(spark, [(1, PASSAGE, None, None)] * 3))):
        for name, f in corpus_pipeline.STAGES:
            f(spark, docs, sf).write.parquet(f"{tmp_path}/{k}{name}")
            docs = spark.read.parquet(f"{tmp_path}/{k}{name}")


def test_documents_stay_where_no_language_can_be_learned(spark, sf):
    docs = frame(spark, [(1, "some words", None, "a"), (2, None, None, "a")])
    assert corpus_pipeline.identify(spark, docs, sf).count() == 2


def test_the_floor_follows_the_number_of_languages(spark):
    docs = frame(spark, [(k, f"{'alpha beta gamma' if k % 2 else 'uno dos tres'} {k}", "en" if k % 2 else "es", "a") for k in range(40)]
                 + [(99, "12 34 x", "en", "a")])
    model = language_id.train(docs, PIECES)
    scores = {r.doc_id: r.score for r in language_id.predict(docs, model).collect()}
    kept = {r.doc_id for r in language_id.keep_languages(docs, model, times_chance=1.2).collect()}
    assert kept == {d for d, p in scores.items() if p >= 0.6}

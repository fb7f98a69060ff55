"""Hard negatives, collocations and toxicity against brute force and held-out rows."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
from helpers import LONG, empty, frame, odd, odd_rows

from evidence.llm import collocations, hard_negatives, toxicity

VECTORS = "vec_id long, label int, embedding array<double>, score string, q string, anchor string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "s", "q", "a") for r in rows], VECTORS).repartition(4)


def brute_negatives(rows, is_anchor, positives=5, negatives=10):
    own = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows if None not in (i, y, v)
           and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, y, v in {(i, y, tuple(v)) for i, y, v in own if is_anchor(i)}:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, z) for j, z, w in own if j != i)
        for place, (p, j, _) in enumerate([s for s in scored if s[2] == y][:positives], 1):
            inside = [s for s in scored if s[2] != y and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out += [(i, j, place, rank, k, -p, -s) for rank, (s, k, _) in enumerate(inside, 1)]
    return Counter(out)


def mined(df, **more):
    return Counter(tuple(r) for r in hard_negatives.mine(df, lambda x: x % 5 == 0, **more).collect())


def test_negatives_against_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    # few values, so that scores tie; odd rows; a label that a third of all rows have
    rows = [(i, rng.choice([0, 0, 0, 1, 2, 3, 4]), [rng.choice([-0.5, 0.1, 0.25, 0.3, 1.0]) for _ in range(4)]) for i in range(300)]
    rows += [(5, 0, [0.3] * 4), rows[10], (None, 1, [1.0] * 4), (305, None, [1.0] * 4), (310, 1, None), (315, 1, [None, 1.0, 1.0, 1.0]),
             (320, 1, [float("nan")] * 4), (325, 1, [float("inf")] * 4), (330, 2, []), (335, 2, [0.5]), (-10, 1, [0.7] * 9)]
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 17)
    want = brute_negatives(rows, lambda x: x % 5 == 0)
    assert len(want) > 500 and mined(vectors(spark, rows)) == want
    few = brute_negatives(rows, lambda x: x % 5 == 0, 2, 3)
    assert mined(vectors(spark, rows), positives=2, negatives=3) == few


def test_negatives_of_large_components_are_exact(spark):
    rng = random.Random(12)
    rows = [(i, i % 2, [rng.random() * 4e6 + rng.random() * 1e-3 for _ in range(8)]) for i in range(40)]
    assert mined(vectors(spark, rows)) == brute_negatives(rows, lambda x: x % 5 == 0)


def test_negatives_of_empty_and_lonely_rows(spark):
    assert mined(vectors(spark, [])) == Counter()
    assert mined(vectors(spark, [(5, 1, [1.0])])) == Counter()
    assert mined(vectors(spark, [(5, 1, [1.0]), (6, 1, [1.0])])) == Counter()
    with pytest.raises(ValueError):
        hard_negatives.mine(vectors(spark, []), lambda x: x > 0, low_percent=95)


def brute_phrases(rows, least=10, longest=3, top=2000):
    lower = {c: c + 32 for c in range(65, 91)}
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang or "und" if lang is None else lang] += len(w)
            for s in range(1, longest + 1):
                f.update(("und" if lang is None else lang, tuple(w[i:i + s])) for i in range(len(w) - s + 1))
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if any(100 * b >= 50 * a for (x, q), b in f.items() if b >= least and x == lang and len(q) > len(p)
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
            continue
        cut = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-cut[0], -a, " ".join(p).encode(), f[lang, p[:cut[1]]], f[lang, p[cut[1]:]]))
    return {(lang, k, p.decode(), -a, left, right, n[lang], -s)
            for lang, every in out.items() for k, (s, a, p, left, right) in enumerate(sorted(every)[:top], 1)}


def phrases(df, **more):
    return {tuple(r)[:8] for r in collocations.mine(df, **more).collect()}


def phrase_rows():
    rng = random.Random(13)
    some = ["New York", "a", "the", "of the", "É", "漢字", "x-y", "red\tbig dog", "b", "York city", "no\x00thing"]
    rows = [("".join(rng.choice(some) + rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\r\n", " \x0b"]) for _ in range(60)),
             rng.choice(["en", "de", None, "und"])) for _ in range(60)]
    return rows + [rows[0]] * 15 + [(None, "en"), ("", None), (" \t\n", "en"), ("?!", "de"), ("the of the", "")] + [(LONG, "en")] * 2


def phrase_frame(spark, rows):
    return frame(spark, [(k % 50 or None, text, lang, "a") for k, (text, lang) in enumerate(rows)]).repartition(5)


def test_phrases_against_brute_force(spark, monkeypatch):
    rows = phrase_rows()
    want = brute_phrases(rows)
    assert len(want) > 30 and phrases(phrase_frame(spark, rows)) == want
    assert phrases(phrase_frame(spark, rows), top=3) == {r for r in want if r[1] <= 3}
    four = brute_phrases(rows, least=20, longest=4)
    assert phrases(phrase_frame(spark, rows), least=20, longest=4) == four


def test_phrases_of_colliding_fingerprints_are_counted_by_their_texts(spark):
    rows = phrase_rows()
    assert phrases(phrase_frame(spark, rows), bits=5) == brute_phrases(rows)


def test_phrases_of_long_texts_cut_in_parts(monkeypatch):
    rows = [t for t, _ in phrase_rows() if t]
    whole = "\n".join(rows).encode()
    monkeypatch.setattr(collocations, "PART", 300)
    cut = list(collocations.parts(whole))
    assert len(cut) > 5 and b"".join(cut) == whole
    one, base = collocations.Slice([whole]), 0
    for part in map(lambda t: collocations.Slice([t]), cut):
        assert one.data[base:base + len(part.data)].tobytes() == part.data.tobytes()
        at = np.searchsorted(one.start, base)
        assert (one.start[at:at + len(part.start)] - base == part.start).all()
        assert (one.joined[at:at + len(part.start)] == part.joined).all()
        base += len(part.data)
    assert base == len(one.data)


def test_phrases_of_odd_and_empty_rows(spark):
    assert phrases(empty(spark)) == set()
    rows = [(r[1], r[2]) for r in odd_rows()]
    assert phrases(odd(spark), least=2) == brute_phrases(rows, least=2)


def test_a_phrase_count_beyond_64_bits_is_exact():
    a, left, right = 10**9, 3 * 10**9, 7 * 10**9
    assert collocations.SCALE * a * a > 2**63 and collocations.SCALE * a * a // (left * right) == 47619


def by_hand(tokens):
    """The kinds of a clause's matches by plain rules."""
    out = []
    said = quoted = False
    for k, cls in enumerate(tokens):
        if cls == toxicity.REPORT:
            said = True
        elif cls == toxicity.QUOTE:
            quoted = not quoted
        elif cls == toxicity.INSULT:
            back = [i for i in range(k - 1, -1, -1) if tokens[i] != toxicity.QUOTE]
            denied = any(tokens[i] == toxicity.NEGATION for i in back[:toxicity.NEGATED_SPAN])
            aimed = any(tokens[i] == toxicity.TARGET for i in back[:toxicity.TARGET_BEFORE])
            out.append(toxicity.DENIED if denied else toxicity.REPORTED if said or quoted
                       else toxicity.AIMED if aimed else toxicity.PLAIN)
    return out


def test_composed_machine_reads_like_its_parts():
    after, said = toxicity.table()
    rng = random.Random(14)
    classes = [toxicity.OTHER, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.QUOTE, toxicity.INSULT]
    for _ in range(3000):
        tokens = [rng.choice(classes) for _ in range(rng.randrange(1, 9))]
        state, got = 0, []
        for cls in tokens:
            if cls == toxicity.INSULT:
                got.append(said[state][cls])
            state = after[state][cls]
        assert got == by_hand(tokens), tokens


@pytest.mark.parametrize("text, kinds", [
    ("What an idiot. Fine.", [{"PLAIN"}]), ("You are such an idiot, you moron!", [{"AIMED"}, {"AIMED"}]),
    ("He is not an idiot", [{"DENIED"}]), ("She said that he is an idiot. Stupid thing.", [{"REPORTED"}, {"PLAIN"}]),
    ('They wrote "idiot idiot" there', [{"REPORTED"}]), ("I will kill you", [{"THREAT"}]), ("Ich werde dich umbringen", [{"THREAT"}]),
    ("I will not kill you", []), ("He said I will kill you", [{"REPORTED_THREAT"}]), ("idiot you", [{"PLAIN", "AIMED"}]),
    ("kill. you will", []), ("The weather will be fine", []), ("", []),
])
def test_clauses(text, kinds):
    grammar = toxicity.Grammar({w: 6.0 for w in toxicity.WORDS[toxicity.INSULT].split()})
    names = {getattr(toxicity, n): n for n in "PLAIN AIMED DENIED REPORTED THREAT REPORTED_THREAT".split()}
    assert [{names[k] for k in c} for c in grammar.clauses(text)] == kinds


def test_a_word_repeated_in_its_clause_counts_once():
    grammar = toxicity.Grammar({"idiot": 6.0})
    assert (grammar.features("idiot idiot idiot")[0] == grammar.features("idiot")[0]).all()
    assert grammar.features("idiot. idiot")[0][0] > grammar.features("idiot")[0][0]


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for d, r in got.items())
    said = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p == y for p, y in said) >= 0.95 * len(said) and sum(y for _, y in said) > 3


def test_labels_of_held_out_documents_change_nothing(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(labels["doc_id"]), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    first, second = (toxicity.train(docs, x) for x in (labels, turned))
    assert first.lexicon == second.lexicon and np.allclose(first.weights, second.weights) and first.base == second.base


def test_toxicity_of_odd_empty_and_unlabelled_rows(spark):
    labels = spark.createDataFrame([(1, 0, "x"), (2, 1, "x"), (2, 1, "x"), (3, 1, "x"), (3, 0, "x"), (None, 1, "x"), (7, None, "x"), (99, 1, "x")],
                                   "doc_id long, toxic int, text string")
    model = toxicity.train(odd(spark), labels)
    got = toxicity.score(odd(spark), model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score < 0.5 for r in got if r.n_clauses == 0)
    assert len({r.score for r in got if r.n_clauses == 0}) == 1
    nothing = toxicity.train(empty(spark), labels.limit(0))
    assert "idiot" in nothing.lexicon and toxicity.score(empty(spark), nothing).count() == 0
    rows = frame(spark, [(1, "You are an idiot, you moron.", "en", "a"), (2, "You are kind.", "en", "a")])
    assert {r.doc_id: r.predicted for r in toxicity.score(rows, nothing).collect()} == {1: 1, 2: 0}


def test_a_copied_toxic_text_does_not_fill_the_lexicon(spark):
    rng = random.Random(15)

    def word(n):
        return "".join(rng.choice("abcdefghij") for _ in range(n))
    base = [word(7) for _ in range(60)]
    rows, labels = [], []
    for k in range(400):
        if k % 4 == 0:  # near copies of one toxic text
            text = " ".join(w if rng.random() > 0.02 else word(7) for w in base)
        else:
            text = " ".join(word(5) for _ in range(40)) + (" blorgy" if k % 4 == 1 else "")
        rows.append((k, text, "en", "a"))
        labels.append((k, int(k % 4 in (0, 1))))
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    learned = {w for w, x in model.lexicon.items() if x != toxicity.PRIOR_LEXICAL}
    assert any("blorgy".startswith(w) for w in learned)
    assert sum(any(w.startswith(e) for e in learned) for w in base) <= 3


def test_every_pair_of_words_of_a_slice_is_found_once():
    part = collocations.Slice([b"a b. c  d\te", b"", b" f g"])
    data = part.data.tobytes()
    assert [data[part.start[k]:part.stop[k + 1]] for k in part.runs(2)] == [b"a b", b"c d", b"d e", b"f g"]
    assert [data[a:b] for a, b in pairwise([*part.base, len(data)])] == [b"a b c d e ", b"", b"f g "]

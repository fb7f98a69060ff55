"""Line dedup, sentence spans, quality rules and mixing on odd rows and against brute force."""

import re
from collections import Counter, defaultdict

from helpers import OWN, PASSAGE, empty, frame, odd, odd_rows
from pyspark.sql import functions as F

from evidence.llm import line_dedup, mixing, quality, queries, sentence_spans


def cut(docs, **k):
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, **k)).collect()
    return Counter(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out))


def test_lines_keep_first_occurrence(spark):
    rows = odd_rows()
    seen, want = set(), Counter()
    order = {}
    for r in spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "i int, doc_id long, text string") \
            .select("i", "doc_id", "text", F.xxhash64("text").alias("h")).collect():
        order[r.i] = (r.doc_id is not None, r.doc_id or 0, r.h)
    done = {}
    for i in sorted(range(len(rows)), key=lambda i: order[i]):
        d, text = rows[i][:2]
        if (d, text) in done:  # a repeated row has the result of the first
            want[done[d, text]] += 1
            continue
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").lower() if line.isascii() else line.strip(" \t\n\x0b\x0c\r")
            if not key or key not in seen:
                kept.append(line)
            if key:
                seen.add(key)
        done[d, text] = (d, len(lines), len(lines) - len(kept), "\n".join(kept))
        want[done[d, text]] += 1
    # documents of one text only repeat the passage: min_docs of 2 is any second document
    got = cut(odd(spark), min_docs=2)
    assert got == want


def test_lines_dropped_everywhere_and_long_bitmaps(spark):
    many = [(i, "\n".join([f"own {i} {k}" if k % 70 else "Common LINE " for k in range(400)]), "en", "a") for i in range(12)]
    got = cut(frame(spark, many), min_docs=10, keep_first=False)
    assert all(k[1:3] == (400, 6) and "Common" not in k[3] and k[3].count("\n") == 393 for k in got)
    few = cut(frame(spark, many[:9]), min_docs=10, keep_first=False)
    assert all(k[2] == 0 for k in few)


def test_lines_of_empty_table(spark):
    assert not cut(empty(spark), min_docs=2)


def sentences_by_hand(rows, span=3, least=10):
    pieces = [re.split(r"(?<=[.!?][\x20\x09-\x0D])|(?<=\n)", t or "") for _, t in rows]
    spans = defaultdict(list)
    for n, own in enumerate(pieces):
        real = [(i, p.strip(" \t\n\x0b\x0c\r")) for i, p in enumerate(own) if p.strip(" \t\n\x0b\x0c\r")]
        for k in range(len(real)):
            end = next((e for e in range(k + span, len(real) + 1) if sum(len(s.split()) for _, s in real[k:e]) >= least),
                       None if k else len(real))
            if end is not None:
                run = real[k:end]
                spans[tuple(s for _, s in run)].append((rows[n][0], n, run[0][0], [i for i, _ in run]))
    gone = defaultdict(set)
    for places in spans.values():
        for _, n, _, at in sorted(places)[1:]:
            gone[n].update(at)
    return {rows[n][0]: "".join(p for i, p in enumerate(own) if i not in gone[n]) for n, own in enumerate(pieces)}


def test_sentence_spans_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sentences_by_hand(rows)
    got = {r.doc_id: r for r in sentence_spans.drop_repeated_spans(docs).collect()}
    assert {d: r.kept_text for d, r in got.items()} == want
    assert sum(r.n_removed > 0 for r in got.values()) > 5


def test_op9_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.kept_text for r in queries.op9_sentence_spans(spark, sf).collect()}
    assert got == sentences_by_hand(rows, 2, 16)


def test_spans_of_any_number_of_words(spark):
    rows = [(1, "Milk.\nEggs.\nBread. \nSalt.\nmine", "en", "a"), (2, "STOP!! GO!! Eggs.\nBread.\nSalt.", "en", "a"),
            (3, "Milk.\nEggs.\nSalt.", "en", "a")]
    found = sentence_spans.drop_repeated_spans(frame(spark, rows), span=3, min_words=0).collect()
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in found}
    assert got == {1: (0, rows[0][1]), 2: (3, "STOP!! GO!! "), 3: (0, rows[2][1])}


def test_short_texts_and_other_scripts(spark, tmp_path):
    one, han = "one line of words " * 30, "他说：“你好。”我走了。天黑了！谁知道？"
    rows = [(1, one, "en", "a"), (2, f" {one}\n", "en", "a"), (3, f"{one} more", "en", "a"), (4, "Yes. No.", "en", "a"),
            (5, "Yes. No.\u3000", "en", "a"), (6, "Yes.", "en", "a"), (7, "No. Yes. No. Well.", "en", "a"),
            (8, han, "zh", "a"), (9, f"早。{han}晚。", "zh", "a"), (10, "क है। ख है। ग है।", "hi", "a"), (11, "नया। क है। ख है। ग है।", "hi", "a"),
            (12, '"A a." "B b!" (C c?) D', "en", "a"), (13, '"X." "A a." "B b!" (C c?) Y', "en", "a"), (14, "Q.\rR.\rS\r\nT", "en", "a")]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in sentence_spans.drop_repeated_spans(docs, span=3, min_words=0).collect()}
    changed = {2: "", 5: "", 9: "早。晚。", 11: "नया।", 13: '"X." Y'}
    assert {k: r.kept_text for k, r in got.items()} == {r[0]: changed.get(r[0], r[1]) for r in rows}
    n = {k: r.n_sentences for k, r in got.items()}
    assert (n[1], n[7], n[8], n[10], n[12], n[14]) == (1, 4, 4, 3, 4, 4)
    # two sentences with five words: characters of Chinese count as words
    two = {r.doc_id: r.kept_text for r in sentence_spans.drop_repeated_spans(docs, span=2, min_words=5).collect()}
    assert two[9] == "早。晚。" and two[2] == "" and two[7] == rows[6][1]


def test_sentence_spans_of_odd_rows(spark):
    got = sentence_spans.drop_repeated_spans(odd(spark)).collect()
    assert len(got) == len(odd_rows())
    # nulls come first: the passage stays with the row without id
    holders = [r.doc_id for r in got if PASSAGE in r.kept_text]
    assert holders == [None]
    assert Counter((r.doc_id, r.kept_text) for r in got if r.doc_id == 3)[3, OWN[2]] == 2
    assert sentence_spans.drop_repeated_spans(empty(spark)).count() == 0


def test_quality_measures(spark):
    five = "one two three four five"
    docs = frame(spark, [(1, f"{five} six {five} x {five}", "en", "a"), (2, None, None, None), (3, "", None, None),
                         (4, "a#b $ c\n\nsame line\nsame line\n \n", "en", "a"), (5, "the cat and the dog " * 400, "en", "a")])
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert (got[1].n_words, got[1].n_repeat_words) == (17, 15)
    assert (got[2].n_words, got[2].base_failed, got[2].kept, got[2].failed_rules) == (0, True, False, "")
    assert (got[4].n_symbols, got[4].n_lines, got[4].n_dup_lines, got[4].word_chars) == (2, 3, 1, 21)
    assert got[5].n_repeat_words == got[5].n_words == 2000
    assert quality.judge(odd(spark)).count() == len(odd_rows()) and quality.judge(empty(spark)).count() == 0


def test_overlapping_windows_are_counted_once(spark):
    text = " ".join(["a"] * 9)
    got = quality.measures(frame(spark, [(1, text, "en", "a"), (2, "a b c d e f", "en", "a")])).collect()
    assert {r.doc_id: r.n_repeat_words for r in got} == {1: 9, 2: 0}


def waterfill(sizes, weights, share, cap):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        full = [s for s in open_ if left * w[s] / total > cap * sizes[s]]
        if not full:
            return target | {s: left * w[s] / total for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= set(full)
    return target


def test_mixing_targets(spark):
    sizes = {"a": 1000, "b": 10, "c": 500, "d": 0, "é": 70, None: 300}
    t = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = waterfill(sizes, (5, 2, 1), 1.5, 2.0)
    got = {r.source: r.target for r in t.collect()}
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes) and len(got) == len(want)


def test_mixing_copies_and_rows(spark):
    docs = odd(spark)
    got = mixing.copies(docs).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.copies <= 2 for r in got)
    out = mixing.emit(docs)
    assert out.columns == docs.columns
    emitted = Counter(r.doc_id for r in out.collect())
    assert emitted == +Counter({d: sum(r.copies for r in got if r.doc_id == d) for d in {r.doc_id for r in got}})
    assert mixing.emit(empty(spark)).count() == 0 and mixing.copies(empty(spark)).count() == 0

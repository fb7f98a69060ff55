"""Chat, language, token files, decontamination, near copies and suffixes against brute force."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from helpers import LONG, OWN, PASSAGE, empty, frame, odd, odd_rows

from evidence.llm import chat, decontaminate, language_id, minhash, suffix_dedup, token_files
from evidence.session import shared_folder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("word_bpe_49k.json")


def test_chat_keeps_maximal_conversations(spark):
    a = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", None)]
    logs = {1: a[:1], 2: a[:3], 3: a, 4: a, 5: a[:2] + [("user", "other")], 6: [("user", "hi "), ("assistant", "hello")]}
    rows = [(c, t, r, x, "q") for c, ms in logs.items() for t, (r, x) in enumerate(ms)]
    rows += [rows[0], (None, 0, "user", "alone", "q"), (None, 0, "user", "alone", "q"), (None, 7, "user", "hi", "q"),
             (7, None, None, None, "q")]
    got = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, p1 string")).collect()
    assert sorted((r.conv_id or 0, r.n_turns) for r in got) == [(0, 1), (3, 4), (5, 3), (6, 2), (7, 1)]
    three = next(r.rendered for r in got if r.conv_id == 3)
    assert three.startswith("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello") and three.count("<|im_end|>\n") == 4
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.render(none).count() == 0


def ways(word, pieces):
    if not word:
        return [[]]
    return [[word[:n], *rest] for n in range(1, len(word) + 1) if word[:n] in pieces for rest in ways(word[n:], pieces)]


def test_forward_sums_all_segmentations():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    number = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (
        model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    v = language_id.Vocabulary(PIECES)
    rng = np.random.default_rng(3)
    logp = np.log(rng.dirichlet(np.ones(v.size), 2))
    some = ["hello", "Straße", "a", "nation", "xqz", "été"]
    lattice = v.lattice(some)
    got = lattice.forward(logp)[lattice.tails]
    uses = np.zeros(v.size)
    for k, w in enumerate(some):
        for lang in (0, 1):
            cuts = ways("▁" + w, number)
            probs = [np.exp(sum(logp[lang, number[p]] for p in c)) for c in cuts]
            assert abs(got[k, lang] - np.log(sum(probs))) < 1e-9
            if lang == 0:
                for c, p in zip(cuts, probs, strict=True):
                    for piece in c:
                        uses[number[piece]] += p / sum(probs)
    assert np.allclose(lattice.expected(logp[0], np.ones(len(some))), uses)


def test_unknown_characters_and_long_words_have_a_score():
    v = language_id.Vocabulary(PIECES)
    lattice = v.lattice(["\U0001F9FF" * 3, "ab" * 3000])
    got = lattice.forward(np.full((1, v.size), -np.log(v.size)))[lattice.tails]
    assert np.isfinite(got).all()


def test_language_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language_id.predict(docs, language_id.train(docs, PIECES)).join(docs.select("doc_id", "lang", "n_chars"), "doc_id") \
        .filter("held_out AND n_chars > 30").collect()
    assert got and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(spark):
    docs = odd(spark)
    model = language_id.train(docs, PIECES)
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(odd_rows())
    said = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (4, 5, 6, 10)}
    assert set(said.values()) == {("und", 0.0)}
    kept = language_id.keep_languages(docs, model, min_score=0.0)
    assert kept.columns == docs.columns and {4, 5, 6, 10}.isdisjoint({r.doc_id for r in kept.collect()})
    nothing = language_id.train(empty(spark), PIECES)
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(empty(spark), nothing).count() == 0


def test_tokens_equal_whole_text_encoding(spark, sf):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(BPE)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder = shared_folder(spark, "tokens")
    token_files.write(docs, folder, BPE)
    got = {r.doc_id: r for r in token_files.read(spark, folder).collect()}
    at = 0
    for r in docs.select("doc_id", "text").orderBy("doc_id").collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 1]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens) == (at, len(ids))
        assert got[r.doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_words_encode_like_their_text():
    from tokenizers import Tokenizer
    whole, own = Tokenizer.from_file(BPE), token_files.WordEncoder(BPE, remembered=3)
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(["a", "É", "é", "'s", " ", "\n", " ", "\x1c", " ", "7", "<|endoftext|>", "漢", "!?", "̸"])
                       for _ in range(rng.randrange(12)))
        assert own.encode([text.encode()])[0] == np.array(whole.encode(text, add_special_tokens=False).ids, own.dtype).tobytes(), repr(text)


def test_token_files_of_odd_rows(spark):
    folder = shared_folder(spark, "tokens")
    manifest = token_files.write(odd(spark), folder, BPE)
    got = token_files.read(spark, folder).collect()
    assert len(got) == len(odd_rows()) and sum(r.n_tokens for r in got) == manifest["n_ids"]
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id is not None for r in ordered] == sorted(r.doc_id is not None for r in got)
    assert all(a.start + a.n_tokens == b.start for a, b in pairwise(ordered))
    assert sorted(r.n_tokens for r in got if r.doc_id in (4, 5, 6)) == [1, 1, 1]
    none = shared_folder(spark, "tokens")
    assert token_files.write(empty(spark), none, BPE)["files"] == [] and token_files.read(spark, none).count() == 0


def hits(text, items, window=10):
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, found, best = low(text), set(), set(), 0
    for i, t in items:
        x = low(t)
        n = min(window, len(x))
        for o in range(len(x) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == x[o:o + n]:
                    hit.update(range(p, p + n))
                    found.add(str(i))
                    k = n
                    while o + k < len(x) and p + k < len(w) and x[o + k] == w[p + k]:
                        k += 1
                    best = max(best, k)
    return len(w), len(hit), sorted(found), best


@pytest.mark.parametrize("block_bytes", [1 << 20, 120])
def test_decontamination_against_brute_force(spark, block_bytes):
    rng = random.Random(1)
    word = lambda: rng.choice(["a", "b", "c", "the", "é7", "Z"])
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([4, 12, 30, 9, 10])]
    items += [(90, None), (91, " .. "), (92, items[1][1]), (None, "unique item words that nobody else has ever said here before")]
    rows = [(d, " ".join(word() for _ in range(60))) for d in range(20)]
    rows += [(50, f"x {items[2][1].upper()}, y"), (51, items[1][1].replace(" ", "\n-")), (52, None), (53, ""), (53, items[3][1]),
             (None, items[4][1]), (54, items[8][1])]
    docs = frame(spark, [(*r, "en", "a") for r in rows]).repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.items), r.longest) for r in
                  decontaminate.scan(docs, bench, block_bytes=block_bytes).collect())
    want = Counter()
    for d, t in rows:
        n, h, f, best = hits(t, [("" if i is None else i, x) for i, x in items])
        want[d, n, h, tuple(f), best] += 1
    strip = lambda c: Counter({k[:4]: v for k, v in c.items()})
    assert strip(got) == strip(want)
    assert all(k[4] >= 4 for k in got if k[2])
    clean = decontaminate.remove_contaminated(docs, bench, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(k[0] for k in want.elements() if not k[2])


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(empty(spark), none).count() == 0
    assert {r.n_hit for r in decontaminate.scan(odd(spark), none).collect()} == {0}
    assert decontaminate.remove_contaminated(odd(spark), none).count() == len(odd_rows())


def test_longest_match_and_its_place(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = frame(spark, [(1, f"zero {item} thirteen", "en", "a"), (2, item[:-7], "en", "a")])
    got = {r.doc_id: r for r in decontaminate.scan(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert (got[1].longest, got[1].longest_at, got[1].spans) == (12, 1, [1, 13])
    assert (got[2].longest, got[2].longest_at, got[2].spans) == (11, 0, [0, 11])


def near(rows, width, percent):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        n = min(width, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return sets, group


def variants():
    """A chain, in which only neighbours are near, a star around a text, and groups in between."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows, n = [], 0
    for step in range(25):
        base[step * 4] = f"v{step}"
        rows.append((n, " ".join(base)))
        n += 1
    star = [f"s{rng.randrange(10**6)}" for _ in range(150)]
    for k in range(40):
        own = list(star)
        for _ in range(1 + k % 5):
            own[rng.randrange(150)] = f"o{rng.randrange(10**6)}"
        rows.append((1000 - k, " ".join(own)))
    half = [f"h{rng.randrange(10**6)}" for _ in range(100)]
    for k in range(30):
        rows.append((2000 + k, " ".join([*half, *[f"g{k // 3}x{i}" for i in range(25)]])))
    return rows + [(3000, rows[0][1]), (3001, rows[30][1])]


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_copies_against_brute_force(spark, width, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = variants()
    _, group = near(rows, width, percent)
    want = {d: min(rows[k][0] for k in range(len(rows)) if group[k] == group[i]) for i, (d, _) in enumerate(rows)}
    got = minhash.groups(frame(spark, [(*r, "en", "a") for r in rows]).repartition(3), width, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_buckets_are_compared_beyond_their_leader(spark):
    # b and c are near, d is near neither of them
    rng = np.random.default_rng(0)
    sig = rng.integers(0, 1 << 32, 120, dtype=np.uint32).astype("<u4").tobytes()
    one, two, far = np.arange(100, dtype=np.uint64), np.arange(5, 100, dtype=np.uint64), np.arange(60, 160, dtype=np.uint64)
    names = [b"b", b"c", b"d"]
    classes = spark.createDataFrame([(k, sig) for k in names], "class binary, signature binary")
    sets = spark.createDataFrame([(k, s.tobytes()) for k, s in zip(names, (one, two, far), strict=True)], "class binary, own binary")
    members = spark.createDataFrame([(5, k, k, 3) for k in names], "bucket long, class binary, label binary, n long")
    got = minhash.compared(members, classes, sets, 80, 120, 1e-6).collect()
    assert [(bytes(r.a), bytes(r.b)) for r in got] == [(b"b", b"c")]


def test_near_copies_of_odd_rows(spark):
    docs = odd(spark)
    got = minhash.groups(docs).collect()
    assert len(got) == len(odd_rows())
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id in (4, 5, 6)} == {(0, 4), (0, 5), (0, 6)}
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    seen = Counter(r.doc_id for r in kept.collect())
    assert seen[3] == 2 and seen[4] == seen[5] == seen[6] == 1 and sum(seen.values()) == len(odd_rows()) - 1
    assert minhash.groups(empty(spark)).count() == 0 and minhash.keep_one(empty(spark)).count() == 0


def test_prune_bounds():
    for n, m in minhash.least_matches(85, 120, 1e-6):
        assert 0 < m < 0.85 * n
    assert 120 // minhash.band_rows(85, 120, 1e-6) * minhash.band_rows(85, 120, 1e-6) <= 120
    assert (1 - 0.85 ** minhash.band_rows(85, 120, 1e-6)) ** (120 // minhash.band_rows(85, 120, 1e-6)) <= 1e-6


def repeats(rows, length):
    seen, out = set(), {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(b[p:p + length])
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeated_strings_against_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    shared = [text(n) for n in (100, 101, 130, 260, 99)]
    rows = []
    for d in range(40):
        parts = [text(rng.randrange(200))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(shared), text(rng.randrange(60))]
        rows.append((d, "".join(parts)))
    rows += [(50, "a" * 500), (51, "ab" * 300), (52, None), (53, rows[3][1]), (54, "x" * 99), (55, rows[3][1][:-1])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in
           suffix_dedup.remove_repeats(frame(spark, [(*r, "en", "a") for r in rows]).repartition(3)).collect()}
    assert got == repeats(rows, 100)


def test_transform_of_a_collection():
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 12))) for _ in range(9)]
    size = np.array([len(t) for t in texts])
    got = suffix_dedup.ranks(*suffix_dedup.transform(texts), size)
    suffixes = [(t[p:], k) for k, t in enumerate(texts) for p in range(len(t))]
    order = sorted(range(len(suffixes)), key=lambda i: suffixes[i])
    assert np.argsort(got).tolist() == order


def test_repeated_strings_of_odd_rows(spark):
    got = suffix_dedup.remove_repeats(odd(spark)).collect()
    assert len(got) == len(odd_rows())
    by = {(r.doc_id, r.n_bytes): r for r in got}
    assert by[None, len(f"{OWN[2]}\n{PASSAGE}")].n_removed == 0
    assert by[1, len(f"{OWN[0]}\n{PASSAGE}")].n_removed >= len(PASSAGE)
    assert by[7, len(LONG)].kept.decode() == LONG and by[4, 0].kept == b""
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_manifest_lists_bases(spark, tmp_path):
    token_files.write(frame(spark, [(d, f"t {d}", "en", "a") for d in range(50)]).repartition(5), f"file://{tmp_path}/t", BPE)
    files = json.loads((tmp_path / "t" / "manifest.json").read_text())["files"]
    assert [f["base"] for f in files] == [sum(g["n_ids"] for g in files[:k]) for k in range(len(files))]

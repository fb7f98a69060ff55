"""Token ids as flat binary files with 64-bit document offsets, written and read by tasks.

A file set is a folder. Each range of documents (ascending doc_id, then text hash; null ids
first) makes three files: ``.bin`` the ids, little-endian unsigned, 16 bits wide where the
vocabulary allows it, else 32; ``.idx`` n + 1 unsigned 64-bit offsets in ids; ``.doc`` the
signed 64-bit doc_ids. ``manifest.json`` lists the files of the successful attempts, one
entry per range, with the running sum of ids before each (its base) and the null ids that
lead it. Names carry the attempt, so a task that is run again never touches another's file,
and files that the manifest does not list are not part of the set.

Encoding is per white-space separated word, which this tokenizer cannot merge across, and
punctuation behind a letter is encoded by itself, as the tokenizer does. A worker process
remembers words up to a bound, over all its tasks, and then starts anew.

Only the manifest (one entry per range) passes the driver. Readers map local files into
memory; other stores that pyarrow knows are read by file.

Defined cases: null text is empty and yields the end id alone. Rows with equal ids, also
fully repeated ones, are documents of their own, ordered by text hash. An empty table gives
an empty manifest and no file. Extra columns are left out.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from evidence.llm.base import keyed
from evidence.llm.graph import store

END_ID = 1
REMEMBERED_BYTES = 96 << 20
#: a dictionary entry and two short bytes objects, without what they hold
ENTRY_BYTES = 170
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TOGETHER = 256
#: ends that the tokenizer splits from a letter before them
TAIL = b",.!?;:"
ROWS_OUT = 8192
TEXTS = 128
MANIFEST = "part int, stem string, n_docs long, n_null long, n_ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


class WordEncoder:
    """Ids of UTF-8 texts as bytes in the file's integer type."""

    def __init__(self, tokenizer_file: str, remembered: int = REMEMBERED_BYTES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.code = "H" if self.dtype == "<u2" else "I"
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool) if suffix else None
        for token, number in self.tokenizer.get_vocab().items() if suffix else ():
            self.last[number] = token.endswith(suffix)
        normalizer = self.tokenizer.normalizer
        self.lower = normalizer is not None and normalizer.normalize_str(LETTERS) == LETTERS.lower()
        self.known: dict[bytes, bytes] = {}
        #: estimated bytes of what is known, and how much of it is kept
        self.size, self.remembered = 0, remembered

    def learn(self, words: Iterable[bytes]) -> None:
        self.known[b""] = b""
        letters, tailed, rest = [], [], []
        for w in words:
            if w.isalpha():
                letters.append(w)
            else:
                stem = w.rstrip(TAIL)
                if len(stem) < len(w) and stem and (stem.isalpha() or stem.decode("utf-8", "replace")[-1].isalpha()):
                    tailed.append((w, stem))
                else:
                    rest.append(w)
        # the two parts of a word with a tail encode apart
        parts = {p for w, stem in tailed for p in (stem, w[len(stem):])}.difference(self.known, letters, rest)
        for p in parts:
            (letters if p.isalpha() else rest).append(p)
        if self.last is None:
            rest += letters
        else:
            wide = [w for w in rest if w.decode("utf-8", "replace").isalpha()]
            rest = [*set(rest).difference(wide), *self.learn_letters(letters), *self.learn_letters(wide)]
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        for at in range(0, len(rest), 20_000):
            some = rest[at:at + 20_000]
            done = encode([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)
            self.remember(some, [struct.pack(f"<{len(e)}{self.code}", *e.ids) for e in done])
        self.remember([w for w, _ in tailed], [self.known[x] + self.known[w[len(x):]] for w, x in tailed])

    def remember(self, words: list[bytes], ids: list[bytes]) -> None:
        self.known.update(zip(words, ids, strict=True))
        self.size += ENTRY_BYTES * len(words) + sum(map(len, words)) + sum(map(len, ids))

    def learn_letters(self, words: list[bytes]) -> list[bytes]:
        """Learn words of letters many at a time, cut where a token ends a word; returns the rest."""
        rest = []
        groups = [words[a:a + TOGETHER] for a in range(0, len(words), TOGETHER)]
        texts = [b" ".join(g).decode("utf-8", "replace") for g in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.dtype)
            stops = ((np.flatnonzero(self.last[ids]) + 1) * ids.itemsize).tolist()
            if len(stops) != len(group):  # lower case made more than letters of one of them
                rest += group
                continue
            raw = ids.tobytes()
            self.remember(group, [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)])
        return rest

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.size > self.remembered:
            self.known.clear()
            self.size = 0
        # bytes.lower() changes ASCII letters only, which the tokenizer does as well
        split = [t.lower().split() for t in texts] if self.lower else [t.split() for t in texts]
        new = set().union(*split).difference(self.known)
        if new:
            self.learn(new)
        ids = self.known.__getitem__
        return [b"".join(map(ids, words)) for words in split]


@lru_cache(maxsize=1)
def loaded(file: str) -> WordEncoder:
    """One encoder per worker process."""
    return WordEncoder(file)


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def write(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = END_ID) -> dict:
    """Encode every text and write the file set; returns the manifest."""
    spark = docs.sparkSession

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer_file)
        end = np.array([end_id], encoder.dtype).tobytes()
        width = len(end)
        fs, path = store(folder)
        context = TaskContext.get()
        stem = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        files, n_docs, n_null, n_ids = {}, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if not files:
                files = {k: fs.open_output_stream(f"{path}/{stem}.{k}") for k in ("bin", "idx", "doc")}
                files["idx"].write(np.zeros(1, "<u8").tobytes())
            named = batch.column("doc_id")
            n_null += named.null_count
            files["doc"].write(named.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                               .astype("<i8").tobytes())
            lengths = np.empty(batch.num_rows, np.uint64)
            texts = batch.column("text").cast(pa.binary())
            for a in range(0, len(texts), TEXTS):
                ids = encoder.encode([t.as_py() or b"" for t in texts.slice(a, TEXTS)])
                lengths[a:a + len(ids)] = [len(x) // width + 1 for x in ids]
                files["bin"].write(end.join([*ids, b""]))
            offsets = np.cumsum(lengths, dtype=np.uint64) + np.uint64(n_ids)
            files["idx"].write(offsets.astype("<u8").tobytes())
            n_docs, n_ids = n_docs + batch.num_rows, int(offsets[-1])
        for f in files.values():
            f.close()
        if n_docs:
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([context.partitionId()], pa.int32()), "stem": [stem],
                 "n_docs": [n_docs], "n_null": [n_null], "n_ids": [n_ids]})

    fs, path = store(folder)
    fs.create_dir(path, recursive=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed(docs).repartitionByRange(parts, "doc_id", "text_hash") \
        .sortWithinPartitions("doc_id", "text_hash", "text").select("doc_id", "text")
    rows = sorted(ordered.mapInArrow(partition, MANIFEST).collect())
    kind, base, listed = loaded(tokenizer_file).dtype, 0, []
    for r in rows:
        listed.append({**r.asDict(), "base": base})
        base += r["n_ids"]
    manifest = {"dtype": kind, "end_id": end_id, "n_ids": base, "files": listed}
    with fs.open_output_stream(f"{path}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def mapped(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_manifest(folder: str) -> dict:
    fs, path = store(folder)
    with fs.open_input_file(f"{path}/manifest.json") as f:
        return json.loads(f.read())


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of a file set, from its files."""
    manifest = read_manifest(folder)
    dtype = manifest["dtype"]

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                at = f"{path}/{row['stem']}"
                ids, idx = mapped(fs, f"{at}.bin", dtype), mapped(fs, f"{at}.idx", "<u8").astype(np.int64)
                names = mapped(fs, f"{at}.doc", "<i8")
                for a in range(0, row["n_docs"], ROWS_OUT):
                    b = min(a + ROWS_OUT, row["n_docs"])
                    sums = [zlib.crc32(ids[idx[k]:idx[k + 1]].astype("<u4").tobytes()) for k in range(a, b)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(np.array(names[a:b], np.int64), mask=np.arange(a, b) < row["n_null"]),
                        "start": pa.array(idx[a:b] + row["base"]),
                        "n_tokens": pa.array(idx[a + 1:b + 1] - idx[a:b]),
                        "ids_crc32": pa.array(sums, pa.int64())})

    rows = [(f["part"], f["stem"], f["n_docs"], f["n_null"], f["base"]) for f in manifest["files"]]
    listed = spark.createDataFrame(rows, "part int, stem string, n_docs long, n_null long, base long")
    if rows:
        listed = listed.repartitionByRange(len(rows), "part")
    return listed.mapInArrow(files, READ)

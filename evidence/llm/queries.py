"""The operators bound to the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidence.llm import (
    chat,
    collocations,
    decontaminate,
    hard_negatives,
    language_id,
    line_dedup,
    minhash,
    mixing,
    quality,
    sentence_spans,
    suffix_dedup,
    token_files,
    toxicity,
)
from evidence.llm.base import table
from evidence.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: the six white-space characters, for trim() in SQL
SQL_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def bound(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f
    return add


@bound(f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, translate(trim(line, {SQL_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (o.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN often o ON k.key = o.key GROUP BY doc_id""")
def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that occur in ten documents or more go everywhere."""
    docs = table(spark, sf, "documents")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, min_docs=10, keep_first=False))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@bound(r"""
WITH s AS (SELECT doc_id, source,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, text
           FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size, 
             [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
      FROM s GROUP BY source),
q AS (SELECT *, 2.0 * source_size::DOUBLE AS cap,
             1.5 * (sum(source_size) OVER ())::DOUBLE AS total FROM p),
lv AS (SELECT a.source, (a.total - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight
                         OR b.cap / b.weight = a.cap / a.weight AND b.source < a.source), 0))
        / sum(b.weight) FILTER (NOT (b.cap / b.weight < a.cap / a.weight
                         OR b.cap / b.weight = a.cap / a.weight AND b.source < a.source)) AS level,
        any_value(a.cap) AS cap, any_value(a.weight) AS weight
       FROM q a, q b GROUP BY a.source, a.total, a.cap, a.weight),
best AS (SELECT arg_min(level, cap / weight) AS level FROM lv WHERE cap >= weight * level),
t AS (SELECT source, source_size, least(cap, coalesce(weight * best.level, cap)) AS target
      FROM q, best),
r AS (SELECT s.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
             ('0x' || md5('17|' || doc_id || '|' || md5(coalesce(text, '')))[1:13])::BIGINT
               / 4503599627370496.0::DOUBLE AS u
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM r""")
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words taken from each document so that sources stand 5 : 2 : 1, at 150 % of all words."""
    mixed = mixing.copies(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)


@bound(rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)),
                         lambda x: length(trim(x, {SQL_WHITE})) > 0) AS ls,
             coalesce(text, '') AS text FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i,
             unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) AS five
      FROM w WHERE len(w) >= 5),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM h WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(ls)::BIGINT AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words,
        len(list_filter(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                                IN ({_STOP})))::BIGINT AS n_stop_words
      FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        concat_ws(',',
          CASE WHEN n_words > 0 AND NOT word_chars / n_words BETWEEN 2.0 AND 15.0 THEN 'word_length' END,
          CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
          CASE WHEN n_words > 0 AND n_stop_words / n_words < 0.02 THEN 'stop_words' END,
          CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'repeated_lines' END) AS failed_rules
      FROM m)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM b""")
def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, base rules and the verdict of the threshold table for every document."""
    return quality.judge(table(spark, sf, "documents"))


@bound()
def op9_sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of a repeated run of two or more with sixteen words are removed but for the first run."""
    return sentence_spans.drop_repeated_spans(table(spark, sf, "documents"), span=2, min_words=16)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path(name)


@bound()
def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every text, learned from the documents that are not held out."""
    docs = table(spark, sf, "documents")
    model = language_id.train(docs, vocabulary("piece_bpe_32k.model"))
    return language_id.predict(docs, model)


@bound()
def op3_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's place in the token files, read back from them."""
    folder = shared_folder(spark, "tokens")
    token_files.write(table(spark, sf, "documents"), folder, vocabulary("word_bpe_49k.json"))
    return token_files.read(spark, folder)


@bound(r"""
WITH low AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
             FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
               array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n,
            unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS k,
            unnest(range(1, len(w) - n + 2)) AS i
          FROM low, sizes WHERE len(w) >= n),
found AS (SELECT g.doc_id, g.i, g.n, win.item_id FROM grams g JOIN win ON g.n = win.n AND g.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
         FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM found) GROUP BY doc_id)
SELECT low.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN hit ON low.doc_id = hit.doc_id LEFT JOIN item ON low.doc_id = item.doc_id""")
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of each document inside ten words running of a benchmark item."""
    found = decontaminate.scan(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@bound(r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
         JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
         WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
         GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON c.doc_id = n.doc_id""")
def op6_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles are 85 % alike."""
    found = minhash.groups(table(spark, sf, "documents"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@bound("""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, count(*) AS n, list('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)
             ORDER BY turn NULLS FIRST) AS m FROM t GROUP BY conv_id),
once AS (SELECT min(conv_id) AS conv_id, n, m FROM c GROUP BY n, m),
inner_ AS (SELECT DISTINCT m[1:k] AS p FROM (SELECT m, unnest(range(1, n)) AS k FROM once))
SELECT conv_id, n AS n_turns, array_to_string(m, '') AS rendered FROM once ANTI JOIN inner_ ON once.m = inner_.p""")
def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """The conversations that are no snapshot of a longer one, rendered."""
    return chat.render(table(spark, sf, "conversations"))


@bound()
def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes covered by a string of 100 that starts earlier are removed."""
    kept = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@bound("""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10""")
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of other labels that score below an anchor's positives but not far below."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(table(spark, sf, "embeddings"), lambda vec_id: vec_id % 100 == 0, label)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@bound(r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, s, unnest(list_transform(range(1, len(w) - s + 2),
                                            lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) v(s) WHERE len(w) >= s),
f AS MATERIALIZED (SELECT lang, s, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE s = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE s > 1 AND a >= 10),
l AS (SELECT lang, phrase, max(a) AS a FROM (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
        FROM c WHERE s = 3) GROUP BY ALL),
k AS (SELECT c.lang, c.phrase, c.a, unnest(range(1, s)) AS k, w FROM c LEFT JOIN l ON c.lang = l.lang AND c.phrase = l.phrase
      WHERE l.a IS NULL OR 100 * l.a < 50 * c.a),
x AS (SELECT k.lang, k.phrase, k.a, k, h.a AS l, t.a AS r,
             ((1000000::HUGEINT * k.a * k.a) // (h.a::HUGEINT * t.a))::BIGINT AS score
      FROM k JOIN f h ON h.lang = k.lang AND h.phrase = array_to_string(k.w[1:k.k], ' ')
             JOIN f t ON t.lang = k.lang AND t.phrase = array_to_string(k.w[k.k + 1:], ' ')
      QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k) = 1)
SELECT x.lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM x JOIN n ON x.lang = n.lang
WINDOW o AS (PARTITION BY x.lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000""")
def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The phrases of each language whose parts seldom occur without each other."""
    return collocations.mine(table(spark, sf, "documents")).drop("cut")


@bound()
def op13_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every text, learned from the labels of documents that are not held out."""
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels")))

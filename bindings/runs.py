"""Runs on disk: committed parts, resumes, forced runs, broken-off attempts, streams of arrivals."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence.operators import chunks, hierarchy, records, screen
from evidence.plans import acquire, extract, pack, prescreen, report, rounds
from evidence.session import shared_folder
from evidence.sources import commits, sinks
from evidence.streaming import incremental

from .corpus import _CLEAN, xml_records
from .extraction import _SHARD, ONE_MODEL, documents, order_sources, two_answers
from .frames import ARTICLES_SQL, DOCUMENT_SQL, ENTITY_SQL, REVIEW_SQL, articles, with_answers
from .registry import bound, table
from .screening import _OUTCOMES, RULES, screening_responses

# Every document of a run must be there once, whichever way the run came about. In the SQL each
# state is simply all orders.
_STATES = ("resumed", "forced", "broken off")


def _half(source):
    return source.filter(F.trim("pmid").cast("bigint") % 2 == 0)


def _run_states(spark, sf, base):
    """A run over half of the orders, resumed with all; then forced; then an attempt that breaks off."""
    source, said = order_sources(spark, sf), two_answers(spark, sf)
    extract.run_extract(_half(source), said, base, "r", settings=ONE_MODEL)
    extract.run_extract(source, said, base, "r", resume=True, settings=ONE_MODEL)
    yield "resumed"
    extract.run_extract(source, said, base, "r", force=True, settings=ONE_MODEL)
    yield "forced"
    # breaks off after its streams are written: there is no commit
    own = commits.begin(spark, base, "extract", "r")
    extract.write_part(own, _half(source), said, settings=ONE_MODEL)
    yield "broken off"


def _in_states(spark, sf, read):
    base, out = shared_folder(spark, "committed"), None
    for state in _run_states(spark, sf, base):
        # what a state shows is kept: the next one removes the folders it replaces
        now = sinks.stage_rows(read(base), f"{base}/seen", state.replace(" ", "_")).withColumn("state", F.lit(state))
        out = now if out is None else out.unionByName(now)
    return out


@bound(f"""SELECT s.state, CAST(k AS VARCHAR) AS pmid, {_SHARD} AS shard, sub, {REVIEW_SQL} AS needs_review
  FROM ({DOCUMENT_SQL}), (VALUES {', '.join(f"('{s}')" for s in _STATES)}) s(state)""")
def committed_documents(spark, sf):
    """The documents of a run as its readers see them after each step."""
    return _in_states(spark, sf, lambda base: extract.read_stream(spark, base, "r").select(
        "pmid", "shard", F.col("doc.article_level.primary_subspecialty").alias("sub"), "needs_review"))


@bound(f"""WITH t AS (SELECT {_SHARD} AS shard, k, parsed, {REVIEW_SQL} AS review FROM ({DOCUMENT_SQL}))
  SELECT * FROM (
    SELECT 'resumed' AS state, shard, count(*) FILTER (WHERE k % 2 = 0) AS total, count(*) FILTER (WHERE k % 2 = 0) AS scheduled,
      count(*) FILTER (WHERE k % 2 = 0 AND parsed) AS ok, count(*) FILTER (WHERE k % 2 = 0 AND review) AS review,
      count(*) FILTER (WHERE k % 2 = 0 AND NOT parsed) AS errors FROM t GROUP BY ROLLUP (shard)
    UNION ALL SELECT 'resumed', shard, count(*), count(*) FILTER (WHERE k % 2 = 1), count(*) FILTER (WHERE k % 2 = 1 AND parsed),
      count(*) FILTER (WHERE k % 2 = 1 AND review), count(*) FILTER (WHERE k % 2 = 1 AND NOT parsed) FROM t GROUP BY ROLLUP (shard)
    UNION ALL SELECT state, shard, count(*), count(*), count(*) FILTER (WHERE parsed), count(*) FILTER (WHERE review),
      count(*) FILTER (WHERE NOT parsed) FROM t, (VALUES ('forced'), ('broken off')) s(state) GROUP BY state, ROLLUP (shard))""")
def committed_totals(spark, sf):
    """The totals that count after each step: of two parts, then of the one that replaced them."""
    return _in_states(spark, sf, lambda base: extract.read_totals(spark, base, "r").drop("part"))


@bound(f"""SELECT outcome, count(*) AS n, count(*) FILTER (WHERE outcome = 'error') AS whole_texts
  FROM ({_OUTCOMES}) GROUP BY outcome""")
def resumed_screening(spark, sf):
    """A prescreen over half of the articles, resumed twice without naming a part."""
    base, source, said = shared_folder(spark, "prescreen"), articles(spark, sf), screening_responses(spark, sf)
    prescreen.run_prescreen(source.filter("doc_id % 2 = 0"), said, base, "r", RULES)
    for _ in range(2):
        prescreen.run_prescreen(source, said, base, "r", RULES, resume=True)
    kept = prescreen.read_outcomes(spark, base, "r")
    return kept.groupBy("outcome").agg(
        F.count("*").alias("n"), F.count("error_text").alias("whole_texts"))


# --- arrivals -----------------------------------------------------------------------------------
#
# First two thirds of the documents arrive; then the last two thirds, so that one third comes twice.

_ARTICLE_COLUMNS = ("pmid", "title", "abstract", "journal", "pub_date", "publication_types")


def _arrivals(spark, sf, base):
    rows = articles(spark, sf).withColumn("third", F.col("doc_id") % 3)
    for condition in ("third < 2", "third > 0"):
        sinks.write_jsonl(rows.filter(condition).select(*_ARTICLE_COLUMNS), f"{base}/in")
        yield


def _ingest(spark, base, **more):
    incremental.ingest(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", glob="*.json", by="none", **more).awaitTermination()


@bound("SELECT CAST(doc_id AS VARCHAR) AS pmid, source AS journal, length(text) AS chars FROM documents")
def repeated_arrivals(spark, sf):
    """Every id once, though a third of them arrive twice; the index is merged in between."""
    base = shared_folder(spark, "intake")
    for _ in _arrivals(spark, sf, base):
        _ingest(spark, base)
        incremental.compact_ids(spark, f"{base}/out")
    return incremental.read_ingested(spark, f"{base}/out").select("pmid", "journal", F.char_length("abstract").cast("long").alias("chars"))


@bound("""WITH t AS (SELECT count(*) AS n, count(*) FILTER (WHERE doc_id % 3 < 2) AS a, count(*) FILTER (WHERE doc_id % 3 > 0) AS b FROM documents)
  SELECT 1 AS generation, FALSE AS live, a AS rows, CAST(0 AS BIGINT) AS without_id, a AS written FROM t
  UNION ALL SELECT 1, FALSE, b, 0, n - a FROM t UNION ALL SELECT 2, TRUE, a + b, 0, n FROM t""")
def intake_progress(spark, sf):
    """What the batches of two runs and of a forced third one counted."""
    base = shared_folder(spark, "intake")
    for _ in _arrivals(spark, sf, base):
        _ingest(spark, base)
    _ingest(spark, base, force=True)
    return incremental.progress_table(spark, f"{base}/out").select(
        F.col("generation").cast("int").alias("generation"), "live", "rows", "without_id", "written")


# orders whose customer key is their own key, so that a prompt's record key gives its answer
_SELF_SQL = DOCUMENT_SQL.replace("FROM orders", "FROM (SELECT o_orderkey, o_orderkey AS o_custkey, o_orderdate, o_orderpriority FROM orders)")


def _respond(prompts):
    k = F.col("record_key").cast("bigint")
    rows = with_answers(prompts.select("record_key"), k, k)
    return rows.select(
        F.col("record_key").alias("pmid"), F.lit("m1").alias("model"), F.lit(1).alias("pass"), F.lit(1).alias("attempt"),
        F.when(k % 23 == 7, 500).otherwise(200).alias("status"), "content")


@bound(f"""SELECT unnest(CASE WHEN {REVIEW_SQL} THEN ['extracted', 'review'] ELSE ['extracted'] END) AS stream,
    CAST(k AS VARCHAR) AS pmid, sub, n_models, CAST(confidence AS INT) AS confidence FROM ({_SELF_SQL})""")
def streamed_extraction(spark, sf):
    """Documents and review rows of two arrivals, a third of which comes twice: those of one batch run."""
    base = shared_folder(spark, "streamed")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("pmid"), F.lit("t").alias("title"), F.lit("a").alias("abstract"),
        F.col("o_orderpriority").alias("journal"), (F.col("o_orderkey") % 3).alias("third"))
    for condition in ("third < 2", "third > 0"):
        sinks.write_jsonl(rows.filter(condition).drop("third"), f"{base}/in")
        incremental.extract_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", _respond, "*.json",
                                   extract.RunSettings(primary_model="m1", scope="global")).awaitTermination()
    a, out = F.col("doc.article_level"), []
    for stream in ("extracted", "review"):
        out.append(incremental.read_extracted(spark, f"{base}/out", stream).select(
            F.lit(stream).alias("stream"), "pmid", a["primary_subspecialty"].alias("sub"),
            a["number_of_models_described"].alias("n_models"),
            F.col("doc.normalization.overall_extraction_confidence").alias("confidence")))
    return out[0].unionByName(out[1])


# --- acquisition ----------------------------------------------------------------------------------
#
# Record files of two arrivals, the second of which repeats some records of the first.

_ACQUIRED_SQL = f"""SELECT *, CASE WHEN count(*) OVER (PARTITION BY late, substr(day, 1, 7)) <= 3 THEN substr(day, 1, 7) ELSE day END AS chunk
  FROM (SELECT *, doc_id % 3 = 2 AS late, CASE WHEN doc_id % 4 = 3 THEN substr(pub_date, 1, 4) || '-01-01' WHEN doc_id % 4 = 0 THEN pub_date
    ELSE substr(pub_date, 1, 8) || '01' END AS day FROM ({ARTICLES_SQL}) WHERE doc_id % 13 <> 5 AND doc_id % 17 <> 3)"""


def _acquired(spark, sf):
    base, rows = shared_folder(spark, "acquired"), xml_records(spark, sf)
    for name, condition in (("a", "doc_id % 3 < 2"), ("b", "doc_id % 3 > 0")):
        rows.filter(condition).select("xml").write.text(f"{base}/in/{name}")
        for _ in range(2):  # nothing new the second time
            acquire.run_acquire(spark, f"{base}/in/*", base, "r", glob="*.txt", groups=(("vivo",),), years=(2008, 2027),
                                excluded_types=(), max_rows=3)
    return base


@bound(f"SELECT chunk AS chunk_id, count(*) AS n FROM ({_ACQUIRED_SQL}) GROUP BY chunk")
def acquired_manifest(spark, sf):
    """XML files to chunks: two arrivals, each acquired twice."""
    return acquire.read_manifest(spark, _acquired(spark, sf), "r")


@bound(f"SELECT pmid, day AS pub_date, chunk AS chunk_id, {_CLEAN.format('title')} || ' in vivo <x' AS title FROM ({_ACQUIRED_SQL})")
def acquired_rows(spark, sf):
    """The articles in the chunk files, each id once."""
    return acquire.read_chunks(spark, _acquired(spark, sf), "r").select("pmid", "pub_date", "chunk_id", "title")


@bound(f"""SELECT arrival, count(*) AS records, count(*) FILTER (WHERE arrival = 'a' OR doc_id % 3 = 2) AS kept
  FROM ({_ACQUIRED_SQL}), (VALUES ('a'), ('b')) v(arrival)
  WHERE CASE WHEN arrival = 'a' THEN doc_id % 3 < 2 ELSE doc_id % 3 > 0 END GROUP BY arrival""")
def acquired_files(spark, sf):
    """Records found in the files of each arrival, and those that were kept."""
    files = acquire.read_files(spark, _acquired(spark, sf), "r")
    return files.groupBy(F.regexp_extract("file", "/in/([ab])/", 1).alias("arrival")).agg(
        F.sum("records").alias("records"), F.sum("kept").alias("kept"))


# --- answers in rounds ------------------------------------------------------------------------------
#
# A responder that fails by key and attempt: key k is answered well on attempt k % 5 + 1; before
# that the call fails, raises no object, or comes back as broken JSON. Four attempts are allowed.

def _moody(keys, messages, attempt):
    out = []
    for key, said in zip(keys, messages, strict=True):
        k = int(key)
        if attempt > k % 5:
            out.append((200, '{"n": %d, "roles": "%s"}' % (attempt, ",".join(m["role"] for m in said))))
        else:
            out.append(((503, "busy"), (200, "no object"), (200, '{"n": '))[(k + attempt) % 3])
    return out


def _answered(spark, sf):
    base = shared_folder(spark, "rounds")
    sent = extract.outgoing(articles(spark, sf).select("pmid", "title", "abstract", "journal", "pub_date", "shard", "file_name", "block_start", "ord"))
    return base, rounds.run_prompts(sent, _moody, base, "r", max_attempts=4)


@bound("""SELECT CAST(doc_id AS VARCHAR) AS pmid, CAST(least(doc_id % 5 + 1, 4) AS INT) AS attempt, doc_id % 5 < 4 AS ok,
    CASE WHEN doc_id % 5 < 4 THEN 'system,user' END AS roles, CASE WHEN doc_id % 5 < 4 THEN NULL
      WHEN (doc_id + 4) % 3 = 0 THEN 'HTTP 503: busy' ELSE 'Model response could not be parsed as JSON object' END AS error
  FROM documents""")
def answers_in_rounds(spark, sf):
    """The first good attempt of each prompt, or the last one."""
    return records.best_attempt(_answered(spark, sf)[1]).select(
        "pmid", "attempt", "ok", F.try_variant_get("raw", "$.roles", "string").alias("roles"), "error")


@bound("""SELECT CAST(a AS INT) AS attempt, count(*) FILTER (WHERE doc_id % 5 >= a - 1) AS asked,
    count(*) FILTER (WHERE doc_id % 5 = a - 1) AS good FROM documents, (VALUES (1), (2), (3), (4)) v(a) GROUP BY a""")
def rounds_asked(spark, sf):
    """How many prompts each round asked, and how many it answered well."""
    return rounds.rounds(spark, _answered(spark, sf)[0], "r")


# --- thousands of terms, stored order, hierarchy -----------------------------------------------------
#
# 5,040 terms by rule: words of three syllables, beginnings of words, and phrases of two words.

_A = ("th", "er", "an", "on", "re", "ti", "es", "or", "de", "qu", "au", "che")
_B = ("en", "in", "at", "ed", "nd", "ou", "ea", "ha", "is", "le", "ie", "ta")


def _many_terms():
    whole = [a + b + c for a in _A for b in _B for c in (*_A, *_B)]
    begun = [f"{a}{b}{c}*" for a in _A for b in _B for c in ("x", "bl", "ke", "zu")]
    pairs = [f"{a} {b}{c}" for a in ("the", "of", "la", "der") for b in _A for c in (*_B, *_A)][:1008]
    return whole + begun + pairs


def _rule_sql(terms):
    whole = ", ".join(f"'{t}'" for t in terms if " " not in t and "*" not in t)
    begun = " OR ".join(f"list_has_any(list_transform(w, lambda x: left(x, {n})), [{', '.join(repr(t[:-1]) for t in terms if t.endswith('*') and len(t) == n + 1)}])"
                        for n in sorted({len(t) - 1 for t in terms if t.endswith("*")}))
    pairs = ", ".join(f"'{t}'" for t in terms if " " in t)
    return f"(list_has_any(w, [{whole}]) OR {begun} OR list_has_any(p, [{pairs}]))"


@bound(rf"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(split_part(text, chr(10), 1) || ' ' || text),
    '[\p{{L}}\p{{M}}\p{{N}}_]+|[^\p{{L}}\p{{M}}\p{{N}}_]+') AS w FROM documents),
  q AS (SELECT doc_id, w, list_transform(range(1, len(w) - 1), lambda i: CASE WHEN w[i + 1] = ' ' THEN w[i] || ' ' || w[i + 2] END) AS p FROM t)
  SELECT CAST(doc_id AS VARCHAR) AS pmid FROM q WHERE {_rule_sql(_many_terms())}""")
def thousands_of_terms(spark, sf):
    """Articles that hold one of 5,000 words, beginnings of words or phrases."""
    return screen.corpus_filter(articles(spark, sf), (_many_terms(),), None, ()).select("pmid")


_ORDERED = "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS rn FROM lineitem"


@bound(f"""SELECT rn - 1 AS place, l_orderkey, l_linenumber FROM ({_ORDERED})
  WHERE rn BETWEEN 3001 AND 5000 OR rn > (SELECT count(*) - 700 FROM lineitem)""")
def stored_pages(spark, sf):
    """Two adjacent pages and the last one, read from one stored order."""
    path = shared_folder(spark, "ordered")
    rows = table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    chunks.store_order(rows, path, ["l_shipdate", "l_orderkey", "l_linenumber"], block_rows=900)
    n, out = rows.count(), None
    for start, size in ((3000, 1000), (4000, 1000), (n - 700, 5000)):
        page = chunks.stored_page(spark, path, start, size)
        placed = chunks.number_rows(page, ["l_shipdate", "l_orderkey", "l_linenumber"], 1).select(
            (F.col("row_no") + start - 1).alias("place"), "l_orderkey", "l_linenumber")
        out = placed if out is None else out.unionByName(placed)
    return out


# a tree over the documents: the parent of n is n // 3; every seventh name is known
@bound("""WITH RECURSIVE up AS (SELECT doc_id AS term, doc_id AS ancestor, 0 AS distance FROM documents
    UNION ALL SELECT term, ancestor // 3, distance + 1 FROM up WHERE ancestor > 0),
  best AS (SELECT term, min(distance) AS distance FROM up WHERE ancestor % 7 = 3 GROUP BY term)
  SELECT 'd ' || d.doc_id AS label, 'D-' || up.ancestor AS name, up.distance AS distance
  FROM documents d LEFT JOIN best b ON b.term = d.doc_id LEFT JOIN up ON up.term = b.term AND up.distance = b.distance""")
def conservative_names(spark, sf):
    """The nearest known name of each label, up the tree."""
    d = table(spark, sf, "documents").select("doc_id")
    tree = d.filter("doc_id > 0").select(
        F.concat(F.lit("d "), "doc_id").alias("term"), F.concat(F.lit("D "), F.floor(F.col("doc_id") / 3)).alias("parent"))
    known = d.filter("doc_id % 7 = 3").select(F.concat(F.lit("D-"), "doc_id").alias("term"))
    labels = d.select(F.concat(F.lit("d "), "doc_id").alias("label"))
    return hierarchy.conservative_name(labels, "label", tree, known, "name").select(
        "label", "name", F.col("name_distance").alias("distance"))


@bound("""WITH RECURSIVE up AS (SELECT doc_id AS term, doc_id AS ancestor FROM documents
    UNION ALL SELECT term, ancestor // 3 FROM up WHERE ancestor > 0)
  SELECT DISTINCT 'd_' || term AS term, 'd_' || ancestor AS ancestor FROM up WHERE ancestor BETWEEN 3 AND 8""")
def ancestors_at_depth(spark, sf):
    """Every label's ancestor two steps below the root."""
    d = table(spark, sf, "documents").select("doc_id")
    tree = d.filter("doc_id > 0").select(
        F.concat(F.lit("d "), "doc_id").alias("term"), F.concat(F.lit("d "), F.floor(F.col("doc_id") / 3)).alias("parent"))
    return hierarchy.at_depth(tree, 2)


# --- the analysis pack in parts -------------------------------------------------------------------------

def _pack_documents(spark, sf):
    """What the pack reads of the orders' documents, as a stored table: parts and checks read it often."""
    return sinks.stage_rows(documents(spark, sf, pack.fields()).select("pmid", "doc"), shared_folder(spark, "packed"), "r")


def _pack(spark, docs):
    """The pack of the orders in two parts, the first of which is added twice."""
    base = shared_folder(spark, "pack")
    for name in ("even", "odd", "even"):
        pack.add_part(docs.filter(F.col("pmid").cast("bigint") % 2 == (0 if name == "even" else 1)), base, "r", name)
    return pack.pack_tables(spark, base, "r")


@bound(f"""SELECT 'subspecialties' AS name, sub AS key, count(*) AS n, CAST(NULL AS DOUBLE) AS value FROM ({DOCUMENT_SQL}) GROUP BY sub
  UNION ALL SELECT 'per_year', CAST(year(o_orderdate) AS VARCHAR), count(*), NULL FROM ({DOCUMENT_SQL}) GROUP BY 2
  UNION ALL SELECT 'methods', method, count(*), NULL FROM ({ENTITY_SQL}) GROUP BY method
  UNION ALL SELECT 'outcomes', outcome, count(*), round(100.0 * count(*) / sum(count(*)) OVER (), 6) FROM ({ENTITY_SQL}) GROUP BY outcome
  UNION ALL SELECT 'mean_score', sub, NULL, round(avg(CAST(a_total AS DOUBLE)), 6) FROM ({DOCUMENT_SQL}) GROUP BY sub
  UNION ALL SELECT 'validation', 'external', NULL, round(avg(CAST(ext AS INT)) * 100, 6) FROM ({DOCUMENT_SQL})
  UNION ALL SELECT 'total', stat, n, value FROM (SELECT count(a_total) AS n, round(avg(CAST(a_total AS DOUBLE)), 6) AS mean,
      round(stddev_samp(CAST(a_total AS DOUBLE)), 6) AS std, round(quantile_cont(CAST(a_total AS DOUBLE), 0.25), 6) AS q25,
      round(quantile_cont(CAST(a_total AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST(a_total AS DOUBLE), 0.75), 6) AS q75
    FROM ({DOCUMENT_SQL})) UNPIVOT (value FOR stat IN (mean, std, q25, q50, q75))""")
def pack_in_parts(spark, sf):
    """Exact tables of the merged pack."""
    t = _pack(spark, _pack_documents(spark, sf))

    def shown(name, key, n=None, value=None, df=None):
        return (t[name] if df is None else df).select(
            F.lit(name).alias("name"), key.cast("string").alias("key"),
            (F.lit(None) if n is None else n).cast("bigint").alias("n"),
            (F.lit(None).cast("double") if value is None else F.round(value, 6)).alias("value"))
    total = t["scores"].filter(F.col("column") == "study_total_score").select(
        "n", F.explode(F.create_map(*[x for c in ("mean", "std", "q25", "q50", "q75") for x in (F.lit(c), F.col(c).cast("double"))])))
    n = F.col("n")
    out = [shown("subspecialties", F.col("primary_subspecialty"), n), shown("per_year", F.col("year"), n),
           shown("methods", F.col("model_method_group"), n), shown("outcomes", F.col("outcome_group"), n, F.col("share")),
           shown("mean_score", F.col("primary_subspecialty"), None, F.col("mean")),
           shown("validation", F.lit("external"), None, F.col("article_has_external_validation_pct")),
           shown("total", F.col("key"), n, F.col("value"), total)]
    return chunks.union_shards(out)


@bound(f"""SELECT TRUE AS ids_within, count(*) AS groups, count(*) AS sizes_within FROM (SELECT sub FROM ({ENTITY_SQL})
  WHERE sample_size IS NOT NULL GROUP BY sub)""")
def pack_sketches(spark, sf):
    """Whether distinct ids and medians of sample sizes lie within four times their stated errors."""
    docs = _pack_documents(spark, sf)
    t = _pack(spark, docs)
    rows = docs.select(F.explode("doc.model_level").alias("e")).select(
        F.col("e.disease_subspecialty").alias("sub"), F.col("e.sample_size").alias("size")).filter("size is not null")
    median = t["sample_sizes"].select(F.col("disease_subspecialty").alias("sub"), "q50")
    ranked = rows.join(median, "sub").groupBy("sub").agg(
        F.avg((F.col("size") < F.col("q50")).cast("int")).alias("below"), F.avg((F.col("size") <= F.col("q50")).cast("int")).alias("upto"))
    sizes = ranked.agg(F.count("*").alias("groups"), F.count_if((F.col("below") <= 0.56) & (F.col("upto") >= 0.44)).alias("sizes_within"))
    exact = table(spark, sf, "orders").agg(F.count_distinct("o_orderkey").alias("exact"))
    off = F.abs(t["counts"].select("n_pmids").scalar() / exact.scalar() - 1)
    return sizes.select((off < 4 * 1.04 / 2 ** (pack.HLL_LG / 2)).alias("ids_within"), "groups", "sizes_within")


@bound(f"""SELECT 'subspecialties' AS name, count(DISTINCT sub) AS n FROM ({DOCUMENT_SQL})
  UNION ALL SELECT 'counts', 1 UNION ALL SELECT 'per_year', count(DISTINCT year(o_orderdate)) FROM ({DOCUMENT_SQL})
  UNION ALL SELECT 'outcomes', count(DISTINCT outcome) FROM ({ENTITY_SQL})
  UNION ALL SELECT 'export', count(*) FROM ({ENTITY_SQL})""")
def written_pack(spark, sf):
    """The whole pack written to a folder, and rows of some of its tables read back."""
    base = shared_folder(spark, "written")
    docs = sinks.stage_rows(documents(spark, sf).select("pmid", "doc"), base, "docs")
    report.write_pack(docs, f"{base}/pack")
    out = [spark.read.option("header", True).csv(f"{base}/pack/{name}").agg(F.lit(name).alias("name"), F.count("*").alias("n"))
           for name in ("subspecialties", "counts", "per_year", "outcomes")]
    out.append(spark.read.parquet(f"{base}/pack/export").agg(F.lit("export").alias("name"), F.count("*").alias("n")))
    return chunks.union_shards(out)

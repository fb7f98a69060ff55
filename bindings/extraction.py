"""Normalisation, records, extraction and arbitration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence.functions import jsontext
from evidence.functions.text import computed
from evidence.operators import analysis, chunks, records
from evidence.operators.normalize import needs_review, normalize, review_fields
from evidence.plans import extract
from evidence.schema import SCORE_KEYS
from evidence.session import shared_folder
from evidence.sources import jsonl, sinks

from .frames import (ARTICLE_SQL, ARTICLES_SQL, DOCUMENT_SQL, ENTITY_SQL, REVIEW_SQL, answers,
                     articles, with_answers)
from .registry import bound, spread, table


def documents(spark, sf, fields=None):
    """Normalised documents of all orders, or the fields of them that are named."""
    parsed = computed(answers(spark, sf), {"raw": jsontext.parse_object("content")}).withColumn(
        "error", F.when(F.col("raw").isNull(), F.lit("unreadable")))
    return normalize(parsed, error="error", fields=fields).drop("raw", "content")


def reviewed(spark, sf, fields):
    """Named fields of the documents, with the review flag."""
    return documents(spark, sf, [*fields, *review_fields()]).withColumn("needs_review", needs_review())


def article(*names):
    return [f"article_level.{n}" for n in names]


def entity(*names):
    return [f"model_level.{n}" for n in names]


@bound(f"""SELECT sub AS subspecialty, count(*) AS n_articles, CAST(sum(n_entities) AS BIGINT) AS n_entities,
    count(*) FILTER (WHERE {REVIEW_SQL}) AS n_review,
    round(avg(CAST(ext AS INT)) * 100, 6) AS external_validation_pct,
    round(avg(CAST(a_total AS DOUBLE)), 6) AS mean_total_score
  FROM ({DOCUMENT_SQL}) GROUP BY sub""")
def subspecialty_summary(spark, sf):
    art = F.col("doc.article_level")
    rows = reviewed(spark, sf, article("primary_subspecialty", "article_has_external_validation", "study_quality_score"))
    return (rows.groupBy(art["primary_subspecialty"].alias("subspecialty")).agg(
        F.count("*").alias("n_articles"),
        F.sum(F.size("doc.model_level")).alias("n_entities"),
        F.count_if("needs_review").alias("n_review"),
        F.round(F.avg(art["article_has_external_validation"].cast("int")) * 100, 6)
        .alias("external_validation_pct"),
        F.round(F.avg(art["study_quality_score"]["total_score"]), 6).alias("mean_total_score")))


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, 'Order ' || k AS title, o_orderpriority AS journal,
    strftime(o_orderdate, '%Y-%m-%d') AS pub_date, sub AS subspecialty, ext, int_ AS internal,
    n_models, n_models > 1 AS multimodel, CAST(a_total AS INT) AS total, CAST(confidence AS INT) AS confidence,
    CASE WHEN parsed THEN '' ELSE 'primary_failed: unreadable' END AS notes,
    CAST(n_issues AS INT) AS n_issues, {REVIEW_SQL} AS needs_review FROM ({DOCUMENT_SQL})""")
def normalised_articles(spark, sf):
    a = F.col("doc.article_level")
    rows = reviewed(spark, sf, [*article(
        "pmid", "title", "journal", "pub_date", "primary_subspecialty", "article_has_external_validation",
        "article_has_internal_validation", "number_of_models_described", "is_multimodel_article", "study_quality_score",
        "overall_notes"), "issues"])
    return rows.select(
        a["pmid"].alias("pmid"), a["title"].alias("title"), a["journal"].alias("journal"),
        a["pub_date"].alias("pub_date"), a["primary_subspecialty"].alias("subspecialty"),
        a["article_has_external_validation"].alias("ext"),
        a["article_has_internal_validation"].alias("internal"),
        a["number_of_models_described"].alias("n_models"), a["is_multimodel_article"].alias("multimodel"),
        a["study_quality_score"]["total_score"].alias("total"),
        F.col("doc.normalization.overall_extraction_confidence").alias("confidence"),
        a["overall_notes"].alias("notes"), F.size("issues").alias("n_issues"), "needs_review")


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, CAST(j + 1 AS INT) AS id, 'model ' || j AS model_name, sub, outcome,
    method, validation, ext, int_ AS internal, sample_size, round(CAST(auc AS DOUBLE), 6) AS auc,
    CASE WHEN (k + j) % 2 = 0 THEN 'age|sex|bmi' ELSE 'age|7' END AS predictors,
    {', '.join(f'CAST(e{i} AS INT) AS {k}' for i, k in enumerate(SCORE_KEYS))},
    CAST(e_total AS INT) AS total FROM ({ENTITY_SQL})""")
def normalised_entities(spark, sf):
    named = entity("model_name", "disease_subspecialty", "outcome_group", "model_method_group", "validation_type",
                   "has_external_validation", "has_internal_validation", "sample_size", "performance_metrics",
                   "predictors_raw", "model_quality_score")
    rows = documents(spark, sf, named).select("pmid", F.explode("doc.model_level").alias("e"))
    e = F.col("e")
    return rows.select(
        "pmid", e["model_id_within_article"].alias("id"), e["model_name"].alias("model_name"),
        e["disease_subspecialty"].alias("sub"), e["outcome_group"].alias("outcome"),
        e["model_method_group"].alias("method"), e["validation_type"].alias("validation"),
        e["has_external_validation"].alias("ext"), e["has_internal_validation"].alias("internal"),
        e["sample_size"].alias("sample_size"), F.round(e["performance_metrics"]["auc"], 6).alias("auc"),
        F.array_join(e["predictors_raw"], "|").alias("predictors"),
        *[e["model_quality_score"][k].alias(k) for k in SCORE_KEYS],
        e["model_quality_score"]["total_score"].alias("total"))


@bound(f"""SELECT issue, count(*) AS n FROM (
    SELECT 'model[' || idx || '].' || unnest([
        CASE WHEN sub_issue THEN 'disease_subspecialty_out_of_set' END,
        CASE WHEN out_issue THEN 'outcome_group_out_of_set' END,
        CASE WHEN method_issue THEN 'method_group_out_of_set' END,
        CASE WHEN val_issue THEN 'validation_type_out_of_set' END,
        CASE WHEN e_mismatch THEN 'quality_score_total_mismatch' END]) AS issue FROM ({ENTITY_SQL})
    UNION ALL SELECT unnest(CASE WHEN NOT parsed THEN ['primary_failed:unreadable'] ELSE [
        CASE WHEN NOT has_art THEN 'missing_article_level' END,
        CASE WHEN NOT has_models THEN 'missing_model_level_array' END,
        CASE WHEN sub_issue THEN 'article.primary_subspecialty_out_of_set' END,
        CASE WHEN a_mismatch THEN 'article.quality_score_total_mismatch' END,
        CASE WHEN has_models AND k % 17 = 0 THEN 'model[0]_not_object' END,
        CASE WHEN n_given < 0 THEN 'number_of_models_negative' END] END) FROM ({ARTICLE_SQL}))
  WHERE issue IS NOT NULL GROUP BY issue""")
def issue_codes(spark, sf):
    return (documents(spark, sf, ["issues"]).select(F.explode("issues").alias("issue"))
            .groupBy("issue").agg(F.count("*").alias("n")))


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, sub, n_models, n_entities FROM ({DOCUMENT_SQL})""")
def pruned_documents(spark, sf):
    """Three fields of a document, computed without the rest of it."""
    rows = documents(spark, sf, [*article("primary_subspecialty", "number_of_models_described"), "model_level.sample_size"])
    a = F.col("doc.article_level")
    return rows.select("pmid", a["primary_subspecialty"].alias("sub"), a["number_of_models_described"].alias("n_models"),
                       F.size("doc.model_level").cast("long").alias("n_entities"))


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid FROM ({DOCUMENT_SQL})
  WHERE n_issues > 0""")
def low_confidence_documents(spark, sf):
    return analysis.low_confidence(documents(spark, sf, ["quality_flags.requires_human_review"])).select("pmid")


# --- documents as keyed records ----------------------------------------------------------------
#
# The length bucket of a text is a key that many records share; some keys are empty.

_KEYED_SQL = """SELECT *, CASE WHEN n_chars % 10 = 0 THEN '' ELSE CAST(n_chars % 100 AS VARCHAR) END AS key
  FROM documents"""


def keyed(spark, sf):
    n = table(spark, sf, "documents").select("doc_id", "n_chars")
    return (articles(spark, sf).drop("pmid").join(n, "doc_id")
            .withColumn("pmid", F.when(F.col("n_chars") % 10 == 0, " ")
                        .otherwise((F.col("n_chars") % 100).cast("string"))))


def _first(partition: str) -> str:
    return (f"SELECT doc_id, source AS shard, key AS pmid FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {partition} ORDER BY source, doc_id) AS rn FROM ({_KEYED_SQL})) WHERE rn = 1 OR key = ''")


@bound(_first("source, key"))
def first_per_shard(spark, sf):
    return records.dedupe_first(keyed(spark, sf)).select("doc_id", "shard", F.trim("pmid").alias("pmid"))


@bound(_first("key"))
def first_overall(spark, sf):
    return records.dedupe_first(keyed(spark, sf), scope="global").select(
        "doc_id", "shard", F.trim("pmid").alias("pmid"))


def label_ids(spark, sf, condition="true"):
    return table(spark, sf, "labels").filter(condition).select(
        F.col("doc_id").cast("string").alias("pmid"))


@bound("""SELECT CAST(doc_id AS VARCHAR) AS pmid, source AS journal FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def resume_by_id(spark, sf):
    return records.pending(articles(spark, sf), label_ids(spark, sf)).select("pmid", "journal")


@bound("""SELECT CAST(doc_id AS VARCHAR) AS pmid FROM documents d
  WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 0)
    AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)""")
def flagged_not_adjudicated(spark, sf):
    rows = records.selected(articles(spark, sf), label_ids(spark, sf, "quality = 0"))
    return records.pending(rows, label_ids(spark, sf, "toxic = 1")).select("pmid")


@bound("""SELECT source AS shard, count(*) AS n FROM documents
  WHERE source NOT IN (SELECT source FROM documents WHERE n_chars > 20000) GROUP BY source""")
def unfinished_shards(spark, sf):
    finished = articles(spark, sf).filter(F.char_length("abstract") > 20000).select("file_name")
    return (records.pending_shards(articles(spark, sf), finished)
            .groupBy("shard").agg(F.count("*").alias("n")))


@bound("""SELECT source AS shard, count(*) AS n FROM documents
  WHERE source IN (SELECT source FROM documents WHERE n_chars > 20000) GROUP BY source""")
def shards_with_output(spark, sf):
    other = articles(spark, sf).filter(F.char_length("abstract") > 20000).select("shard")
    return (records.paired_shards(articles(spark, sf), other)
            .groupBy("shard").agg(F.count("*").alias("n")))


@bound("""SELECT CAST(doc_id AS VARCHAR) AS pmid FROM documents WHERE doc_id % 3 = 0
  UNION SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1
  UNION SELECT CAST(conv_id AS VARCHAR) FROM conversations""")
def united_ids(spark, sf):
    conv = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("pmid"))
    return chunks.union_ids([articles(spark, sf).filter("doc_id % 3 = 0"),
                             label_ids(spark, sf, "quality = 1"), conv])


@bound("""SELECT lang, count(*) AS n FROM (SELECT lang FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT lang FROM documents WHERE doc_id % 2 = 1) GROUP BY lang""")
def united_shards(spark, sf):
    a = articles(spark, sf)
    both = chunks.union_shards([a.filter("doc_id % 2 = 0"), a.filter("doc_id % 2 = 1")])
    return both.groupBy("lang").agg(F.count("*").alias("n"))


# --- attempts ----------------------------------------------------------------------------------------
#
# A turn of a conversation is one attempt; the assistant's turns came through, every fourth
# of them without readable JSON.

_STATUS_SQL = "CASE role WHEN 'assistant' THEN 200 WHEN 'user' THEN 429 ELSE 404 END"
_GOOD_SQL = "(role = 'assistant' AND length(text) % 4 <> 0)"


def attempts(spark, sf):
    n = F.char_length("text")
    status = F.when(F.col("role") == "assistant", 200).when(F.col("role") == "user", 429).otherwise(404)
    content = F.when(status != 200, F.col("text")).when(
        n % 4 == 0, "no braces here").otherwise(
        F.concat(F.lit("Result: {\"article_level\": {\"overall_notes\": \"n "), n.cast("string"),
                 F.lit("\"}, \"n\": "), n.cast("string"), F.lit("} end")))
    return table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("pmid"), F.lit("m1").alias("model"),
        F.lit(1).alias("pass"), F.col("turn").cast("int").alias("attempt"),
        status.alias("status"), content.alias("content"))


_BEST_SQL = f"""SELECT conv_id, turn, {_GOOD_SQL} AS ok, length(text) AS n, {_STATUS_SQL} AS status, text
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY {_GOOD_SQL} DESC,
    CASE WHEN {_GOOD_SQL} THEN turn ELSE -turn END) AS rn FROM conversations) WHERE rn = 1"""
_ERROR_SQL = """CASE WHEN ok THEN NULL WHEN status = 200 THEN 'Model response could not be parsed as JSON object'
    WHEN status = 429 THEN 'HTTP 429: ' || substr(text, 1, 500) ELSE 'HTTP 404: ' || substr(text, 1, 1000) END"""


@bound(f"""SELECT CAST(conv_id AS VARCHAR) AS pmid, CAST(turn AS INT) AS attempt, ok,
    CASE WHEN ok THEN n END AS n, md5({_ERROR_SQL}) AS error FROM ({_BEST_SQL})""")
def best_attempts(spark, sf):
    return records.best_attempt(attempts(spark, sf)).select(
        "pmid", "attempt", "ok", F.try_variant_get("raw", "$.n", "bigint").alias("n"),
        F.md5("error").alias("error"))


_SQUEEZED = r"trim(regexp_replace({}, '[\s\x{{a0}}]+', ' ', 'g'))"


@bound(f"""SELECT CAST(doc_id AS VARCHAR) AS pmid, CASE WHEN ok THEN 'ok' ELSE 'error' END AS status,
    CASE WHEN ok THEN 'n ' || n ELSE substr({_SQUEEZED.format("'primary_failed: LLM call failed, model=m1, error=' || coalesce(" + _ERROR_SQL + ", 'no response')")}, 1, 300) END AS notes,
    CAST(1 AS INT) AS n_issues, TRUE AS needs_review
  FROM (SELECT doc_id FROM documents) LEFT JOIN ({_BEST_SQL}) b ON doc_id = conv_id""")
def extraction_with_failures(spark, sf):
    rows = extract.extract(articles(spark, sf), attempts(spark, sf),
                           settings=extract.RunSettings(primary_model="m1"), fields=())
    return rows.select("pmid", "status", F.col("doc.article_level.overall_notes").alias("notes"),
                       F.size("issues").alias("n_issues"), "needs_review")


def order_responses(spark, sf, shift, model, pass_no):
    """Answers of a model: the answer JSON of another order key, so that two models differ."""
    k, c = F.col("o_orderkey") + shift, F.col("o_custkey") + shift
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    rows = with_answers(spread(orders, "o_orderkey"), k, c)
    return rows.select(
        F.col("o_orderkey").cast("string").alias("pmid"), F.lit(model).alias("model"),
        F.lit(pass_no).alias("pass"), F.lit(1).alias("attempt"),
        F.when((k % 23 == 7), 500).otherwise(200).alias("status"), "content")


def order_sources(spark, sf):
    """Orders as source records; the priority is the shard."""
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        k.cast("string").alias("pmid"), F.concat(F.lit("Order "), k.cast("string")).alias("title"),
        F.lit("abstract").alias("abstract"), F.col("o_orderpriority").alias("journal"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("pub_date"),
        F.substring("o_orderpriority", 1, 1).alias("shard"),
        F.col("o_orderpriority").alias("file_name"), F.lit(0).cast("bigint").alias("block_start"),
        k.alias("ord"))


TWO_MODELS = extract.RunSettings(primary_model="m1", arbitration_model="m2", second_pass=True)


def two_answers(spark, sf):
    return order_responses(spark, sf, 0, "m1", 1).unionByName(order_responses(spark, sf, 1000, "m2", 2))


def _moved(sql: str, shift: int) -> str:
    """The same SQL over orders whose keys are moved by ``shift``."""
    moved = (f"(SELECT o_orderkey + {shift} AS o_orderkey, o_custkey + {shift} AS o_custkey, "
             "o_orderdate, o_orderpriority FROM orders)")
    return sql.replace("FROM orders", f"FROM {moved}")


_FIRST_SQL = DOCUMENT_SQL
_SECOND_SQL = _moved(DOCUMENT_SQL, 1000)
_FLAG1 = "(f.n_issues > 0 OR f.ambiguous OR f.confidence < 60 OR f.n_entities = 0 OR f.scored = 0)"
_FLAG2 = _FLAG1.replace("f.", "s.")
# m1 answered unless key % 23 = 7; m2 answered unless (key + 1000) % 23 = 7
_PASSES = f"""SELECT f.k, f.o_orderpriority, f.parsed AS ok1, s.parsed AS ok2, {_FLAG1} AS flag1, {_FLAG2} AS flag2,
    CASE WHEN f.parsed AND {_FLAG1} AND s.parsed THEN s.sub ELSE f.sub END AS sub,
    f.parsed AND {_FLAG1} AS again, CAST(f.n_issues AS INT) AS i1, CAST(s.n_issues AS INT) AS i2,
    least(CASE WHEN f.parsed AND {_FLAG1} AND s.parsed THEN s.confidence ELSE f.confidence END,
          CASE WHEN f.parsed AND {_FLAG1} AND NOT s.parsed THEN 20 ELSE 100 END) AS confidence
  FROM ({_FIRST_SQL}) f JOIN ({_SECOND_SQL}) s ON f.k + 1000 = s.k"""


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, sub, again AS second_pass,
    CASE WHEN ok1 THEN 'ok' ELSE 'error' END AS status, CAST(confidence AS INT) AS confidence,
    CASE WHEN NOT again THEN i1 WHEN ok2 THEN i1 + i2 ELSE i1 + 1 END AS n_issues,
    CASE WHEN NOT again THEN flag1 WHEN ok2 THEN flag2 ELSE TRUE END AS needs_review
  FROM ({_PASSES})""")
def second_pass_extraction(spark, sf):
    rows = extract.extract(order_sources(spark, sf), two_answers(spark, sf), settings=TWO_MODELS,
                           fields=article("primary_subspecialty"))
    return rows.select(
        "pmid", F.col("doc.article_level.primary_subspecialty").alias("sub"),
        F.col("audit.inline_second_pass").alias("second_pass"), "status",
        F.col("doc.normalization.overall_extraction_confidence").alias("confidence"),
        F.size("issues").alias("n_issues"), "needs_review")


ONE_MODEL = extract.RunSettings(primary_model="m1", arbitration_model="m2")
_SHARD = "substr(o_orderpriority, 1, 1)"


@bound(f"""SELECT {_SHARD} AS shard, count(*) AS total, count(*) FILTER (WHERE parsed) AS ok,
    count(*) FILTER (WHERE {REVIEW_SQL}) AS review, count(*) FILTER (WHERE NOT parsed) AS errors
  FROM ({DOCUMENT_SQL}) GROUP BY ROLLUP ({_SHARD})""")
def extraction_totals(spark, sf):
    return extract.totals(extract.extract(order_sources(spark, sf), two_answers(spark, sf),
                                          settings=ONE_MODEL, fields=()))


# arbitration: flagged documents of the first answer, those of keys divisible by 4 done before
@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, CASE WHEN ok2 THEN 'ok' ELSE 'error' END AS status,
    i2 AS n_issues, flag2 AS needs_review FROM ({_PASSES}) WHERE flag1 AND k % 4 <> 0""")
def arbitrated_documents(spark, sf):
    return _arbitrated(spark, sf).select("pmid", "status", F.size("issues").alias("n_issues"),
                                         "needs_review")


def _first_docs(spark, sf):
    """Extracted documents as the first run leaves them: a stored table."""
    rows = documents(spark, sf, [*article("pmid"), *review_fields()]).select(
        "pmid", F.substring("journal", 1, 1).alias("shard"), "doc")
    return sinks.stage_rows(rows, shared_folder(spark, "extracted"), "first")


def _arbitrated(spark, sf, first=None):
    first = first or _first_docs(spark, sf)
    done = first.filter(F.col("pmid").cast("bigint") % 4 == 0)
    return extract.rerun_flagged(order_sources(spark, sf), first, two_answers(spark, sf), done, ONE_MODEL,
                                 fields=())


@bound(f"""SELECT {_SHARD} AS shard, count(*) AS flagged, count(*) FILTER (WHERE k % 4 <> 0) AS scheduled,
    count(*) FILTER (WHERE k % 4 <> 0 AND ok2) AS ok,
    count(*) FILTER (WHERE k % 4 <> 0 AND flag2) AS still_review,
    count(*) FILTER (WHERE k % 4 <> 0 AND NOT ok2) AS errors
  FROM ({_PASSES}) WHERE flag1 GROUP BY ROLLUP ({_SHARD})""")
def arbitration_totals(spark, sf):
    first = _first_docs(spark, sf)
    flagged = records.flagged_ids(first, keep=["shard"])
    return extract.rerun_totals(_arbitrated(spark, sf, first), flagged)


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, {_SHARD} AS shard FROM ({DOCUMENT_SQL})
  WHERE {REVIEW_SQL} AND k % 6 <> 0""")
def new_review_rows(spark, sf):
    rows = reviewed(spark, sf, article("pmid")).select(
        "pmid", F.substring("journal", 1, 1).alias("shard"), "doc", "needs_review",
        F.col("pmid").alias("record_key"))
    seen = rows.filter(F.col("pmid").cast("bigint") % 6 == 0)
    return extract.review_rows(rows, seen).select("pmid", "shard")


@bound(f"""SELECT stream, count(*) AS n FROM (SELECT unnest(CASE WHEN {REVIEW_SQL}
    THEN ['extracted', 'audit', 'review'] ELSE ['extracted', 'audit'] END) AS stream FROM ({DOCUMENT_SQL}))
  GROUP BY stream""")
def written_streams(spark, sf):
    base = shared_folder(spark, "streams")
    extract.run_extract(order_sources(spark, sf), two_answers(spark, sf), base, "r1", settings=ONE_MODEL)
    counted = [jsonl.read_jsonl(spark, f"{base}/{name}/run=r1/*").agg(
        F.lit(name).alias("stream"), F.count("*").alias("n"))
        for name in ("extracted", "review", "audit")]
    return chunks.union_shards(counted)


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, sub, n_entities AS n FROM ({DOCUMENT_SQL})""")
def reloaded_documents(spark, sf):
    base = shared_folder(spark, "documents")
    rows = documents(spark, sf)
    sinks.write_sharded(rows.select(*sinks.document_columns()), base, rows=1000, packed=True)
    art, ent = jsonl.split_levels(jsonl.read_documents(spark, base))
    per = ent.groupBy("_source_pmid").agg(F.count("*").alias("n"))
    return (art.select("_source_pmid", F.col("primary_subspecialty").alias("sub"))
            .join(per, "_source_pmid", "left")
            .select(F.col("_source_pmid").alias("pmid"), "sub", F.coalesce("n", F.lit(0)).alias("n")))


ARTICLES_ROUND_TRIP = f"SELECT journal AS shard, count(*) AS n, CAST(sum(length(abstract)) AS BIGINT) AS chars FROM ({ARTICLES_SQL}) GROUP BY journal"


@bound(ARTICLES_ROUND_TRIP)
def article_shards_round_trip(spark, sf):
    path = shared_folder(spark, "articles")
    columns = ("pmid", "title", "abstract", "journal", "pub_date", "publication_types", "keywords")
    sinks.write_by_shard(articles(spark, sf).select(*columns, F.col("shard").alias("s")), path, "s", rows=50)
    back = jsonl.articles(jsonl.read_jsonl(spark, f"{path}/*", "*.json"))
    return back.groupBy(F.get("publication_types", F.lit(0)).alias("shard")).agg(
        F.count("*").alias("n"), F.sum(F.char_length("abstract")).alias("chars"))


@bound(ARTICLES_ROUND_TRIP)
def strict_scan(spark, sf):
    path = shared_folder(spark, "strict")
    sinks.write_jsonl(articles(spark, sf).select("pmid", "title", "abstract", "journal"), path)
    back = jsonl.read_jsonl(spark, path, "*.json", mode="strict",
                            schema="pmid string, title string, abstract string, journal string")
    return back.groupBy(F.col("journal").alias("shard")).agg(
        F.count("*").alias("n"), F.sum(F.char_length("abstract")).alias("chars"))


# --- runs on disk -------------------------------------------------------------------------------

def _padded(spark, sf):
    """Order sources with padded ids."""
    return order_sources(spark, sf).withColumn("pmid", F.concat(F.lit("  "), F.col("pmid"), F.lit(" ")))


def _finished_run(spark, sf, base):
    """A run over half of the orders, resumed with all of them."""
    source, said = _padded(spark, sf), two_answers(spark, sf)
    half = source.filter(F.trim("pmid").cast("bigint") % 2 == 0)
    extract.run_extract(half, said, base, "r", settings=ONE_MODEL)
    done = records.processed_ids(jsonl.read_documents(spark, f"{base}/extracted/run=r"), keep=["shard"])
    return extract.run_extract(source, said, base, "r", done, settings=ONE_MODEL)


@bound(f"SELECT CAST(k AS VARCHAR) AS pmid, {_SHARD} AS shard, sub, {REVIEW_SQL} AS needs_review FROM ({DOCUMENT_SQL})")
def resumed_run(spark, sf):
    """All documents of a run that was resumed in its own folder, each once."""
    base = shared_folder(spark, "resumed")
    _finished_run(spark, sf, base)
    docs = jsonl.read_documents(spark, f"{base}/extracted/run=r")
    return docs.select(F.trim("pmid").alias("pmid"), "shard",
                       F.col("doc.article_level.primary_subspecialty").alias("sub"), "needs_review")


@bound(f"""SELECT {_SHARD} AS shard, count(*) AS total, count(*) FILTER (WHERE k % 2 = 1) AS scheduled,
    count(*) FILTER (WHERE k % 2 = 1 AND parsed) AS ok, count(*) FILTER (WHERE k % 2 = 1 AND {REVIEW_SQL}) AS review,
    count(*) FILTER (WHERE k % 2 = 1 AND NOT parsed) AS errors FROM ({DOCUMENT_SQL}) GROUP BY ROLLUP ({_SHARD})""")
def resumed_totals(spark, sf):
    return _finished_run(spark, sf, shared_folder(spark, "resumed"))


@bound(f"""SELECT {_SHARD} AS shard, count(*) AS flagged, count(*) AS scheduled, count(*) FILTER (WHERE ok2) AS ok,
    count(*) FILTER (WHERE flag2) AS still_review, count(*) FILTER (WHERE NOT ok2) AS errors
  FROM ({_PASSES}) WHERE flag1 GROUP BY ROLLUP ({_SHARD})""")
def arbitration_from_disk(spark, sf):
    """Flagged documents of a stored run go to the second model; run twice, with one result."""
    base, source, said = shared_folder(spark, "arbitrated"), _padded(spark, sf), two_answers(spark, sf)
    extract.run_extract(source, said, base, "r", settings=ONE_MODEL)
    docs = jsonl.read_documents(spark, f"{base}/extracted/run=r")
    for _ in range(2):
        extract.run_rerun_flagged(source, docs, said, base, "r", settings=ONE_MODEL)
    return spark.read.schema("shard string, flagged long, scheduled long, ok long, still_review long, errors long") \
        .json(f"{base}/rerun_summary/run=r").drop("part")


@bound(f"""SELECT count(*) AS both, count(*) FILTER (WHERE f.sub IS DISTINCT FROM s.sub) AS changed,
    count(*) FILTER (WHERE f.sub IS NULL AND s.sub IS NOT NULL) AS filled,
    count(*) FILTER (WHERE f.sub IS NOT NULL AND s.sub IS NULL) AS emptied, 'article_level.primary_subspecialty' AS field
  FROM ({_FIRST_SQL}) f JOIN ({_SECOND_SQL}) s ON f.k + 1000 = s.k""")
def compared_documents(spark, sf):
    """Subspecialties of the two models' documents side by side."""
    source, said = order_sources(spark, sf), two_answers(spark, sf)
    field = article("primary_subspecialty")
    one = extract.extract(source, said.filter("pass = 1"), settings=ONE_MODEL, fields=field)
    other = said.filter("pass = 2").withColumns({"model": F.lit("m1"), "pass": F.lit(1)})
    two = extract.extract(source, other, settings=ONE_MODEL, fields=field)
    return analysis.compare_documents(one, two, field).select(
        "field", "both", "changed", "filled", "emptied")


@bound("""SELECT CASE source WHEN 'src1' THEN 'group one' WHEN 'src2' THEN 'group one' ELSE source END AS name, count(*) AS n
  FROM documents GROUP BY 1""")
def synonym_lookup(spark, sf):
    listed = spark.createDataFrame([("SRC1", "group one"), ("src2 ", "group one"), ("other", "x")], "term string, canonical string")
    return (analysis.with_synonyms(table(spark, sf, "documents").select("source"), "source", listed, "name")
            .groupBy("name").agg(F.count("*").alias("n")))


@bound("SELECT CAST(doc_id AS VARCHAR) AS pmid, 2 AS messages, 'ok' AS status FROM documents")
def prompt_handoff(spark, sf):
    """Default prompts to a folder, answers from a folder, one document for each."""
    base, source = shared_folder(spark, "handoff"), articles(spark, sf)
    sinks.write_prompts(extract.outgoing(source), f"{base}/prompts")
    sent = spark.read.schema("record_key string, messages array<struct<role string,content string>>") \
        .json(f"{base}/prompts")
    said = sent.select(F.col("record_key").alias("pmid"), F.lit("primary").alias("model"), F.lit(1).alias("pass"),
                       F.lit(1).alias("attempt"), F.lit(200).alias("status"), F.lit('{"article_level": {}}').alias("content"))
    sinks.write_jsonl(said, f"{base}/answers")
    rows = extract.extract(source, jsonl.read_responses(spark, f"{base}/answers"))
    return rows.select("pmid", "status").join(sent.select(
        F.col("record_key").alias("pmid"), F.size("messages").alias("messages")), "pmid")

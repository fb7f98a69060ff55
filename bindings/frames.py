"""Frames of the engine's own shape, derived from the given tables row by row.

Each builder has a SQL twin (a CTE body) that says the same over the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidence.functions.text import computed
from evidence.schema import (METHOD_GROUPS, SCORE_KEYS, SUBSPECIALTIES, VALIDATION_TYPES)

from .registry import spread, table

# --- documents as article records -------------------------------------------------------

ARTICLES_SQL = """
  SELECT CAST(doc_id AS VARCHAR) AS pmid, split_part(text, chr(10), 1) AS title,
         text AS abstract, source AS journal, lang,
         printf('%04d-%02d-%02d', 2008 + doc_id % 20, 1 + doc_id % 12, 1 + doc_id % 28) AS pub_date,
         source AS ptype, doc_id
  FROM documents"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """pmid = doc_id, title = first line, abstract = whole text, type and journal = source."""
    d = F.col("doc_id")
    return table(spark, sf, "documents").select(
        d.cast("string").alias("pmid"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"), F.col("source").alias("journal"), "lang",
        F.format_string("%04d-%02d-%02d", 2008 + d % 20, 1 + d % 12, 1 + d % 28)
        .alias("pub_date"),
        F.array("source").alias("publication_types"),
        F.array("lang", "source").alias("keywords"),
        F.array(F.concat(F.lit("M "), "lang")).alias("mesh_terms"),
        F.col("source").alias("shard"), F.col("source").alias("file_name"),
        F.lit(0).cast("bigint").alias("block_start"), d.alias("ord"), "doc_id")


# --- orders as answer texts ---------------------------------------------------------------
#
# One order is one article with o_orderkey % 4 entities, all written from the columns of
# that order.  Values take every JSON type the rules know: numbers, words, mixed text,
# missing fields and wrong types.

def _k() -> Column:
    return F.col("o_orderkey")


def _c() -> Column:
    return F.col("o_custkey")


def _member(words: tuple[str, ...], index: Column, style: Column) -> Column:
    """Vocabulary member in a sloppy spelling; null beyond the list."""
    raw = F.get(F.array(*[F.lit(w) for w in words]), index.cast("int"))
    return (F.when(style == 0, raw).when(style == 1, F.upper(F.replace(raw, F.lit("_"), F.lit(" "))))
            .otherwise(F.concat(F.lit("  "), F.initcap(F.replace(raw, F.lit("_"), F.lit("-"))))))


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _pairs(items: dict[str, Column]) -> Column:
    """JSON object of the non-null values, each already JSON text; a join leaves nulls out."""
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), v) for k, v in items.items()]), F.lit("}"))


def _scores(seed: Column) -> Column:
    """Sub-scores from -3 to 23, some missing, some as text; a given total now and then."""
    subs = {}
    for i, name in enumerate(SCORE_KEYS):
        value = ((seed * (i + 3)) % 27 - 3).cast("string")
        subs[name] = (F.when((seed + i) % 13 == 0, F.lit(None))
                      .when((seed + i) % 5 == 0, _quoted(F.concat(value, F.lit(" of 20"))))
                      .otherwise(value))
    subs["total_score"] = F.when(seed % 6 == 0, F.lit("60"))
    return F.when(seed % 9 == 0, F.lit('"n/a"')).otherwise(_pairs(subs))


def subspecialty(seed: Column) -> Column:
    idx = seed % 25
    return (F.when(idx < 23, _quoted(_member(SUBSPECIALTIES, idx, seed % 3)))
            .when(idx == 23, F.lit('"Unknown field"')))


def _entity(k: Column, j: Column) -> Column:
    s = k + j
    size = (k * 7 + j) % 5000
    return _pairs({
        "model_name": _quoted(F.concat(F.lit(" model  "), j.cast("string"))),
        "disease_subspecialty": subspecialty(s),
        "outcome_group": F.when(s % 4 == 0, F.lit('"Mortality"')).when(s % 4 == 1, F.lit('"x"')),
        "model_method_group": F.when(s % 16 < 15, _quoted(_member(METHOD_GROUPS, s % 16, s % 3)))
        .otherwise(F.lit('"xyz"')),
        "validation_type": F.when(s % 9 < 8, _quoted(_member(VALIDATION_TYPES, s % 9, s % 3))),
        "has_external_validation": F.when(s % 5 == 0, F.lit("false")),
        "sample_size": F.when(s % 3 == 0, size.cast("string"))
        .when(s % 3 == 1, _quoted(F.concat(F.lit("n="), F.format_number(size, 0), F.lit(" pts")))),
        "predictors_raw": F.when(s % 2 == 0, F.lit('"age; sex ;; bmi"')).otherwise(F.lit('["age", " ", null, 7]')),
        "performance_metrics": F.concat(F.lit('{"auc": "0.'), F.lpad((s % 100).cast("string"), 2, "0"),
                                        F.lit(' (0.1-0.9)", "calibration_reported": "YES"}')),
        "model_quality_score": _scores(s),
    })


def answer_body(k: Column, c: Column) -> Column:
    """Answer JSON of an order."""
    article = _pairs({
        "pmid": F.when(k % 10 != 0, _quoted(k.cast("string"))),
        "prediction_type": F.when(k % 2 == 0, F.lit('" risk   score "')),
        "primary_subspecialty": subspecialty(c),
        "article_has_external_validation": F.when(k % 7 == 1, F.lit('"yes"'))
        .when(k % 7 == 2, F.lit("0")).when(k % 7 == 3, F.lit("false"))
        .when(k % 7 == 4, F.lit("true")).when(k % 7 == 5, F.lit('"maybe"'))
        .when(k % 7 == 6, F.lit('" No "')),
        "number_of_models_described": F.when(k % 11 == 0, F.lit("-1"))
        .when(k % 11 == 1, F.lit('"5 models"')),
        "study_quality_score": _scores(k),
    })
    entities = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda j: F.when(
        j.cast("bigint") < k % 4, _entity(k, j.cast("bigint"))))
    # an item that is no object goes first, so indices and numbers differ
    listed = F.concat(F.when(k % 17 == 0, F.array(F.lit('"s"'))).otherwise(
        F.array().cast("array<string>")), F.array_compact(entities))
    return _pairs({
        "article_level": F.when(k % 29 == 0, F.lit("[]")).otherwise(article),
        "model_level": F.when(k % 37 != 0, F.concat(F.lit("["), F.array_join(listed, ", "), F.lit("]"))),
        "normalization": F.concat(F.lit('{"overall_extraction_confidence": "'),
                                  ((k * 3) % 130).cast("string"), F.lit('%"}')),
        "quality_flags": F.when(k % 31 == 0, F.lit('{"disease_ambiguous": "Y"}')),
    })


def wrapped(body: Column, k: Column) -> Column:
    """Answer text around a JSON body: plain, fenced, in prose, or followed by more."""
    return (F.when(k % 5 == 0, body)
            .when(k % 5 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
            .when(k % 5 == 2, F.concat(F.lit("Here it is: "), body, F.lit(" Done }")))
            .when(k % 5 == 3, F.concat(F.lit("\n  "), body, F.lit("{\"x\": 1}")))
            .otherwise(F.concat(F.lit("```\n"), body, F.lit("```"))))


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as source rows with their answer text; every 23rd answer is cut off."""
    k = _k()
    return with_answers(spread(table(spark, sf, "orders"), "o_orderkey").select(
        k.cast("string").alias("pmid"),
        F.concat(F.lit("Order  "), k.cast("string")).alias("title"),
        F.col("o_orderpriority").alias("journal"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("pub_date"),
        k.alias("k"), _c().alias("c")), F.col("k"), F.col("c"))


_BODIES: dict[str, Column] = {}


def with_answers(df: DataFrame, k: Column, c: Column) -> DataFrame:
    """Add the answer text ``content``; every 23rd answer is cut off."""
    session = df.sparkSession.sparkContext.applicationId
    if session not in _BODIES:
        _BODIES[session] = answer_body(F.col("_k"), F.col("_c"))
    keyed = df.select("*", k.alias("_k"), c.alias("_c"))
    body = computed(keyed, {"_body": _BODIES[session]})
    text = computed(body, {"_text": wrapped(F.col("_body"), F.col("_k"))})
    return text.withColumn("content", F.when(F.col("_k") % 23 == 7, F.substring_index("_text", "}", 1))
                           .otherwise(F.col("_text"))).drop("_body", "_text", "_k", "_c")


def _sql_list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_SUBS, _METHODS, _VALS = map(_sql_list, (SUBSPECIALTIES, METHOD_GROUPS, VALIDATION_TYPES))


def _score_sql(seed: str, name: str) -> str:
    """Sub-score columns of one block: clamped, null where missing or block is text."""
    cols = []
    for i in range(len(SCORE_KEYS)):
        cols.append(f"CASE WHEN ({seed}) % 9 = 0 OR ({seed} + {i}) % 13 = 0 THEN NULL ELSE "
                    f"greatest(0, least(20, (({seed}) * {i + 3}) % 27 - 3)) END AS {name}{i}")
    cols.append(f"CASE WHEN ({seed}) % 9 <> 0 AND ({seed}) % 6 = 0 THEN 60 END AS {name}_given")
    return ", ".join(cols)


def _total_sql(name: str) -> str:
    known = " + ".join(f"(CASE WHEN {name}{i} IS NULL THEN 0 ELSE 1 END)" for i in range(5))
    total = " + ".join(f"coalesce({name}{i}, 0)" for i in range(5))
    return (f"CASE WHEN {known} = 5 THEN {total} WHEN {name}_given IS NOT NULL THEN {name}_given "
            f"WHEN {known} > 0 THEN {total} END AS {name}_total, "
            f"({known} = 5 AND {name}_given IS NOT NULL AND {name}_given <> {total}) AS {name}_mismatch")


# parsed = the answer could be read; in the cut-off case it could not
ENTITY_SQL = f"""
  SELECT k, j, idx, sub, out_issue, sub_issue, method, method_issue, validation, val_issue,
         sample_size, auc,
         CASE WHEN explicit_false THEN FALSE
              ELSE validation IN ('external_validation', 'independent_validation_cohort') END AS ext,
         validation IN ('internal_split', 'cross_validation', 'bootstrap', 'temporal_validation') AS int_,
         outcome, e0, e1, e2, e3, e4, {_total_sql('e')}
  FROM (
    SELECT k, j, j + CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS idx,
      CASE WHEN (k + j) % 25 < 23 THEN {_SUBS}[CAST((k + j) % 25 AS INT) + 1] ELSE 'other' END AS sub,
      (k + j) % 25 IN (22, 23) AS sub_issue,
      CASE WHEN (k + j) % 4 = 0 THEN 'mortality' ELSE 'other' END AS outcome,
      (k + j) % 4 = 1 AS out_issue,
      CASE WHEN (k + j) % 16 < 15 THEN {_METHODS}[CAST((k + j) % 16 AS INT) + 1] ELSE 'unclear' END AS method,
      (k + j) % 16 >= 14 AS method_issue,
      CASE WHEN (k + j) % 9 < 8 THEN {_VALS}[CAST((k + j) % 9 AS INT) + 1] ELSE 'unclear' END AS validation,
      (k + j) % 9 = 7 AS val_issue,
      (k + j) % 5 = 0 AS explicit_false,
      CASE WHEN (k + j) % 3 < 2 THEN (k * 7 + j) % 5000 END AS sample_size,
      ((k + j) % 100) / 100.0 AS auc,
      {_score_sql('k + j', 'e')}
    FROM (SELECT o_orderkey AS k, unnest(range(o_orderkey % 4)) AS j FROM orders
          WHERE o_orderkey % 37 <> 0 AND o_orderkey % 23 <> 7))"""

ARTICLE_SQL = f"""
  SELECT *, {_total_sql('a')}
  FROM (
    SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 23 <> 7 AS parsed,
      o_orderkey % 29 <> 0 AS has_art, o_orderkey % 37 <> 0 AS has_models,
      o_orderdate, o_orderpriority,
      CASE WHEN o_orderkey % 23 <> 7 AND o_orderkey % 29 <> 0 AND o_custkey % 25 < 23
           THEN {_SUBS}[CAST(o_custkey % 25 AS INT) + 1] ELSE 'other' END AS sub,
      o_orderkey % 29 <> 0 AND o_custkey % 25 IN (22, 23) AS sub_issue,
      CASE WHEN o_orderkey % 23 = 7 OR o_orderkey % 29 = 0 THEN NULL
           WHEN o_orderkey % 7 IN (1, 4) THEN TRUE WHEN o_orderkey % 7 IN (2, 3, 6) THEN FALSE
      END AS ext_given,
      CASE WHEN o_orderkey % 23 = 7 OR o_orderkey % 29 = 0 THEN NULL
           WHEN o_orderkey % 11 = 0 THEN -1 WHEN o_orderkey % 11 = 1 THEN 5 END AS n_given,
      CASE WHEN o_orderkey % 23 = 7 THEN 0
           ELSE least(100, (o_orderkey * 3) % 130) END AS confidence,
      o_orderkey % 31 = 0 AS ambiguous,
      CASE WHEN o_orderkey % 23 = 7 OR o_orderkey % 29 = 0 THEN 9 ELSE o_orderkey END AS seed,
      {_score_sql('CASE WHEN o_orderkey % 23 = 7 OR o_orderkey % 29 = 0 THEN 9 ELSE o_orderkey END', 'a')}
    FROM orders)"""

# one row per order: the document's article level with roll-ups, issue count, review flag
DOCUMENT_SQL = f"""
  SELECT a.k, a.c, a.sub, a.parsed, a.o_orderdate, a.o_orderpriority, a.a_total, a.confidence,
    coalesce(e.n, 0) AS n_entities,
    CASE WHEN a.n_given >= 0 THEN a.n_given ELSE coalesce(e.n, 0) END AS n_models,
    coalesce(a.ext_given, e.any_ext) AS ext, e.any_int AS int_,
    CASE WHEN NOT a.parsed THEN 1 ELSE
      (CASE WHEN NOT a.has_art THEN 1 ELSE 0 END) + (CASE WHEN NOT a.has_models THEN 1 ELSE 0 END)
      + (CASE WHEN a.sub_issue THEN 1 ELSE 0 END) + (CASE WHEN a.a_mismatch THEN 1 ELSE 0 END)
      + (CASE WHEN a.has_models AND a.k % 17 = 0 THEN 1 ELSE 0 END) + coalesce(e.issues, 0)
      + (CASE WHEN a.n_given < 0 THEN 1 ELSE 0 END) END AS n_issues,
    a.ambiguous AND a.parsed AS ambiguous, coalesce(e.scored, 0) AS scored, e.ext_n, e.total_sum
  FROM ({ARTICLE_SQL}) a LEFT JOIN (
    SELECT k, count(*) AS n, bool_or(ext) AS any_ext, bool_or(int_) AS any_int,
      count(e_total) AS scored, count(*) FILTER (WHERE ext) AS ext_n, sum(e_total) AS total_sum,
      sum(CAST(sub_issue AS INT) + CAST(out_issue AS INT) + CAST(method_issue AS INT)
          + CAST(val_issue AS INT) + CAST(e_mismatch AS INT)) AS issues
    FROM ({ENTITY_SQL}) GROUP BY k) e ON a.k = e.k"""

REVIEW_SQL = "(n_issues > 0 OR ambiguous OR confidence < 60 OR n_entities = 0 OR scored = 0)"

# --- orders, customers and lineitems as the two analysis frames ----------------------------

FRAME_ARTICLES_SQL = """
  SELECT CAST(o_orderkey AS VARCHAR) AS pmid, 'Order ' || o_orderkey AS title,
    o_orderpriority AS journal, strftime(o_orderdate, '%Y-%m-%d') AS pub_date,
    CASE WHEN o_orderkey % 19 <> 0 THEN c_mktsegment END AS primary_subspecialty,
    CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS article_has_external_validation,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS article_has_internal_validation,
    year(o_orderdate) AS year,
    CAST(o_orderkey % 21 AS INT) AS study_sample_size_score, CAST(o_custkey % 21 AS INT) AS study_validation_rigor_score,
    CAST((o_orderkey + o_custkey) % 21 AS INT) AS study_method_score,
    CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 20 END AS INT) AS study_performance_score,
    CAST(7 AS INT) AS study_clinical_applicability_score,
    CAST(CASE WHEN o_orderkey % 8 <> 0 THEN (o_orderkey * 7 + o_custkey) % 101 END AS INT) AS study_total_score
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def frame_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Article frame of the analysis: orders with the customer's segment as subspecialty."""
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    seg = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = table(spark, sf, "orders").join(seg, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        _k().cast("string").alias("pmid"), F.concat(F.lit("Order "), _k().cast("string")).alias("title"),
        F.col("o_orderpriority").alias("journal"), F.date_format(day, "yyyy-MM-dd").alias("pub_date"),
        F.when(_k() % 19 != 0, F.col("c_mktsegment")).alias("primary_subspecialty"),
        F.when(status == "F", True).when(status == "O", False)
        .alias("article_has_external_validation"),
        F.when(_k() % 3 != 0, _k() % 2 == 0).alias("article_has_internal_validation"),
        F.year(day).alias("year"),
        (_k() % 21).cast("int").alias("study_sample_size_score"),
        (_c() % 21).cast("int").alias("study_validation_rigor_score"),
        ((_k() + _c()) % 21).cast("int").alias("study_method_score"),
        F.when(_k() % 5 != 0, _c() % 20).cast("int").alias("study_performance_score"),
        F.lit(7).alias("study_clinical_applicability_score"),
        F.when(_k() % 8 != 0, (_k() * 7 + _c()) % 101).cast("int").alias("study_total_score"))


FRAME_ENTITIES_SQL = """
  SELECT CAST(l_orderkey AS VARCHAR) AS _source_pmid, l_linenumber AS model_id_within_article,
    CASE WHEN l_partkey % 13 <> 0 THEN 'm' || (l_partkey % 6) END AS model_method_group,
    CASE WHEN l_partkey % 17 <> 0 THEN 's' || (l_suppkey % 5) END AS disease_subspecialty,
    l_returnflag AS outcome_group,
    CASE l_linenumber % 4 WHEN 0 THEN 'external_validation' WHEN 1 THEN 'bootstrap'
      WHEN 2 THEN 'none_reported' ELSE 'internal_split' END AS validation_type,
    CASE WHEN l_partkey % 7 = 0 THEN TRUE ELSE l_linenumber % 4 = 0 AND l_partkey % 11 <> 0 END AS has_external_validation,
    l_linenumber % 4 IN (1, 3) AS has_internal_validation,
    CAST(l_quantity * 50 AS BIGINT) AS sample_size, CAST(l_partkey % 21 AS INT) AS sample_size_score,
    CAST(l_suppkey % 21 AS INT) AS validation_rigor_score, CAST(l_partkey % 19 AS INT) AS performance_score,
    l_discount AS auc, l_tax > 0.04 AS calibration
  FROM lineitem"""


def frame_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Entity frame of the analysis: line items."""
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("_source_pmid"), n.alias("model_id_within_article"),
        F.when(p % 13 != 0, F.concat(F.lit("m"), (p % 6).cast("string"))).alias("model_method_group"),
        F.when(p % 17 != 0, F.concat(F.lit("s"), (s % 5).cast("string"))).alias("disease_subspecialty"),
        F.col("l_returnflag").alias("outcome_group"),
        F.when(n % 4 == 0, "external_validation").when(n % 4 == 1, "bootstrap")
        .when(n % 4 == 2, "none_reported").otherwise("internal_split").alias("validation_type"),
        F.when(p % 7 == 0, True).otherwise((n % 4 == 0) & (p % 11 != 0))
        .alias("has_external_validation"),
        (n % 4).isin(1, 3).alias("has_internal_validation"),
        (F.col("l_quantity") * 50).cast("bigint").alias("sample_size"),
        (p % 21).cast("int").alias("sample_size_score"),
        (s % 21).cast("int").alias("validation_rigor_score"),
        (p % 19).cast("int").alias("performance_score"),
        F.col("l_discount").alias("auc"), (F.col("l_tax") > 0.04).alias("calibration"))

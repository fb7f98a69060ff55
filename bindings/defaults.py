"""Defaults and parameters that other queries leave out: fences, vocabularies, rubric bands, renames."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence.functions import jsontext
from evidence.functions.text import computed
from evidence.operators import analysis, chunks
from evidence.operators.normalize import normalize
from evidence.plans import extract
from evidence.schema import DEFAULT_SCHEMA, SUBSPECIALTIES, TRIAL_ADDED, TRIAL_RENAMES

from .extraction import ONE_MODEL, article, documents, entity, order_responses, order_sources
from .frames import DOCUMENT_SQL, ENTITY_SQL, FRAME_ENTITIES_SQL, answers, frame_entities
from .registry import bound, table


@bound("""SELECT event_id, md5(CASE WHEN event_id % 5 = 4 THEN '``' || props ELSE props END) AS digest FROM events""")
def code_fences(spark, sf):
    """Event JSON out of fences: with and without a language, left open, absent, and too short to be one."""
    k, body = F.col("event_id") % 5, F.col("props")
    wrapped = (F.when(k == 0, F.concat(F.lit(" ```json\n"), body, F.lit("\n```\n"))).when(k == 1, F.concat(F.lit("```"), body, F.lit("```")))
               .when(k == 2, F.concat(F.lit("```JSON "), body)).when(k == 3, F.concat(F.lit("\n\t"), body, F.lit(" ")))
               .otherwise(F.concat(F.lit("``"), body)))
    return table(spark, sf, "events").select("event_id", F.md5(jsontext.strip_code_fence(wrapped)).alias("digest"))


_FEW = SUBSPECIALTIES[:4]
_IN_FEW = f"sub IN ({', '.join(repr(s) for s in _FEW)})"


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, 'article' AS level, CASE WHEN {_IN_FEW} THEN sub ELSE 'other' END AS sub FROM ({DOCUMENT_SQL})
  UNION ALL SELECT CAST(k AS VARCHAR), 'model', CASE WHEN {_IN_FEW} THEN sub ELSE 'other' END FROM ({ENTITY_SQL})""")
def smaller_vocabulary(spark, sf):
    """Documents of a schema whose subspecialties are four and ``other``."""
    schema = DEFAULT_SCHEMA.adapted(vocabularies={"subspecialty": (*_FEW, "other")})
    parsed = computed(answers(spark, sf), {"raw": jsontext.parse_object("content")})
    docs = normalize(parsed, schema, fields=[*article("primary_subspecialty"), *entity("disease_subspecialty")])
    one = docs.select("pmid", F.lit("article").alias("level"), F.col("doc.article_level.primary_subspecialty").alias("sub"))
    each = docs.select("pmid", F.explode("doc.model_level").alias("e")).select(
        "pmid", F.lit("model").alias("level"), F.col("e.disease_subspecialty").alias("sub"))
    return one.unionByName(each)


@bound(f"""SELECT sub AS disease_subspecialty, round(avg(CAST(CASE WHEN sample_size < 100 THEN e0 BETWEEN 0 AND 5 WHEN sample_size < 500 THEN e0 BETWEEN 5 AND 10
      WHEN sample_size = 500 THEN e0 BETWEEN 5 AND 15 WHEN sample_size <= 2000 THEN e0 BETWEEN 10 AND 15
      WHEN sample_size > 2000 THEN e0 BETWEEN 15 AND 20 END AS INT)) * 100, 6) AS sample_size_pct,
    round(avg(CAST(CASE WHEN ext THEN e1 BETWEEN 12 AND 20 WHEN int_ THEN e1 BETWEEN 5 AND 12 ELSE e1 BETWEEN 0 AND 5 END AS INT)) * 100, 6) AS validation_pct,
    round(avg(CAST(e3 BETWEEN 10 AND 18 AS INT)) * 100, 6) AS performance_pct FROM ({ENTITY_SQL}) GROUP BY sub""")
def rubric_of_documents(spark, sf):
    """Scores inside the default rubric bands, per subspecialty of the entities."""
    named = entity("disease_subspecialty", "sample_size", "has_external_validation", "has_internal_validation",
                   "performance_metrics", "model_quality_score")
    ent = documents(spark, sf, named).select(F.explode("doc.model_level").alias("e")).select("e.*")
    report = analysis.rubric_report(ent, "disease_subspecialty", analysis.default_bands())
    return report.select("disease_subspecialty", *[F.round(c, 6).alias(c) for c in report.columns[1:]])


_NEXT = "(o_orderkey + 1000)"


@bound(f"""SELECT CAST(o_orderkey AS VARCHAR) AS pmid, CAST({_NEXT} AS VARCHAR) AS reported_pmid, substr(o_orderpriority, 1, 1) AS shard
  FROM orders WHERE {_NEXT} % 23 <> 7 AND {_NEXT} % 29 <> 0 AND {_NEXT} % 10 <> 0""")
def mismatched_ids(spark, sf):
    """Documents that report the id of another record: answers of orders a thousand keys on."""
    said = order_responses(spark, sf, 1000, "m1", 1)
    rows = extract.extract(order_sources(spark, sf), said, settings=ONE_MODEL, fields=article("pmid"))
    return extract.id_mismatches(rows)


@bound(f"""SELECT model_id_within_article AS arm_id, model_method_group AS intervention_type, count(*) AS n,
    count(*) FILTER (WHERE CAST(NULL AS VARCHAR) IS NOT NULL) AS endpoints FROM ({FRAME_ENTITIES_SQL}) GROUP BY ALL""")
def trial_entities(spark, sf):
    """Entities under the names of trials, with their added fields still empty."""
    named = analysis.adapt_entities(frame_entities(spark, sf), TRIAL_RENAMES, TRIAL_ADDED)
    return named.groupBy("arm_id", "intervention_type").agg(F.count("*").alias("n"), F.count("primary_endpoint").alias("endpoints"))


@bound("SELECT CAST(o_orderkey AS VARCHAR) AS pmid, row_number() OVER (ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR)) AS place FROM orders")
def places_in_order(spark, sf):
    """The place of every row of a global sort, across its ranges."""
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("pmid"), "o_orderdate")
    placed = chunks.sorted_by(rows, F.desc("o_orderdate")).select("pmid", F.monotonically_increasing_id().alias("i"))
    return chunks.number_rows(placed, ["i"]).select("pmid", F.col("row_no").alias("place"))


# two runs: the first lacks every third order, the second every third but one; every eleventh has no id
@bound(f"""WITH a AS (SELECT k, sub, k % 11 = 0 AS lone FROM ({DOCUMENT_SQL}) WHERE k % 3 <> 0),
  b AS (SELECT k, CASE WHEN k % 2 = 0 THEN sub ELSE 'other' END AS sub, k % 11 = 0 AS lone FROM ({DOCUMENT_SQL}) WHERE k % 3 <> 1)
  SELECT 'article_level.primary_subspecialty' AS field,
    (SELECT count(*) FROM a JOIN b ON a.k = b.k WHERE NOT a.lone) AS both,
    (SELECT count(*) FROM a JOIN b ON a.k = b.k WHERE NOT a.lone AND a.sub <> b.sub) AS changed,
    (SELECT count(*) FROM a WHERE NOT lone AND k % 3 = 1) AS only_first, (SELECT count(*) FROM b WHERE NOT lone AND k % 3 = 0) AS only_second,
    (SELECT count(*) FROM a WHERE lone) AS keyless_first, (SELECT count(*) FROM b WHERE lone) AS keyless_second""")
def compared_sides(spark, sf):
    """Documents of two runs that hold different records, some of them without id."""
    field = article("primary_subspecialty")
    k = F.col("pmid").cast("bigint")
    docs = documents(spark, sf, field).select("pmid", "doc").withColumn("k", k)
    named = docs.withColumn("pmid", F.when(F.col("k") % 11 == 0, F.lit(" ")).otherwise(F.col("pmid")))
    other = named.withColumn("doc", F.when(F.col("k") % 2 == 0, F.col("doc")).otherwise(
        F.col("doc").withField("article_level.primary_subspecialty", F.lit("other"))))
    return analysis.compare_documents(named.filter("k % 3 <> 0"), other.filter("k % 3 <> 1"), field).select(
        "field", "both", "changed", "only_first", "only_second", "keyless_first", "keyless_second")

"""Analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidence.operators import analysis
from evidence.schema import TRIAL_ADDED
from evidence.session import shared_folder
from evidence.sources import jsonl, sinks

from . import extraction
from .frames import (ARTICLES_SQL, DOCUMENT_SQL, ENTITY_SQL, FRAME_ARTICLES_SQL as A,
                     FRAME_ENTITIES_SQL as E, articles, frame_articles, frame_entities)
from .registry import bound, table

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
METHODS = tuple(f"m{i}" for i in range(6))
SUB = ("study_sample_size_score", "study_validation_rigor_score", "study_method_score",
       "study_performance_score", "study_clinical_applicability_score")


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@bound(f"""SELECT (SELECT count(*) FROM ({A})) AS n_articles, (SELECT count(*) FROM ({E})) AS n_entities,
    (SELECT count(DISTINCT pmid) FROM ({A})) AS n_pmids,
    round(CAST((SELECT count(*) FROM ({E})) AS DOUBLE) / (SELECT count(*) FROM ({A})), 6) AS mean_entities""")
def corpus_counts(spark, sf):
    return _rounded(analysis.corpus_counts(frame_articles(spark, sf), frame_entities(spark, sf)), "mean_entities")


@bound(f"SELECT primary_subspecialty, count(*) AS n FROM ({A}) WHERE primary_subspecialty IS NOT NULL GROUP BY 1")
def subspecialty_counts(spark, sf):
    return analysis.value_counts(frame_articles(spark, sf), "primary_subspecialty")


@bound(f"SELECT model_method_group, count(*) AS n FROM ({E}) WHERE model_method_group IS NOT NULL GROUP BY 1")
def method_counts(spark, sf):
    return analysis.value_counts(frame_entities(spark, sf), "model_method_group")


@bound(f"""SELECT outcome_group, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM ({E})), 6) AS share
  FROM ({E}) GROUP BY 1""")
def outcome_shares(spark, sf):
    return _rounded(analysis.value_shares(frame_entities(spark, sf), "outcome_group"), "share")


@bound(f"SELECT CAST(year AS INT) AS year, count(*) AS n FROM ({A}) GROUP BY 1")
def articles_per_year(spark, sf):
    return analysis.yearly(frame_articles(spark, sf))


@bound(f"""SELECT primary_subspecialty, round(avg(study_total_score), 6) AS mean FROM ({A})
  WHERE primary_subspecialty IS NOT NULL GROUP BY 1""")
def mean_score_by_subspecialty(spark, sf):
    return _rounded(analysis.mean_by(frame_articles(spark, sf), "primary_subspecialty", "study_total_score"), "mean")


@bound(f"""SELECT round(avg(CAST(article_has_external_validation AS INT)) * 100, 6) AS article_has_external_validation_pct,
    round(avg(CAST(article_has_internal_validation AS INT)) * 100, 6) AS article_has_internal_validation_pct FROM ({A})""")
def validation_rates(spark, sf):
    flags = ("article_has_external_validation", "article_has_internal_validation")
    return _rounded(analysis.validation_rates(frame_articles(spark, sf), flags), *[f"{f}_pct" for f in flags])


def _describe(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            f"CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, "
            f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, "
            f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM ({A})")


@bound(" UNION ALL ".join(map(_describe, analysis.STUDY_SCORES)))
def described_scores(spark, sf):
    return _rounded(analysis.describe_scores(frame_articles(spark, sf), analysis.STUDY_SCORES), "mean", "std")


def _pivot(row: str, column: str, values, frame: str) -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE {column} = '{v}') AS \"{v}\"" for v in values)
    quoted = ", ".join(f"'{v}'" for v in values)
    return f"SELECT {row}, {cells} FROM ({frame}) WHERE {row} IS NOT NULL AND {column} IN ({quoted}) GROUP BY 1"


@bound(_pivot("disease_subspecialty", "model_method_group", METHODS, E))
def subspecialty_by_method(spark, sf):
    return analysis.crosstab(frame_entities(spark, sf), "disease_subspecialty", "model_method_group", METHODS)


@bound(_pivot("CAST(year AS INT) AS year", "primary_subspecialty", SEGMENTS, A)
       .replace("WHERE CAST(year AS INT) AS year IS NOT NULL AND", "WHERE"))
def year_by_subspecialty(spark, sf):
    return analysis.crosstab(frame_articles(spark, sf), "year", "primary_subspecialty", SEGMENTS)


@bound(f"""SELECT a.primary_subspecialty, count(DISTINCT pmid) AS n_articles, count(pmid) AS n_models,
    round(avg(CAST(article_has_external_validation AS INT)) * 100, 6) AS external_validation_pct,
    round(avg(study_total_score), 6) AS mean_quality, median(CAST(year AS DOUBLE)) AS median_year,
    CAST(coalesce(sum(e.n), 0) AS BIGINT) AS n_entities
  FROM ({A}) a LEFT JOIN (SELECT _source_pmid, count(*) AS n FROM ({E}) GROUP BY 1) e ON a.pmid = e._source_pmid
  WHERE a.primary_subspecialty IS NOT NULL GROUP BY 1""")
def table_one(spark, sf):
    t = analysis.table1(frame_articles(spark, sf), frame_entities(spark, sf))
    return _rounded(t, "external_validation_pct", "mean_quality")


_TOP = f"SELECT primary_subspecialty FROM ({A}) WHERE primary_subspecialty IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3"


@bound(f"SELECT primary_subspecialty, {', '.join(f'round(avg({c}), 6) AS {c}' for c in SUB)} FROM ({A}) "
       f"WHERE primary_subspecialty IN ({_TOP}) GROUP BY 1")
def score_profile_of_top(spark, sf):
    return _rounded(analysis.top_k_means(frame_articles(spark, sf), "primary_subspecialty", SUB, 3), *SUB)


@bound(f"SELECT primary_subspecialty, count(*) AS n FROM ({A}) WHERE primary_subspecialty IN ({_TOP}) GROUP BY 1")
def top_subspecialties(spark, sf):
    return analysis.top_k(frame_articles(spark, sf), "primary_subspecialty", 3)


@bound(f"SELECT pmid, primary_subspecialty FROM ({A}) WHERE primary_subspecialty IN ({_TOP})")
def rows_of_top(spark, sf):
    return analysis.in_top_k(frame_articles(spark, sf), "primary_subspecialty", 3).select("pmid", "primary_subspecialty")


@bound(f"""SELECT _source_pmid, model_id_within_article, model_method_group, disease_subspecialty, a.pmid,
    title, journal, pub_date, primary_subspecialty, l.n FROM (
    SELECT _source_pmid, model_id_within_article, model_method_group, disease_subspecialty, count(*) AS n FROM ({E}) GROUP BY ALL) l
  JOIN ({A}) a ON a.pmid = l._source_pmid""")
def exported_join(spark, sf):
    keys = ("_source_pmid", "model_id_within_article", "model_method_group", "disease_subspecialty")
    ent = frame_entities(spark, sf).groupBy(*keys).agg(F.count("*").alias("n"))
    return analysis.export_join(ent, frame_articles(spark, sf))


@bound(f"""SELECT CAST(d.k AS VARCHAR) AS pmid, 'Order ' || d.k AS title, o_orderpriority AS journal, d.sub AS primary_subspecialty,
    CAST(e.j + 1 AS INT) AS model_id_within_article, e.method AS model_method_group FROM ({DOCUMENT_SQL}) d JOIN ({ENTITY_SQL}) e ON d.k = e.k""")
def exported_documents(spark, sf):
    out = analysis.export_documents(extraction.documents(spark, sf))
    return out.select("pmid", "title", "journal", "primary_subspecialty", "model_id_within_article", "model_method_group")


_PROFILED = ("title", "primary_subspecialty", "article_has_external_validation", "study_total_score", "year")


@bound(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) FILTER (WHERE {c} IS NULL OR CAST({c} AS VARCHAR) = '') AS n_missing FROM ({A})"
                         for c in _PROFILED))
def missing_values(spark, sf):
    return analysis.null_profile(frame_articles(spark, sf), _PROFILED)


@bound(f"""SELECT 'model_method_group' AS "column", model_method_group AS value, count(*) AS n FROM ({E})
    WHERE model_method_group NOT IN ('m0', 'm1', 'm2') GROUP BY 2
  UNION ALL SELECT 'outcome_group', outcome_group, count(*) FROM ({E}) WHERE outcome_group NOT IN ('A', 'N') GROUP BY 2""")
def vocabulary_violations(spark, sf):
    return analysis.vocabulary_report(frame_entities(spark, sf), {
        "model_method_group": METHODS[:3], "outcome_group": ("A", "N")})


@bound(f"""SELECT count(*) AS n,
    count(*) FILTER (WHERE x AND validation_type IN ('internal_split', 'cross_validation', 'bootstrap', 'temporal_validation')) AS external_but_type_internal,
    count(*) FILTER (WHERE NOT x AND validation_type = 'external_validation') AS type_external_but_flag_false,
    count(*) FILTER (WHERE x AND validation_rigor_score < 12) AS external_but_low_rigor,
    count(*) FILTER (WHERE NOT x AND NOT has_internal_validation AND validation_rigor_score > 5) AS unvalidated_but_high_rigor
  FROM (SELECT *, has_external_validation AS x FROM ({E}))""")
def contradictions(spark, sf):
    return analysis.cross_check(frame_entities(spark, sf))


@bound(f"""SELECT disease_subspecialty,
    round(avg(CAST(CASE WHEN sample_size < 100 THEN sample_size_score BETWEEN 0 AND 5
      WHEN sample_size = 500 THEN sample_size_score BETWEEN 5 AND 15
      WHEN sample_size < 500 THEN sample_size_score BETWEEN 5 AND 10 WHEN sample_size <= 2000 THEN sample_size_score BETWEEN 10 AND 15
      ELSE sample_size_score BETWEEN 15 AND 20 END AS INT)) * 100, 6) AS sample_size_pct,
    round(avg(CAST(CASE WHEN has_external_validation THEN validation_rigor_score BETWEEN 12 AND 20
      WHEN has_internal_validation THEN validation_rigor_score BETWEEN 5 AND 12
      ELSE validation_rigor_score BETWEEN 0 AND 5 END AS INT)) * 100, 6) AS validation_pct,
    round(avg(CAST(CASE WHEN auc > 0 AND calibration THEN performance_score BETWEEN 10 AND 18
      WHEN auc > 0 THEN performance_score BETWEEN 5 AND 10 ELSE performance_score = 0 END AS INT)) * 100, 6) AS performance_pct
  FROM ({E}) WHERE disease_subspecialty IS NOT NULL GROUP BY 1""")
def rubric_bands(spark, sf):
    auc = F.col("auc") > 0
    bands = {
        "sample_size": analysis.sample_size_in_band(F.col("sample_size"), F.col("sample_size_score")),
        "validation": analysis.validation_in_band(F.col("has_external_validation"), F.col("has_internal_validation"),
                                                  F.col("validation_rigor_score")),
        "performance": analysis.performance_in_band(auc, auc & F.col("calibration"), F.lit(False), F.col("performance_score")),
    }
    out = analysis.rubric_report(frame_entities(spark, sf), "disease_subspecialty", bands)
    return _rounded(out, *[f"{b}_pct" for b in bands])


@bound("""SELECT CAST(step AS INT) AS step, stage, n FROM (VALUES (0, 'documents', (SELECT count(*) FROM documents)), (1, 'labelled', (SELECT count(*) FROM labels)),
    (2, 'good', (SELECT count(*) FROM labels WHERE quality = 1))) t(step, stage, n)""")
def reconciled_stages(spark, sf):
    labels = table(spark, sf, "labels")
    return analysis.reconcile({"documents": articles(spark, sf), "labelled": labels,
                               "good": labels.filter("quality = 1")})


@bound("""SELECT CAST(step AS INT) AS step, stage, n AS calls, CAST(n * tin AS BIGINT) AS tokens_in, CAST(n * tout AS BIGINT) AS tokens_out FROM (VALUES
    (0, 'prescreen', (SELECT count(*) FROM documents WHERE n_chars >= 50), 500, 100), (1, 'extract', (SELECT count(*) FROM labels WHERE quality = 1), 2000, 1000),
    (2, 'arbitrate', (SELECT count(*) FROM labels WHERE quality = 1 AND toxic = 1), 2000, 1000)) t(step, stage, n, tin, tout)""")
def workload_funnel(spark, sf):
    labels = table(spark, sf, "labels").filter("quality = 1")
    return analysis.funnel({"prescreen": articles(spark, sf).filter(F.char_length("abstract") >= 50),
                            "extract": labels, "arbitrate": labels.filter("toxic = 1")})


@bound(f"""SELECT model_method_group AS intervention_type, CAST(NULL AS VARCHAR) AS primary_endpoint, count(*) AS n
  FROM ({E}) GROUP BY 1""")
def adapted_entities(spark, sf):
    renames = {"model_method_group": "intervention_type", "model_id_within_article": "arm_id"}
    ent = analysis.adapt_entities(frame_entities(spark, sf), renames, TRIAL_ADDED)
    return ent.groupBy("intervention_type", "primary_endpoint").agg(F.count("*").alias("n"))


@bound(f"""SELECT CAST(k AS VARCHAR) AS pmid, CAST(a0 AS INT) AS study_sample_size_score, CAST(a4 AS INT) AS study_clinical_applicability_score,
    CAST(a_total AS INT) AS study_total_score FROM (SELECT d.k, a.a0, a.a4, d.a_total FROM ({DOCUMENT_SQL}) d JOIN ({extraction.ARTICLE_SQL}) a ON d.k = a.k)""")
def flattened_scores(spark, sf):
    art, _ = jsonl.split_levels(extraction.documents(spark, sf))
    return art.select("pmid", "study_sample_size_score", "study_clinical_applicability_score", "study_total_score")


@bound(f"SELECT primary_subspecialty, CAST(count(*) AS VARCHAR) AS n FROM ({A}) WHERE primary_subspecialty IS NOT NULL GROUP BY 1")
def exported_csv(spark, sf):
    path = shared_folder(spark, "csv")
    sinks.write_csv(analysis.value_counts(frame_articles(spark, sf), "primary_subspecialty"), path)
    return spark.read.option("header", True).csv(path)


@bound(f"SELECT pmid, title, journal, pub_date FROM ({ARTICLES_SQL})")
def projected_articles(spark, sf):
    path = shared_folder(spark, "export")
    columns = ("pmid", "title", "journal", "pub_date")
    sinks.write_table(articles(spark, sf).select(*columns), path)
    return spark.read.parquet(path)




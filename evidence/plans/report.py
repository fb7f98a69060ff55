"""Analysis pack over extracted documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import analysis
from ..schema import DEFAULT_SCHEMA, SCORE_KEYS, ExtractionSchema
from ..sources import jsonl, sinks


def analysis_pack(docs: DataFrame, schema: ExtractionSchema = DEFAULT_SCHEMA) -> dict[str, DataFrame]:
    """All tables of the guide, lazily, by name."""
    art, ent = jsonl.split_levels(docs, schema)
    group = schema.article_group
    v = schema.vocabularies
    return {
        "counts": analysis.corpus_counts(art, ent),
        "subspecialties": analysis.value_counts(art, group),
        "per_year": analysis.yearly(art),
        "methods": analysis.value_counts(ent, schema.entity_method),
        "outcomes": analysis.value_shares(ent, schema.entity_outcome),
        "scores": analysis.describe_scores(art, analysis.STUDY_SCORES),
        "mean_score": analysis.mean_by(art, group, "study_total_score"),
        "validation": analysis.validation_rates(
            art, (schema.article_external, schema.article_internal)),
        "year_by_subspecialty": analysis.crosstab(art, "year", group, v["subspecialty"]),
        "subspecialty_by_method": analysis.crosstab(
            ent, schema.entity_group, schema.entity_method, v["method"]),
        "score_profile": analysis.top_k_means(art, group, [f"study_{k}" for k in SCORE_KEYS]),
        "table1": analysis.table1(art, ent, schema),
        "missing": analysis.null_profile(art, ["pmid", "title", "journal", "pub_date"]),
        "vocabulary": analysis.vocabulary_report(ent, {
            f.name: v[f.vocabulary] for f in schema.entity_fields if f.kind == "enum"}),
        "contradictions": analysis.cross_check(ent, schema),
        "export": analysis.export_documents(docs, schema=schema),
    }


def write_pack(docs: DataFrame, base: str, schema: ExtractionSchema = DEFAULT_SCHEMA) -> None:
    """Small tables as CSV, the full export as Parquet."""
    for name, df in analysis_pack(docs, schema).items():
        path = f"{base.rstrip('/')}/{name}"
        sinks.write_table(df, path) if name == "export" else sinks.write_csv(df, path)

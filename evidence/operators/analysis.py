"""Counts, trends, cross-tabs, score summaries and the export of the two levels.

pandas habits of the guide are kept: null groups drop out, quartiles are linear, ties are
broken by name so that every result is the same on every run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schema import CALL_TOKENS, DEFAULT_SCHEMA, SCORE_KEYS, TOTAL_KEY, ExtractionSchema, Field


def corpus_counts(art: DataFrame, ent: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: articles, entities, distinct ids and mean entities per article."""
    both = (art.select("pmid", F.lit(1).alias("a"), F.lit(0).alias("e"))
            .unionByName(ent.select(F.lit(None).cast("string").alias("pmid"),
                                    F.lit(0).alias("a"), F.lit(1).alias("e"))))
    distinct = F.approx_count_distinct("pmid") if approximate else F.count_distinct("pmid")
    return (both.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("n_articles"),
                     F.coalesce(F.sum("e"), F.lit(0)).alias("n_entities"),
                     distinct.alias("n_pmids"))
            .withColumn("mean_entities",
                        F.try_divide(F.col("n_entities").cast("double"), F.col("n_articles"))))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls drop out."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count("*").alias("n")).orderBy(F.desc("n"), column))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """`value_counts` with the share of each value in percent.

    The total is a scalar subquery over the same exchange, not a window over one task.
    """
    counts = (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).scalar()
    return (counts.withColumn("share", F.col("n") * 100.0 / total)
            .orderBy(F.desc("n"), column))


def top_k(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    return value_counts(df, column).limit(k)


def in_top_k(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """Rows whose value is among the k most frequent; Spark sees how large k values are."""
    return df.join(top_k(df, column, k).select(column), column, "left_semi")


def top_k_means(df: DataFrame, key: str, values: Sequence[str], k: int = 5) -> DataFrame:
    """Mean of several columns for the k most frequent keys.

    Count and means come from one aggregation; the limit then works on its result.
    """
    grouped = (df.filter(F.col(key).isNotNull()).groupBy(key)
               .agg(F.count("*").alias("_n"), *[F.avg(v).alias(v) for v in values]))
    return grouped.orderBy(F.desc("_n"), key).limit(k).drop("_n")


def yearly(df: DataFrame, year: str = "year") -> DataFrame:
    return (df.filter(F.col(year).isNotNull()).groupBy(year)
            .agg(F.count("*").alias("n")).orderBy(year))


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Group means, ascending; groups without any value last."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.avg(value).alias("mean")).orderBy(F.asc_nulls_last("mean"), key))


def validation_rates(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Percent true of nullable flags, nulls ignored; one row."""
    return df.agg(*[(F.avg(F.col(f).cast("int")) * 100).alias(f"{f}_pct") for f in flags])


def describe_scores(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, one row each.

    The exact quartiles keep one counter per distinct value: at most 101 for scores.  Use
    ``approximate`` for columns with an open range.
    """
    quartiles = (F.percentile_approx if approximate else F.percentile)
    stats = [F.struct(
        F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"),
        quartiles(F.col(c), [0.25, 0.5, 0.75]).cast("array<double>").alias("q"),
        F.max(F.col(c).cast("double")).alias("max")) for c in columns]
    wide = df.agg(F.array(*stats).alias("s"))
    s = F.col("s")
    return (wide.select(F.explode("s").alias("s"))
            .select(s["column"].alias("column"), s["n"].alias("n"), s["mean"].alias("mean"),
                    s["std"].alias("std"), s["min"].alias("min"),
                    *[s["q"][i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))],
                    s["max"].alias("max")))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``column`` values per ``row`` value, zero filled.

    The value list is given, so no extra job looks it up.
    """
    kept = df.filter(F.col(row).isNotNull() & F.col(column).isin(*values))
    return (kept.groupBy(row).pivot(column, list(values)).count()
            .na.fill(0, list(values)).orderBy(row))


def table1(art: DataFrame, ent: DataFrame | None = None,
           schema: ExtractionSchema = DEFAULT_SCHEMA,
           score: str = f"study_{TOTAL_KEY}") -> DataFrame:
    """Study characteristics per subspecialty.

    ``n_models`` counts article rows, as the guide does; with ``ent`` the entities of the
    articles are counted too, as ``n_entities``: those of each id once per subspecialty,
    rows without id left out.  Counts add up per id before the join, so
    the distinct count and the entity count share their shuffle on the id.
    """
    group = schema.article_group
    rows = art.filter(F.col(group).isNotNull())
    table = rows.groupBy(group).agg(
        F.count_distinct("pmid").alias("n_articles"), F.count("pmid").alias("n_models"),
        (F.avg(F.col(schema.article_external).cast("int")) * 100)
        .alias("external_validation_pct"),
        F.avg(score).alias("mean_quality"), F.median("year").alias("median_year"))
    if ent is not None:
        named = F.coalesce(F.col("pmid") != "", F.lit(False))
        per_id = (ent.select(F.col("_source_pmid").alias("pmid")).filter(named)
                  .groupBy("pmid").agg(F.count("*").alias("_e")))
        per_group = (rows.select("pmid", group).filter(named).distinct().join(per_id, "pmid")
                     .groupBy(group).agg(F.sum("_e").alias("n_entities")))
        table = (table.join(per_group, group, "left")
                 .withColumn("n_entities", F.coalesce("n_entities", F.lit(0))))
    return table.orderBy(group)


# --- exports -----------------------------------------------------------------------------

EXPORT_COLUMNS = ("pmid", "title", "journal", "pub_date", "primary_subspecialty")


def export_join(ent: DataFrame, art: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS
                ) -> DataFrame:
    """Entities with the fields of their article, inner join on the id.

    Clashing names get ``_entity`` and ``_article``.  Rows without an id have no link and
    stay out; `export_documents` keeps them and needs no join at all.
    """
    clash = (set(ent.columns) & set(columns))
    left = ent.withColumnsRenamed({c: f"{c}_entity" for c in clash})
    right = (art.filter("pmid <> ''").select(*columns)
             .withColumnsRenamed({c: f"{c}_article" for c in clash}))
    key = "pmid_article" if "pmid" in clash else "pmid"
    return left.join(right, left["_source_pmid"] == right[key], "inner")


def export_documents(docs: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS,
                     schema: ExtractionSchema = DEFAULT_SCHEMA) -> DataFrame:
    """The same table straight from the documents: each entity beside its own article."""
    names = [f.name for f in schema.entity_fields]
    clash = set(names) & set(columns)
    level = F.col("doc")[schema.article_key]
    return (docs.select(*[level[c].alias(f"{c}_article" if c in clash else c) for c in columns],
                        level["pmid"].alias("_source_pmid"),
                        F.explode(F.col("doc")[schema.entity_key]).alias("e"))
            .select(*[f"{c}_article" if c in clash else c for c in columns], "_source_pmid",
                    F.col(f"e.{schema.entity_id}"),
                    *[F.col(f"e.{n}").alias(f"{n}_entity" if n in clash else n) for n in names]))


def low_confidence(docs: DataFrame, schema: ExtractionSchema = DEFAULT_SCHEMA) -> DataFrame:
    """Documents that ask for human review."""
    return docs.filter(F.col("doc")["quality_flags"][schema.review_flag])


def adapt_entities(ent: DataFrame, renames: Mapping[str, str],
                   added: Sequence[Field] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Entity frame of another study type: renamed fields and new, still empty ones."""
    types = {"int": "bigint", "float": "double", "bool": "boolean", "list": "array<string>"}
    return ent.drop(*drop).withColumnsRenamed(dict(renames)).withColumns(
        {f.name: F.lit(None).cast(types.get(f.kind, "string")) for f in added})


# --- comparisons and lookups ----------------------------------------------------------------

def compare_documents(first: DataFrame, second: DataFrame, fields: Sequence[str],
                      keys: Sequence[str] = ("pmid",)) -> DataFrame:
    """Differences of two sets of documents per field: ``field, both, changed, filled, emptied,
    only_first, only_second, keyless_first, keyless_second``.

    Documents are paired by their key; those without one (any part empty) pair with nothing and
    are counted apart.  Fields are dotted paths below ``doc``.  ``changed`` counts null as a
    value, ``filled`` and ``emptied`` are the changes from and to null.
    """
    def side(df: DataFrame, name: str, number: int) -> DataFrame:
        named = df.select(*[text.norm_text(k).alias(k) for k in keys],
                          F.array(*[F.col(f"doc.{f}").cast("string") for f in fields]).alias(name))
        lone = reduce(Column.__or__, [F.col(k) == "" for k in keys])
        # rows without key differ by side, so they never meet, and are spread by their content
        return named.withColumns({"_lone": F.when(lone, F.lit(number)).otherwise(F.lit(0)),
                                  "_spread": F.when(lone, F.xxhash64(name)).otherwise(F.lit(0).cast("bigint"))})
    pairs = side(first, "_a", 1).join(side(second, "_b", 2), [*keys, "_lone", "_spread"], "full").select(
        "_lone", F.col("_a").isNotNull().alias("_in_a"), F.col("_b").isNotNull().alias("_in_b"),
        F.posexplode(F.array(*map(F.lit, fields))).alias("_i", "field"), "_a", "_b")
    a, b = F.get("_a", F.col("_i")), F.get("_b", F.col("_i"))
    both, lone = F.col("_in_a") & F.col("_in_b"), F.col("_lone")
    return pairs.groupBy("field").agg(
        F.count_if(both).alias("both"), F.count_if(both & ~a.eqNullSafe(b)).alias("changed"),
        F.count_if(both & a.isNull() & b.isNotNull()).alias("filled"),
        F.count_if(both & a.isNotNull() & b.isNull()).alias("emptied"),
        F.count_if((lone == 0) & ~F.col("_in_b")).alias("only_first"),
        F.count_if((lone == 0) & ~F.col("_in_a")).alias("only_second"),
        F.count_if(lone == 1).alias("keyless_first"), F.count_if(lone == 2).alias("keyless_second"))


def with_synonyms(df: DataFrame, column: str, synonyms: DataFrame, name: str = "canonical") -> DataFrame:
    """Add the canonical term of a label; a label that is not listed is its own.

    ``synonyms`` has ``term`` and ``canonical``; terms are compared as vocabulary keys, and of
    several entries for one term the first canonical one in order counts.
    """
    listed = synonyms.groupBy(text.label("term").alias("_term")).agg(F.min("canonical").alias("_canonical"))
    return (df.withColumn("_term", text.label(column)).join(listed, "_term", "left")
            .withColumn(name, F.coalesce("_canonical", F.col(column))).drop("_term", "_canonical"))


# --- run counters ---------------------------------------------------------------------------

def run_totals(rows: DataFrame, counters: Mapping[str, Column], by: str = "shard") -> DataFrame:
    """Rows and conditional counts per shard plus the grand total (``by`` is null there)."""
    return rows.rollup(by).agg(
        F.count("*").alias("total"),
        *[F.count_if(condition).alias(name) for name, condition in counters.items()])


def reconcile(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per stage, side by side."""
    counted = [df.agg(F.lit(i).alias("step"), F.lit(name).alias("stage"),
                      F.count("*").alias("n"))
               for i, (name, df) in enumerate(stages.items())]
    return reduce(DataFrame.unionByName, counted)


def funnel(stages: Mapping[str, DataFrame],
           tokens: Mapping[str, tuple[int, int]] = CALL_TOKENS) -> DataFrame:
    """Calls and tokens per stage from the actual stage sizes."""
    def per_call(i: int) -> Column:
        chain = F.lit(0)
        for name, cost in tokens.items():
            chain = F.when(F.col("stage") == name, F.lit(cost[i])).otherwise(chain)
        return chain.cast("bigint")
    return reconcile(stages).select(
        "step", "stage", F.col("n").alias("calls"),
        (F.col("n") * per_call(0)).alias("tokens_in"),
        (F.col("n") * per_call(1)).alias("tokens_out"))


# --- quality checks -----------------------------------------------------------------------------

def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null or empty values per column, from one pass."""
    empty = [F.struct(F.lit(c).alias("column"), F.count("*").alias("n"),
                      F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == ""))
                      .alias("n_missing")) for c in columns]
    return df.agg(F.array(*empty).alias("s")).select(F.inline("s"))


def vocabulary_report(df: DataFrame, vocabularies: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside the vocabulary, with counts, for several columns in one pass."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"),
                 F.col(c).isin(*allowed).alias("ok")) for c, allowed in vocabularies.items()]))
    return (df.select(cells.alias("s")).filter("s.value is not null and not s.ok")
            .groupBy(F.col("s.column"), F.col("s.value")).agg(F.count("*").alias("n"))
            .orderBy("column", F.desc("n"), "value"))


def cross_check(ent: DataFrame, schema: ExtractionSchema = DEFAULT_SCHEMA,
                rigor: str = "validation_rigor_score", external_minimum: int = 12,
                none_maximum: int = 5) -> DataFrame:
    """Contradictions between validation flags, validation type and rigor score; one row."""
    ext, kind = F.col(schema.entity_external), F.col(schema.entity_validation)
    internal = F.col(schema.entity_internal)
    score = F.col(schema.entity_score)[rigor] if schema.entity_score in ent.columns else F.col(rigor)
    none = ~F.coalesce(ext, F.lit(False)) & ~F.coalesce(internal, F.lit(False))
    checks = {
        "external_but_type_internal": ext & kind.isin(*schema.internal_values),
        "type_external_but_flag_false": ~ext & kind.isin(*schema.external_values),
        "external_but_low_rigor": ext & (score < external_minimum),
        "unvalidated_but_high_rigor": none & (score > none_maximum),
    }
    return ent.agg(F.count("*").alias("n"),
                   *[F.count_if(c).alias(name) for name, c in checks.items()])


def _in_band(score: Column, lo: int, hi: int) -> Column:
    return score.between(lo, hi)


def sample_size_in_band(n: Column, score: Column) -> Column:
    """Bands by sample size; 500 belongs to both of its bands."""
    return (F.when(n < 100, _in_band(score, 0, 5)).when(n < 500, _in_band(score, 5, 10))
            .when(n == 500, _in_band(score, 5, 15)).when(n <= 2000, _in_band(score, 10, 15))
            .when(n > 2000, _in_band(score, 15, 20)))


def validation_in_band(external: Column, internal: Column, score: Column) -> Column:
    return (F.when(external, _in_band(score, 12, 20)).when(internal, _in_band(score, 5, 12))
            .otherwise(_in_band(score, 0, 5)))


def performance_in_band(discrimination: Column, calibration: Column, full: Column,
                        score: Column) -> Column:
    """Bands by what is reported: nothing, discrimination, with calibration, everything."""
    return (F.when(full, _in_band(score, 18, 20)).when(calibration, _in_band(score, 10, 18))
            .when(discrimination, _in_band(score, 5, 10)).otherwise(score == 0))


def rubric_report(ent: DataFrame, group: str, bands: Mapping[str, Column]) -> DataFrame:
    """Share of scores inside their rubric band per group, in percent; unknowns ignored."""
    return (ent.filter(F.col(group).isNotNull()).groupBy(group)
            .agg(*[(F.avg(b.cast("int")) * 100).alias(f"{name}_pct")
                   for name, b in bands.items()]).orderBy(group))


def default_bands(schema: ExtractionSchema = DEFAULT_SCHEMA) -> dict[str, Column]:
    """Rubric bands on a normalised entity frame."""
    s, m = F.col(schema.entity_score), F.col("performance_metrics")
    discrimination = m["auc"].isNotNull() | m["c_index"].isNotNull()
    calibration = discrimination & F.coalesce(m["calibration_reported"], F.lit(False))
    full = calibration & F.coalesce(m["dca_reported"], F.lit(False)) & m["sensitivity"].isNotNull()
    return {
        "sample_size": sample_size_in_band(F.col("sample_size"), s["sample_size_score"]),
        "validation": validation_in_band(F.col(schema.entity_external),
                                         F.col(schema.entity_internal),
                                         s["validation_rigor_score"]),
        "performance": performance_in_band(discrimination, calibration, full,
                                           s["performance_score"]),
    }


STUDY_SCORES = tuple(f"study_{k}" for k in (*SCORE_KEYS, TOTAL_KEY))

"""The analysis pack kept up to date: partial aggregates per part, merged when read.

`report.analysis_pack` scans all documents for each of its tables. Here a part of the corpus (a
shard, a batch) is read once: its documents become narrow facts, one aggregation over grouping
sets gives the sums of all tables, one more the sketches, and both are committed as a part of the
pack. A part that is repeated replaces its own sums. Reading merges what is committed, a few
hundred rows per part, so the tables cost the same whether a corpus has grown by one shard or by
a thousand.

Counts, means, standard deviations and quartiles of scores are exact: scores are small whole
numbers, so their histogram is kept. Distinct ids (HyperLogLog, relative standard error
1.04 / sqrt(2**HLL_LG)) and quantiles of sample sizes (KLL, rank error about 1.33 % at
KLL_K = 200) are estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import analysis
from ..schema import DEFAULT_SCHEMA, SCORE_KEYS, TOTAL_KEY, ExtractionSchema
from ..sources import commits

KIND = "pack"
HLL_LG = 14
KLL_K = 400
KEYS = ("level", "grp", "year", "method", "outcome", "score", "value")
SETS = (("level",), ("level", "grp"), ("level", "year"), ("level", "year", "grp"), ("level", "method"),
        ("level", "outcome"), ("level", "grp", "method"), ("level", "score", "value"))
FLAGS, SUBS = ("ext", "internal"), tuple(f"s{i}" for i in range(len(SCORE_KEYS)))
MEASURES = (*FLAGS, "total", *SUBS)
FACT_TYPE = ("level string, pmid string, grp string, year int, method string, outcome string, score string, value int, "
             + ", ".join(f"{m} int" for m in MEASURES) + ", size long")
_SUM_TYPE = ("gid long, level string, grp string, year int, method string, outcome string, score string, value int, n long, "
             + ", ".join(f"{m}_sum long, {m}_n long" for m in MEASURES))
_SKETCH_TYPE = "level string, grp string, ids binary, sizes binary"


def fields(schema: ExtractionSchema = DEFAULT_SCHEMA) -> tuple[str, ...]:
    """What of a document the pack reads, for `normalize(..., fields=...)`."""
    s = schema
    return (*[f"{s.article_key}.{n}" for n in ("pmid", "pub_date", s.article_group, s.article_external,
                                               s.article_internal, s.article_score)],
            *[f"{s.entity_key}.{n}" for n in (s.entity_group, s.entity_method, s.entity_outcome, "sample_size")])


def facts(docs: DataFrame, schema: ExtractionSchema = DEFAULT_SCHEMA) -> DataFrame:
    """One row per article, entity and score of an article."""
    s, a = schema, F.col("doc")[schema.article_key]
    names = [part.split()[0] for part in FACT_TYPE.split(", ")]
    kinds = dict(part.split() for part in FACT_TYPE.split(", "))

    def fact(**values: Column) -> Column:
        return F.struct(*[values.get(n, F.lit(None)).cast(kinds[n]).alias(n) for n in names])
    scores = a[s.article_score]
    article = fact(level=F.lit("article"), pmid=a["pmid"], grp=a[s.article_group], year=text.year_of(a["pub_date"]),
                   ext=a[s.article_external], internal=a[s.article_internal], total=scores[TOTAL_KEY],
                   **{c: scores[k] for c, k in zip(SUBS, SCORE_KEYS, strict=True)})
    entities = F.transform(F.col("doc")[s.entity_key], lambda e: fact(
        level=F.lit("entity"), grp=e[s.entity_group], method=e[s.entity_method], outcome=e[s.entity_outcome],
        size=e["sample_size"]))
    given = F.array(*[fact(level=F.lit("score"), score=F.lit(f"study_{k}"), value=scores[k])
                      for k in (*SCORE_KEYS, TOTAL_KEY)])
    return docs.select(F.inline(F.concat(F.array(article), entities, F.filter(given, lambda x: x["value"].isNotNull()))))


def add_part(docs: DataFrame, base: str, run: str, part: str, schema: ExtractionSchema = DEFAULT_SCHEMA) -> None:
    """Aggregate the documents of a part and commit them; a part of that name is replaced."""
    spark = docs.sparkSession
    own = commits.begin(spark, base, KIND, run, part)
    facts(docs, schema).write.mode("overwrite").parquet(own.folder("facts"))
    rows = spark.read.schema(FACT_TYPE).parquet(own.folder("facts"))
    sums = rows.groupingSets([list(s) for s in SETS], *KEYS).agg(
        F.grouping_id().alias("gid"), F.count("*").alias("n"),
        *[x for m in MEASURES for x in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))])
    sums.write.mode("overwrite").parquet(own.folder("sums"))
    (rows.filter("level <> 'score'").groupBy("level", "grp").agg(
        F.hll_sketch_agg("pmid", HLL_LG).alias("ids"), F.kll_sketch_agg_bigint("size", KLL_K).alias("sizes"))
     .write.mode("overwrite").parquet(own.folder("sketches")))
    commits.commit(spark, own)
    commits.drop_folder(spark, own.folder("facts"))


def _of(merged: DataFrame, level: str, *keys: str) -> DataFrame:
    """The rows of one grouping set and level."""
    inside = {"level", *keys}
    gid = sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k not in inside)
    return merged.filter((F.col("gid") == gid) & (F.col("level") == level))


def merged_sums(spark: SparkSession, base: str, run: str) -> DataFrame:
    rows = commits.read(spark, base, KIND, run, "sums", _SUM_TYPE)
    return rows.groupBy("gid", *KEYS).agg(F.sum("n").alias("n"), *[
        F.sum(f"{m}_{x}").alias(f"{m}_{x}") for m in MEASURES for x in ("sum", "n")])


def merged_sketches(spark: SparkSession, base: str, run: str) -> DataFrame:
    """level, grp, ids (HLL), sizes (KLL)."""
    rows = commits.read(spark, base, KIND, run, "sketches", _SKETCH_TYPE)
    return rows.groupBy("level", "grp").agg(F.hll_union_agg("ids").alias("ids"), F.kll_merge_agg_bigint("sizes").alias("sizes"))


def _mean(measure: str) -> Column:
    return F.try_divide(F.col(f"{measure}_sum").cast("double"), F.col(f"{measure}_n"))


def _counted(sums: DataFrame, level: str, key: str, name: str) -> DataFrame:
    return _of(sums, level, key).filter(F.col(key).isNotNull()).select(F.col(key).alias(name), "n")


def _crossed(sums: DataFrame, level: str, row: str, row_name: str, column: str, values) -> DataFrame:
    kept = _of(sums, level, row, column).filter(F.col(row).isNotNull() & F.col(column).isin(*values))
    return (kept.groupBy(F.col(row).alias(row_name)).pivot(column, list(values)).agg(F.sum("n"))
            .na.fill(0, list(values)).orderBy(row_name))


def described(sums: DataFrame) -> DataFrame:
    """Summary of the score columns from their histograms; sums of squares of whole numbers are exact."""
    v, n = F.col("value").cast("double"), F.col("n")
    kept = _of(sums, "score", "score", "value")
    wide = kept.groupBy(F.col("score").alias("column")).agg(
        F.sum("n").alias("n"), F.sum(v * n).alias("_s"), F.sum(v * v * n).alias("_q"), F.min(v).alias("min"),
        F.percentile("value", [0.25, 0.5, 0.75], F.col("n")).alias("_p"), F.max(v).alias("max"))
    every = kept.sparkSession.createDataFrame([(c,) for c in analysis.STUDY_SCORES], "column string")
    total = F.col("n")
    variance = (F.col("_q") - F.col("_s") * F.col("_s") / total) / (total - 1)
    return every.join(wide, "column", "left").select(
        "column", F.coalesce("n", F.lit(0)).alias("n"), (F.col("_s") / total).alias("mean"),
        F.when(total > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("std"), "min",
        *[F.col("_p")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))], "max")


def pack_tables(spark: SparkSession, base: str, run: str, schema: ExtractionSchema = DEFAULT_SCHEMA) -> dict[str, DataFrame]:
    """Tables of the pack over all committed parts, with the columns of `report.analysis_pack`.

    ``counts`` estimates ``n_pmids``; ``sample_sizes`` is a table of estimates by subspecialty.
    """
    s, v = schema, schema.vocabularies
    sums, sketches = merged_sums(spark, base, run), merged_sketches(spark, base, run)
    group = s.article_group
    by_group = _of(sums, "article", "grp").filter("grp is not null").withColumnRenamed("grp", group)
    methods = _counted(sums, "entity", "method", s.entity_method)
    outcomes = _counted(sums, "entity", "outcome", s.entity_outcome)
    ids = sketches.filter("level = 'article'").agg(F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("n_pmids"))
    totals = sums.agg(*[F.coalesce(F.sum(F.when((F.col("gid") == (1 << (len(KEYS) - 1)) - 1) & (F.col("level") == level), F.col("n"))),
                                   F.lit(0)).alias(name) for level, name in (("article", "n_articles"), ("entity", "n_entities"))])
    sizes = sketches.filter("level = 'entity' AND grp is not null AND sizes is not null")
    return {
        "counts": totals.select(
            "n_articles", "n_entities", F.coalesce(ids.scalar(), F.lit(0)).alias("n_pmids"),
            F.try_divide(F.col("n_entities").cast("double"), F.col("n_articles")).alias("mean_entities")),
        "subspecialties": by_group.select(group, "n").orderBy(F.desc("n"), group),
        "per_year": _counted(sums, "article", "year", "year").orderBy("year"),
        "methods": methods.orderBy(F.desc("n"), s.entity_method),
        "outcomes": outcomes.withColumn("share", F.col("n") * 100.0 / outcomes.agg(F.sum("n")).scalar())
        .orderBy(F.desc("n"), s.entity_outcome),
        "scores": described(sums),
        "mean_score": by_group.select(group, _mean("total").alias("mean")).orderBy(F.asc_nulls_last("mean"), group),
        "validation": _of(sums, "article").select(
            *[(_mean(m) * 100).alias(f"{f}_pct") for m, f in zip(FLAGS, (s.article_external, s.article_internal), strict=True)]),
        "year_by_subspecialty": _crossed(sums, "article", "year", "year", "grp", v["subspecialty"]),
        "subspecialty_by_method": _crossed(sums, "entity", "grp", s.entity_group, "method", v["method"]),
        "score_profile": by_group.orderBy(F.desc("n"), group).limit(5).select(
            group, *[_mean(c).alias(f"study_{k}") for c, k in zip(SUBS, SCORE_KEYS, strict=True)]),
        "sample_sizes": sizes.filter(F.kll_sketch_get_n_bigint("sizes") > 0).select(
            F.col("grp").alias(s.entity_group), F.kll_sketch_get_n_bigint("sizes").alias("n"),
            *[F.kll_sketch_get_quantile_bigint("sizes", F.lit(q)).alias(name) for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]),
    }

"""Extraction and arbitration of all shards in one job each."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import analysis, prompts, records
from ..operators.normalize import ISSUES, add_error_note, needs_review, normalize, review_fields
from ..schema import DEFAULT_SCHEMA, REVIEW_THRESHOLD, ExtractionSchema
from ..sources import commits, jsonl, sinks

OUTPUT = ("pmid", "record_key", "shard", "doc", "issues", "status", "audit", "needs_review")


@dataclass(frozen=True)
class RunSettings:
    """Models per stage and review rules of one run."""

    primary_model: str = "primary"
    arbitration_model: str = "arbitration"
    second_pass: bool = False
    threshold: int = REVIEW_THRESHOLD
    scope: str = "shard"
    schema: ExtractionSchema = DEFAULT_SCHEMA


def scheduled(source: DataFrame, done: DataFrame | None = None,
              settings: RunSettings = RunSettings()) -> DataFrame:
    """First row per id that has no output yet.

    The dedupe comes first: it shrinks hot ids inside the tasks, and the resume join then
    works on one row per id.  Where ``done`` names record keys, rows without id are resumed
    too, by their content; by id alone they are worked on again.
    """
    rows = records.dedupe_first(source, scope=settings.scope)
    if done is None:
        return records.with_record_key(rows)
    by_shard = ["shard"] if settings.scope == "shard" and "shard" in done.columns else []
    if "record_key" in done.columns:
        return records.pending(records.with_record_key(rows), done, ["record_key", *by_shard])
    return records.with_record_key(records.pending(rows, done, ["pmid", *by_shard] if by_shard else "pmid"))


def outgoing(source: DataFrame, done: DataFrame | None = None,
             settings: RunSettings = RunSettings(), style: str = "long") -> DataFrame:
    """Extraction prompts of the scheduled rows."""
    return prompts.render_prompts(scheduled(source, done, settings), "record_key",
                                  settings.schema, style)


def _audit(mode: str, status: Column, issues: Column, extra: dict[str, Column]) -> Column:
    """Audit record; ``error`` holds the whole error text."""
    return F.struct(
        F.col("pmid"), F.lit(mode).alias("mode"), *[c.alias(k) for k, c in extra.items()],
        status.alias("status"), issues.alias("issues"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"))


def _wanted(fields: Collection[str] | None, schema: ExtractionSchema) -> set[str] | None:
    """The fields a run needs to judge its documents, besides those that are wanted."""
    if fields is None:
        return None
    return {*fields, ISSUES, *review_fields(schema), f"{schema.article_key}.{schema.article_notes}"}


def extract(source: DataFrame, responses: DataFrame, done: DataFrame | None = None,
            settings: RunSettings = RunSettings(), fields: Collection[str] | None = None) -> DataFrame:
    """One normalised document per scheduled row, with issues, audit and review flag.

    Both answers are joined as parsed VARIANTs before any document is built, so no
    document is shuffled.  The second answer counts only where the first needs review.
    With ``fields``, documents have these and what the review rules look at, nothing else.
    """
    s, fields = settings, _wanted(fields, settings.schema)
    rows = records.attach(scheduled(source, done, s), responses, s.primary_model, 1)
    if s.second_pass:
        rows = records.attach(rows, responses, s.arbitration_model, 2, "raw2", "error2")
    out = normalize(rows, s.schema, error="error", fields=fields)
    failed = F.col("error").isNotNull()
    second = F.lit(False)
    if s.second_pass:
        out = out.withColumn("_again", ~failed & needs_review("doc", s.threshold, s.schema))
        out = _second_pass(out, s, fields)
        second = F.col("_again")
    status = F.when(failed, "error").otherwise("ok")
    out = out.withColumn("status", status)
    return out.select(
        *[c for c in OUTPUT if c not in ("audit", "needs_review")],
        _audit("extract", F.col("status"), F.col("issues"), {
            "primary_model": F.lit(s.primary_model), "inline_second_pass": second,
            "second_pass_model": F.when(second, F.lit(s.arbitration_model)),
            "error": F.coalesce("error_text", F.when(second, F.col("error2_text"))) if s.second_pass
            else F.col("error_text"),
        }).alias("audit"),
        needs_review("doc", s.threshold, s.schema).alias("needs_review"))


def _second_pass(first: DataFrame, s: RunSettings, fields: Collection[str] | None) -> DataFrame:
    """Replace documents that need review by the second answer, or note that it failed."""
    renamed = first.drop("raw").withColumnsRenamed({"doc": "_doc1", "issues": "_issues1"})
    # the second answer of a row that does not need it is not even normalised
    renamed = renamed.withColumn("raw2", F.when(F.col("_again"), F.col("raw2")))
    both = normalize(renamed, s.schema, raw="raw2", fields=fields).withColumn("_bad", F.col("raw2").isNull())
    again, bad = F.col("_again"), F.col("_bad")
    message = F.concat(F.lit("second_pass_failed: "), F.col("error2"))
    failure = F.array(F.concat(F.lit("second_pass_failed:"), text.norm_text("error2")))
    return (both
            .withColumn("_final", F.when(~again, F.col("_doc1"))
                        .when(bad, add_error_note(F.col("_doc1"), message, s.schema))
                        .otherwise(F.col("doc")))
            .withColumn("_all", F.when(~again, F.col("_issues1"))
                        .when(bad, F.concat("_issues1", failure))
                        .otherwise(F.concat("_issues1",
                                            records.with_prefix(F.col("issues"), "second_pass:"))))
            .drop("doc", "issues").withColumnsRenamed({"_final": "doc", "_all": "issues"}))


def rerun_flagged(source: DataFrame, extracted: DataFrame, responses: DataFrame,
                  adjudicated: DataFrame | None = None, settings: RunSettings = RunSettings(),
                  fields: Collection[str] | None = None) -> DataFrame:
    """Arbitration: flagged rows that are not adjudicated yet, with the other model's answer."""
    s = settings
    keep = ["shard"] if s.scope == "shard" and "shard" in extracted.columns else []
    return _rerun(source, records.flagged_ids(extracted, s.threshold, s.schema, keep), responses, adjudicated, s, fields)


def _rerun(source: DataFrame, flagged: DataFrame, responses: DataFrame, adjudicated: DataFrame | None,
           s: RunSettings, fields: Collection[str] | None = None) -> DataFrame:
    """`rerun_flagged` of the ids in ``flagged``, within their shards if it has these."""
    keys, keep = (["pmid", "shard"], ["shard"]) if "shard" in flagged.columns else ("pmid", [])
    rows = records.drop_missing_ids(source)
    rows = records.selected(rows, flagged, keys)
    if adjudicated is not None:
        done = records.processed_ids(adjudicated, s.schema, keep)
        rows = records.pending(rows, done, keys)
    rows = records.attach(records.with_record_key(rows), responses, s.arbitration_model, 2)
    out = normalize(rows, s.schema, error="error", error_label="rerun_failed",
                    fields=_wanted(fields, s.schema))
    out = out.withColumn("status", F.when(F.col("error").isNotNull(), "error").otherwise("ok"))
    return out.select(
        *[c for c in OUTPUT if c not in ("audit", "needs_review")],
        _audit("rerun_flagged", F.col("status"), F.col("issues"),
               {"model": F.lit(s.arbitration_model), "error": F.col("error_text")}).alias("audit"),
        needs_review("doc", s.threshold, s.schema).alias("needs_review"))


def review_rows(rows: DataFrame, existing: DataFrame | None = None,
                schema: ExtractionSchema = DEFAULT_SCHEMA) -> DataFrame:
    """Review stream: rows that need review, one per reported id and shard, new ids only.

    Rows whose document has no id are all kept.
    """
    reported = rows.filter("needs_review").withColumn(
        "_reported", F.col("doc")[schema.article_key]["pmid"])
    first = records.dedupe_first(reported, "_reported", order=("record_key",))
    if existing is not None:
        ids = records.processed_ids(existing, schema, ["shard"]).withColumnRenamed(
            "pmid", "_reported")
        first = records.pending(first, ids, ["_reported", "shard"])
    return first.drop("_reported")


def id_mismatches(rows: DataFrame, schema: ExtractionSchema = DEFAULT_SCHEMA) -> DataFrame:
    """Documents that report another id than their source row."""
    inside = F.col("doc")[schema.article_key]["pmid"]
    return rows.filter(inside != text.norm_text("pmid")).select(
        "pmid", inside.alias("reported_pmid"), "shard")


def totals(rows: DataFrame, by: str = "shard", source: DataFrame | None = None) -> DataFrame:
    """ok, review and error counts per shard and overall.

    With ``source``, ``total`` counts its rows and ``scheduled`` those that were worked on.
    """
    counters = {"ok": F.col("status") == "ok", "review": F.col("needs_review"),
                "errors": F.col("status") != "ok"}
    if source is None:
        return analysis.run_totals(rows, counters, by)
    both = rows.select(by, "status", "needs_review", F.lit(False).alias("_read")).unionByName(
        source.select(by, F.lit(True).alias("_read")), allowMissingColumns=True)
    out = analysis.run_totals(both, {
        "_total": F.col("_read"), "scheduled": ~F.col("_read"), **counters}, by)
    return out.drop("total").withColumnRenamed("_total", "total")


def rerun_totals(rows: DataFrame, flagged: DataFrame) -> DataFrame:
    """flagged, scheduled, ok, still_review and errors per shard and overall."""
    both = (rows.select("shard", "status", F.col("needs_review").alias("again"))
            .unionByName(flagged.distinct().select("shard"), allowMissingColumns=True))
    scheduled_row = F.col("status").isNotNull()
    return analysis.run_totals(both, {
        "flagged": ~scheduled_row, "scheduled": scheduled_row, "ok": F.col("status") == "ok",
        "still_review": F.col("again"), "errors": F.col("status") != "ok"}).drop("total")


STREAMS = ("extracted", "review", "audit")
ADJUDICATED = ("adjudicated", "adjudicated_audit")
ROW_KEYS = "pmid string, shard string, record_key string"


def done_rows(spark, base: str, run: str, kind: str = "extract") -> DataFrame:
    """Ids, shards and record keys of the committed rows of a run, from their stored table."""
    return commits.read(spark, base, kind, run, "rows" if kind == "extract" else "rerun/rows", ROW_KEYS)


def read_stream(spark, base: str, run: str, stream: str = "extracted",
                schema: ExtractionSchema = DEFAULT_SCHEMA, kind: str | None = None,
                without: Collection[str] = ()) -> DataFrame:
    """Committed documents of a run: ``doc, pmid, needs_review, shard, file_name``."""
    kind = kind or ("rerun" if stream in ADJUDICATED else "extract")
    found = commits.paths(spark, base, kind, run, stream, without)
    return commits.read_with(
        spark, found, lambda folders: jsonl.read_documents(spark, folders, schema=schema, nested=True),
        f"doc {schema.doc_type()}, pmid string, needs_review boolean, shard string, file_name string")


def read_audit(spark, base: str, run: str, stream: str = "audit") -> DataFrame:
    """Committed audit records of a run."""
    rerun = stream in ADJUDICATED
    fields = ("model string, error string" if rerun else
              "primary_model string, inline_second_pass boolean, second_pass_model string, error string")
    return commits.read(spark, base, "rerun" if rerun else "extract", run, stream,
                        f"pmid string, mode string, {fields}, status string, issues array<string>, "
                        "timestamp string, shard string", "json")


_TOTALS = "shard string, total long, scheduled long, ok long, review long, errors long"
_RERUN_TOTALS = "shard string, flagged long, scheduled long, ok long, still_review long, errors long"


def read_totals(spark, base: str, run: str, kind: str = "extract") -> DataFrame:
    """Totals of the committed parts of a run, with the part that counted them."""
    name, fields = ("summary", _TOTALS) if kind == "extract" else ("rerun_summary", _RERUN_TOTALS)
    out = spark.createDataFrame([], f"{fields}, part string")
    for r in commits.live(spark, base, kind, run):
        rows = spark.read.schema(fields).json(commits.folder(base, name, run, r.attempt))
        out = out.unionByName(rows.withColumn("part", F.lit(r.part)))
    return out


def write_part(own: commits.Part, source: DataFrame, responses: DataFrame, done: DataFrame | None = None,
               existing_review: DataFrame | None = None, settings: RunSettings = RunSettings()) -> DataFrame:
    """Extract one part into its own folders, without committing it; returns the totals."""
    rows = sinks.stage_rows(extract(source, responses, done, settings), own.base, own.run, own.attempt)
    review = review_rows(rows, existing_review, settings.schema)
    sinks.write_streams(sinks.extraction_streams(rows, review, settings.schema), own.base, own.run, own.attempt)
    return _written(totals(rows, source=source), own, "summary", _TOTALS)


def _written(summary: DataFrame, own: commits.Part, name: str, fields: str) -> DataFrame:
    path = own.folder(name)
    sinks.write_summary(summary, path)
    return summary.sparkSession.read.schema(fields).json(path)


def run_extract(source: DataFrame, responses: DataFrame, base: str, run: str,
                done: DataFrame | None = None, existing_review: DataFrame | None = None,
                finished: DataFrame | None = None, force: bool = False,
                settings: RunSettings = RunSettings(), part: str | None = None,
                resume: bool = False) -> DataFrame:
    """Extract all unfinished shards, write the three streams, commit them and return the totals.

    A run without ``done``, ``finished`` or ``resume`` is the whole run: at its commit it
    replaces everything the run held before, as ``force`` does. A resumed run is a part of its
    own that adds to what is there; ``resume`` takes what is done from the committed rows of this
    run, rows without id included. A named ``part`` replaces its own earlier attempt only. What
    broke off before its commit does not count; `read_stream`, `read_audit` and `read_totals` read
    what does.
    """
    spark, again = source.sparkSession, not force and (resume or done is not None or finished is not None)
    own = commits.begin(spark, base, "extract", run, part, again)
    if resume and done is None:
        done = done_rows(spark, base, run)
    todo = records.pending_shards(source, finished, force=force)
    summary = write_part(own, todo, responses, None if force else done, existing_review, settings)
    commits.commit(spark, own)
    return summary


def run_rerun_flagged(source: DataFrame, extracted: DataFrame, responses: DataFrame, base: str,
                      run: str, adjudicated: DataFrame | None = None,
                      finished: DataFrame | None = None, force: bool = False,
                      settings: RunSettings = RunSettings(), part: str | None = None) -> DataFrame:
    """Arbitrate all shards that have extracted output, write and commit the adjudicated stream.

    Parts are as in `run_extract`; a run is resumed when ``adjudicated`` or ``finished`` is given.
    """
    spark, again = source.sparkSession, not force and (adjudicated is not None or finished is not None)
    own = commits.begin(spark, base, "rerun", run, part, again)
    # ids, flags and shards are stored, so that documents are read once for all that asks for them
    seen = own.folder("rerun/seen")
    ids = records.judged_ids(extracted, settings.threshold, settings.schema, ["shard"])
    ids.write.mode("overwrite").parquet(seen)
    judged = spark.read.schema(ids.schema).parquet(seen)
    flagged = judged.filter("needs_review and pmid is not null").select("pmid", "shard")
    todo = records.paired_shards(records.pending_shards(source, finished, force=force), judged)
    result = _rerun(todo, flagged if settings.scope == "shard" else flagged.select("pmid"), responses,
                    None if force else adjudicated, settings)
    rows = sinks.stage_rows(result, f"{base.rstrip('/')}/rerun", run, own.attempt)
    docs = sinks.document_columns(settings.schema)
    sinks.write_streams({"adjudicated": rows.select("pmid", *docs, "shard"),
                         "adjudicated_audit": rows.select("audit.*", "shard")}, base, run, own.attempt)
    summary = _written(rerun_totals(rows, flagged), own, "rerun_summary", _RERUN_TOTALS)
    commits.commit(spark, own)
    commits.drop_folder(spark, seen)
    return summary

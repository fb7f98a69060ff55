"""Screening of all shards in one job: resume, prefilter, answers, gate, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analysis, prompts, records, screen
from ..schema import PrefilterRules
from ..sources import commits, sinks

OUTCOMES = ("included", "excluded_local", "excluded_llm", "error")


def candidates(source: DataFrame, rules: PrefilterRules = PrefilterRules(),
               done: DataFrame | None = None) -> DataFrame:
    """Unprocessed rows with ``exclude_reason`` and ``record_key``.

    Where ``done`` names record keys, rows without id are resumed too, by their content.
    """
    rows = records.with_record_key(source)
    if done is not None:
        rows = records.pending(rows, done, "record_key" if "record_key" in done.columns else "pmid")
    return screen.prefilter(rows, rules)


def outgoing(source: DataFrame, rules: PrefilterRules = PrefilterRules(),
             done: DataFrame | None = None) -> DataFrame:
    """Prompts of the rows that passed the prefilter."""
    kept = candidates(source, rules, done).filter(~F.col("excluded"))
    return prompts.screening_prompts(kept, "record_key", rules=rules)


def prescreen(source: DataFrame, responses: DataFrame, rules: PrefilterRules = PrefilterRules(),
              done: DataFrame | None = None) -> DataFrame:
    """Every row with ``answer``, ``outcome`` and ``error_text``; a missing answer is an error."""
    best = records.best_screening_attempt(responses).select(
        F.col("pmid").alias("record_key"), "answer", "error_text")
    joined = candidates(source, rules, done).join(best, "record_key", "left")
    judged = joined.withColumn("outcome", screen.screening_outcome(
        F.col("exclude_reason"), F.col("answer.decision")))
    return judged.withColumn("error_text", F.when(F.col("outcome") == "error", F.coalesce(
        "error_text", F.when(F.col("answer").isNull(), F.lit("no response")), "answer.reason")))


def screened(source: DataFrame, responses: DataFrame, rules: PrefilterRules = PrefilterRules(),
             done: DataFrame | None = None) -> DataFrame:
    """Included rows only.

    Both filters sit below the join, so excluded rows and refused answers never shuffle.
    """
    best = records.best_screening_attempt(responses).filter(
        screen.passes_gate(F.col("answer"))).select(F.col("pmid").alias("record_key"))
    kept = candidates(source, rules, done).filter(~F.col("excluded"))
    return kept.join(best, "record_key", "left_semi").select(*source.columns)


def totals(rows: DataFrame, by: str = "shard") -> DataFrame:
    """Counts of the four outcomes per shard and overall."""
    return analysis.run_totals(rows, {o: F.col("outcome") == o for o in OUTCOMES}, by)


_TOTALS = "shard string, total long, " + ", ".join(f"{o} long" for o in OUTCOMES)
OUTCOME_TYPE = ("pmid string, record_key string, outcome string, exclude_reason string, decision string, "
                "reason string, error_text string, shard string")


def read_outcomes(spark, base: str, run: str) -> DataFrame:
    """Committed outcomes of a run, screened out or not; what a resume leaves out."""
    return commits.read(spark, base, "prescreen", run, "outcomes", OUTCOME_TYPE, "json")


def run_prescreen(source: DataFrame, responses: DataFrame, base: str, run: str,
                  rules: PrefilterRules = PrefilterRules(), done: DataFrame | None = None,
                  finished: DataFrame | None = None, force: bool = False,
                  part: str | None = None, resume: bool = False) -> DataFrame:
    """Screen all unfinished shards; write and commit included rows, outcomes and totals, return the totals.

    Shards in ``finished`` and ids in ``done`` are skipped unless ``force``; ``resume`` takes
    what is done from the committed outcomes. Parts are as in `extract.run_extract`: a
    resume adds a part, anything else replaces the run. All rows of a part, screened out or not,
    are under ``outcomes``; an answer that could not be read is there as a whole (``error_text``).
    """
    spark, again = source.sparkSession, not force and (resume or done is not None or finished is not None)
    own = commits.begin(spark, base, "prescreen", run, part, again)
    if resume and done is None:
        done = read_outcomes(spark, base, run)
    todo = records.pending_shards(source, finished, force=force)
    judged = prescreen(todo, responses, rules, None if force else done)
    rows = sinks.stage_rows(judged.select(
        *source.columns, "record_key", "outcome", "exclude_reason",
        F.col("answer.decision").alias("decision"), F.col("answer.reason").alias("reason"),
        "error_text"), base, run, own.attempt)
    sinks.write_streams({
        "screened": rows.filter("outcome = 'included'").select(*source.columns),
        "outcomes": rows.select("pmid", "record_key", "outcome", "exclude_reason", "decision",
                                "reason", "error_text", "shard")}, base, run, own.attempt)
    path = own.folder("summary")
    sinks.write_summary(totals(rows), path)
    commits.commit(spark, own)
    return spark.read.schema(_TOTALS).json(path)

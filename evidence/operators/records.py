"""Keyed record operations: dedupe, resume, flagged subsets, attempts and pairing.

Every join here is an equi-join on one key whose right side holds one row per key.
Records without an id get a key of their own first, so they never meet in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsontext, text
from ..operators.normalize import needs_review
from ..schema import DEFAULT_SCHEMA, REVIEW_THRESHOLD, RETRIED_STATUS, ExtractionSchema
from .screen import HEAD_CHARS, answer_head, decision_of

RESPONSE_TYPE = ("pmid string, model string, pass int, attempt int, status int, "
                 "content string")


def with_record_key(df: DataFrame, key: str = "pmid",
                    content: Sequence[str] = ("title", "abstract", "journal")) -> DataFrame:
    """Add ``record_key``: the id, or a hash of the content where the id is empty.

    The key pairs a record with its answer also when the record has no id, and is the
    same on every run.
    """
    used = [c for c in content if c in df.columns]
    own = F.concat(F.lit("#"), F.sha2(F.to_json(F.struct(*used)), 256))
    return df.withColumn("record_key", F.coalesce(text.maybe_text(key), own))


def drop_missing_ids(df: DataFrame, key: str = "pmid") -> DataFrame:
    return df.filter(text.has_text(key))


def dedupe_first(df: DataFrame, key: str = "pmid", scope: str = "shard",
                 order: Sequence[str | Column] = ("file_name", "block_start", "ord")) -> DataFrame:
    """First row per id, within a shard or overall; rows without id are all kept.

    ``row_number() = 1`` is turned into a group limit before the shuffle, so a key that
    fills a third of the input sends one row per task.  A row without id is numbered and so
    a group of its own, whatever its content; the source is read once.
    """
    own = F.when(~text.has_text(key), F.monotonically_increasing_id())
    keys = [text.norm_text(key), F.col("_own")] + ([F.col("shard")] if scope == "shard" else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_own", own).withColumn("_rn", F.row_number().over(w))
            .filter("_rn = 1").drop("_rn", "_own"))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Right side of a semi or anti join: one row per normalised key, empty ids left out."""
    named = df.select(text.maybe_text(keys[0]).alias("_key"), *keys[1:])
    return named.filter("_key is not null").distinct()


def _joined(df: DataFrame, other: DataFrame, keys: str | Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on ids that are normalised on both sides."""
    on = [keys] if isinstance(keys, str) else list(keys)
    marked = df.withColumn("_key", text.norm_text(on[0]))
    return marked.join(distinct_keys(other, on), ["_key", *on[1:]], how).select(*df.columns)


def pending(df: DataFrame, done: DataFrame, keys: str | Sequence[str] = "pmid") -> DataFrame:
    """Rows of ``df`` whose key is not in ``done``; rows without id stay."""
    return _joined(df, done, keys, "left_anti")


def selected(df: DataFrame, ids: DataFrame, keys: str | Sequence[str] = "pmid") -> DataFrame:
    """Rows of ``df`` whose key is in ``ids``."""
    return _joined(df, ids, keys, "left_semi")


def processed_ids(docs: DataFrame, schema: ExtractionSchema = DEFAULT_SCHEMA,
                  keep: Sequence[str] = (), prefer: str = "source") -> DataFrame:
    """Ids already written: the source id, else the one in the document.

    A wrong id inside an answer thus does not make the record look unfinished;
    ``prefer="document"`` turns that round.
    """
    return docs.select(_id_of(docs, schema, prefer).alias("pmid"), *keep).filter("pmid is not null")


def _id_of(docs: DataFrame, schema: ExtractionSchema, prefer: str) -> Column:
    ids = [text.norm_text(F.col("doc")[schema.article_key]["pmid"])]
    if "pmid" in docs.columns:
        ids.insert(0 if prefer == "source" else 1, text.norm_text("pmid"))
    return text.first_text(*ids)


def flagged_ids(docs: DataFrame, threshold: int = REVIEW_THRESHOLD,
                schema: ExtractionSchema = DEFAULT_SCHEMA, keep: Sequence[str] = (),
                prefer: str = "source") -> DataFrame:
    """Ids of documents that need review, by source id like `processed_ids`.

    A stored ``needs_review`` column is used where there is one.
    """
    if "needs_review" in docs.columns:
        hit = docs.filter("needs_review")
    else:
        hit = docs.filter(needs_review("doc", threshold, schema))
    return hit.select(_id_of(hit, schema, prefer).alias("pmid"), *keep).filter("pmid is not null")


def judged_ids(docs: DataFrame, threshold: int = REVIEW_THRESHOLD,
               schema: ExtractionSchema = DEFAULT_SCHEMA, keep: Sequence[str] = ()) -> DataFrame:
    """The id of every document, null if it has none, and whether it needs review, as `flagged_ids` says."""
    flag = F.col("needs_review") if "needs_review" in docs.columns else needs_review("doc", threshold, schema)
    return docs.select(_id_of(docs, schema, "source").alias("pmid"), flag.alias("needs_review"), *keep)


def pending_shards(df: DataFrame, finished: DataFrame | None, shard: str = "file_name",
                   force: bool = False) -> DataFrame:
    """Rows of shards that are not finished; everything with ``force``."""
    return df if force or finished is None else pending(df, finished, shard)


def paired_shards(df: DataFrame, other: DataFrame, shard: str = "shard") -> DataFrame:
    """Rows of shards that have output in ``other``."""
    return selected(df, other, shard)


# --- attempts ------------------------------------------------------------------------------

def attempt_error(status: Column, content: Column, retried_chars: int | None = 500,
                  other_chars: int | None = 1000) -> Column:
    """Error text of a failed attempt, cut for notes; None for the whole text."""
    body = F.coalesce(content, F.lit(""))

    def part(chars: int | None) -> Column:
        return body if chars is None else F.substring(body, 1, chars)
    cut = F.when(status.isin(*RETRIED_STATUS), part(retried_chars)).otherwise(part(other_chars))
    return (F.when(status.isNull(), F.lit("no response"))
            .when(status != 200, F.concat(F.lit("HTTP "), status.cast("string"), F.lit(": "), cut))
            .otherwise(F.lit("Model response could not be parsed as JSON object")))


def best_attempt(responses: DataFrame,
                 keys: Sequence[str] = ("pmid", "model", "pass")) -> DataFrame:
    """One row per key: the first attempt that gave an object, else the last one.

    Adds ``raw`` (VARIANT, null when no attempt was good), ``ok`` and ``error``.  Each text
    is parsed once; the group limit before the shuffle keeps one row per key and task, and only
    texts of failures go through it.
    """
    parsed = text.computed(responses, {
        "raw": F.when(F.col("status") == 200, jsontext.parse_object("content"))})
    ranked = parsed.withColumn("ok", F.col("raw").isNotNull()) \
        .withColumn("content", F.when(~F.col("ok"), F.col("content")))
    w = Window.partitionBy(*keys).orderBy(
        F.desc("ok"), F.when(F.col("ok"), F.col("attempt")).otherwise(-F.col("attempt")))
    return (ranked.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .withColumns({
                "error": F.when(~F.col("ok"), attempt_error(F.col("status"), F.col("content"))),
                "error_text": F.when(~F.col("ok"), attempt_error(F.col("status"), F.col("content"), None, None))})
            .drop("_rn", "content"))


def best_screening_attempt(responses: DataFrame, head_chars: int = HEAD_CHARS) -> DataFrame:
    """One row per pmid for the screening stage, with ``answer`` (decision, reason).

    A text without any brace is a final error; other failures were tried again, so the
    first attempt that is final wins.  ``reason`` holds the head of an answer that is no
    decision; ``error_text`` has all of it, or the whole error of a failed attempt.
    """
    parsed = text.computed(responses, {
        "_v": F.when(F.col("status") == 200, jsontext.parse_screening("content")),
        "_head": answer_head("content", head_chars)})
    final = (F.col("status") == 200) & (
        F.col("_v").isNotNull() | (F.locate("{", F.col("content")) == 0))
    # only texts of failures go through the shuffle
    ranked = parsed.withColumn("ok", F.coalesce(final, F.lit(False))).withColumn(
        "error_text", F.when(F.col("status") != 200, attempt_error(F.col("status"), F.col("content"), None, None))
        .when(F.try_variant_get("_v", "$.decision", "string").isNull(), F.col("content"))).drop("content")
    w = Window.partitionBy("pmid").orderBy(
        F.desc("ok"), F.when(F.col("ok"), F.col("attempt")).otherwise(-F.col("attempt")))
    failed = F.struct(F.lit("error").alias("decision"),
                      F.lit("max retries exceeded").alias("reason"))
    return (ranked.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select("pmid", "attempt", "ok", "error_text",
                    F.when(F.col("ok"), decision_of(F.col("_v"), F.col("_head")))
                    .otherwise(failed).alias("answer")))


def attach(source: DataFrame, responses: DataFrame, model: str, pass_no: int | None = None,
           raw: str = "raw", error: str = "error") -> DataFrame:
    """Left join source rows to the chosen attempt of one model.

    A row without answer gets an error text, ``error`` cut for notes and ``error_text`` whole.  The attempts of one model are ranked by id
    alone, so ranking and join share one shuffle of the responses.  Answers are merged and never broadcast: packed in
    a shuffle they look small, but a broadcast unpacks all of them in the driver.
    """
    wanted = responses.filter(F.col("model") == model)
    if pass_no is not None:
        wanted = wanted.filter(F.col("pass") == pass_no)
    chosen = best_attempt(wanted, ("pmid",)).select(
        F.col("pmid").alias("record_key"), F.col("raw").alias(raw),
        F.col("error").alias("_error"), F.col("error_text").alias("_whole"))

    def message(c: str) -> Column:
        said = F.concat(F.lit(f"LLM call failed, model={model}, error="),
                        F.coalesce(F.col(c), F.lit("no response")))
        return F.when(F.col(raw).isNull(), said)
    return (source.join(chosen.hint("merge"), "record_key", "left")
            .withColumns({error: message("_error"), f"{error}_text": message("_whole")})
            .drop("_error", "_whole"))


def with_prefix(items: Column, prefix: str) -> Column:
    return F.transform(items, lambda x: F.concat(F.lit(prefix), x))

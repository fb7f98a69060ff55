"""Prompts run in rounds until every one has a good answer or the attempts are used up.

A round asks the user's own batch function for the keys that have no good answer yet, in the
tasks that hold their prompts, and commits what came back as a part of the run. A round that breaks
off is asked again as a whole; a run that is started again goes on where the commits end. The
stored attempts are a response table like any other: `records.best_attempt` picks from it.

Prompts are rendered for the first round only. A round stores those it got no good answer to beside
their keys, in a folder of its own that the next round reads and that is then removed: later rounds
neither render nor shuffle prompts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsontext
from ..operators.records import RESPONSE_TYPE
from ..sources import commits

KIND = "responses"
MAX_ATTEMPTS = 6
#: prompts given to the function at once
BATCH = 64
#: keys of one Arrow batch and their attempt -> (status, content) of each, in order
Infer = Callable[[Sequence[str], Sequence[list], int], Sequence[tuple[int | None, str | None]]]


def holds_object(status: Column, content: Column) -> Column:
    """An extraction answer is good when the call went through and an object can be read from it."""
    return (status == 200) & jsontext.parse_object(content).isNotNull()


def final_screening(status: Column, content: Column) -> Column:
    """A screening answer is final when it can be read, and also when it has no brace at all."""
    return (status == 200) & (jsontext.parse_screening(content).isNotNull() | (F.locate("{", content) == 0))


def asked(prompts: DataFrame, infer: Infer, model: str, pass_no: int, attempt: int, batch: int = BATCH,
          carried: bool = False) -> DataFrame:
    """One attempt at each prompt; a prompt whose batch raises has no status and the error as content.

    With ``carried``, the prompt follows its answer, as ``_key`` and ``_messages``.
    """
    key = next(c for c in prompts.columns if c != "messages")
    schema = RESPONSE_TYPE
    if carried:
        kinds = {f.name: f.dataType.simpleString() for f in prompts.schema}
        schema += f", _key {kinds[key]}, _messages {kinds['messages']}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, batch):
                part = whole.slice(a, batch)
                keys = [str(k) for k in part.column(key).to_pylist()]
                try:
                    said = list(infer(keys, part.column("messages").to_pylist(), attempt))
                except Exception as error:  # noqa: BLE001 - the user's function may raise anything
                    said = [(None, f"{type(error).__name__}: {error}")] * len(keys)
                if len(said) != len(keys):
                    raise ValueError(f"{len(keys)} prompts were given, {len(said)} answers came back")
                n = len(keys)
                own = [part.column(key), part.column("messages")] if carried else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), pa.array([model] * n), pa.array([pass_no] * n, pa.int32()),
                     pa.array([attempt] * n, pa.int32()), pa.array([s for s, _ in said], pa.int32()),
                     pa.array([c for _, c in said], pa.string()), *own],
                    names=["pmid", "model", "pass", "attempt", "status", "content", *(["_key", "_messages"] if carried else [])])
    return prompts.select(key, "messages").mapInArrow(run, schema)


def read_attempts(spark: SparkSession, base: str, run: str) -> DataFrame:
    """All committed attempts of a run, a response table."""
    return commits.read(spark, base, KIND, run, "attempts", f"{RESPONSE_TYPE}, good boolean").drop("good")


def run_prompts(prompts: DataFrame, infer: Infer, base: str, run: str, model: str = "primary", pass_no: int = 1,
                max_attempts: int = MAX_ATTEMPTS, good: Callable[[Column, Column], Column] = holds_object) -> DataFrame:
    """Ask until all prompts (``record_key, messages``) are answered well; returns all attempts.

    Every round's record counts the keys asked and those answered well.
    """
    spark = prompts.sparkSession
    key = next(c for c in prompts.columns if c != "messages")
    stored = None  # the folder of what the last round of this call asked
    while True:
        done = [r for r in commits.live(spark, base, KIND, run)]
        attempt = len(done) + 1
        last = max(done, key=lambda r: int(r.part)) if done else None
        if attempt > max_attempts or (last and last.counters["asked"] == last.counters["good"]):
            if stored is not None:
                commits.drop_folder(spark, stored)
            return read_attempts(spark, base, run)
        if stored is not None:
            todo = _unanswered(spark.read.parquet(stored), key)
        elif done:
            commits.drop_folder(spark, commits.folder(base, "asked", run, last.attempt))  # of a call that broke off
            held = commits.read(spark, base, KIND, run, "attempts", f"{RESPONSE_TYPE}, good boolean")
            todo = prompts.join(held.filter("good").select(F.col("pmid").alias(key)).distinct(), key, "left_anti")
        else:
            todo = prompts
        own = commits.begin(spark, base, KIND, run, part=str(attempt))
        more = attempt < max_attempts
        said = asked(todo, infer, model, pass_no, attempt, carried=more).withColumn(
            "good", F.coalesce(good(F.col("status"), F.col("content")), F.lit(False)))
        before, stored = stored, None
        if more:
            # a prompt without key is asked in every round: no answer can be told to be its own
            open_, stored = ~F.col("good") | F.col("_key").isNull(), own.folder("asked")
            said.withColumn("_messages", F.when(open_, F.col("_messages"))).withColumn("_open", open_) \
                .write.mode("overwrite").option("compression", "zstd").parquet(stored)
            said = spark.read.parquet(stored).drop("_key", "_messages", "_open")
        said.write.mode("overwrite").parquet(own.folder("attempts"))
        if before is not None:
            commits.drop_folder(spark, before)
        row = spark.read.schema("good boolean").parquet(own.folder("attempts")).agg(
            F.count("*").alias("asked"), F.count_if("good").alias("good")).first()
        commits.commit(spark, own, row.asDict())


def _unanswered(asked_: DataFrame, key: str) -> DataFrame:
    """Prompts of a stored round whose key got no good answer in it.

    A key that is there once has its answer in its own row, and no join is needed. Only where one
    comes several times, with a good answer and another, the good one settles all its rows.
    """
    todo = asked_.filter("_open").select(F.col("_key").alias(key), F.col("_messages").alias("messages"))
    mixed = (asked_.groupBy("pmid").agg(F.count("*").alias("n"), F.bool_or("good").alias("any"), F.bool_or("_open").alias("open"))
             .filter("n > 1 and any and open").select(F.col("pmid").alias(key)))
    return todo.join(mixed, key, "left_anti") if mixed.limit(1).count() else todo


def rounds(spark: SparkSession, base: str, run: str) -> DataFrame:
    """attempt, asked and good of each committed round."""
    return commits.history(spark, base, KIND, run).filter("live").select(
        F.col("part").cast("int").alias("attempt"), F.col("counters")["asked"].alias("asked"), F.col("counters")["good"].alias("good"))

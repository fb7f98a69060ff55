"""From raw documents to token files: five stages, each an operator of evidence.llm.

Every stage takes the documents that the one before it kept and, but for the last, returns
them with the columns of ``documents``. Rows without letters or with an uncertain language
go, unless no language could be learned (language_id), one row of each group of near copies stays (near_dedup), documents that
hold a benchmark passage go (decontamination), sources are repeated or thinned out to their
weights (mixing), and what is left is written as token files and read back (token_files).

An empty table passes all stages as an empty table; rows with null text or ids are treated as
the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evidence.llm import decontaminate, language_id, minhash, mixing, token_files
from evidence.llm.base import table
from evidence.llm.graph import Stage
from evidence.llm.queries import vocabulary
from evidence.session import shared_folder

#: only texts without evidence stay below so many times the score that chance gives
TIMES_CHANCE = 1.2

ORACLE_SQL = None


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs, vocabulary("piece_bpe_32k.model"))
    return language_id.keep_languages(docs, model, times_chance=TIMES_CHANCE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    token_files.write(docs, folder, vocabulary("word_bpe_49k.json"))
    return token_files.read(spark, folder)


STAGES = [("language_id", identify), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mix), ("token_files", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents."""
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

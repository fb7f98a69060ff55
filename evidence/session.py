"""Session settings the engine is written for, and lineage cuts that survive lost executors."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: up to so many folders a task writes at once, without sorting its rows by folder first
FEW_SHARDS = 16

SETTINGS = {
    # skewed join partitions are split at run time, small ones merged
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a repeated key in model-written JSON keeps its last value
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.maxConcurrentOutputFileWriters": str(FEW_SHARDS),
    # lower() of the JVM, which has a fast path for ASCII
    "spark.sql.icu.caseMappings.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}

# To be given when the session is built: no Python call site per expression node, of
# which the normalisation plan has thousands.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session the caller owns."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names for checkpoints, else below the warehouse.

    A folder of one machine is no shared folder: without a named one, a session on a
    cluster needs a warehouse on a file system that all executors see.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir")
        one_machine = named.startswith(("file:", "/"))
        if one_machine and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share; "
                             f"the warehouse {named} is on this machine")
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)

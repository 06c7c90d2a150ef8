"""Bounded micro-batches with change detection: what a polling watcher does, as a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholia.operators.identity import latest


def fingerprint(columns: list[str]):
    """sha256 of the columns' canonical JSON."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def changed(rows: DataFrame, known: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The latest row of each key (by seq) whose fingerprint isn't the known one; adds fp."""
    now = latest(rows, [key], [F.col("seq")]).withColumn("fp", fingerprint(columns))
    return now.join(known.select(key, "fp"), [key, "fp"], "left_anti")


def watch(spark: SparkSession, folder: str, schema: str, checkpoint: str, work: Callable[[DataFrame, int], None], files_per_batch: int = 100):
    """Runs `work` on batches of at most so many new files of a folder until none are left.

    The backlog stays for later batches; a batch that failed is repeated with the same id, so
    `work` has to be idempotent by batch id.
    """
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    return source.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

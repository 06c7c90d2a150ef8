"""Connected components of a graph between rows and the values that they share, and durable intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, of spark.checkpoint.dir; local sessions may leave that unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="scholia-kept-"))
    return context.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt(df: DataFrame, key: str, rows: int = 4000) -> DataFrame:
    """The rows by key, so many to a partition, so that a task's share stays as it is however large the table.

    They are counted before, which reads no column of a stored table. A given number of partitions isn't
    made less afterwards, as Spark does with partitions that are small before their rows are unfolded.
    """
    n = df.count()  # one number
    return df.repartition(max(n // rows + 1, df.sparkSession.sparkContext.defaultParallelism), key)


def components(edges: DataFrame) -> DataFrame:
    """node, component: the least node that can be reached over shared values; edges are (node long, value).

    Each round takes the least label over a value's nodes and over a node's values, both combined
    before the shuffle however many nodes share a value, then the label of that label, so chains
    shrink by halves. No pair of nodes is made. An empty table gives no rows.
    """
    edges = kept(edges.select("node", "value").distinct())
    labels = kept(edges.select("node").distinct().withColumn("component", F.col("node")))
    while True:
        least = edges.join(labels, "node").groupBy("value").agg(F.min("component").alias("least"))
        near = edges.join(least, "value").groupBy("node").agg(F.min("least").alias("least"))
        far = labels.select(F.col("node").alias("least"), F.col("component").alias("far"))
        after = labels.join(near, "node").join(far, "least").select("node", F.least("component", "least", "far").alias("next"), "component")
        after = kept(after)
        if after.where("next < component").isEmpty():
            return labels
        labels = after.select("node", F.col("next").alias("component"))

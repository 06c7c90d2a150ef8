"""JSONL tables: strict and tolerant scans, gzipped records, writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the bad lines (line); a byte order mark and blank lines are skipped, an object is asked for."""
    raw = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("line")).where(F.trim("line") != "")
    parsed = raw.select("line", F.from_json("line", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull() | ~F.startswith(F.ltrim("line"), F.lit("{"))
    return parsed.where(~bad).select("r.*").drop("_bad"), parsed.where(bad).select("line")


def strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a table of which every line must be an object."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def records(spark: SparkSession, pattern: str, schema: str, limit: int | None = None) -> DataFrame:
    """Gzipped JSON records in order of file name, with file_name."""
    if limit is not None and limit <= 0:
        raise ValueError("the limit has to be positive")
    rows = spark.read.schema(schema).option("multiLine", True).json(pattern).withColumn("file_name", F.col("_metadata.file_name"))
    return rows.orderBy("file_name").limit(limit) if limit else rows


def write(df: DataFrame, path: str, once: bool = False) -> None:
    """JSONL, gzipped; with once=True an existing table is an error."""
    df.write.mode("errorifexists" if once else "overwrite").option("compression", "gzip").json(path)

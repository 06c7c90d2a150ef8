"""Scans that know where a row stands: lines with file and number, manifests with rank, directories of JSON files.

A file is one row until its lines are numbered, so large tables are kept in many files.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINES = "path string, line long, text string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line (from 1) and text of the lines that aren't blank, without a byte order mark; a missing path has none."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINES)
    whole = files.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split(F.regexp_replace("value", "^﻿", ""), r"\r?\n")).alias("at", "text"))
    return whole.where(F.trim("text") != "").select("path", (F.col("at") + 1).cast("long").alias("line"), "text")


def _place() -> Column:
    return F.concat(F.col("path"), F.lit(":"), F.col("line").cast("string"))


def _parsed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = lines(spark, path).withColumn("row", F.from_json("text", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return rows.withColumn("bad", F.col("row").isNull() | F.col("row._bad").isNotNull() | ~F.ltrim("text").startswith("{"))


def strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows with _path and _line; a line that is no object of the schema fails the query and names its place."""
    rows = _parsed(spark, path, schema)
    sure = F.when(F.col("bad"), F.raise_error(F.concat(_place(), F.lit(": no JSON object of the schema")))).otherwise(F.col("row"))
    return rows.select(sure.alias("row"), F.col("path").alias("_path"), F.col("line").alias("_line")).select("row.*", "_path", "_line").drop("_bad")


def tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows with _path and _line, and the bad lines (path, line, text)."""
    rows = _parsed(spark, path, schema)
    good = rows.where(~F.col("bad")).select("row.*", F.col("path").alias("_path"), F.col("line").alias("_line")).drop("_bad")
    return good, rows.where("bad").select("path", "line", "text")


def manifest(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Rows of a manifest file with _manifest_line and _manifest_rank (from 1, blank lines not counted).

    Keys are compared without case and outer blanks; the first missing or repeated one raises
    ValueError with its line. One row, the first fault, comes to the driver.
    """
    rows = strict(spark, path, schema).withColumnRenamed("_line", "_manifest_line")
    name = F.lower(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))))
    named = rows.select("_path", "_manifest_line", name.alias("name"))
    missing = named.where("name = ''").select("_manifest_line", F.lit("missing").alias("fault"), "_path", "name")
    again = named.where("name <> ''").groupBy("name").agg(F.sort_array(F.collect_list(F.struct("_manifest_line", "_path"))).alias("at")).where(F.size("at") > 1)
    again = again.select(F.get("at", F.lit(1))["_manifest_line"].alias("_manifest_line"), F.lit("repeated").alias("fault"), F.get("at", F.lit(1))["_path"].alias("_path"), "name")
    fault = missing.unionByName(again).orderBy("_manifest_line").first()
    if fault:
        raise ValueError(f"{fault['_path']}:{fault['_manifest_line']}: {fault['fault']} {key} {fault['name']!r}")
    # the rank within a file is the number of lines before that aren't blank
    ordered = rows.groupBy("_path").agg(F.sort_array(F.collect_list("_manifest_line")).alias("all")).select("_path", F.posexplode("all").alias("at", "_manifest_line"))
    return rows.join(ordered, ["_path", "_manifest_line"]).withColumn("_manifest_rank", (F.col("at") + 1).cast("long")).drop("at", "_path")


def record_paths(spark: SparkSession, pattern: str, ending: str = r"\.jsonl?(\.gz)?$") -> DataFrame:
    """key (the file's name in capitals, letters and digits only) and path; of equal keys the last path."""
    files = spark.read.format("binaryFile").load(pattern).select("path")
    stem = F.regexp_replace(F.substring_index("path", "/", -1), ending, "")
    return files.groupBy(F.upper(F.regexp_replace(stem, "[^A-Za-z0-9]+", "")).alias("key")).agg(F.max("path").alias("path"))


def json_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, value (Variant) and issue of each file; one that can't be read as an object stays, with an issue and no value.

    Spark's readers pass over files of no bytes.
    """
    files = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("text"))
    value = files.withColumn("value", F.try_parse_json("text"))
    object_ = F.startswith(F.schema_of_variant("value"), F.lit("OBJECT"))
    issue = F.when(F.col("value").isNull(), "invalid_json").when(~object_, "not_an_object")
    return value.select("path", F.when(issue.isNull(), F.col("value")).alias("value"), issue.alias("issue"))


def run_index(spark: SparkSession, pattern: str, keys: list[str]) -> DataFrame:
    """Readable attempts of a glob as JSON text with their path, in order of the given fields (as text) and path."""
    rows = json_files(spark, pattern).where("issue IS NULL")
    fields = [F.coalesce(F.try_variant_get("value", f"$.{k}", "string"), F.lit("")).alias(k) for k in keys]
    return rows.select("path", *fields, F.to_json("value").alias("attempt")).orderBy(*keys, "path")

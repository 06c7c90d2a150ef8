"""A training corpus from `documents`: five stages, each written and read again by the next one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholia.llm import mixing, packing, pii, quality, simhash
from scholia.llm.util import apart, durable

#: Keys of rows up to which they are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Columns that the first two stages read; others may have any name.
USED = ("doc_id", "text", "lang", "source")


def _without(docs: DataFrame, out: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id and text aren't those of a row of `out` (doc_id, text_key)."""
    out = durable(out.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct())
    side = F.broadcast(out) if out.count() <= BROADCAST_ROWS else out
    return docs.join(side, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key")), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't outliers of their language and source.

    A null or blank text goes; repeated rows have one verdict; an empty table stays empty.
    """
    names, docs = docs.columns, apart(docs, USED)
    return _without(docs, quality.judge(docs).where("not kept")).toDF(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the least doc_id, null last; of equal rows one.

    Near are texts within 4 bits by their four-word shingles, as in op7 (README: how many pairs at a
    five-word Jaccard of 0.8 that finds). Null and blank texts are one group.
    """
    names, docs = docs.columns, apart(docs, USED)
    groups = durable(simhash.near_duplicates(docs))
    first = groups.groupBy(F.col("component").alias("__c")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"), F.count("*").alias("n"))
    rows = groups.join(first.where("n > 1"), F.col("component") == F.col("__c"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    rows = rows.select("doc_id", "text_key", stays.alias("stays"))
    left = _without(docs, rows.where("not stays"))
    repeated = not rows.where("stays").groupBy("doc_id", "text_key").count().where("count > 1").isEmpty()
    return (left.dropDuplicates(["doc_id", "text"]) if repeated else left).toDF(*names)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; n_chars follows. Null texts stay null, repeated rows stay."""
    new = pii.replace(docs)
    length = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return new.withColumn("n_chars", length).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the curriculum reads them, in its order; null and blank texts are never read."""
    return mixing.mix_texts(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset; a null text is the end id alone."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: Covariance estimates, tokens and components have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what goes from one to the next is Parquet in the shared checkpoint folder."""
    durable(spark.range(1))  # names a folder where none is set
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

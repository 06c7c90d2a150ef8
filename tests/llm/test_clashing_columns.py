"""Extra columns under the names that operators use for themselves."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scholia.llm import mixing, pii

NAMES = ["text_key", "__key", "__hint", "__names", "positions", "copies", "__id", "__text_key", "__at", "__source", "__reads", "component", "__c", "fp", "kept", "size", "stays", "first", "n", "__extra_0", "gender", "words", "__g"]


@pytest.fixture(scope="module")
def clashing(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    return docs.select("*", *[F.concat_ws("-", F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES]).cache()


def unchanged(out):
    """The extra columns still belong to their rows."""
    assert out.count() > 0
    for n in NAMES:
        assert out.where(F.col(n) != F.concat_ws("-", F.lit(n), F.col("doc_id").cast("string"))).isEmpty()


def test_surrogates_and_mix_keep_them(clashing):
    out = pii.replace(clashing)
    assert out.columns == [*clashing.columns, "n_entities", "entity_spans"]
    unchanged(out)
    mixed = mixing.mix_texts(clashing)
    assert mixed.columns == clashing.columns
    unchanged(mixed)


@pytest.mark.parametrize("stage", [corpus_pipeline.quality_rules, corpus_pipeline.near_duplicates, corpus_pipeline.personal_data])
def test_stages_keep_them(spark, data, clashing, stage):
    out = stage(spark, clashing, data)
    assert out.columns == clashing.columns
    unchanged(out)
    plain = stage(spark, clashing.select("doc_id", "text", "lang", "source", "n_chars"), data)
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted(r["doc_id"] for r in plain.select("doc_id").collect())

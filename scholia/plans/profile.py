"""Profiles of a corpus: words, sentences and their distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholia.functions import text as T
from scholia.sources.tables import read

SENTENCES_SQL = r"len(list_filter(string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+([A-Z0-9])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: len(regexp_extract_all(s, '[A-Za-z]+(?:[-''][A-Za-z]+)?')) >= 4))"
WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+(?:[-''][A-Za-z]+)?'))"


def section_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers, words, sentences and word percentiles by language."""
    docs = read(spark, sf_dir, "documents").select("lang", T.word_count(F.col("text")).alias("w"), F.size(T.sentences(F.col("text"))).cast("long").alias("s"))
    q = F.percentile("w", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return docs.groupBy("lang").agg(F.count("*").alias("n_papers"), F.sum("w").alias("words"), F.sum("s").alias("sentences"), q.alias("q")).select(
        "lang", "n_papers", "words", "sentences", F.col("q")[0].alias("p25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("p75")
    )


QUERIES = {
    "section_profile": (
        section_profile,
        f"""SELECT lang, count(*) AS n_papers, CAST(sum(w) AS BIGINT) AS words, CAST(sum(s) AS BIGINT) AS sentences, quantile_cont(w, 0.25) AS p25,
                   quantile_cont(w, 0.5) AS median, quantile_cont(w, 0.75) AS p75
            FROM (SELECT lang, {WORDS_SQL} AS w, {SENTENCES_SQL} AS s FROM documents) GROUP BY lang""",
    ),
}

"""Ranked full-text retrieval: postings, BM25, conjunctive filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = r"[a-z0-9]+"
#: BM25: saturation of counts and weight of length.
K1, B = 1.2, 0.75


def postings(sections: DataFrame, key: str, columns: dict[str, float]) -> DataFrame:
    """term, key, f (weighted frequency over the columns) and length (tokens of all columns)."""
    def weighted(column: str, weight: float):
        found = F.regexp_extract_all(F.lower(F.coalesce(column, F.lit(""))), F.lit(TOKEN), F.lit(0))
        return F.transform(found, lambda t: F.struct(t.alias("term"), F.lit(weight).alias("w")))

    parts = [weighted(c, w) for c, w in columns.items()]
    tokens = sections.select(key, F.concat(*parts).alias("tokens"))
    rows = tokens.select(key, F.size("tokens").cast("long").alias("length"), F.explode("tokens").alias("t"))
    return rows.groupBy(F.col("t.term").alias("term"), key, "length").agg(F.sum("t.w").alias("f"))


def bm25(posts: DataFrame, key: str, terms: list[str], n_docs: int, mean_length: float, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """key and score (negative, less is better) of documents that hold all terms."""
    terms = list(dict.fromkeys(terms))
    own = posts.where(F.col("term").isin(terms))
    df = own.groupBy("term").agg(F.count("*").alias("n"))
    idf = F.greatest(F.log((F.lit(n_docs) - F.col("n") + 0.5) / (F.col("n") + 0.5)), F.lit(1e-6))
    weight = F.col("idf") * F.col("f") * (k1 + 1) / (F.col("f") + k1 * (1 - b + b * F.col("length") / mean_length))
    # one row a query term
    scored = own.join(F.broadcast(df.select("term", idf.alias("idf"))), "term")
    return scored.groupBy(key).agg(F.sum(weight).alias("s"), F.count("*").alias("k")).where(F.col("k") == len(terms)).select(key, (-F.col("s")).alias("score"))


def and_scores(rows: DataFrame, keys: list[str], fields: dict[str, float], terms: list[str]) -> DataFrame:
    """Negative BM25 scores of the rows that hold all terms: keys and score, the least being the best.

    Term counts are taken in each row, so nothing is exploded; the collection's numbers are one row
    that every task gets.
    """
    found = {f: F.regexp_extract_all(F.lower(f), F.lit(TOKEN), F.lit(0)) for f in fields}
    held = rows.select(*keys, *[c.alias(f"__{f}") for f, c in found.items()])
    length = sum((F.size(f"__{f}") for f in fields), F.lit(0))
    own = lambda t: sum((F.size(F.array_remove(f"__{f}", t)) * -w + F.size(f"__{f}") * w for f, w in fields.items()), F.lit(0.0))
    counted = held.select(*keys, length.alias("__len"), *[own(t).alias(f"__t{k}") for k, t in enumerate(terms)])
    total = counted.agg(F.count("*").alias("__n"), F.sum("__len").alias("__all"), *[F.count_if(F.col(f"__t{k}") > 0).alias(f"__df{k}") for k in range(len(terms))])
    j = counted.join(F.broadcast(total))
    score = F.lit(0.0)
    for k in range(len(terms)):
        df, f = F.col(f"__df{k}"), F.col(f"__t{k}")
        idf = F.greatest(F.log((F.col("__n") - df + 0.5) / (df + 0.5)), F.lit(1e-6))
        score = score + idf * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("__len") / (F.col("__all") / F.col("__n"))))
    every = F.lit(True)
    for k in range(len(terms)):
        every = every & (F.col(f"__t{k}") > 0)
    return j.where(every).select(*keys, (-score).alias("score"))

"""A full-text index that is stored: postings with positions, found by bucket and term, published whole.

Postings lie in a folder for each bucket of terms, in order of term and document, so a query opens the
folders of its terms and, in those, the row groups that can hold them. They are dealt to writers by
bucket, and a large bucket is cut among many, so one very common term is written by many.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholia.functions import text as T
from scholia.sinks import publish

from .search import K1, TOKEN, B

BUCKETS = 64
SNIPPET_TOKENS = 28


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _posts(found: list[Column], weights: Column) -> Column:
    """The postings of one row: array of term, length, f and positions, made in the row, since no posting has two.

    The tokens are put in order by term, field and place; each run of a term is a posting.
    """
    one = "struct<term string, field int, at int>"

    def placed(k: int):
        return lambda t, at: F.struct(t.alias("term"), F.lit(k).alias("field"), at.alias("at"))

    tokens = F.concat(*[F.transform(c, placed(k)) for k, c in enumerate(found)]).cast(f"array<{one}>")

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (x["term"] != F.get(s, i - 1)["term"]), i)), lambda i: i.isNotNull())

        def posting(a: Column, b: Column) -> Column:
            own = F.slice(s, a + 1, b - a)
            return T.let(own, lambda o: F.struct(
                F.get(o, 0)["term"].alias("term"), n.cast("long").alias("length"), F.aggregate(o, F.lit(0.0), lambda f, x: f + F.get(weights, x["field"])).alias("f"),
                F.transform(o, lambda x: F.struct(x["field"].alias("field"), x["at"].alias("at"))).alias("positions"),
            ))

        return T.let(starts, lambda at: F.transform(at, lambda a, k: posting(a, F.coalesce(F.get(at, k + 1), n))))

    return T.let(F.sort_array(tokens), runs)


def build(docs: DataFrame, key: str, fields: dict[str, float], root: str, batch: str, buckets: int = BUCKETS) -> None:
    """Indexes the text columns `fields`, whose hits have the given weights, and publishes the index as a batch.

    Tables: postings (term, key, f, length, positions by field), terms (term, n), stats (n, tokens). A
    null text has no tokens; `key` is unique; an empty table gives an empty index.
    """
    spark = docs.sparkSession
    low = {c: F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in fields}
    weights = F.array(*[F.lit(float(w)) for w in fields.values()])
    posts = docs.select(F.col(key).alias("key"), F.explode(_posts([F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0)) for t in low.values()], weights)).alias("p")).select("p.term", "key", "p.length", "p.f", "p.positions")
    posts = posts.withColumn("bucket", _bucket(F.col("term"), buckets))
    # dealt by bucket, large ones cut and small ones joined as they turn out: nothing is made twice to find the ranges
    ordered = posts.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "term", "key")
    length = sum((F.regexp_count(t, F.lit(TOKEN)).cast("long") for t in low.values()), F.lit(0).cast("long"))
    stats = docs.select(length.alias("length")).agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).withColumn("buckets", F.lit(buckets))

    publish.publish(spark, root, batch, {"postings": ordered, "stats": stats}, {"postings": ["bucket"]})


class Index:
    """The current index of a folder; what it reads stays that of one batch, whatever is published meanwhile."""

    def __init__(self, spark: SparkSession, root: str):
        batch = publish.current(spark, root)
        read = lambda table: spark.read.parquet(f"{root}/{publish.BATCHES}/{batch}/{table}")
        self.postings_table, self.stats = read("postings"), read("stats").first()  # stats is one row

    def postings(self, terms: list[str]) -> DataFrame:
        """Postings of some terms; only their buckets are read."""
        wanted = [(F.col("bucket") == _bucket(F.lit(t), self.stats["buckets"])) & (F.col("term") == t) for t in dict.fromkeys(terms)]
        return self.postings_table.where(reduce(lambda a, b: a | b, wanted))

    def search(self, terms: list[str]) -> DataFrame:
        """key, score (negative, less is better) and positions of documents that hold all terms, by BM25."""
        terms = list(dict.fromkeys(terms))
        own = self.postings(terms)
        n, mean = self.stats["n"], self.stats["tokens"] / max(self.stats["n"], 1)
        idf = F.greatest(F.log((F.lit(n) - F.col("n") + 0.5) / (F.col("n") + 0.5)), F.lit(1e-6))
        known = own.groupBy("term").agg(F.count("*").alias("n")).select(F.col("term").alias("of"), idf.alias("idf"))  # a row for each term asked for
        weight = F.col("idf") * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("length") / mean))
        scored = own.join(F.broadcast(known), F.col("term") == F.col("of"))
        hits = scored.groupBy("key").agg(F.sum(weight).alias("s"), F.count("*").alias("held"), F.flatten(F.collect_list("positions")).alias("positions"))
        return hits.where(F.col("held") == len(terms)).select("key", (-F.col("s")).alias("score"), "positions")


def snippet(text: Column, positions: Column, field: int, size: int = SNIPPET_TOKENS) -> Column:
    """The stretch of `size` tokens from a hit on that holds most hits, the first of equals, with hits in brackets.

    `positions` are those of a search; a text without hits gives its first tokens. What is cut off is an ellipsis.
    """
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?i){TOKEN}"), F.lit(0))
    hits = F.transform(F.filter(positions, lambda p: p["field"] == field), lambda p: p["at"])
    counted = F.transform(hits, lambda h: F.struct(F.size(F.filter(hits, lambda o: (o >= h) & (o < h + size))).alias("n"), (-h).alias("at")))

    def shown(x: Column) -> Column:
        start = F.coalesce(-F.array_max(x["counted"])["at"], F.lit(0))
        part = F.transform(F.slice(x["tokens"], start + 1, size), lambda t, k: F.when(F.array_contains(x["hits"], start + k), F.concat(F.lit("["), t, F.lit("]"))).otherwise(t))
        return F.concat(F.when(start > 0, "… ").otherwise(""), F.array_join(part, " "), F.when(F.size(x["tokens"]) > start + size, " …").otherwise(""))

    return F.transform(F.array(F.struct(tokens.alias("tokens"), hits.alias("hits"), counted.alias("counted"))), shown)[0]

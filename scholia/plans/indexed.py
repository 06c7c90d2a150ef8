"""Queries on a stored index of `documents`, built in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scholia.operators.components import shared_folder
from scholia.operators.stored_index import Index, build, snippet
from scholia.sources.tables import read

from .records import BM25_SQL

QUERIES: dict = {}


def query(sql: str | None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


def _parts(s, d):
    head, body = F.substring_index("text", "\n", 1), F.expr("substr(text, instr(text || '\n', '\n') + 1)")
    return read(s, d, "documents").select("doc_id", head.alias("head"), body.alias("body"))


def _index(s, d) -> Index:
    root = f"{shared_folder(s)}/index-{uuid.uuid4().hex}"
    build(_parts(s, d), "doc_id", {"head": 0.8, "body": 1.0}, root, "0")
    return Index(s, root)


@query(BM25_SQL.format(terms="['the', 'reer']") + "SELECT doc_id, score FROM sc ORDER BY score, doc_id LIMIT 10")
def indexed_search(s, d):
    """The ten best documents that hold both words, from the stored postings of these words."""
    hits = _index(s, d).search(["the", "reer"])
    return hits.select(F.col("key").alias("doc_id"), (F.floor(F.col("score") * 1e6 + 0.5) / 1e6).alias("score")).orderBy("score", "doc_id").limit(10)


@query("SELECT term, count(*) AS docs, CAST(sum(n) AS BIGINT) AS hits FROM (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents) GROUP BY doc_id, term) WHERE term IN ('the', 'of', 'est', 'nosuchword') GROUP BY term")
def posting_counts(s, d):
    """Documents and hits of some words."""
    own = _index(s, d).postings(["the", "of", "est", "nosuchword"])
    return own.groupBy("term").agg(F.count("*").alias("docs"), F.sum(F.size("positions")).alias("hits"))


@query(
    "WITH t AS (SELECT doc_id, regexp_extract_all(substr(text, strpos(text || chr(10), chr(10)) + 1), '(?i)[a-z0-9]+') AS w, list_has_all(regexp_extract_all(lower(text), '[a-z0-9]+'), ['the', 'of']) AS held FROM documents), "
    "h AS (SELECT doc_id, w, list_filter(range(0, len(w)), lambda k: lower(w[k + 1]) IN ('the', 'of')) AS hits FROM t WHERE held), "
    "b AS (SELECT *, coalesce(list_max(list_transform(hits, lambda k: {'n': len(list_filter(hits, lambda o: o >= k AND o < k + 28)), 'at': -k}))['at'] * -1, 0) AS b FROM h) "
    "SELECT doc_id, CASE WHEN b > 0 THEN '… ' ELSE '' END || array_to_string(list_transform(range(b, least(b + 28, len(w))), lambda k: CASE WHEN list_contains(hits, k) THEN '[' || w[k + 1] || ']' ELSE w[k + 1] END), ' ') || CASE WHEN len(w) > b + 28 THEN ' …' ELSE '' END AS snippet FROM b"
)
def indexed_snippets(s, d):
    """The densest 28 words of each document that holds both words, by stored positions."""
    hits = _index(s, d).search(["the", "of"])
    return hits.join(_parts(s, d), F.col("key") == F.col("doc_id")).select("doc_id", snippet(F.col("body"), F.col("positions"), 1).alias("snippet"))

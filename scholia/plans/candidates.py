"""Queries on candidates of several searches: one record for each paper, in order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholia.functions import text as T
from scholia.operators import identity
from scholia.operators.arrival import arrivals

from .papers import _HAS_SQL, _KEY, PAPERS_SQL, table

QUERIES: dict = {}


def query(sql: str | None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


#: Columns of aliases in order of preference; a record takes identifiers over, but keeps its title.
KINDS = [("by_doi", True), ("by_pmcid", True), ("by_pmid", True), ("by_title", False)]


def candidates(s, d) -> DataFrame:
    """Papers with their aliases; the id is the order of arrival."""
    c = F.col
    tagged = lambda tag, v: F.concat(F.lit(tag), v)
    title = T.nz(T.title_key(c("phrase")))
    made = {"by_doi": tagged("doi:", T.doi(c("doi"))), "by_pmcid": tagged("pmcid:", F.upper("pmcid")), "by_pmid": tagged("pmid:", c("pmid")), "by_title": F.concat_ws(":", tagged("title:", title), c("year"))}
    return table(s, d).select("*", *[v.alias(k) for k, v in made.items()])


_CANDIDATES = f"""(SELECT *, 'doi:' || {_HAS_SQL["doi_bare"]} AS by_doi, 'pmcid:' || upper(pmcid) AS by_pmcid, 'pmid:' || pmid AS by_pmid,
  'title:' || {_KEY.format("phrase")} || ':' || year AS by_title FROM {PAPERS_SQL})"""
_ARRIVALS = f"""
WITH listed AS (SELECT list({{'seq': doc_id, 'al': [by_doi, by_pmcid, by_pmid, by_title]}} ORDER BY doc_id) AS rows FROM {_CANDIDATES}),
replayed AS (
  SELECT list_reduce(rows, lambda s, x: list_transform([{{
      'record': coalesce(s.own[list_filter(x.al, lambda a: a IS NOT NULL AND s.own[a] IS NOT NULL)[1]], x.seq)}}], lambda f: list_transform([{{
      'record': f.record, 'vals': CASE WHEN s.mine[f.record] IS NULL THEN x.al ELSE [coalesce(s.mine[f.record][1], x.al[1]), coalesce(s.mine[f.record][2], x.al[2]), coalesce(s.mine[f.record][3], x.al[3]), s.mine[f.record][4]] END}}],
      lambda g: {{
        'own': map_concat(s.own, map(list_filter(g.vals, lambda a: a IS NOT NULL), list_transform(list_filter(g.vals, lambda a: a IS NOT NULL), lambda a: g.record))),
        'mine': map_concat(s.mine, map([g.record], [g.vals])),
        'done': s.done || [{{'seq': x.seq, 'record': g.record}}]}})[1])[1],
    {{'own': MAP {{}}::MAP(VARCHAR, BIGINT), 'mine': MAP {{}}::MAP(BIGINT, VARCHAR[]), 'done': []::STRUCT(seq BIGINT, record BIGINT)[]}}).done AS done
  FROM listed
), arrived AS (SELECT unnest(done, recursive := true) FROM replayed)
"""


@query(f"{_ARRIVALS} SELECT seq AS doc_id, record FROM arrived")
def arrival_records(s, d):
    """The record of each candidate: the paper that started it."""
    return arrivals(candidates(s, d), "doc_id", KINDS).select(F.col("seq").alias("doc_id"), "record")


@query(
    f"{_ARRIVALS}, joined AS (SELECT c.*, a.record FROM {_CANDIDATES} AS c JOIN arrived AS a ON c.doc_id = a.seq) "
    "SELECT record, count(*) AS papers, arg_min(by_doi, doc_id) FILTER (by_doi IS NOT NULL) AS doi, arg_min(by_pmcid, doc_id) FILTER (by_pmcid IS NOT NULL) AS pmcid, arg_min(by_pmid, doc_id) FILTER (by_pmid IS NOT NULL) AS pmid, "
    "coalesce(arg_min(by_doi, doc_id) FILTER (by_doi IS NOT NULL), arg_min(by_pmcid, doc_id) FILTER (by_pmcid IS NOT NULL), arg_min(by_pmid, doc_id) FILTER (by_pmid IS NOT NULL), min(by_title) FILTER (doc_id = record)) AS paper_id, "
    "max(cites) AS cites, array_to_string(list_sort(list_distinct(list(lang))), ',') AS strata, bool_or(doc_id % 3 = 0) AS open FROM joined GROUP BY record"
)
def candidate_union(s, d):
    """One row for each record: first identifiers by arrival, most citations, all strata, any open copy."""
    rows = candidates(s, d).withColumn("open", F.col("doc_id") % 3 == 0)
    rows = rows.join(arrivals(rows, "doc_id", KINDS), F.col("doc_id") == F.col("seq")).withColumn("strata", F.array("lang")).withColumn("one", F.lit(1))
    merged = identity.merge_candidates(rows, "record", "doc_id", ["by_doi", "by_pmcid", "by_pmid"], ["cites"], ["strata"], ["open"])
    counted = rows.groupBy(F.col("record").alias("of")).agg(F.count("*").alias("papers"), F.max(F.when(F.col("doc_id") == F.col("record"), F.col("by_title"))).alias("own_title"))
    ids = [F.coalesce("by_doi", "by_pmcid", "by_pmid", "own_title").alias("paper_id"), F.col("by_doi").alias("doi"), F.col("by_pmcid").alias("pmcid"), F.col("by_pmid").alias("pmid")]
    return merged.join(counted, F.col("record") == F.col("of")).select("record", "papers", *ids, "cites", F.array_join("strata", ",").alias("strata"), "open")

"""Queries on articles in JATS, made from `documents`: every line is a section, three to a branch of the tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholia.operators import jats

from .papers import _HAS_SQL, _SECTION, HEADS, PAPERS_SQL, _at, table

QUERIES: dict = {}


def query(sql: str | None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


#: Line k of a text is a section at depth 1 + k % 3 below the line before; every seventh has no title.
HEADING = f"CASE WHEN k % 7 = 5 THEN '' ELSE {_at(HEADS, '(n_chars + k)')} END"
GIVEN = "CASE WHEN (doc_id + k) % 12 = 0 THEN 'methods' WHEN (doc_id + k) % 29 = 0 THEN 'conclusions' ELSE '' END"
CONTROL = r"[\x00-\x1F\x7F￾￿]"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def articles(s, d) -> DataFrame:
    """doc_id and the XML of an article for each document; some have no abstract, some no sections."""
    lines = F.filter(F.transform(F.split(F.coalesce("body", F.lit("")), "\n"), lambda x: F.regexp_replace(x, CONTROL, " ")), lambda x: F.trim(x) != "")
    t = table(s, d).withColumn("lines", F.transform(lines, lambda x: F.replace(escaped(x), F.lit(" the "), F.lit(" <italic>the</italic> "))))
    heads = F.array(*[F.lit(h) for h in HEADS])
    heading = lambda k: F.when(k % 7 == 5, F.lit("")).otherwise(F.get(heads, ((F.col("n_chars") + k) % len(HEADS)).cast("int")))
    given = lambda k: F.when((F.col("doc_id") + k) % 12 == 0, "methods").when((F.col("doc_id") + k) % 29 == 0, "conclusions").otherwise("")

    def section(line: Column, k: Column) -> Column:
        close = F.when((k % 3 == 0) & (k > 0), F.lit("</sec></sec></sec>")).otherwise("")
        title = F.when(k % 7 == 5, F.lit("")).otherwise(F.concat(F.lit("<title>"), heading(k), F.lit("</title>")))
        return F.concat(close, F.lit('<sec sec-type="'), given(k), F.lit('">'), title, F.lit("<p>"), line, F.lit("</p><ref-list><title>R</title><ref>gone</ref></ref-list>"))

    n = F.size("lines")
    tree = F.concat(F.array_join(F.transform("lines", section), ""), F.repeat(F.lit("</sec>"), F.when(n > 0, (n - 1) % 3 + 1).otherwise(0)))
    flat = F.array_join(F.transform("lines", lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "\n")
    identifier = lambda kind, c: F.coalesce(F.concat(F.lit(f'<article-id pub-id-type="{kind}">'), escaped(F.col(c)), F.lit("</article-id>")), F.lit(""))
    wrap = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    abstract = F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(wrap("abstract", wrap("p", escaped(F.col("phrase")))))
    meta = F.concat(
        identifier("doi", "doi"), identifier("pmc", "pmcid"), identifier("pmid", "pmid"), wrap("title-group", wrap("article-title", wrap("bold", escaped(F.col("phrase"))))),
        wrap("pub-date", wrap("year", F.col("year").cast("string"))), F.lit('<permissions><license xlink:href="https://l/'), F.col("lang"), F.lit('"><license-p>Free</license-p></license></permissions>'), abstract,
    )
    head = wrap("front", F.concat(wrap("journal-meta", wrap("journal-title-group", wrap("journal-title", escaped(F.col("journal"))))), wrap("article-meta", meta)))
    xml = F.concat(F.lit('<article xmlns:xlink="http://www.w3.org/1999/xlink">'), head, wrap("body", F.when(F.col("doc_id") % 13 == 0, flat).otherwise(tree)), F.lit("</article>"))
    return t.select("doc_id", xml.alias("xml"))


_LINES = rf"""
lines AS (
  SELECT doc_id, n_chars, k - 1 AS k, l[k] AS line
  FROM (SELECT doc_id, n_chars, list_filter(list_transform(string_split(coalesce(body, ''), chr(10)), lambda x: trim(regexp_replace(regexp_replace(x, '[\x00-\x1F\x7F\x{{FFFE}}\x{{FFFF}}]', ' ', 'g'), '\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM {PAPERS_SQL}),
    LATERAL (SELECT unnest(range(1, len(l) + 1)) AS k)
), named AS (SELECT doc_id, k, line, {HEADING} AS heading, {GIVEN} AS sec_type FROM lines WHERE doc_id % 13 <> 0),
own AS (SELECT *, {_SECTION} AS own FROM named),
top AS (SELECT *, own AS t0 FROM own WHERE k % 3 = 0),
mid AS (SELECT o.*, t.t0, CASE WHEN t.t0 = 'references' OR (o.own = 'other' AND t.t0 <> 'other') THEN t.t0 ELSE o.own END AS t1 FROM own AS o JOIN top AS t ON o.doc_id = t.doc_id AND o.k = t.k + 1 WHERE o.k % 3 = 1),
typed AS (
  SELECT doc_id, k, line, heading, own AS section_type FROM top
  UNION ALL SELECT doc_id, k, line, heading, t1 FROM mid
  UNION ALL SELECT o.doc_id, o.k, o.line, o.heading, CASE WHEN m.t1 = 'references' OR (o.own = 'other' AND m.t1 <> 'other') THEN m.t1 ELSE o.own END FROM own AS o JOIN mid AS m ON o.doc_id = m.doc_id AND o.k = m.k + 1 WHERE o.k % 3 = 2
), numbered AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS ordinal, 1 + k % 3 AS depth, heading, section_type, line FROM typed WHERE section_type <> 'references'
), sections AS (
  SELECT doc_id, ordinal, depth, CASE WHEN heading = '' THEN 'Untitled section ' || ordinal ELSE trim(regexp_replace(heading, '\s+', ' ', 'g')) END AS heading, section_type, line AS text FROM numbered
  UNION ALL SELECT doc_id, 1, 1, 'Body', 'other', string_agg(line, ' ' ORDER BY k) FROM lines WHERE doc_id % 13 = 0 GROUP BY doc_id
  UNION ALL SELECT doc_id, 0, 0, 'Abstract', 'abstract', phrase FROM {PAPERS_SQL} WHERE doc_id % 5 <> 0
)
"""
_WORDS = "len(regexp_extract_all(text, '[A-Za-z]+(?:[-''][A-Za-z]+)?'))"


def records(s, d) -> DataFrame:
    """Parsed articles: front matter and sections, the abstract first."""
    parsed = articles(s, d).select("doc_id", jats.article(F.col("xml")).alias("article"))
    fronts = parsed.select("doc_id", *jats.front(F.col("article")), jats.sections(F.col("article.body")).alias("found"))
    return fronts.withColumn("sections", jats.with_abstract(F.col("found"), F.col("abstract"))).drop("found")


@query(f"WITH {_LINES} SELECT doc_id, CAST(ordinal AS INT) AS ordinal, CAST(depth AS INT) AS depth, heading, section_type, {_WORDS} AS words, md5(text) AS digest FROM sections")
def jats_sections(s, d):
    """Sections of parsed articles with types that go down the tree; sections of references go with all below them."""
    # outer, since Spark sends what it infers of an inner one down to the scan, where it builds and parses every article a second time
    rows = records(s, d).select("doc_id", F.explode_outer("sections").alias("x")).where("x IS NOT NULL")
    return rows.select("doc_id", "x.ordinal", "x.depth", "x.heading", "x.section_type", "x.words", F.md5("x.text").alias("digest"))


@query(
    f"WITH {_LINES}, sums AS (SELECT doc_id, count(*) AS n, CAST(sum({_WORDS}) AS BIGINT) AS words FROM sections GROUP BY doc_id) "
    f"SELECT p.doc_id, phrase AS title, journal, {_HAS_SQL['doi_bare']} AS doi, pmid, upper(pmcid) AS pmcid, CAST(year AS INT) AS year, 'Free' AS license, 'https://l/' || lang AS license_url, "
    f"CASE WHEN p.doc_id % 5 = 0 THEN '' ELSE phrase END AS abstract, coalesce(n, 0) AS section_count, coalesce(words, 0) AS word_count FROM {PAPERS_SQL} AS p LEFT JOIN sums AS s ON p.doc_id = s.doc_id"
)
def jats_records(s, d):
    """Records of articles: identifiers, licence, abstract, and how many sections and words they have."""
    words = F.aggregate("sections", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return records(s, d).withColumn("section_count", F.size("sections").cast("long")).withColumn("word_count", words).drop("sections")

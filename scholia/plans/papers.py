"""Queries on papers, made from `documents`: candidates, sections, kinds, moves, selection, joins of records.

The tables have no bibliographic columns, so PAPER makes them from the ids, in both engines by the
same expressions; the operators under test are written twice, as columns and as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholia.functions import patterns as V
from scholia.functions import text as T
from scholia.operators import identity, papers
from scholia.sources.tables import read

#: Phrases that the invented prose lacks, dealt by id so that every rule has rows that it takes.
PHRASES = [
    "This study aims to test a novel implant.", "However, little is known. Correction to a porous scaffold.", "A systematic review of clinical trials.",
    "Results showed that it increased because of fatigue.", "We propose a finite element simulation.", "Editorial: the limitation may be [12] and (Smith et al., 2019a).",
    "Case report of a retracted cohort.", "In contrast, the scaffold was fabricated and the model was validated.", "Study protocol with topology optimization.", "Nothing of note.",
]
TYPES = ["research-article", "Journal Article", "review", "case report", "letter", "clinical trial", "protocol", "", "news", "method"]
HEADS = ["1. Introduction", "Materials and methods", "Results and discussion", "2.1 Methods of test", "Conclusions.", "References", "Overview", "Discussion", "3 Case report", "Limitations of it"]


def _listed(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _at(values: list[str], key: str) -> str:
    """The value of a list by an id, in the SQL of both engines."""
    return "CASE " + " ".join(f"WHEN {key} % {len(values)} = {k} THEN '" + v.replace("'", "''") + "'" for k, v in enumerate(values)) + " END"


PAPER = {
    "doc_id": "doc_id", "lang": "lang", "journal": "source", "n_chars": "n_chars", "body": "text",
    "title": f"split_part(text, '\n', 1) || ' ' || {_at(PHRASES, 'doc_id')}", "phrase": _at(PHRASES, "doc_id"), "kind": _at(TYPES, "(doc_id + n_chars)"),
    "doi": "CASE WHEN doc_id % 3 <> 0 THEN 'DOI: 10.1000/' || source || '.' || CAST(doc_id % 500 AS STRING) || '.)' END",
    "pmcid": "CASE WHEN doc_id % 11 <> 0 THEN 'PMC' || CAST(doc_id % 800 AS STRING) END", "pmid": "CASE WHEN doc_id % 7 = 0 THEN CAST(doc_id % 300 AS STRING) END",
    "year": "1995 + doc_id % 31", "cites": "n_chars % 1000", "pages": "doc_id % 40", "fonts": "doc_id % 17", "images": "n_chars % 90", "tables": "doc_id % 6", "formulas": "doc_id % 9",
    "heading": _at(HEADS, "n_chars"), "sec_type": "CASE WHEN doc_id % 4 = 0 THEN 'methods' WHEN doc_id % 9 = 0 THEN 'conclusions' ELSE '' END",
}
PAPERS_SQL = "(SELECT " + ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS {c}" for c, e in PAPER.items()) + " FROM documents)"


def table(s, d) -> DataFrame:
    return read(s, d, "documents").selectExpr(*[f"{e} AS {c}" for c, e in PAPER.items()])


QUERIES: dict = {}


def query(sql: str | None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


def _any(text: str, cues) -> str:
    return "(" + " OR ".join(f"contains({text}, '{c}')" for c in cues) + ")"


def _rx(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '" + pattern.replace("'", "''") + "')"


def _n(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '" + pattern.replace("'", "''") + "'))"


_HAS_SQL = {"doi_bare": "nullif(regexp_replace(regexp_replace(lower(trim(doi)), '^(?:https?://(?:dx\\.)?doi\\.org/|doi:\\s*)', ''), '[.,;:)\\]}>]+$', ''), '')"}
_KEY = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]', '', 'g')"


@query(f"SELECT doc_id, pmcid, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, year FROM {PAPERS_SQL} WHERE pmcid IS NOT NULL AND trim(title) <> ''")
def candidate_projection(s, d):
    t = table(s, d)
    return t.where(T.nz(F.col("pmcid")).isNotNull() & T.nz(F.col("title")).isNotNull()).select("doc_id", "pmcid", T.compact(F.col("title")).alias("title"), "year")


@query(f"SELECT doc_id, concat_ws('; ', nullif(kind, ''), CASE WHEN doc_id % 2 = 0 THEN lang END) AS kinds FROM {PAPERS_SQL}")
def type_flatten(s, d):
    parts = F.array(T.nz(F.col("kind")), F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    return table(s, d).select("doc_id", F.array_join(F.array_compact(parts), "; ").alias("kinds"))


_ALIASES = f"list_filter([CASE WHEN {_HAS_SQL['doi_bare']} IS NOT NULL THEN 'doi:' || {_HAS_SQL['doi_bare']} END, 'pmcid:' || upper(pmcid), 'pmid:' || pmid, 'title:' || {_KEY.format('phrase')} || ':' || year], lambda x: x IS NOT NULL)"


def _aliased(s, d) -> DataFrame:
    c = F.col
    return table(s, d).select("doc_id", identity.aliases(c("doi"), c("pmcid"), c("pmid"), c("phrase"), c("year")).alias("aliases"))


@query(f"SELECT doc_id, unnest(range(len(a))) AS place, unnest(a) AS alias FROM (SELECT doc_id, {_ALIASES} AS a FROM {PAPERS_SQL})")
def alias_explosion(s, d):
    return _aliased(s, d).select("doc_id", F.posexplode("aliases").alias("place", "alias")).withColumn("place", F.col("place").cast("long"))


@query(f"WITH a AS (SELECT doc_id, {_ALIASES} AS a FROM {PAPERS_SQL}) SELECT doc_id FROM a WHERE doc_id % 2 = 1 AND NOT list_has_any(a, (SELECT list(x) FROM (SELECT unnest(a) AS x FROM a WHERE doc_id % 20 = 0)))")
def unused_candidates(s, d):
    """Odd candidates none of whose aliases a used paper has."""
    a = _aliased(s, d)
    used = a.where("doc_id % 20 = 0").select(F.explode("aliases").alias("alias"))
    return identity.unused(a.where("doc_id % 2 = 1"), used, "doc_id", "aliases", "alias").select("doc_id")


@query(f"WITH a AS (SELECT doc_id, unnest({_ALIASES}) AS alias FROM {PAPERS_SQL}) SELECT alias, min(doc_id) AS first_id, count(DISTINCT doc_id) AS papers FROM a GROUP BY alias HAVING count(DISTINCT doc_id) > 1")
def alias_union(s, d):
    """Aliases that unite papers, with the first of them."""
    a = _aliased(s, d).select("doc_id", F.explode("aliases").alias("alias")).distinct()
    return a.groupBy("alias").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("papers")).where("papers > 1")


_SCORE = f"floor((12 * (1 + doc_id % 2) + CASE WHEN trim(body) <> '' THEN 4 ELSE 0 END + CASE WHEN doi IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN year >= 2020 THEN 4 WHEN year >= 2010 THEN 2 ELSE 0 END + CASE WHEN {_any('lower(kind)', ['research', 'journal article'])} THEN 3 ELSE 0 END + CASE WHEN contains(lower(kind), 'review') THEN 1 ELSE 0 END + least(ln(1 + greatest(cites, 0)), 7)) * 1e3 + 0.5) / 1e3"


def _scored(s, d) -> DataFrame:
    c = F.col
    return table(s, d).select("*", papers.candidate_score(1 + c("doc_id") % 2, c("body"), c("doi"), c("year"), c("kind"), c("cites")).alias("score"))


@query(f"SELECT doc_id, {_SCORE} AS score FROM {PAPERS_SQL}")
def candidate_score(s, d):
    return _scored(s, d).select("doc_id", "score")


@query(f"SELECT doc_id, row_number() OVER (ORDER BY {_SCORE} DESC, year DESC, cites DESC, title DESC, doc_id) AS rank FROM {PAPERS_SQL} ORDER BY rank LIMIT 100")
def global_rank(s, d):
    """The hundred best candidates; the limit comes before the rank, so no window holds the table."""
    order = [F.desc("score"), F.desc("year"), F.desc("cites"), F.desc("title"), F.col("doc_id")]
    top = _scored(s, d).select("doc_id", "score", "year", "cites", "title").orderBy(*order).limit(100)
    return top.select("doc_id", F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank"))


_NAME = r"regexp_replace(trim(lower(trim(regexp_replace(heading, '\s+', ' ', 'g'))), ' .:'), '^\d+(?:\.\d+)*\.?\s*', '')"
_SECTION = (
    "CASE WHEN sec_type IN ('intro', 'introduction') THEN 'introduction' WHEN sec_type IN ('methods', 'materials|methods', 'method') THEN 'methods' WHEN sec_type = 'conclusions' THEN 'conclusion' WHEN sec_type IN ('results', 'discussion', 'conclusion') THEN sec_type WHEN sec_type IN ('references', 'ref-list') THEN 'references' "
    + " ".join(f"WHEN {_NAME} = '{k}' OR starts_with({_NAME}, '{k} ') THEN '{v}'" for k, v in V.SECTION_TYPES.items())
    + " ELSE 'other' END"
)


@query(f"SELECT doc_id, heading, {_SECTION} AS section FROM {PAPERS_SQL}")
def section_types(s, d):
    return table(s, d).select("doc_id", "heading", papers.section_type(F.col("heading"), F.col("sec_type")).alias("section"))


@query(f"SELECT section, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM (SELECT {_SECTION} AS section, n_chars FROM {PAPERS_SQL}) WHERE section <> 'references' GROUP BY section")
def sections_without_references(s, d):
    t = table(s, d).select(papers.section_type(F.col("heading"), F.col("sec_type")).alias("section"), "n_chars")
    return t.where("section <> 'references'").groupBy("section").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(
    "WITH t AS (SELECT conv_id, turn, turn % 3 AS depth, CASE WHEN turn % 3 = 0 THEN CASE WHEN length(text) % 2 = 0 THEN 'methods' ELSE 'results' END WHEN length(text) % 5 = 0 THEN 'discussion' ELSE 'other' END AS own FROM conversations), "
    "p AS (SELECT *, last_value(CASE WHEN depth = 0 THEN own END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS top, last_value(CASE WHEN depth = 0 THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS at0 FROM t), "
    "m AS (SELECT *, CASE WHEN depth = 1 AND own = 'other' THEN top ELSE own END AS mid FROM p) "
    "SELECT conv_id, turn, CASE WHEN depth < 2 OR own <> 'other' THEN mid ELSE coalesce(last_value(CASE WHEN depth = 1 THEN mid END IGNORE NULLS) OVER (PARTITION BY conv_id, at0 ORDER BY turn), top) END AS section FROM m"
)
def section_inheritance(s, d):
    """A section of type 'other' has the type of the nearest one above; depth is the turn modulo 3, turns are sections."""
    own = F.when(F.col("depth") == 0, F.when(F.length("text") % 2 == 0, "methods").otherwise("results")).when(F.length("text") % 5 == 0, "discussion").otherwise("other")
    t = read(s, d, "conversations").withColumn("depth", F.col("turn") % 3).select("conv_id", "turn", "depth", own.alias("own"))
    last = lambda c, w: F.last(c, ignorenulls=True).over(w)
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = t.withColumn("top", last(F.when(F.col("depth") == 0, F.col("own")), w)).withColumn("at0", last(F.when(F.col("depth") == 0, F.col("turn")), w))
    t = t.withColumn("mid", F.when((F.col("depth") == 1) & (F.col("own") == "other"), F.col("top")).otherwise(F.col("own")))
    up = last(F.when(F.col("depth") == 1, F.col("mid")), Window.partitionBy("conv_id", "at0").orderBy("turn"))
    return t.select("conv_id", "turn", F.when((F.col("depth") < 2) | (F.col("own") != "other"), F.col("mid")).otherwise(F.coalesce(up, F.col("top"))).alias("section"))


_BOTH = "lower(phrase) || ' ' || lower(kind)"
_KINDS = {k: "|".join(c.replace("-", r"\-") for c in cues) for k, cues in V.KINDS.items()}
_KIND = (
    "CASE "
    + " ".join(f"WHEN {_rx(_BOTH, rf'\b(?:{c})\b')} OR {_rx('lower(heading)', rf'^\s*(?:\d+(?:\.\d+)*\.?\s+)?(?:{c})\b')} THEN '{k}'" for k, c in _KINDS.items())
    + f" WHEN contains(lower(kind), 'case report') THEN 'case_report' WHEN {_any('lower(kind)', ['research', 'journal article', 'clinical trial'])} THEN 'original_research' WHEN {_any('lower(kind)', ['method', 'protocol'])} THEN 'protocol' ELSE 'other_substantive' END"
)


@query(f"SELECT doc_id, {_KIND} AS article_kind FROM {PAPERS_SQL}")
def article_kinds(s, d):
    return table(s, d).select("doc_id", papers.article_kind(F.col("phrase"), F.col("kind"), F.array("heading")).alias("article_kind"))


_FEATURES = ", ".join(f"CASE WHEN {_any('t', cues)} THEN '{k}' END" for k, cues in V.FEATURES.items())


@query(
    f"SELECT doc_id, coalesce(nullif(concat_ws(';', {_FEATURES}, CASE WHEN doc_id % 2 = 0 AND {_any('t', V.FEATURES['finite_element_or_computational'])} THEN 'methods_results_modeling' END), ''), 'unclassified') AS features FROM (SELECT doc_id, lower(title || ' ' || body) AS t FROM {PAPERS_SQL})"
)
def design_features(s, d):
    """Raw substring cues over title and body; even papers have methods and results."""
    kinds = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("methods"), F.lit("results"))).otherwise(F.array(F.lit("other")))
    return table(s, d).select("doc_id", F.array_join(papers.design_features(F.concat_ws(" ", "title", "body"), kinds), ";").alias("features"))


_LOW = "lower(kind)"
_REASONS = f"concat_ws(';', CASE WHEN {_any(_BOTH, V.CORRECTION)} THEN 'correction' END, CASE WHEN {_any(_BOTH, V.RETRACTION)} THEN 'retraction' END, CASE WHEN {_any(_BOTH, V.EDITORIAL)} THEN 'editorial' END, CASE WHEN w = 0 THEN 'zero_content' END, CASE WHEN w = 0 OR {_any(_LOW, V.NON_SUBSTANTIVE)} THEN 'non_substantive' END)"
_W = "len(regexp_extract_all(body, '[A-Za-z]+(?:[-''][A-Za-z]+)?'))"


def _reasons(s, d) -> DataFrame:
    w = T.word_count(F.col("body"))
    return table(s, d).select("doc_id", "lang", papers.exclusion_reasons(F.col("phrase"), F.col("kind"), w, w).alias("reasons"))


@query(f"SELECT doc_id, {_REASONS} AS reasons FROM (SELECT *, {_W} AS w FROM {PAPERS_SQL})")
def paper_exclusions(s, d):
    return _reasons(s, d).select("doc_id", F.array_join("reasons", ";").alias("reasons"))


@query(f"WITH r AS (SELECT lang, {_REASONS} AS r FROM (SELECT *, {_W} AS w FROM {PAPERS_SQL})) SELECT lang, reason, count(*) AS n FROM (SELECT lang, unnest(string_split(r, ';')) AS reason FROM r WHERE r <> '') GROUP BY lang, reason")
def reason_histogram(s, d):
    return _reasons(s, d).select("lang", F.explode("reasons").alias("reason")).groupBy("lang", "reason").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 4 = 0 THEN ' ' ELSE lang END), ''), 'unclassified') AS stratum FROM {PAPERS_SQL}")
def primary_stratum(s, d):
    strata = F.array(F.when(F.col("doc_id") % 4 == 0, " ").otherwise(F.col("lang")), F.col("journal"))
    return table(s, d).select("doc_id", F.coalesce(T.nz(F.get(strata, 0)), F.lit("unclassified")).alias("stratum"))


@query("SELECT domain, count(*) AS papers FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS domain FROM {PAPERS_SQL} WHERE {_rx('lower(phrase || chr(32) || substr(body, 1, 5000))', p)}" for k, p in V.DOMAINS.items()) + ") GROUP BY domain")
def domain_labels(s, d):
    """Domains named in title and the first 5,000 characters."""
    text = F.lower(F.concat_ws(" ", "phrase", F.substring("body", 1, 5000)))
    found = F.array_compact(F.array(*[F.when(F.regexp_like(text, F.lit(p)), F.lit(k)) for k, p in V.DOMAINS.items()]))
    return table(s, d).select(F.explode(found).alias("domain")).groupBy("domain").agg(F.count("*").alias("papers"))


def _hits(k: str) -> str:
    return "(" + " + ".join(f"CAST(contains(t, '{c}') AS BIGINT)" for c in V.KEYWORDS[k]) + ")"


_R4 = "floor(({}) * 1e4 + 0.5) / 1e4"
_SHOT = "(images / greatest(pages, 1))"
_DENS = "(n_chars / greatest(pages, 1))"
_SCAN = f"({_DENS} < 150 OR (fonts = 0 AND images >= pages))"
_STRATA = {
    "layout_stress": (
        f"CAST({_SCAN} AS INT) * 120 + greatest(0.0::DOUBLE, 900.0::DOUBLE - {_DENS}) / 12 + CAST(fonts <= 1 AS INT) * 25 + least({_SHOT}, 5.0::DOUBLE) * 3 + greatest(0, 2018 - year) * 0.7::DOUBLE",
        f"{_SCAN} OR {_DENS} < 3500 OR pages >= 20 OR fonts >= 15 OR {_SHOT} >= 15 OR (year > 0 AND year < 2012)",
    ),
    "formula_fe_topology": (f"formulas * 3.0::DOUBLE + {_hits('formula')} * 25", f"formulas >= 4 OR {_hits('formula')} > 0"),
    "table_review_clinical": (f"tables * 4.0::DOUBLE + {_hits('table')} * 20", f"tables >= 3 OR {_hits('table')} > 0"),
    "figure_am_biomaterial": (f"tables * 2.0::DOUBLE + {_hits('figure')} * 18", f"tables >= 4 OR {_hits('figure')} > 0"),
    "standard_born_digital": (f"least({_DENS}, 3000.0::DOUBLE) / 70 + least(fonts, 12) - CAST({_SCAN} AS INT) * 35 - abs(greatest(pages, 1) - 12) * 0.15::DOUBLE", f"NOT {_SCAN}"),
}
_STRATA_SQL = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS stratum, {_R4.format(a)} AS score, {b} AS qualifies FROM (SELECT *, lower(title) AS t FROM {PAPERS_SQL})" for k, (a, b) in _STRATA.items())


def _strata(s, d) -> DataFrame:
    c = F.col
    t = table(s, d).withColumn("density", c("n_chars") / F.greatest("pages", F.lit(1)))
    t = t.withColumn("scanned", (c("density") < 150) | ((c("fonts") == 0) & (c("images") >= c("pages"))))
    own = {k: c(k) for k in ("year", "pages", "density", "fonts", "images", "scanned", "formulas", "tables")} | {"figures": c("tables"), "text": F.lower("title")}
    return t.select("doc_id", F.explode(papers.stratum_scores(own)).alias("x")).select("doc_id", "x.*")


@query(_STRATA_SQL)
def stratum_scores(s, d):
    return _strata(s, d)


@query(f"SELECT doc_id, stratum, rank FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY NOT qualifies, score DESC, doc_id) AS rank FROM ({_STRATA_SQL})) WHERE rank <= 5")
def stratum_top(s, d):
    """The five best of each stratum, qualified ones first; a window limit, so only heads of partitions are sorted together."""
    w = Window.partitionBy("stratum").orderBy(~F.col("qualifies"), F.desc("score"), "doc_id")
    return _strata(s, d).withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 5").select("doc_id", "stratum", "rank")


@query(None)
def stratified_with_reserves(s, d):
    """Strata in order take three unused papers each, then two reserves; tested against a plain loop."""
    return papers_with_reserves(_strata(s, d), list(_STRATA), 3, 2)


def papers_with_reserves(scored: DataFrame, strata: list[str], per: int, reserve: int) -> DataFrame:
    """Disjoint picks: doc_id, stratum, basis.

    A stratum needs at most its own number of rows beyond those that earlier ones took, so the first
    (per + reserve) * (strata so far) of each ranking are enough: a bounded table, on which the
    sequential part runs in the driver.
    """
    most = (per + reserve) * len(strata)
    w = Window.partitionBy("stratum").orderBy(~F.col("qualifies"), F.desc("score"), "doc_id")
    heads = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).select("doc_id", "stratum", "qualifies", "rank").collect()
    ranked = {k: sorted((r for r in heads if r["stratum"] == k), key=lambda r: r["rank"]) for k in strata}
    used, out = set(), []
    for k in strata:
        free = [r for r in ranked[k] if r["doc_id"] not in used]
        if len(free) < per + reserve:
            raise ValueError(f"not enough candidates for {k}: {len(free)}")
        for prefix, some in (("", free[:per]), ("reserve_", free[per : per + reserve])):
            for r in sorted(some, key=lambda r: r["doc_id"]):
                out.append((r["doc_id"], k, prefix + ("qualified" if r["qualifies"] else "ranked_fill")))
                used.add(r["doc_id"])
    return scored.sparkSession.createDataFrame(out, "doc_id long, stratum string, basis string")


_ASCII = r"regexp_replace({}, '[^\x00-\x7F\P{{L}}]', 'x', 'g')"
_MOVE_TEXT = _ASCII.format("phrase || ' ' || body")
_MOVES = ", ".join(f"CAST({' + '.join(_n('t', '(?i)' + p) for p in ps)} AS BIGINT) AS {k}" for k, ps in V.MOVES.items())


@query(f"SELECT doc_id, {_MOVES} FROM (SELECT doc_id, {_MOVE_TEXT} AS t FROM {PAPERS_SQL})")
def rhetorical_moves(s, d):
    text = F.concat_ws(" ", "phrase", "body")
    return table(s, d).select("doc_id", *[c.alias(k) for k, c in papers.move_counts(text).items()])


_FIRST = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS name, length(regexp_extract(t, '(?is)^(.*?)(?:{'|'.join(p.replace(chr(39), chr(39) * 2) for p in ps)})', 1)) AS at_ FROM x WHERE {' OR '.join(_rx('t', '(?i)' + p) for p in ps)}" for k, ps in V.MOVES.items())


@query(f"WITH x AS (SELECT doc_id, {_ASCII.format('phrase')} AS t FROM {PAPERS_SQL}), m AS ({_FIRST}) SELECT x.doc_id, coalesce(string_agg(name, '>' ORDER BY at_, name), '') AS moves FROM x LEFT JOIN m ON x.doc_id = m.doc_id GROUP BY x.doc_id")
def rhetorical_sequence(s, d):
    return table(s, d).select("doc_id", F.array_join(papers.move_sequence(F.col("phrase")), ">").alias("moves"))


_EXAMPLE = " UNION ALL ".join(f"SELECT '{k}' AS move, doc_id, phrase FROM {PAPERS_SQL} WHERE {' OR '.join(_rx('phrase', '(?i)' + p) for p in ps)}" for k, ps in V.MOVES.items())
_CLIP = "array_to_string(regexp_extract_all(phrase, '\\S+')[1:6], ' ') || CASE WHEN len(regexp_extract_all(phrase, '\\S+')) > 6 THEN ' …' ELSE '' END"


@query(f"SELECT move, doc_id, {_CLIP} AS excerpt FROM (SELECT *, row_number() OVER (PARTITION BY move ORDER BY doc_id) AS r FROM ({_EXAMPLE})) WHERE r <= 2")
def move_examples(s, d):
    """The first two papers of each move, with six words."""
    found = F.array_compact(F.array(*[F.when(papers.has_move(F.col("phrase"), k), F.lit(k)) for k in V.MOVES]))
    t = table(s, d).select("doc_id", "phrase", F.explode(found).alias("move"))
    r = F.row_number().over(Window.partitionBy("move").orderBy("doc_id"))
    return t.withColumn("r", r).where("r <= 2").select("move", "doc_id", papers.short_excerpt(F.col("phrase"), 6).alias("excerpt"))


@query(
    f"SELECT doc_id, CAST({_W} AS BIGINT) AS words, CAST({_n('t', V.CITATION)} AS BIGINT) AS citations, CAST({_n('t', V.FIRST_PERSON)} AS BIGINT) AS first_person, CAST({_n('t', V.PASSIVE)} AS BIGINT) AS passive, floor(CAST({_n('t', V.PASSIVE)} AS DOUBLE) * 1000 / greatest({_W}, 1) * 100 + 0.5) / 100 AS density FROM (SELECT *, {_MOVE_TEXT} AS t FROM {PAPERS_SQL})"
)
def section_metrics(s, d):
    text = F.regexp_replace(F.concat_ws(" ", "phrase", "body"), r"[^\x00-\x7F\P{L}]", "x")
    n = lambda p: F.regexp_count(text, F.lit(p)).cast("long")
    w = T.word_count(F.col("body"))
    return table(s, d).select("doc_id", w.alias("words"), n(V.CITATION).alias("citations"), n(V.FIRST_PERSON).alias("first_person"), n(V.PASSIVE).alias("passive"), T.scaled(n(V.PASSIVE) * 1000, F.greatest(w, F.lit(1)), 2).alias("density"))


@query(f"SELECT journal, count(*) AS papers, floor(avg(CAST(contains(title, ':') AS INT)) * 1e4 + 0.5) / 1e4 AS colon_ratio, floor(sqrt(greatest(sum(n_chars * n_chars) / count(*) - (sum(n_chars) / count(*)) ** 2, 0)) + 0.5) AS sd FROM {PAPERS_SQL} GROUP BY journal")
def small_corpus(s, d):
    """Papers, share of titles with a colon and population deviation of length, by journal; sums are exact integers."""
    n = F.count("*")
    mean = F.sum("n_chars") / n
    sd = F.sqrt(F.greatest(F.sum(F.col("n_chars") * F.col("n_chars")) / n - mean * mean, F.lit(0.0)))
    return table(s, d).groupBy("journal").agg(n.alias("papers"), T.scaled(F.count_if(F.contains("title", F.lit(":"))), n).alias("colon_ratio"), F.floor(sd + 0.5).cast("double").alias("sd"))


_JK = "trim(regexp_replace(replace(lower(j), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
_J = "CASE WHEN doc_id % 5 = 0 THEN upper(journal) || ' & Co.' WHEN doc_id % 2 = 0 THEN journal || '  and co' ELSE journal || ' and Co' END"


@query(
    f"WITH k AS (SELECT j, {_JK} AS key FROM (SELECT {_J} AS j FROM {PAPERS_SQL})), v AS (SELECT key, j, count(*) AS n FROM k GROUP BY key, j) SELECT key, CAST(sum(n) AS BIGINT) AS papers, arg_max(j, n * 1000000 - ascii(j)) AS display FROM v GROUP BY key"
)
def journal_counts(s, d):
    """Journals by key with their commonest spelling; of equal counts the one of the lower first letter."""
    j = F.expr(_J)
    v = table(s, d).select(j.alias("j")).withColumn("key", papers.journal_key(F.col("j"))).groupBy("key", "j").agg(F.count("*").alias("n"))
    return v.groupBy("key").agg(F.sum("n").alias("papers"), F.max_by("j", F.struct("n", -F.ascii("j"))).alias("display"))


@query(f"SELECT doc_id, regexp_replace(trim(regexp_replace(t, '\\s+', ' ', 'g')), '\\.', '', 'g') AS plain FROM (SELECT doc_id, ' bold  ' || phrase || ' see   ' AS t FROM {PAPERS_SQL})")
def latex_text(s, d):
    made = F.concat(F.lit("\\textbf{bold} % a comment\n"), F.col("phrase"), F.lit(" see~\\cite{a,b}\\ref{x}"))
    plain = papers.latex_plain(F.translate(made, "~", " "))
    return table(s, d).select("doc_id", F.replace(plain, F.lit("."), F.lit("")).alias("plain"))


@query(
    f"SELECT doc_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(t, chr(92), chr(1)), '&', chr(92) || '&'), '%', chr(92) || '%'), '$', chr(92) || '$'), '#', chr(92) || '#'), '_', chr(92) || '_'), '{{', chr(92) || '{{'), '}}', chr(92) || '}}'), '~', chr(92) || 'textasciitilde{{}}'), '^', chr(92) || 'textasciicircum{{}}'), chr(1), chr(92) || 'textbackslash{{}}') AS tex FROM (SELECT doc_id, 'a_b' || chr(92) || '{{~^' || split_part(body, chr(10), 1) AS t FROM {PAPERS_SQL})"
)
def latex_escape(s, d):
    made = F.concat(F.lit("a_b\\{~^"), F.substring_index("body", "\n", 1))
    return table(s, d).select("doc_id", papers.latex_escape(made).alias("tex"))


@query(
    "SELECT page_id, lower(replace(replace(replace(replace(replace(replace(regexp_replace(h, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS cue FROM (SELECT page_id, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS h FROM pages)"
)
def cue_text(s, d):
    """Title text of pages for cues: tags removed, entities decoded, lower case."""
    h = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return read(s, d, "pages").select("page_id", F.lower(papers.unescaped(h)).alias("cue"))


@query("SELECT page_id, CAST(length(regexp_replace(html, '(?is)<script.*?</script>', '', 'g')) AS BIGINT) AS chars, regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[^A-Za-z0-9._-]+', '_', 'g') AS name FROM pages")
def pre_clean_and_safe_name(s, d):
    """Length of a page without its scripts, and a file name from its address."""
    clean = F.length(F.regexp_replace("html", r"(?is)<script.*?</script>", "")).cast("long")
    return read(s, d, "pages").select("page_id", clean.alias("chars"), F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[^A-Za-z0-9._-]+", "_").alias("name"))


@query("SELECT conv_id, md5(lower(string_agg(substr(text, 1, 1500), ' ' ORDER BY turn) FILTER (turn < 8))) AS h FROM conversations GROUP BY conv_id HAVING count(*) FILTER (turn < 8) > 0")
def record_excerpt(s, d):
    """The first eight sections of a record, 1,500 characters each."""
    t = read(s, d, "conversations").where("turn < 8").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.substring("text", 1, 1500).alias("x")))).alias("a"))
    return t.select("conv_id", F.md5(F.lower(F.array_join(F.transform("a", lambda x: x["x"]), " "))).alias("h"))


@query("SELECT doc_id, sha256('{\"doc\":' || doc_id || ',\"lang\":\"' || lang || '\",\"source\":\"' || source || '\"}') AS signature FROM documents")
def run_signature(s, d):
    """SHA-256 of a run's settings as JSON with sorted keys."""
    return read(s, d, "documents").select("doc_id", F.sha2(F.to_json(F.struct(F.col("doc_id").alias("doc"), "lang", "source")), 256).alias("signature"))


_ST = _at(["completed", "Done ", "pending", "in-progress", "", "broken", "READ", "queued"], "doc_id")


@query(f"SELECT doc_id, CASE WHEN lower(trim(st)) IN ({', '.join(repr(x) for x in V.COMPLETED)}) THEN 'completed' WHEN lower(trim(st)) IN ({', '.join(repr(x) for x in V.PENDING)}) THEN 'pending' ELSE 'invalid' END AS status FROM (SELECT doc_id, {_ST} AS st FROM documents)")
def reading_status(s, d):
    return read(s, d, "documents").select("doc_id", papers.status_name(F.expr(_ST)).alias("status"))

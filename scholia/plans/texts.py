"""Queries on the text of documents: fidelity, identifiers, Markdown, BibTeX and LaTeX, prose lint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholia.functions import text as T
from scholia.operators import fidelity, markdown
from scholia.operators.components import dealt
from scholia.sources.tables import read

QUERIES: dict = {}


def query(sql: str | None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


_LOSS = "CASE WHEN doc_id % 4 = 0 THEN substr(text, 1, CAST(floor(length(text) * 0.7) AS INT)) WHEN doc_id % 4 = 1 THEN substr(text, 1, greatest(length(text) - 400, 0)) ELSE text END"
_ID = "'see 10.1000/abc.' || {0} || '. It was 12.' || {0} || ' mm and 3 % [' || {0} || '] (Smith et al., 2019a) '"


def _pairs(docs: DataFrame) -> DataFrame:
    """A document and what a parser would keep of it: a quarter loses the end, a quarter the last 400 characters."""
    return docs.select("doc_id", F.col("text").alias("a"), F.expr(_LOSS).alias("b"))


def _dealt_words(s, d) -> DataFrame:
    """The words of both sides; documents are dealt before anything is made of them."""
    docs = dealt(read(s, d, "documents").select("doc_id", "text"), "doc_id")
    return _pairs(docs).select("doc_id", _words("a").alias("a"), _words("b").alias("b"))


_WORDS = "regexp_extract_all(lower({}), '[a-z0-9]+')"
_SIDES = (
    f"x AS (SELECT doc_id, {_WORDS.format('text')} AS a, {_WORDS.format(_LOSS)} AS b FROM documents), t AS (SELECT doc_id, 0 AS side, unnest(a) AS w FROM x UNION ALL SELECT doc_id, 1, unnest(b) FROM x UNION ALL SELECT doc_id, 2, unnest(a[-40:]) FROM x), "
    "c AS (SELECT doc_id, w, count(*) FILTER (side = 0) AS e, count(*) FILTER (side = 1) AS p, count(*) FILTER (side = 2) AS l FROM t GROUP BY doc_id, w), "
    "m AS (SELECT x.doc_id, coalesce(CAST(sum(e) AS BIGINT), 0) AS e, coalesce(CAST(sum(p) AS BIGINT), 0) AS p, coalesce(CAST(sum(l) AS BIGINT), 0) AS l, coalesce(CAST(sum(least(e, p)) AS BIGINT), 0) AS common, coalesce(CAST(sum(least(l, p)) AS BIGINT), 0) AS tail FROM x LEFT JOIN c ON c.doc_id = x.doc_id GROUP BY x.doc_id)"
)


def _words(c: str):
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


@query(f"WITH {_SIDES} SELECT doc_id, e AS n_expected, p AS n_actual, common, CASE WHEN e + p = 0 THEN 1.0::DOUBLE ELSE floor(2 * common / (e + p) * 1e6 + 0.5) / 1e6 END AS f1 FROM m")
def token_f1(s, d):
    o = fidelity.overlaps(_dealt_words(s, d), "doc_id", "a", "b")
    total = F.col("n_expected") + F.col("n_actual")
    return o.select("doc_id", "n_expected", "n_actual", "common", F.when(total == 0, F.lit(1.0)).otherwise(T.scaled(2 * F.col("common"), total, 6)).alias("f1"))


@query(f"WITH {_SIDES} SELECT doc_id, p = 0 OR p / greatest(e, 1) < 0.75 OR (l > 0 AND tail / l < 0.25 AND common / greatest(e, 1) < 0.85) AS truncated FROM m")
def truncation_flags(s, d):
    """No words, too few of them, or the last forty lost along with more than 15 percent of all."""
    rows = _dealt_words(s, d)
    o = fidelity.overlaps(rows.withColumn("tail", F.slice("a", F.greatest(F.size("a") - 39, F.lit(1)), 40)), "doc_id", "a", "b", "tail")
    e, p = F.greatest("n_expected", F.lit(1)), F.col("n_actual")
    lost = (F.col("n_tail") > 0) & (F.col("common_tail") / F.greatest("n_tail", F.lit(1)) < 0.25) & (F.col("common") / e < 0.85)
    return o.select("doc_id", ((p == 0) | (p / e < 0.75) | lost).alias("truncated"))


_GRAM = "CASE WHEN length({0}) = 0 THEN [] WHEN length({0}) <= 3 THEN [{0}] ELSE list_transform(range(1, length({0}) - 1), lambda i: substr({0}, i, 3)) END"


@query(f"WITH x AS (SELECT item_id, lower(text) AS a, lower(regexp_replace(text, '[aeiou]{{2}}', '', 'g')) AS b FROM benchmark), t AS (SELECT item_id, 0 AS side, unnest({_GRAM.format('a')}) AS g FROM x UNION ALL SELECT item_id, 1, unnest({_GRAM.format('b')}) FROM x), c AS (SELECT item_id, g, count(*) FILTER (side = 0) AS e, count(*) FILTER (side = 1) AS p FROM t GROUP BY item_id, g) SELECT item_id, CAST(sum(e) AS BIGINT) AS n_expected, CAST(sum(p) AS BIGINT) AS n_actual, CAST(sum(least(e, p)) AS BIGINT) AS common FROM c GROUP BY item_id")
def trigram_f1(s, d):
    t = dealt(read(s, d, "benchmark"), "item_id").select("item_id", F.lower("text").alias("a"), F.lower(F.regexp_replace("text", "[aeiou]{2}", "")).alias("b"))
    return fidelity.overlaps(t.select("item_id", fidelity.ngrams(F.col("a")).alias("a"), fidelity.ngrams(F.col("b")).alias("b")), "item_id", "a", "b")


_IDENT = "split_part(text, chr(10), 1) || ' ' || " + _ID.format("CAST(doc_id AS VARCHAR)")


def _identified(s, d) -> DataFrame:
    return read(s, d, "documents").select("doc_id", F.expr("split_part(text, '\n', 1) || ' ' || " + _ID.format("CAST(doc_id AS STRING)")).alias("t"))


@query(f"SELECT doc_id, array_to_string(list_transform(regexp_extract_all(t, '(?i)10\\.\\d{{4,9}}/[-._;()/:A-Z0-9]+'), lambda x: rtrim(lower(x), '.,;:)]}}')), ' ') AS dois, len(regexp_extract_all(t, '\\[\\d+(?:\\s*[-,;]\\s*\\d+)*\\]|\\([A-Z][A-Za-z-]+(?:\\s+et\\s+al\\.)?,?\\s+\\d{{4}}[a-z]?\\s*\\)')) AS citations, array_to_string(regexp_extract_all(t, '\\d+(?:\\.\\d+)?\\s*(?:mm|cm|%)'), ';') AS measures FROM (SELECT doc_id, {_IDENT} AS t FROM documents)")
def identifier_groups(s, d):
    """DOIs, citations and measures of a text."""
    found = lambda p: F.regexp_extract_all("t", F.lit(p), F.lit(0))
    dois = F.transform(found(r"(?i)10\.\d{4,9}/[-._;()/:A-Z0-9]+"), lambda x: F.regexp_replace(F.lower(x), r"[.,;:)\]}]+$", ""))
    cited = F.size(found(r"\[\d+(?:\s*[-,;]\s*\d+)*\]|\([A-Z][A-Za-z-]+(?:\s+et\s+al\.)?,?\s+\d{4}[a-z]?\s*\)")).cast("long")
    return _identified(s, d).select("doc_id", F.array_join(dois, " ").alias("dois"), cited.alias("citations"), F.array_join(found(r"\d+(?:\.\d+)?\s*(?:mm|cm|%)"), ";").alias("measures"))


_CUT = "SELECT doc_id % 100 AS g, '10.1000/ab' || repeat('x', CAST(doc_id % 7 AS INT)) || CASE WHEN doc_id % 2 = 0 THEN '.' || doc_id % 30 ELSE '' END AS e, '10.1000/ab' || repeat('x', CAST(doc_id % 5 AS INT)) AS p FROM documents"


@query(f"WITH x AS ({_CUT}), e AS (SELECT DISTINCT g, e FROM x WHERE (g, e) NOT IN (SELECT g, p FROM x)), p AS (SELECT DISTINCT g, p FROM x WHERE (g, p) NOT IN (SELECT g, e FROM x)) SELECT p.g, p.p AS predicted, min(e.e) AS expected FROM p JOIN e ON e.g = p.g AND (starts_with(e.e, p.p) OR starts_with(p.p, e.e)) GROUP BY p.g, p.p")
def truncated_dois(s, d):
    """Unmatched predicted DOIs with the first unmatched expected one that is their beginning, or whose beginning they are."""
    x = read(s, d, "documents").selectExpr(*[f"{e} AS {n}" for e, n in (("doc_id % 100", "g"), ("'10.1000/ab' || repeat('x', CAST(doc_id % 7 AS INT)) || CASE WHEN doc_id % 2 = 0 THEN '.' || CAST(doc_id % 30 AS STRING) ELSE '' END", "e"), ("'10.1000/ab' || repeat('x', CAST(doc_id % 5 AS INT))", "p"))])
    e, p = x.select("g", "e").distinct(), x.select("g", "p").distinct()
    missing = e.join(p.withColumnRenamed("p", "e"), ["g", "e"], "left_anti")
    extra = p.join(e.withColumnRenamed("e", "p"), ["g", "p"], "left_anti")
    starts = lambda c: F.explode(F.transform(F.sequence(F.lit(1), F.length(c)), lambda n: F.substring(c, 1, n)))
    # each side meets the other at the equal beginning, so groups aren't crossed
    longer = missing.where(F.length("e") > 0).select("g", "e", starts("e").alias("p")).join(extra, ["g", "p"]).select("g", "p", "e")
    shorter = extra.where(F.length("p") > 0).select("g", "p", starts("p").alias("e")).join(missing, ["g", "e"]).select("g", "p", "e")
    return longer.unionByName(shorter).groupBy("g", F.col("p").alias("predicted")).agg(F.min("e").alias("expected"))


@query(None)
def document_fidelity(s, d):
    """The 80-point score of each document against what a parser would keep of it; lines of few words are headings."""
    heads = lambda c: F.filter(F.split(c, "\n"), lambda x: (F.length(x) > 0) & (F.length(x) < 40))
    none = F.array().cast("array<string>")
    doc = lambda c, more: F.struct(F.col(c).alias("body"), heads(F.col(c)).alias("headings"), more.alias("tables"), none.alias("formulas"), none.alias("captions"))
    lines = lambda c: F.filter(F.split(c, "\n"), lambda x: F.contains(x, F.lit("|")))
    p = _pairs(read(s, d, "documents"))
    return fidelity.scores(p.select("doc_id", doc("a", lines(F.col("a"))).alias("expected"), doc("b", lines(F.col("b"))).alias("actual")), "doc_id")


def _markdown(s, d) -> DataFrame:
    """Documents as Markdown: each line a paragraph, some of them headings, tables, formulas or captions."""
    kind = lambda x, i: F.when(i % 11 == 0, F.concat(F.lit("## "), F.substring(x, 1, 30))).when(i % 13 == 5, F.concat(F.lit("| a | "), x, F.lit(" |\n| - | - |"))).when(i % 17 == 7, F.lit("$$\nx = 1\n$$")).when(i % 19 == 3, F.concat(F.lit("Figure 1. "), x)).otherwise(x)
    return read(s, d, "documents").select("doc_id", F.array_join(F.transform(F.split("text", "\n"), kind), "\n\n").alias("md"), (F.col("doc_id") % 12).cast("int").alias("pages"))


def _blocks(s, d) -> DataFrame:
    return _markdown(s, d).withColumn("found", markdown.blocks(F.col("md")))


@query(None)
def markdown_blocks(s, d):
    """One row for each block of each document."""
    rows = _blocks(s, d).select("doc_id", F.posexplode("found.blocks").alias("ord", "b"))
    return rows.select("doc_id", "ord", "b.kind", "b.first_line", "b.last_line", "b.level", F.length("b.text").alias("chars"))


@query(None)
def markdown_gate(s, d):
    """Reasons to hold each document back, joined by ';'."""
    return _blocks(s, d).select("doc_id", F.array_join(markdown.gate(F.col("md"), F.col("found"), F.col("pages")), ";").alias("reasons"))


@query("SELECT kind, count(*) AS n FROM (SELECT unnest(list_transform(l, lambda x, i: CASE WHEN (i - 1) % 11 = 0 THEN 'heading' WHEN (i - 1) % 13 = 5 THEN 'markdown_table' WHEN (i - 1) % 17 = 7 THEN 'display_math' WHEN (i - 1) % 19 = 3 THEN 'caption' WHEN trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) = '' THEN 'none' ELSE 'text' END)) AS kind FROM (SELECT string_split(text, chr(10)) AS l FROM documents)) WHERE kind <> 'none' GROUP BY kind")
def markdown_kinds(s, d):
    """How many blocks of each kind the documents have as Markdown."""
    return markdown_blocks(s, d).groupBy("kind").agg(F.count("*").alias("n"))


_BIB = "'@article{{k' || {0} || ',' || chr(10) || '  title = {{' || split_part(text, chr(10), 1) || '}},' || chr(10) || '  year={{' || (1990 + {0} % 30) || '}}' || chr(10) || '}}' || chr(10) || '@book{{b' || {0} || ',' || chr(10) || ' title = \"T ' || {0} || '\"' || chr(10) || '}}'"


@query("SELECT doc_id, 'k' || doc_id AS key, 'article' AS kind, split_part(text, chr(10), 1) AS title, CAST(1990 + doc_id % 30 AS INT) AS year FROM documents UNION ALL SELECT doc_id, 'b' || doc_id, 'book', 'T ' || doc_id, NULL FROM documents")
def bibtex_entries(s, d):
    """Entries of a BibTeX file: an entry begins at '@' and ends before the next; fields are read from its lines."""
    made = F.concat(
        F.lit("@article{k"), F.col("doc_id"), F.lit(",\n  title = {"), F.substring_index("text", "\n", 1), F.lit("},\n  year={"), (1990 + F.col("doc_id") % 30).cast("int"), F.lit("}\n}\n@book{b"), F.col("doc_id"), F.lit(",\n title = \"T "), F.col("doc_id"), F.lit('"\n}'),
    )
    entry = read(s, d, "documents").select("doc_id", F.explode(F.split(made, r"(?m)^(?=@\w+\{)")).alias("e")).where("e <> ''")
    field = lambda name: F.regexp_extract("e", rf'(?m)^\s*{name}\s*=\s*[{{"](.*)[}}"],?\s*$', 1)
    return entry.select("doc_id", F.regexp_extract("e", r"^@\w+\{([^,\s]+)", 1).alias("key"), F.regexp_extract("e", r"^@(\w+)\{", 1).alias("kind"), field("title").alias("title"), F.nullif(field("year"), F.lit("")).try_cast("int").alias("year"))


@query("SELECT conv_id, turn, unnest(['r' || conv_id, 'r' || (turn + 1)]) AS cite, CASE WHEN turn % 2 = 0 THEN 'c' || turn END AS claim FROM conversations WHERE role = 'user'")
def latex_citations(s, d):
    """Citations of LaTeX lines, with the claim that one of the two next lines names."""
    t = read(s, d, "conversations").where("role = 'user'")
    text = F.concat(F.lit("As \\cite{r"), F.col("conv_id"), F.lit(", r"), F.col("turn") + 1, F.lit("} says.\n\n% CLAIMS: "), F.when(F.col("turn") % 2 == 0, F.concat(F.lit("c"), F.col("turn"))).otherwise(""))
    lines = t.select("conv_id", "turn", F.split(text, "\n").alias("l"))
    claim = F.nullif(F.regexp_extract(F.array_join(F.slice("l", 2, 2), "\n"), r"% CLAIMS:\s*(\w+)", 1), F.lit(""))
    cites = F.flatten(F.transform(F.regexp_extract_all(F.get("l", 0), F.lit(r"\\cite\{([^}]*)\}"), F.lit(1)), lambda x: F.split(x, r",\s*")))
    return lines.select("conv_id", "turn", F.explode(cites).alias("cite"), claim.alias("claim"))


_LINT = r"""(SELECT doc_id, text || ' It was significant; really. Significant at p < 0.05; yes; no. ' || repeat('a — b ', CAST(doc_id % 6 AS INT)) AS t FROM documents)"""
_SENT = r"list_filter(string_split(regexp_replace(t, '([.!?])\s+([A-Z0-9])', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s: len(regexp_extract_all(s, '[A-Za-z]+(?:[-''][A-Za-z]+)?')) >= 4)"


@query(
    f"SELECT doc_id, len(string_split(t, '—')) - 1 > 3 AS em_dash, len(string_split(t, ';')) - 1 > greatest(2, round_even(len(regexp_extract_all(t, '[A-Za-z]+(?:[-''][A-Za-z]+)?')) / 500, 0)) AS semicolons, len(list_filter({_SENT}, lambda s: regexp_matches(s, '(?i)significant(?:ly)?') AND NOT regexp_matches(s, '(?i)p\\s*[<=>]|confidence interval|effect size|statistical'))) AS significant FROM {_LINT}"
)
def prose_lint(s, d):
    """Em dashes, semicolon density, and 'significant' without its statistic."""
    t = read(s, d, "documents").select("doc_id", F.expr("text || ' It was significant; really. Significant at p < 0.05; yes; no. ' || repeat('a — b ', CAST(doc_id % 6 AS INT))").alias("t"))
    n = lambda c: F.size(F.split("t", c)) - 1
    bare = F.filter(T.sentences(F.col("t")), lambda x: F.regexp_like(x, F.lit("(?i)significant(?:ly)?")) & ~F.regexp_like(x, F.lit(r"(?i)p\s*[<=>]|confidence interval|effect size|statistical")))
    return t.select("doc_id", (n("—") > 3).alias("em_dash"), (n(";") > F.greatest(F.lit(2.0), F.bround(T.word_count(F.col("t")) / 500, 0))).alias("semicolons"), F.size(bare).cast("long").alias("significant"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_-]+')) AS BIGINT) AS words FROM documents")
def unicode_words(s, d):
    return read(s, d, "documents").select("doc_id", F.regexp_count("text", F.lit(r"[\p{L}\p{N}_-]+")).cast("long").alias("words"))


@query("SELECT doc_id, array_to_string(w[greatest(p - 4, 1) : p - 1], ' ') || ' [' || w[p] || '] ' || array_to_string(w[p + 1 : p + 4], ' ') || CASE WHEN len(w) > p + 4 THEN ' …' ELSE '' END AS snippet FROM (SELECT doc_id, w, list_position(list_transform(w, lambda x: lower(x)), 'the') AS p FROM (SELECT doc_id, regexp_extract_all(text, '\\S+') AS w FROM documents)) WHERE p > 0")
def snippets(s, d):
    """The first hit in brackets, with four words before and after."""
    t = read(s, d, "documents").select("doc_id", F.regexp_extract_all("text", F.lit(r"[^ \t\n\f\r]+"), F.lit(0)).alias("w"))
    p = F.array_position(F.transform("w", lambda x: F.lower(x)), "the").cast("int")
    t = t.withColumn("p", p).where("p > 0")
    before = F.slice("w", F.greatest(F.col("p") - 4, F.lit(1)), F.col("p") - F.greatest(F.col("p") - 4, F.lit(1)))
    after = F.slice("w", F.col("p") + 1, F.lit(4))
    return t.select("doc_id", F.concat(F.array_join(before, " "), F.lit(" ["), F.element_at("w", F.col("p")), F.lit("] "), F.array_join(after, " "), F.when(F.size("w") > F.col("p") + 4, " …").otherwise("")).alias("snippet"))


@query("SELECT doc_id, CAST(sum(CASE WHEN words < 4 AND prev >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS sections FROM (SELECT doc_id, words, lag(words, 1, 4) OVER (PARTITION BY doc_id ORDER BY ord) AS prev FROM (SELECT doc_id, ord, len(regexp_extract_all(line, '[A-Za-z]+(?:[-''][A-Za-z]+)?')) AS words FROM (SELECT doc_id, unnest(range(1, len(l) + 1)) AS ord, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)))) GROUP BY doc_id")
def heading_sections(s, d):
    """Sections of a plain text: a line of under four words begins one, unless the line before does."""
    n = F.transform(F.split("text", "\n"), lambda x: F.regexp_count(x, F.lit(T.ASCII_WORD)))
    begins = F.filter(F.zip_with(n, F.concat(F.array(F.lit(4)), F.slice(n, 1, F.size(n) - 1)), lambda x, b: (x < 4) & (b >= 4)), lambda x: x)
    return read(s, d, "documents").select("doc_id", F.size(begins).cast("long").alias("sections"))

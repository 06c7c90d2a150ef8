"""Papers as rows: scores, sections, kinds, features, exclusions, writing moves, benchmark strata."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholia.functions import patterns as V
from scholia.functions import text as T


def any_of(text: Column, cues: Iterable[str]) -> Column:
    """Whether a text holds one of the cues."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in cues])


def hits(text: Column, cues: Iterable[str]) -> Column:
    """How many of the cues a text holds."""
    return reduce(lambda a, b: a + b, [F.contains(text, F.lit(c)).cast("long") for c in cues])


def candidate_score(n_strata: Column, abstract: Column, doi: Column, year: Column, kind: Column, cites: Column) -> Column:
    """Score of a candidate, to three digits; missing values count nothing."""
    low = F.lower(F.coalesce(kind, F.lit("")))
    has = lambda c: F.when(T.nz(c).isNotNull(), 1).otherwise(0)
    recent = F.when(year >= 2020, 4).when(year >= 2010, 2).otherwise(0)
    typed = F.when(any_of(low, ["research", "journal article"]), 3).otherwise(0) + F.when(F.contains(low, F.lit("review")), 1).otherwise(0)
    cited = F.least(F.log1p(F.greatest(F.coalesce(cites, F.lit(0)), F.lit(0)).cast("double")), F.lit(7.0))
    return T.scaled(n_strata * 12 + has(abstract) * 4 + has(doi) * 2 + recent + typed + cited, F.lit(1), 3)


def section_type(heading: Column, sec_type: Column) -> Column:
    """Type of a section: an explicit type first, else the first listed name that the heading is or begins with."""
    name = F.regexp_replace(F.btrim(F.lower(T.compact(F.coalesce(heading, F.lit("")))), F.lit(" .:")), r"^\d+(?:\.\d+)*\.?\s*", "")
    given = F.lower(F.coalesce(sec_type, F.lit("")))

    def named(x: Column) -> Column:
        name, given = x["name"], x["given"]
        out = F.when(given.isin("intro", "introduction"), "introduction").when(given.isin("methods", "materials|methods", "method"), "methods")
        out = out.when(given == "conclusions", "conclusion").when(given.isin("results", "discussion", "conclusion"), given).when(given.isin("references", "ref-list"), "references")
        for key, kind in V.SECTION_TYPES.items():
            out = out.when((name == key) | F.startswith(name, F.lit(key + " ")), kind)
        return out.otherwise("other")

    # the heading is brought to its form once, not for each name
    return T.let(F.struct(name.alias("name"), given.alias("given")), named)


def _matches(pattern: str):
    return lambda h: F.regexp_like(F.lower(h), F.lit(pattern))


def article_kind(title: Column, kind: Column, headings: Column) -> Column:
    """First kind with a cue as whole words in title or type, or at the start of a heading behind its number; then by type."""
    both = F.concat_ws(" ", F.lower(title), F.lower(kind))
    escaped = {k: "|".join(c.replace("-", r"\-") for c in cues) for k, cues in V.KINDS.items()}
    out = None
    for k, cues in escaped.items():
        head = rf"^\s*(?:\d+(?:\.\d+)*\.?\s+)?(?:{cues})\b"
        inside = F.exists(headings, _matches(head))
        found = F.regexp_like(both, F.lit(rf"\b(?:{cues})\b")) | inside
        out = F.when(found, k) if out is None else out.when(found, k)
    low = F.lower(F.coalesce(kind, F.lit("")))
    out = out.when(F.contains(low, F.lit("case report")), "case_report").when(any_of(low, ["research", "journal article", "clinical trial"]), "original_research")
    return out.when(any_of(low, ["method", "protocol"]), "protocol").otherwise("other_substantive")


def design_features(text: Column, section_types: Column) -> Column:
    """Features whose cues occur as raw substrings, in order; a paper with methods and results and a computational cue is a modelling one; else unclassified."""

    def named(low: Column) -> Column:
        found = [F.when(any_of(low, cues), F.lit(k)) for k, cues in V.FEATURES.items()]
        both = F.array_contains(section_types, "methods") & F.array_contains(section_types, "results") & any_of(low, V.FEATURES["finite_element_or_computational"])
        return F.array_compact(F.array(*found, F.when(both, F.lit("methods_results_modeling"))))

    # the text is made and lowered once, not for each cue
    out = T.let(F.lower(text), named)
    return T.let(out, lambda x: F.when(F.size(x) == 0, F.array(F.lit("unclassified"))).otherwise(x))


def exclusion_reasons(title: Column, kind: Column, body_words: Column, abstract_words: Column) -> Column:
    """Why a paper is left out, in order and without repeats."""
    both = F.concat_ws(" ", F.lower(title), F.lower(kind))
    low = F.lower(F.coalesce(kind, F.lit("")))
    reasons = [
        F.when(any_of(both, V.CORRECTION), "correction"), F.when(any_of(both, V.RETRACTION), "retraction"), F.when(any_of(both, V.EDITORIAL), "editorial"),
        F.when((body_words == 0) & (abstract_words == 0), "zero_content"), F.when((body_words == 0) | any_of(low, V.NON_SUBSTANTIVE), "non_substantive"),
    ]
    return F.array_distinct(F.array_compact(F.array(*reasons)))


def move_counts(text: Column) -> dict[str, Column]:
    return {k: reduce(lambda a, b: a + b, [F.regexp_count(text, F.lit("(?i)" + p)) for p in ps]).cast("long") for k, ps in V.MOVES.items()}


def move_sequence(text: Column) -> Column:
    """Moves in order of their first place, ties by name."""
    at = lambda ps: F.array_min(F.filter(F.array(*[F.regexp_instr(text, F.lit("(?i)" + p)) for p in ps]), lambda x: x > 0))
    found = [F.when(at(ps).isNotNull(), F.struct(at(ps).alias("at"), F.lit(k).alias("name"))) for k, ps in V.MOVES.items()]
    return F.transform(F.array_sort(F.array_compact(F.array(*found))), lambda x: x["name"])


def has_move(sentence: Column, name: str) -> Column:
    return reduce(lambda a, b: a | b, [F.regexp_like(sentence, F.lit("(?i)" + p)) for p in V.MOVES[name]])


def short_excerpt(sentence: Column, words: int = 18) -> Column:
    """First words of a sentence, with an ellipsis if there are more."""
    parts = F.regexp_extract_all(sentence, F.lit(r"\S+"), F.lit(0))
    return F.concat(F.array_join(F.slice(parts, 1, words), " "), F.when(F.size(parts) > words, " …").otherwise(""))


def stratum_scores(c: dict[str, Column]) -> Column:
    """Benchmark strata of a candidate: array of (stratum, score to four digits, qualifies).

    `c` has year, pages, density, fonts, images, scanned, formulas, tables, figures and text (lower-case).
    """
    pages = F.greatest(F.coalesce(c["pages"], F.lit(0)), F.lit(1))
    formula, table, figure = (hits(c["text"], V.KEYWORDS[k]) for k in ("formula", "table", "figure"))
    shots = c["images"] / pages
    scanned = c["scanned"].cast("int")
    layout = scanned * 120 + F.greatest(F.lit(0.0), 900.0 - c["density"]) / 12 + (c["fonts"] <= 1).cast("int") * 25 + F.least(shots, F.lit(5.0)) * 3 + F.greatest(F.lit(0), 2018 - c["year"]) * 0.7
    standard = F.least(c["density"], F.lit(3000.0)) / 70 + F.least(c["fonts"], F.lit(12)) - scanned * 35 - F.abs(pages - 12) * 0.15
    rough = c["scanned"] | (c["density"] < 3500) | (pages >= 20) | (c["fonts"] >= 15) | (shots >= 15) | ((c["year"] > 0) & (c["year"] < 2012))
    one = lambda name, score, ok: F.struct(F.lit(name).alias("stratum"), T.scaled(score, F.lit(1), 4).alias("score"), ok.alias("qualifies"))
    return F.array(
        one("layout_stress", layout, rough), one("formula_fe_topology", c["formulas"] * 3.0 + formula * 25, (c["formulas"] >= 4) | (formula > 0)),
        one("table_review_clinical", c["tables"] * 4.0 + table * 20, (c["tables"] >= 3) | (table > 0)),
        one("figure_am_biomaterial", c["figures"] * 2.0 + figure * 18, (c["figures"] >= 4) | (figure > 0)), one("standard_born_digital", standard, ~c["scanned"]),
    )


def journal_key(name: Column) -> Column:
    """Lower case, '&' as 'and', all but word characters as one space."""
    return F.trim(F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit(" and ")), r"[^a-z0-9]+", " "))


def latex_plain(text: Column) -> Column:
    """LaTeX without comments, commands and braces."""
    out = F.regexp_replace(text, r"(?m)(^|[^\\])%.*$", "$1")
    out = F.regexp_replace(out, r"\\(?:cite|ref|label)[a-z]*\{[^}]*\}", " ")
    out = F.regexp_replace(out, r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?", " ")
    return T.compact(F.translate(out, "{}", "  "))


def latex_escape(text: Column) -> Column:
    """The ten special characters of LaTeX, escaped; a backslash first, by a stand-in."""
    out = F.replace(text, F.lit("\\"), F.lit("\x01"))
    for c in "&%$#_{}":
        out = F.replace(out, F.lit(c), F.lit("\\" + c))
    for c, name in (("~", "\\textasciitilde{}"), ("^", "\\textasciicircum{}"), ("\x01", "\\textbackslash{}")):
        out = F.replace(out, F.lit(c), F.lit(name))
    return out


def unescaped(html: Column) -> Column:
    """Text without tags; the five basic entities and the hard space decoded, the ampersand last."""
    out = F.regexp_replace(html, "<[^>]*>", " ")
    for name, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(c))
    return out


def status_name(status: Column) -> Column:
    """Reading status: completed, pending or invalid, from its synonyms."""
    low = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    return F.when(low.isin(*V.COMPLETED), "completed").when(low.isin(*V.PENDING), "pending").otherwise("invalid")

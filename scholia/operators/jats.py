"""Records of JATS articles: front matter by Spark's XML parser, the section tree by folds over its marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholia.functions import text as T

from .papers import section_type

#: What is read of an article; the body stays markup, since text and inline tags alternate in it.
ARTICLE = """
front struct<
  `journal-meta`: struct<`journal-title-group`: struct<`journal-title`: string>, `journal-title`: string>,
  `article-meta`: struct<
    `article-id`: array<struct<`_pub-id-type`: string, _VALUE: string>>,
    `title-group`: struct<`article-title`: string>,
    `pub-date`: array<struct<year: string>>,
    permissions: struct<license: array<struct<`_xlink:href`: string, `_href`: string, `license-p`: array<string>, p: array<string>>>>,
    abstract: array<string>>>,
body string
"""
MARK = r"</?(?:sec|ref-list)(?:\s[^>]*)?>"
#: A section's own title, behind its label and metadata.
HEAD = r"(?s)^((?:\s*<(label|sec-meta)(?:\s[^>]*)?>.*?</\2>)*)\s*<title(?:\s[^>]*)?>(.*?)</title>"
SECTIONS = "array<struct<ordinal int, depth int, heading string, section_type string, text string, words long>>"


def guarded(xml: Column) -> Column:
    """The same XML whose character data still has its `&lt;`, `&gt;` and `&amp;` once it is parsed.

    The parser gives elements with tags inside as text in which these would be decoded; sections
    marked CDATA become ordinary text, comments go.
    """
    parts = F.split(F.regexp_replace(xml, r"(?s)<!--.*?-->", ""), r"<!\[CDATA\[|\]\]>")
    raw = lambda p: F.replace(F.replace(F.replace(p, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    whole = F.array_join(F.transform(parts, lambda p, k: F.when(k % 2 == 1, raw(p)).otherwise(p)), "")
    return F.regexp_replace(whole, r"&(lt|gt|amp|#60|#62|#38|#x3[cCeE]|#x26);", "&amp;$1;")


def plain(markup: Column) -> Column:
    """Text of markup: tags part words, white space is one space, the guarded references are decoded."""
    out = F.regexp_replace(markup, r"<[^>]*>", " ")
    for name, c in ((r"&(?:lt|#60|#x3[cC]);", "<"), (r"&(?:gt|#62|#x3[eE]);", ">"), (r"&(?:amp|#38|#x26);", "&")):
        out = F.regexp_replace(out, name, c)
    return T.compact(F.coalesce(out, F.lit("")))


def article(xml: Column) -> Column:
    """The parsed article; null fields where something is missing or the XML is broken."""
    return F.from_xml(guarded(xml), ARTICLE, {"mode": "PERMISSIVE", "ignoreNamespace": "false"})


def front(parsed: Column) -> list[Column]:
    """title, journal, doi, pmid, pmcid, year, license, license_url and abstract; '' or null for what is missing."""
    meta, journal = parsed["front"]["article-meta"], parsed["front"]["journal-meta"]
    by_kind = lambda kind: T.nz(F.element_at(F.filter(meta["article-id"], lambda i: i["_pub-id-type"] == kind), -1)["_VALUE"])
    known = lambda kind: F.when(F.size(F.filter(meta["article-id"], lambda i: i["_pub-id-type"] == kind)) > 0, by_kind(kind))
    license_ = F.get(meta["permissions"]["license"], F.lit(0))
    return [
        plain(meta["title-group"]["article-title"]).alias("title"),
        plain(F.coalesce(journal["journal-title-group"]["journal-title"], journal["journal-title"])).alias("journal"),
        T.doi(known("doi")).alias("doi"), known("pmid").alias("pmid"), F.upper(known("pmc")).alias("pmcid"),
        F.get(meta["pub-date"], F.lit(0))["year"].try_cast("int").alias("year"),
        plain(F.array_join(F.concat(F.coalesce(license_["license-p"], F.array()), F.coalesce(license_["p"], F.array())), " ")).alias("license"),
        F.coalesce(license_["_xlink:href"], license_["_href"], F.lit("")).alias("license_url"),
        plain(F.get(meta["abstract"], F.lit(0))).alias("abstract"),
    ]


def _places(marks: Column) -> Column:
    """For the text behind each mark the number of its section, and for the mark of a section its parent and depth.

    A stack of open sections goes along; lists of references, and sections in them, are 0.
    """
    start = F.from_json(F.lit('{"stack": [], "n": 0, "places": ""}'), "struct<stack array<int>, n int, places string>")
    top = lambda stack: F.when(F.size(stack) > 0, F.element_at(stack, -1)).otherwise(-1)

    def step(s: Column, mark: Column) -> Column:
        closing = F.startswith(mark, F.lit("</"))
        section = ~closing & F.startswith(mark, F.lit("<sec")) & ~F.array_contains(s["stack"], 0)
        number = F.when(section, s["n"] + 1).otherwise(0)
        stack = F.when(closing, F.slice(s["stack"], 1, F.greatest(F.size(s["stack"]) - 1, F.lit(0)))).otherwise(F.concat(s["stack"], F.array(number)))
        place = F.when(section, F.concat_ws(" ", number, top(s["stack"]), F.size(s["stack"]) + 1)).otherwise(F.when(closing, top(stack)).otherwise(number).cast("string"))
        return F.struct(stack.alias("stack"), F.when(section, s["n"] + 1).otherwise(s["n"]).alias("n"), F.concat(s["places"], place, F.lit(",")).alias("places"))

    # the state is copied at each step, as one string far faster than as an array
    found = F.transform(F.split(F.rtrim(F.aggregate(marks, start, step)["places"], F.lit(",")), ","), lambda p: F.split(p, " "))
    number = lambda p, k: F.get(p, F.lit(k)).try_cast("int")
    return F.transform(found, lambda p: F.struct(number(p, 0).alias("owner"), number(p, 1).alias("parent"), number(p, 2).alias("depth")))


def _typed(found: Column) -> Column:
    """Sections that are kept, in order: those not of references nor below them, with text.

    A section of type other has the type of the one above it, if that has one.
    """

    def kind(types: Column, x: Column) -> Column:
        above = F.when(x["parent"] > 0, F.element_at(types, F.greatest(x["parent"], F.lit(1)))).otherwise("")
        return T.let(above, lambda a: F.when(a == "references", a).when((x["own"] == "other") & ~a.isin("", "other"), a).otherwise(x["own"]))

    def row(x: Column, k: Column) -> Column:
        heading = F.when(x["heading"] == "", F.concat(F.lit("Untitled section "), (k + 1).cast("string"))).otherwise(x["heading"])
        return F.struct((k + 1).alias("ordinal"), x["depth"].alias("depth"), heading.alias("heading"), x["kind"].alias("section_type"), x["text"].alias("text"), T.word_count(x["text"]).alias("words"))

    # only types go along the fold: what its state holds is copied at each step
    types = F.aggregate(found, F.array().cast("array<string>"), lambda types, x: F.concat(types, F.array(kind(types, x))))
    named = F.zip_with(found, types, lambda x, kind: F.struct(x["depth"].alias("depth"), x["heading"].alias("heading"), x["text"].alias("text"), kind.alias("kind")))
    return F.transform(F.filter(named, lambda x: (x["kind"] != "references") & (x["text"] != "")), row).cast(SECTIONS)


def sections(body: Column) -> Column:
    """The sections of a body with their inherited types: array of ordinal, depth, heading, section_type, text, words.

    Trees of any depth: the marks of sections are numbered by one fold, types go down by another. The
    text of a section is that of its elements but title, sections and lists of references. Sections
    of references, and all below them, are left out, as are those without text. A body without
    sections is one section of type other; a null or blank body has none.
    """

    def read(x: Column, more: Column) -> Column:
        """A section from the text behind its mark, and what follows behind sections and lists in it."""
        heading = plain(F.regexp_extract(x["text"], HEAD, 3))
        given = F.regexp_extract(x["mark"], r"""\ssec-type\s*=\s*["']([^"']*)["']""", 1)
        text = plain(F.concat_ws(" ", F.regexp_replace(x["text"], HEAD, "$1"), F.transform(F.filter(more, lambda p: p["owner"] == x["owner"]), lambda p: p["text"])))
        return F.struct(x["parent"].alias("parent"), x["depth"].alias("depth"), heading.alias("heading"), given.alias("given"), text.alias("text"))

    def built(pieces: Column) -> Column:
        opens = F.filter(pieces, lambda p: p["depth"].isNotNull())
        more = F.filter(pieces, lambda p: p["depth"].isNull() & (p["owner"] > 0) & F.regexp_like(p["text"], F.lit(r"\S")))
        found = T.let(more, lambda more: F.transform(opens, lambda x: read(x, more)))
        return F.transform(found, lambda x: F.struct(x["parent"].alias("parent"), x["depth"].alias("depth"), x["heading"].alias("heading"), x["text"].alias("text"), section_type(x["heading"], x["given"]).alias("own")))

    def alone(whole: Column) -> Column:
        row = F.struct(F.lit(1).alias("ordinal"), F.lit(1).alias("depth"), F.lit("Body").alias("heading"), F.lit("other").alias("section_type"), whole.alias("text"), T.word_count(whole).alias("words"))
        return F.when(whole == "", F.array().cast(SECTIONS)).otherwise(F.array(row).cast(SECTIONS))

    def split(marks: Column) -> Column:
        texts = F.split(body, MARK, -1)
        pieces = T.let(texts, lambda texts: F.transform(_places(marks), lambda p, k: F.struct(p["owner"].alias("owner"), p["parent"].alias("parent"), p["depth"].alias("depth"), F.get(marks, k).alias("mark"), F.get(texts, k + 1).alias("text"))))
        whole = plain(F.array_join(texts, " "))
        return F.when(F.exists(marks, lambda m: F.startswith(m, F.lit("<sec"))), T.let(built(pieces), _typed)).otherwise(T.let(whole, alone))

    body = F.coalesce(body, F.lit(""))
    return T.let(F.regexp_extract_all(body, F.lit(MARK), F.lit(0)), split)


def with_abstract(found: Column, abstract: Column) -> Column:
    """The sections with the abstract, if there is one, as the first."""
    row = F.struct(F.lit(0).alias("ordinal"), F.lit(0).alias("depth"), F.lit("Abstract").alias("heading"), F.lit("abstract").alias("section_type"), abstract.alias("text"), T.word_count(abstract).alias("words"))
    return F.when(abstract != "", F.concat(F.array(row).cast(SECTIONS), found)).otherwise(found)

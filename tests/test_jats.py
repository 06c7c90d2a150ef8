"""JATS articles by hand and against a plain walk over the element tree."""

import random
import re
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from scholia.operators import jats

ARTICLE = """<?xml version="1.0"?><!DOCTYPE article><article xmlns:xlink="http://www.w3.org/1999/xlink"><front><journal-meta><journal-title-group>
<journal-title>J of &amp; T</journal-title></journal-title-group></journal-meta><article-meta><article-id pub-id-type="doi">https://doi.org/10.1/X.</article-id>
<article-id pub-id-type="pmc">pmc1</article-id><title-group><article-title>A <italic>b</italic> c &lt;5 &#233;</article-title></title-group>
<pub-date><year>2020</year></pub-date><pub-date><year>1999</year></pub-date><permissions><license xlink:href="http://l"><license-p>CC <b>x</b></license-p></license></permissions>
<abstract><title>Abstract</title><p>One &amp; two<sup>3</sup>.</p></abstract></article-meta></front><body>
<sec sec-type="methods" id="s1"><label>1</label><title>How &amp; why</title><p>Text <xref rid="a"/>x &lt; 3 <![CDATA[raw <b> & c]]> <!-- <sec> no --> end</p>
<sec><title>Sub</title><p>deep</p><fig><caption><title>Cap</title><p>tion</p></caption></fig><sec><p>deeper &amp;lt;</p></sec></sec><p>behind</p></sec>
<sec><title>References</title><p>gone</p><sec><title>Results</title><p>gone too</p></sec></sec>
<sec><title>2. Discussion.</title><p>said</p><ref-list><title>R</title><ref>r</ref><ref-list><ref>s</ref></ref-list></ref-list><p>more</p></sec><secondary>kept out</secondary></body></article>"""


def parsed(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, x string").select("k", jats.article(F.col("x")).alias("a"))
    rows = df.select("k", *jats.front(df["a"]), jats.sections(df["a"]["body"]).alias("sections")).orderBy("k").collect()
    return [r.asDict(recursive=True) for r in rows]


def test_an_article(spark):
    (r,) = parsed(spark, [ARTICLE])
    assert (r["title"], r["journal"], r["doi"], r["pmcid"], r["pmid"], r["year"]) == ("A b c <5 é", "J of & T", "10.1/x", "PMC1", None, 2020)
    assert (r["license"], r["license_url"], r["abstract"]) == ("CC x", "http://l", "Abstract One & two 3 .")
    got = [(s["ordinal"], s["depth"], s["heading"], s["section_type"], s["text"]) for s in r["sections"]]
    assert got == [
        (1, 1, "How & why", "methods", "1 Text x < 3 raw <b> & c end behind"), (2, 2, "Sub", "methods", "deep Cap tion"),
        (3, 3, "Untitled section 3", "methods", "deeper &lt;"), (4, 1, "2. Discussion.", "discussion", "said more"),
    ]
    assert [s["words"] for s in r["sections"]] == [7, 3, 2, 2]  # Text x raw b c end behind


def test_broken_and_empty_articles(spark):
    rows = parsed(spark, ["<article><body>", "", "<article><body><p>a</p> <p>b</p></body></article>", "<article/>", "no xml"])
    assert [r["title"] for r in rows] == [""] * 5
    assert [[(s["heading"], s["text"]) for s in r["sections"]] for r in rows] == [[], [], [("Body", "a b")], [], []]


def walk(body):
    """Sections by recursion over the tree."""
    out = []
    text = lambda node: re.sub(r"\s+", " ", " ".join(node.itertext())).strip()

    def visit(sec, depth, above):
        title = sec.find("title")
        heading = text(title) if title is not None and text(title) else f"Untitled section {len(out) + 1}"
        name = heading.lower().strip(" .:")
        own = next((t for h, t in (("methods", "methods"), ("results", "results"), ("references", "references")) if name == h or name.startswith(h + " ")), "other")
        kind = above if own == "other" and above not in ("", "other") else own
        if kind == "references":
            return
        words = re.sub(r"\s+", " ", " ".join(text(c) for c in sec if c.tag not in ("title", "sec", "ref-list"))).strip()
        if words:
            out.append((len(out) + 1, depth, heading, kind, words))
        for child in sec.findall("sec"):
            visit(child, depth + 1, kind)

    for sec in body.findall("sec"):
        visit(sec, 1, "")
    return out


def random_sec(rng, depth):
    head = rng.choice(["<title>Methods</title>", "<title>Results of it</title>", "<title>References</title>", "<title>Else <i>x</i></title>", "", "<title/>"])
    inner = [head] + [rng.choice(["<p>one <b>two</b></p>", "<p/>", "<fig><title>t</title></fig>", "<ref-list><ref>r</ref></ref-list>", "<p>a &amp; b</p>"]) for _ in range(rng.randrange(3))]
    if depth < 9:
        inner += [random_sec(rng, depth + 1) for _ in range(rng.choice([0, 0, 1, 1, 2]))]
    return f"<sec>{''.join(inner)}{rng.choice(['', '<p>tail</p>'])}</sec>"


def test_trees_of_any_depth_equal_a_recursive_walk(spark):
    rng = random.Random(1)
    texts = [f"<article><body>{''.join(random_sec(rng, 1) for _ in range(rng.randrange(1, 4)))}</body></article>" for _ in range(120)]
    for row, xml in zip(parsed(spark, texts), texts, strict=True):
        got = [(s["ordinal"], s["depth"], s["heading"], s["section_type"], s["text"]) for s in row["sections"]]
        assert got == walk(ET.fromstring(xml).find("body"))
    assert max(s["depth"] for row in parsed(spark, texts) for s in row["sections"]) > 5


def test_a_heading_is_brought_to_its_form_once(spark):
    from scholia.operators.papers import section_type

    rows = spark.createDataFrame([("2. Materials and methods.", ""), ("Overview", "Intro"), (None, None)], "h string, g string").coalesce(1).select(section_type(F.col("h"), F.col("g")).alias("t"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count(r"^\d+(?:\.\d+)*") == 1
    assert [r["t"] for r in rows.collect()] == ["methods", "introduction", "other"]


def test_an_article_is_built_and_parsed_once(spark, data):
    from scholia.plans import articles

    plan = articles.QUERIES["jats_sections"][0](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1


def test_text_behind_many_sections_stays_with_its_own(spark):
    inner = "".join(f"<sec><title>T{k}</title><p>a{k}</p></sec><p>b{k}</p>\n<ref-list><ref>r</ref></ref-list>" for k in range(300))
    (r,) = parsed(spark, [f"<article><body><sec><p>first</p>{inner}</sec></body></article>"])
    got = [(s["ordinal"], s["depth"], s["heading"], s["text"]) for s in r["sections"]]
    assert got == [(1, 1, "Untitled section 1", " ".join(["first", *(f"b{k}" for k in range(300))])), *[(k + 2, 2, f"T{k}", f"a{k}") for k in range(300)]]

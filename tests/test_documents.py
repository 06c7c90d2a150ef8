"""Fidelity, Markdown, selection and samplers against plain loops and expectations."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from scholia.functions import text as T
from scholia.operators import fidelity, identity, markdown, select
from scholia.plans import corpus, papers

BODY = " ".join(f"The specimen number {k} was loaded to {k}.5 MPa and it failed after {k} cycles as shown in [{k}] there, see 10.1000/abc.{k}." for k in range(1, 12))
PAPER = {"body": BODY, "headings": ["Introduction", "Materials and methods", "Results", "Discussion"], "tables": ["a | b", "c d | e"], "formulas": ["x = y + z"], "captions": ["Figure 1. A plot"]}


PARTS = "struct<body string, headings array<string>, tables array<string>, formulas array<string>, captions array<string>>"


def scored(spark, *pairs):
    order = list(PAPER)
    rows = [(k, tuple(e[n] for n in order), tuple(a[n] for n in order)) for k, (e, a) in enumerate(pairs)]
    got = fidelity.scores(spark.createDataFrame(rows, f"k int, expected {PARTS}, actual {PARTS}"), "k").collect()
    return [r.asDict() for r in sorted(got, key=lambda r: r["k"])]


def test_scores_of_documents(spark):
    nothing = {"body": None, "headings": [], "tables": [], "formulas": [], "captions": []}
    same, turned, no_tables, formula, units, half, empty, void, more, twice, cut = scored(
        spark, (PAPER, PAPER), (PAPER, PAPER | {"headings": PAPER["headings"][::-1]}), (PAPER, PAPER | {"tables": []}), (PAPER, PAPER | {"formulas": ["qqq"]}),
        (PAPER, PAPER | {"body": BODY.replace(".5 MPa", ".7 MPa").replace("[", "(")}), (PAPER, PAPER | {"body": BODY[: len(BODY) // 2]}), (PAPER, PAPER | {"body": ""}), (nothing, nothing),
        (nothing, nothing | {"headings": ["x"], "tables": ["a"]}), (PAPER | {"headings": ["Same", "Other"]}, PAPER | {"headings": ["Same", "Other", "Same"]}),
        (nothing | {"body": "see 10.1000/abc.def"}, nothing | {"body": "see 10.1000/abc"}),
    )
    assert same["score"] > 77.4 and not same["risk"] and not same["truncated"]
    assert turned["heading_order"] == 0.0 and turned["headings"] == 1.0
    assert no_tables["tables"] == 0 and formula["formulas"] < 0.75 and units["risk"]
    assert half["truncated"] and empty["truncated"] and empty["tokens"] == 0.0
    assert void["tokens"] == void["identifiers"] == void["headings"] == void["tables"] == 1.0 and void["truncated"] and not void["risk"]
    assert more["headings"] == 0.75 and more["heading_order"] == 1.0 and more["tables"] == 0.75
    assert twice["heading_order"] == 0.0  # of equal matches the last heading is taken
    assert cut["risk"] and cut["identifiers"] == 0.0


def test_item_pairs_count_shared_parts(spark):
    rng = random.Random(8)
    items = [(k, "t", side, i, rng.choices("abc", k=rng.randint(0, 4))) for k in range(4) for side in (0, 1) for i in range(3)]
    got = {(r["k"], r["i"], r["j"]): r["f1"] for r in fidelity.item_pairs(spark.createDataFrame(items, "k int, kind string, side int, idx int, parts array<string>"), "k").collect()}
    for k, _, _, i, e in (x for x in items if x[2] == 0):
        for _, _, _, j, a in (x for x in items if x[0] == k and x[2] == 1):
            common = sum(min(e.count(c), a.count(c)) for c in set(e))
            want = 1.0 if not e and not a else 2 * common / (len(e) + len(a)) if common else None
            assert got.get((k, i, j)) == (want if want is None else pytest.approx(want))


def test_rising_pairs_against_all_pairs(spark):
    rng = random.Random(3)
    lists = [[rng.randint(0, 9) for _ in range(rng.randint(0, 12))] for _ in range(50)]
    got = [r[0] for r in spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, p array<int>").orderBy("k").select(fidelity.rising(F.col("p"))).collect()]
    for p, share in zip(lists, got, strict=True):
        pairs = [(a, b) for i, a in enumerate(p) for b in p[i + 1 :]]
        assert share == (sum(a < b for a, b in pairs) / len(pairs) if pairs else None)


def test_ngrams(spark):
    texts = ["", "ab", "abc", "a🙂cdé"]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(fidelity.ngrams(F.col("t"))).collect()]
    assert got == [[], ["ab"], ["abc"], ["a🙂c", "🙂cd", "cdé"]]


def test_overlaps_are_those_of_multisets(spark):
    rows = [(1, ["a", "a", "b"], ["a", "b", "b"], ["b"]), (2, [], [], []), (3, ["x"], [], ["x"])]
    got = {r["k"]: tuple(r)[1:] for r in fidelity.overlaps(spark.createDataFrame(rows, "k int, e array<string>, a array<string>, t array<string>"), "k", "e", "a", "t").collect()}
    assert got == {1: (3, 3, 2, 1, 1), 2: (0, 0, 0, 0, 0), 3: (1, 0, 0, 1, 0)}


def marked(spark, *texts):
    rows = spark.createDataFrame([(k, t, n) for k, (t, n) in enumerate(texts)], "k int, md string, pages int").withColumn("found", markdown.blocks(F.col("md")))
    return rows.withColumn("reasons", markdown.gate(F.col("md"), F.col("found"), F.col("pages"))).orderBy("k").collect()


def test_markdown_blocks_and_gate(spark):
    text = "# Title\n\nSome text\nover lines.\n\n<table>\n<tr></tr>\n</table>\n\n$$\nx\n$$\n\n<details>\nheat map\n</details>\n\n## Figure 2. Cap\n\n| a | b |\n| - | - |\n\n![x](y)\n\n$$ open"
    good = "# One\n\n" + "Word " * 400 + "\n\n# Two\n\nMore text.\n\n# References\n\n[1] A"
    first, none, blank, fine, thin, unlisted, damaged, repeated, one_line = marked(
        spark, (text, 1), (None, None), ("", 1), (good, 2), (good, 10), (good.replace("# References", "# End"), 2), (good.replace("# Two", "# Tw\ufffd"), 2), (good + ("\n\n" + "again " * 50) * 4, 2), ("$$ x $$\nText\n## H\n| a | b |\n| c | d |", 1)
    )
    found = first["found"]["blocks"]
    assert [b["kind"] for b in found] == ["heading", "text", "html_table", "display_math", "image_ocr", "caption", "markdown_table", "image", "display_math"]
    assert first["found"]["open"] == "display_math" and (found[1]["first_line"], found[1]["last_line"]) == (3, 4) and "unclosed_display_math" in first["reasons"]
    assert found[0]["level"] == 1 and found[1]["text"] == "Some text\nover lines."
    assert none["found"]["blocks"] == blank["found"]["blocks"] == [] and none["found"]["open"] is None
    assert fine["reasons"] == [] and thin["reasons"] == ["thin_pages"] and "no_references" in unlisted["reasons"]
    assert "damaged_heading" in damaged["reasons"] and "repeated_paragraphs" in repeated["reasons"]
    assert [(b["kind"], b["first_line"], b["last_line"]) for b in one_line["found"]["blocks"]] == [("display_math", 1, 1), ("text", 2, 2), ("heading", 3, 3), ("markdown_table", 4, 5)]


def test_stratified_selection_against_a_loop(spark, data):
    scored = papers._strata(spark, data)
    rows = [r.asDict() for r in scored.collect()]
    used, want = set(), []
    for name in papers._STRATA:
        rank = lambda name=name: sorted((r for r in rows if r["stratum"] == name and r["doc_id"] not in used), key=lambda r: (not r["qualifies"], -r["score"], r["doc_id"]))
        for prefix, n in (("", 3), ("reserve_", 2)):
            chosen = rank()[:n]
            want += [(r["doc_id"], name, prefix + ("qualified" if r["qualifies"] else "ranked_fill")) for r in chosen]
            used |= {r["doc_id"] for r in chosen}
    assert sorted(map(tuple, papers.papers_with_reserves(scored, list(papers._STRATA), 3, 2).collect())) == sorted(want)


def test_round_robin_against_a_loop(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").collect()
    own = {}
    for r in rows:
        own.setdefault(r["lang"], []).append(r["doc_id"])
    own = {k: sorted(v, key=lambda x: hashlib.sha256(str(x).encode()).hexdigest()) for k, v in own.items()}
    names, cursor, want = sorted(own), 0, []
    while names and len(want) < 50:
        name = names[cursor % len(names)]
        want.append(own[name].pop(0))
        if own[name]:
            cursor += 1
        else:
            names.remove(name)
            cursor = 0
    got = corpus.round_robin_sample(spark, data).orderBy("position").collect()
    assert [r["doc_id"] for r in got] == want


def test_diversity_against_a_loop(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    got = {(r["lang"], r["id"]): r["pick"] for r in corpus.diversity_select(spark, data).collect()}
    for lang in {r["lang"] for r in docs}:
        left = [(hashlib.sha256(f"{lang}\0{r['doc_id']}".encode()).hexdigest(), r) for r in docs if r["lang"] == lang]
        seen = [set(), set(), set(), set()]
        for pick in range(1, 6):
            traits = lambda r: (r["source"], r["text"][:1], r["source"], str(r["n_chars"] // 1000))
            best = min(left, key=lambda x: (tuple(-int(t not in s) for t, s in zip(traits(x[1]), seen, strict=True)), x[0]))
            left.remove(best)
            for t, s in zip(traits(best[1]), seen, strict=True):
                s.add(t)
            assert got[lang, str(best[1]["doc_id"])] == pick


def test_small_helpers(spark):
    one = spark.range(1).select(T.casefold(F.lit("STRAßE ﬁ")).alias("f"), T.title_key(F.lit("Groß, 1!")).alias("t"), F.transform(select.evenly_spaced(F.lit(4), 3), lambda x: x).alias("e")).first()
    assert tuple(one) == ("strasse fi", "gross1", [0, 2, 3])
    rows = spark.createDataFrame([(k,) for k in range(0, 300, 3)], "id long")
    got = {r["id"]: r["n"] for r in select.running_number(rows, "id", "n", 7).collect()}
    assert got == {k: i + 1 for i, k in enumerate(range(0, 300, 3))}
    tie = spark.createDataFrame([("a", 1, 5), ("a", 2, 5)], "k string, seq int, at int")
    assert identity.latest(tie, ["k"], [F.col("at"), -F.col("seq")]).first()["seq"] == 1


def test_items_of_a_document_stay_where_it_is(spark, data):
    from scholia.plans import texts

    plan = texts.QUERIES["document_fidelity"][0](spark, data)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and all("REPARTITION_BY_NUM" in line for line in dealt)


def test_only_what_is_apart_is_counted_by_item(spark):
    from collections import Counter

    rng = random.Random(5)
    pairs = [("", ""), ("a", "ab"), ("ab", "ab"), ("abc", "abcd"), ("abcabc", "abc"), ("aaaa", "aaa"), ("é🙂x", "é🙂xy")]
    for _ in range(150):
        a = "".join(rng.choices("ab🙂", k=rng.randint(0, 12)))
        k = rng.randint(0, len(a))
        pairs.append((a, a[:k] + "".join(rng.choices("ab", k=rng.randint(0, 3))) + a[rng.randint(k, len(a)) :]))
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string").repartition(2)
    cut = rows.select("k", fidelity.apart_grams(F.col("a"), F.col("b")).alias("g"), fidelity.apart(F.split("a", ""), F.split("b", "")).alias("c"), fidelity.n_grams(F.col("a")).alias("n"))
    grams = lambda s: ([s[i : i + 3] for i in range(len(s) - 2)] or [s]) if s else []
    common = lambda a, b: sum((Counter(a) & Counter(b)).values())
    for r in cut.collect():
        a, b = pairs[r["k"]]
        assert r["n"] == len(grams(a))
        assert r["g"]["same"] + common(r["g"]["e"], r["g"]["a"]) == common(grams(a), grams(b)), (a, b)
        assert r["c"]["same"] + common(r["c"]["e"], r["c"]["a"]) == common(a or [""], b or [""]), (a, b)
    (long,) = spark.createDataFrame([("word " * 500 + "x" * 50, "word " * 500)], "a string, b string").select(fidelity.apart_grams(F.col("a"), F.col("b")).alias("g")).collect()
    assert long["g"]["same"] == 2498 and long["g"]["e"] == long["g"]["a"] == []

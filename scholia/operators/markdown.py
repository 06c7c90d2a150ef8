"""Blocks of Markdown and what speaks against reading a converted paper, as expressions on the lines of a row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: what begins and ends a block, and the names of sections ----
CAPTION = r"(?i)^(?:#+\s*)?(?:\*\*)?(?:fig(?:ure)?|table|scheme)\.?\s*\d+"
HEADING = r"^#{1,6}\s+"
STARTS = r"^(?:#{1,6}\s|\s*!\[|\s*\$\$|<table\b|<details\b)"
REFERENCES = r"(?i)^(?:\d+\.?\s*)?(?:references|bibliography|literature cited)\W*$"
AFTER_REFERENCES = r"(?i)^(?:acknowledg|funding|author contributions|conflicts? of interest|data availability|appendix|supplementary)"
NUMBERED = r"^\s*(?:\[\d+\]|\d+\.|\(\d+\))\s+\S"
#: Constructs that span lines: kind, what opens one, what ends one.
SPANS = [("html_table", r"(?i)<table\b", r"(?i)</table>"), ("details", r"(?i)<details\b", r"(?i)</details>"), ("display_math", r"^\s*\$\$", r"\$\$\s*$")]
BLOCKS = "array<struct<kind string, first int, last int, level int>>"
# ---- fixed values: when a text is held back ----
MOST_DAMAGE, DAMAGE_SHARE, LEAST_BODY, LEAST_PER_PAGE, LEAST_LISTED, LEAST_HEADINGS = 20, 2000, 1000, 500, 8, 2
LONG_PARAGRAPH, MOST_REPEATS, REPEATED_SHARE, TAIL_FROM = 200, 3, 0.05, 0.55


def _has(line: Column, pattern: str) -> Column:
    return F.regexp_like(line, F.lit(pattern))


def _pipes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))


def _closes(kind: Column, line: Column, first: Column) -> Column:
    """Whether a line ends the construct that is open; the dollars that open a formula don't also end it."""
    rest = F.when(first & (kind == "display_math"), F.regexp_replace(line, r"^\s*\$\$", "")).otherwise(line)
    return reduce(lambda a, b: a | b, [(kind == name) & _has(rest, end) for name, _, end in SPANS])


def folded(lines: Column) -> Column:
    """Struct of `blocks` (kind, first and last line from 1, heading level) and `open`: the kind of the last one if it is never closed.

    One pass over the lines, whose state is the block that goes on. Paragraphs end at a blank line or
    at what begins another block, tables at a line with fewer than two bars, constructs where they close.
    """
    state = f"struct<blocks {BLOCKS}, kind string, first int, last int, level int, on boolean, within boolean>"
    start = F.from_json(F.lit('{"blocks": [], "kind": "", "first": 0, "last": 0, "level": 0, "on": false, "within": false}'), state)
    rows = F.transform(lines, lambda x, i: F.struct(x.alias("line"), F.coalesce(F.get(lines, i + 1), F.lit("")).alias("next"), (i + 1).alias("n")))
    current = lambda s: F.struct(s["kind"].alias("kind"), s["first"].alias("first"), s["last"].alias("last"), s["level"].alias("level"))
    pushed = lambda s: F.when(s["first"] > 0, F.concat(s["blocks"], F.array(current(s)))).otherwise(s["blocks"])

    def step(s: Column, x: Column) -> Column:
        line, n = x["line"], x["n"]
        blank = ~_has(line, r"\S")
        goes_on = s["on"] & F.when(s["kind"] == "markdown_table", _pipes(line) >= 2).when(s["kind"] == "text", ~blank & ~_has(line, STARTS) & ~_has(line, CAPTION)).otherwise(False)
        span = reduce(lambda a, b: a.when(b[0], b[1]), [(_has(line, begin), name) for name, begin, _ in SPANS[1:]], F.when(_has(line, SPANS[0][1]), SPANS[0][0]))
        table = (_pipes(line) >= 2) & (_pipes(x["next"]) >= 2)
        other = F.when(_has(line, CAPTION), "caption").when(_has(line, HEADING), "heading").when(_has(line, r"^\s*!\["), "image").when(table, "markdown_table").otherwise("text")
        kind = F.coalesce(span, other)
        level = F.when(kind == "heading", F.length(F.regexp_extract(line, "^(#+)", 1))).otherwise(0)
        make = lambda blocks, kind, first, last, level, on, within: F.struct(blocks.alias("blocks"), kind.alias("kind"), first.alias("first"), last.alias("last"), level.alias("level"), on.alias("on"), within.alias("within")).cast(state)
        longer = lambda on, within: make(s["blocks"], s["kind"], s["first"], n, s["level"], on, within)
        yes, no = F.lit(True), F.lit(False)
        begun = make(pushed(s), kind, n, n, level, kind.isin("text", "markdown_table"), span.isNotNull() & ~_closes(kind, line, yes))
        idle = make(s["blocks"], s["kind"], s["first"], s["last"], s["level"], no, no)
        return F.when(s["within"], longer(no, ~_closes(s["kind"], line, no))).when(goes_on, longer(yes, no)).when(blank, idle).otherwise(begun)

    done = F.aggregate(rows, start, step, lambda s: F.struct(pushed(s).alias("blocks"), F.when(s["within"], s["kind"]).alias("open")))
    return done


def named(kind: Column) -> Column:
    """A block of details is text read off an image."""
    return F.when(kind == "details", "image_ocr").otherwise(kind)


def blocks(text: Column) -> Column:
    """Array of kind, first_line, last_line, level and text; and of the constructs that are never closed, in a struct."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(
        F.array(F.struct(lines.alias("lines"), folded(lines).alias("found"))),
        lambda x: F.struct(
            F.transform(x["found"]["blocks"], lambda b: F.struct(named(b["kind"]).alias("kind"), b["first"].alias("first_line"), b["last"].alias("last_line"), b["level"].alias("level"), F.array_join(F.slice(x["lines"], b["first"], b["last"] - b["first"] + 1), "\n").alias("text"))).alias("blocks"),
            x["found"]["open"].alias("open"),
        ),
    )[0]


def _longest(flags: Column) -> Column:
    """The longest run of true values."""
    step = lambda s, x: F.struct(F.when(x, s["run"] + 1).otherwise(0).alias("run"), F.greatest(s["best"], F.when(x, s["run"] + 1).otherwise(0)).alias("best"))
    return F.aggregate(flags, F.struct(F.lit(0).alias("run"), F.lit(0).alias("best")), step)["best"]


def gate(text: Column, found: Column, pages: Column) -> Column:
    """Reasons to hold a converted text back, in order; `found` is the struct of `blocks`."""
    text, size = F.coalesce(text, F.lit("")), F.length(F.coalesce(text, F.lit("")))
    all_ = found["blocks"]
    heads = F.filter(all_, lambda b: b["kind"] == "heading")
    broken = size - F.length(F.replace(text, F.lit("�"), F.lit("")))
    name = lambda b: F.trim(F.regexp_replace(b["text"], r"^#+\s*", ""))

    def count(s: Column, b: Column) -> Column:
        head, listing = b["kind"] == "heading", _has(name(b), REFERENCES)
        drop = F.when(head & listing, True).when(head & s["drop"] & _has(name(b), AFTER_REFERENCES), False).otherwise(s["drop"])
        plain = ~head & ~s["drop"] & ~b["kind"].isin("image_ocr", "image")
        return F.struct((s["listed"] | (head & listing)).alias("listed"), drop.alias("drop"), (s["body"] + F.when(plain, F.length(b["text"])).otherwise(0)).alias("body"))

    read = F.aggregate(all_, F.struct(F.lit(False).alias("listed"), F.lit(False).alias("drop"), F.lit(0).alias("body")), count)
    begin = F.floor(F.size(all_) * TAIL_FROM).cast("int")
    run = _longest(F.transform(F.slice(all_, begin + 1, F.greatest(F.size(all_), F.lit(1))), lambda b: (b["kind"] == "text") & _has(b["text"], NUMBERED)))
    long = F.transform(F.filter(all_, lambda b: (b["kind"] == "text") & (F.length(b["text"]) >= LONG_PARAGRAPH)), lambda b: F.lower(F.regexp_replace(b["text"], r"\s+", " ")))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x))
    again, share = F.size(long) - F.size(F.array_distinct(long)), total(long) - total(F.array_distinct(long))
    reasons = [
        F.concat(F.lit("unclosed_"), found["open"]), F.when(F.exists(heads, lambda b: F.contains(b["text"], F.lit("�"))), "damaged_heading"),
        F.when((broken > MOST_DAMAGE) | ((broken > 0) & (size / F.greatest(broken, F.lit(1)) < DAMAGE_SHARE)), "damaged_text"),
        F.when(~read["listed"] & (run < LEAST_LISTED), "no_references"), F.when(read["body"] < LEAST_BODY, "short_body"),
        F.when((pages > 0) & (read["body"] / F.greatest(pages, F.lit(1)) < LEAST_PER_PAGE), "thin_pages"), F.when(F.size(heads) < LEAST_HEADINGS, "few_headings"),
        F.when((again >= MOST_REPEATS) | (share > REPEATED_SHARE * F.greatest(size, F.lit(1))), "repeated_paragraphs"),
    ]
    return F.array_compact(F.array(*reasons))

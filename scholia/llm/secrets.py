"""Secret scans through a trigram index, in DataFrame functions only.

From each rule's pattern a Boolean query over trigrams is derived, as alternatives of trigrams
that must all occur. Texts are indexed by those trigrams, postings are intersected for each
alternative, and only texts that an alternative selects are searched with the rule's pattern, by
bringing the selected keys to the scan. Rules without mandatory trigrams search every text.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import durable, read

try:
    from re import _parser as sre  # the pattern parser of the standard library
except ImportError:  # older Pythons
    import sre_parse as sre

#: Kind, pattern, and the least length of group 2 or of the match. In order of rank.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    # the runs of [0-9a-f]+ that are long enough
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
MORE = [
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 0),
    ("npm", r"npm_[A-Za-z0-9]{36}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
]
RULES = BASE + MORE
#: Strings that a part of a pattern may stand for before it counts as unknown, and alternatives of a query.
MOST_STRINGS = 64
#: Selected keys (16 bytes each) up to which they are broadcast.
BROADCAST_KEYS = 200_000
#: Two noncharacters mark matches; in texts they are first replaced by a third one.
OPEN, CLOSE, OTHER = "﷐", "﷑", "﷒"


def _strings(node) -> set[str] | None:
    """All strings that a parsed item matches, lower-cased; None if there are too many."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        chars: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                chars.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < MOST_STRINGS:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if op == "SUBPATTERN":
        return _all(arg[-1])
    if op == "BRANCH":
        found = [_all(x) for x in arg[1]]
        return None if any(x is None for x in found) else set().union(*found)
    if op == "MAX_REPEAT" and arg[1] <= 1:
        one = _all(arg[2])
        return None if one is None else one | ({""} if arg[0] == 0 else set())
    return None


def _all(items) -> set[str] | None:
    out = {""}
    for x in items:
        more = _strings(x)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a, b in product(out, more)}
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams, one of which occurs wholly in any lower-cased text with a match; [] if none are mandatory."""
    query: list[frozenset[str]] = [frozenset()]
    run: set[str] = {""}

    def flush() -> None:
        nonlocal query, run
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in sets and len(query) * len(sets) <= MOST_STRINGS:
            query = list({a | b for a, b in product(query, sets)})
        run = {""}

    def walk(items) -> None:
        nonlocal run
        for x in items:
            more = _strings(x)
            if more is not None and len(run) * len(more) <= MOST_STRINGS:
                run = {a + b for a, b in product(run, more)}
                continue
            flush()
            if str(x[0]) == "SUBPATTERN":
                walk(x[1][-1])
                flush()
            elif str(x[0]) == "MAX_REPEAT" and x[1][0] >= 1:
                walk(x[1][2])
                flush()

    walk(sre.parse(pattern))
    flush()
    # an alternative that asks for more than another one adds nothing
    return [] if frozenset() in query else [a for a in query if not any(b < a for b in query)]


def let(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _prefix(lengths: Column, width: int = 64) -> Column:
    """Exclusive prefix sums; sums of `width` items go first, so long arrays aren't summed anew for each item."""
    add = lambda a, x: a + x
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / width).cast("int")), lambda b: F.aggregate(F.slice(lengths, b * width + 1, width), F.lit(0), add))

    def inner(totals: Column) -> Column:
        before = F.transform(F.sequence(F.lit(0), F.size(totals) - 1), lambda b: F.aggregate(F.slice(totals, 1, b), F.lit(0), add))
        return let(
            before,
            lambda up: F.transform(
                lengths, lambda _, i: F.element_at(up, F.floor(i / width).cast("int") + 1) + F.aggregate(F.slice(lengths, F.floor(i / width).cast("int") * width + 1, i % width), F.lit(0), add)
            ),
        )

    return let(blocks, inner)


def spans(text: Column, rank: int, rule: tuple[str, str, int, int]) -> Column:
    """Array of (start, rank, end) in code points: leftmost matches without overlap, less those that are too short."""
    _, pattern, group, least = rule
    clean = F.translate(text, OPEN + CLOSE, OTHER + OTHER)
    parts = F.split(F.regexp_replace(clean, F.lit(pattern), F.lit(f"{OPEN}$0{CLOSE}")), f"[{OPEN}{CLOSE}]")

    def of(parts: Column) -> Column:
        starts = _prefix(F.transform(parts, lambda p: F.length(p)))
        found = F.filter(
            F.zip_with(starts, F.transform(parts, lambda p, i: F.struct(p.alias("p"), (i % 2 == 1).alias("hit"))), lambda s, p: F.struct(s.alias("start"), F.lit(rank).alias("rank"), (s + F.length(p["p"])).alias("end"), p.alias("of"))),
            lambda x: x["of"]["hit"] & (F.length(F.regexp_extract(x["of"]["p"], pattern, group) if group else x["of"]["p"]) >= least),
        )
        return F.transform(found, lambda x: F.struct(x["start"], x["rank"], x["end"]))

    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), let(parts, of)).otherwise(none)


def _listed(found: Column) -> Column:
    kinds = F.array(*[F.lit(r[0]) for r in RULES])
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", F.element_at(kinds, x["rank"] + 1), x["start"], x["end"])), ",")


def postings(rows: DataFrame, grams: list[str]) -> DataFrame:
    """(key, gram) of the texts (key, text) that hold a gram, lower-cased once a text."""
    held = let(F.lower(F.col("text")), lambda t: F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(t, g)))
    return rows.select("key", F.explode(held).alias("gram")).distinct()


def intersected(index: DataFrame, queries: list[list[frozenset[str]]]) -> DataFrame:
    """(key, ranks): the rules of which all trigrams of an alternative have the key in their postings."""
    # the table of the rules' alternatives has a few dozen rows
    alts = [(g, k, a, len(alt)) for k, q in enumerate(queries) for a, alt in enumerate(q) for g in sorted(alt)]
    wanted = F.broadcast(index.sparkSession.createDataFrame(alts, "gram string, rank int, alt int, size int"))
    hits = index.join(wanted, "gram").groupBy("key", "rank", "alt").agg(F.count("*").alias("n"), F.first("size").alias("size")).where("n = size")
    return hits.groupBy("key").agg(F.collect_set("rank").alias("ranks"))


def may_match(text: Column, queries: list[list[frozenset[str]]]) -> Column:
    """Whether the text itself holds all trigrams of an alternative."""
    alts = F.array(*[F.array(*[F.lit(g) for g in sorted(alt)]) for q in queries for alt in q])
    return let(F.lower(text), lambda t: F.exists(alts, lambda alt: F.forall(alt, lambda g: F.contains(t, g))))


def scan(docs: DataFrame, rules: list[tuple[str, str, int, int]] = RULES) -> DataFrame:
    """doc_id, found (array of start, rank, end) of each row of `docs` (doc_id, text), by all rules.

    A null text counts as empty. Texts are told apart by their MD5, so copies of a text share its
    postings; every row is searched where it lies, so repeated rows and null ids keep their own
    results. Other columns are ignored; an empty table gives no rows.

    The keys that the index selects are sent to the scan if they are few; if they are many, the
    texts that hold an alternative, and no others, are shuffled to them.
    """
    queries = [trigram_query(r[1]) for r in rules]
    nothing = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    own = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    grams = sorted({g for q in queries for alt in q for g in alt})
    full = [spans(F.col("text"), k, r) for k, r in enumerate(rules) if not queries[k]]
    if not grams:
        return own.select("doc_id", F.array_sort(F.concat(nothing, *full)).alias("found"))
    selected = durable(intersected(postings(own.select("key", "text"), grams), queries)).withColumnRenamed("key", "__key")
    on = F.col("key") == F.col("__key")
    if selected.count() <= BROADCAST_KEYS:
        rows = own.join(F.broadcast(selected), on, "left")
    else:
        may = may_match(F.col("text"), queries)
        rows = own.where(may).join(selected, on, "left").unionByName(own.where(~may), allowMissingColumns=True)
    verified = [F.when(F.array_contains("ranks", k), spans(F.col("text"), k, r)).otherwise(nothing) for k, r in enumerate(rules) if queries[k]]
    return rows.select("doc_id", F.array_sort(F.concat(nothing, *full, *verified)).alias("found"))


def op8_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("found", lambda x: x["rank"] == k)).cast("long")
    base = _listed(F.filter("found", lambda x: x["rank"] < len(BASE)))
    return rows.select("doc_id", *[count(k).alias(f"n_{r[0]}") for k, r in enumerate(BASE)], F.sha2(base, 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def compiled() -> list[tuple[str, re.Pattern, int, int]]:
    """The rules as Python patterns, for tests."""
    return [(k, re.compile(p), g, n) for k, p, g, n in RULES]

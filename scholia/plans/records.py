"""Queries on pages, events and tables: markup, retrieval, fidelity, leaderboards, validation, queues."""

from __future__ import annotations

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from scholia.functions import text as T
from scholia.operators import identity, search, select
from scholia.sources.tables import read


def html_headings(s: SparkSession, d: str):
    h = F.regexp_extract_all("html", F.lit(r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"), F.lit(1))
    return read(s, d, "pages").select("page_id", F.posexplode(h).alias("o", "heading")).select("page_id", F.col("o").cast("long").alias("ord"), "heading")


def tag_counts(s, d):
    tags = F.regexp_extract_all(F.lower("html"), F.lit("<([a-z][a-z0-9]*)"), F.lit(1))
    return read(s, d, "pages").select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def html_text_words(s, d):
    bare = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]*>", " ")
    return read(s, d, "pages").select("page_id", T.word_count(bare).alias("words"))


def _and_bm25(s, d, terms):
    rows = read(s, d, "documents").select("doc_id", "source", F.substring_index("text", "\n", 1).alias("head"), F.expr("substr(text, instr(text || '\n', '\n') + 1)").alias("body"))
    scored = search.and_scores(rows, ["doc_id", "source"], {"head": 0.8, "body": 1.0}, terms)
    return scored.withColumn("score", F.floor(F.col("score") * 1e6 + 0.5) / 1e6)


def bm25_top10(s, d):
    scored = _and_bm25(s, d, ["the", "reer"]).select("doc_id", "score")
    return scored.orderBy("score", "doc_id").limit(10)


def and_filter(s, d):
    t = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(search.TOKEN), F.lit(0)))
    want = F.array(*[F.lit(x) for x in ("the", "and", "of")])
    return read(s, d, "documents").where(F.size(F.array_intersect(t, want)) == 3).select("doc_id")


def source_diversified(s, d):
    """Best document of each source for a query, by BM25."""
    scored = _and_bm25(s, d, ["the", "of"])
    return identity.first_wins(scored, ["source"], [F.col("score"), F.col("doc_id")]).select("source", "doc_id", "score")


BM25_SQL = """
WITH d AS (SELECT doc_id, source, regexp_extract_all(lower(split_part(text, chr(10), 1)), '[a-z0-9]+') AS h,
                  regexp_extract_all(lower(substr(text, strpos(text || chr(10), chr(10)) + 1)), '[a-z0-9]+') AS b FROM documents),
n AS (SELECT count(*) AS n, sum(len(h) + len(b)) / count(*) AS avg FROM d),
q AS (SELECT unnest({terms}) AS term),
p AS (SELECT doc_id, source, term, len(h) + len(b) AS len, 0.8 * len(list_filter(h, lambda x: x = term)) + len(list_filter(b, lambda x: x = term)) AS f FROM d, q),
i AS (SELECT term, greatest(ln((max(n.n) - count(*) + 0.5) / (count(*) + 0.5)), 1e-6) AS idf FROM p, n WHERE f > 0 GROUP BY term),
sc AS (SELECT doc_id, source, floor(-sum(idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len / avg))) * 1e6 + 0.5) / 1e6 AS score
       FROM p JOIN i USING (term), n WHERE f > 0 GROUP BY doc_id, source HAVING count(*) = 2)
"""


def latest_event(s, d):
    e = read(s, d, "events").select("user_id", "event_id", "ts", "event_type")
    # of equal times the first stays
    return identity.latest(e, ["user_id"], [F.col("ts"), -F.col("event_id")]).select("user_id", "event_id", "event_type")


def timing_phase(s, d):
    """Cold until the first success of the user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    warm = F.coalesce(F.max((F.col("event_type") == "purchase").cast("int")).over(w), F.lit(0))
    return read(s, d, "events").select("event_id", F.when(warm == 1, "steady").otherwise("cold").alias("phase"))


def leaderboard(s, d):
    """Two levels: by event type, and by event type and stratum."""
    e = read(s, d, "events").select("event_type", (F.col("user_id") % 3).alias("stratum"), F.floor(F.col("value") * 100).cast("long").alias("v"))
    return e.groupingSets([[F.col("event_type")], [F.col("event_type"), F.col("stratum")]], "event_type", "stratum").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.percentile("v", 0.5).alias("median"))


def winner(s, d):
    e = read(s, d, "events").select("event_type", F.floor(F.col("value") * 100).cast("long").alias("v"))
    return e.groupBy("event_type").agg(F.sum("v").alias("total"), F.count("*").alias("n")).orderBy(F.desc("total"), F.desc("n"), "event_type").limit(1)


def orphans(s, d):
    return read(s, d, "orders").select("o_orderkey", "o_custkey").join(read(s, d, "customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").select("o_orderkey")


def set_diff(s, d):
    a, b = read(s, d, "documents").select("doc_id"), read(s, d, "labels").select("doc_id")
    return a.exceptAll(b).withColumn("side", F.lit("unlabelled")).unionByName(b.exceptAll(a).withColumn("side", F.lit("unknown")))


def key_sets_agree(s, d):
    a = read(s, d, "documents").select("doc_id", F.lit(1).alias("a"))
    b = read(s, d, "labels").select("doc_id", F.lit(1).alias("b"))
    j = a.join(b, "doc_id", "full")
    return j.agg(F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("mismatched"), F.countDistinct("doc_id").alias("keys"))


def verdict(s, d):
    issue = F.when(F.length("text") == 0, "error").when(F.length("text") < 200, "warning")
    g = read(s, d, "documents").select("lang", issue.alias("i")).groupBy("lang").agg(F.count_if(F.col("i") == "error").alias("errors"), F.count_if(F.col("i") == "warning").alias("warnings"))
    return g.select("lang", "errors", "warnings", F.when(F.col("errors") > 0, "FAIL").when(F.col("warnings") > 0, "PASS_WITH_WARNINGS").otherwise("PASS").alias("verdict"))


def stratum_stdev(s, d):
    """Population deviation to two digits, 0 for one row; from exact integer sums."""
    g = read(s, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("t"), F.sum(F.col("n_chars") * F.col("n_chars")).alias("q"))
    n2 = (F.col("n") * F.col("q") - F.col("t") * F.col("t")).cast("double")
    return g.select("lang", F.when(F.col("n") > 1, T.scaled(F.sqrt(n2), F.col("n"), 2)).otherwise(F.lit(0.0)).alias("sd"))


def bounded_batches(s, d):
    rows = read(s, d, "events").select("event_id", "event_type", "ts", F.date_trunc("hour", "ts").alias("hour"))
    return select.numbered(rows, ["event_type"], "hour", ["ts", "event_id"], "n").select("event_id", "event_type", F.floor((F.col("n") - 1) / 100).alias("batch"))


def fingerprint_changes(s, d):
    """Events whose content differs from the user's last one."""
    fp = F.sha2(F.concat_ws("|", "event_type", F.floor("value").cast("string")), 256)
    rows = read(s, d, "events").select("event_id", "user_id", "ts", fp.alias("fp"))
    return identity.collapse_runs(rows, ["user_id"], ["ts", "event_id"], "fp").select("event_id")


def expiry_sweep(s, d):
    """Leases of 1000 seconds that no later event of the user renews in time."""
    nxt = F.lead("t").over(Window.partitionBy("user_id").orderBy("t", "event_id"))
    rows = read(s, d, "events").select("event_id", "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t")).withColumn("n", nxt)
    return rows.where("n is not null and t + 1000 <= n").select("event_id")


QUERIES = {
    "html_headings": (
        html_headings,
        "SELECT page_id, unnest(range(len(h))) AS ord, unnest(h) AS heading FROM (SELECT page_id, regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1) AS h FROM pages)",
    ),
    "tag_counts": (tag_counts, "SELECT tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(html), '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages) GROUP BY tag"),
    "html_text_words": (
        html_text_words,
        r"SELECT page_id, CAST(len(regexp_extract_all(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[A-Za-z]+(?:[-''][A-Za-z]+)?')) AS BIGINT) AS words FROM pages",
    ),
    "bm25_top10": (bm25_top10, BM25_SQL.format(terms="['the', 'reer']") + "SELECT doc_id, score FROM sc ORDER BY score, doc_id LIMIT 10"),
    "and_filter": (and_filter, "SELECT doc_id FROM documents WHERE list_has_all(regexp_extract_all(lower(text), '[a-z0-9]+'), ['the', 'and', 'of'])"),
    "source_diversified": (source_diversified, BM25_SQL.format(terms="['the', 'of']") + "SELECT source, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score, doc_id) AS r FROM sc) WHERE r = 1"),
    "latest_event": (latest_event, "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1"),
    "timing_phase": (
        timing_phase,
        "SELECT event_id, CASE WHEN coalesce(max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'steady' ELSE 'cold' END AS phase FROM events",
    ),
    "leaderboard": (
        leaderboard,
        "SELECT event_type, stratum, count(*) AS n, CAST(sum(v) AS BIGINT) AS total, quantile_cont(v, 0.5) AS median FROM (SELECT event_type, user_id % 3 AS stratum, CAST(floor(value * 100) AS BIGINT) AS v FROM events) GROUP BY GROUPING SETS ((event_type), (event_type, stratum))",
    ),
    "winner": (winner, "SELECT event_type, CAST(sum(v) AS BIGINT) AS total, count(*) AS n FROM (SELECT event_type, CAST(floor(value * 100) AS BIGINT) AS v FROM events) GROUP BY event_type ORDER BY total DESC, n DESC, event_type LIMIT 1"),
    "orphans": (orphans, "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)"),
    "set_diff": (set_diff, "SELECT doc_id, 'unlabelled' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'unknown' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)"),
    "key_sets_agree": (key_sets_agree, "SELECT count(*) FILTER (d.doc_id IS NULL OR l.doc_id IS NULL) AS mismatched, count(DISTINCT coalesce(d.doc_id, l.doc_id)) AS keys FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id"),
    "verdict": (
        verdict,
        "SELECT lang, errors, warnings, CASE WHEN errors > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'PASS_WITH_WARNINGS' ELSE 'PASS' END AS verdict FROM (SELECT lang, count(*) FILTER (length(text) = 0) AS errors, count(*) FILTER (length(text) BETWEEN 1 AND 199) AS warnings FROM documents GROUP BY lang)",
    ),
    "stratum_stdev": (
        stratum_stdev,
        "SELECT lang, CASE WHEN count(*) > 1 THEN floor(sqrt(CAST(count(*) * sum(n_chars * n_chars) - sum(n_chars) * sum(n_chars) AS DOUBLE)) / count(*) * 100 + 0.5) / 100 ELSE 0.0::DOUBLE END AS sd FROM documents GROUP BY lang",
    ),
    "bounded_batches": (bounded_batches, "SELECT event_id, event_type, CAST(floor((row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) / 100) AS BIGINT) AS batch FROM events"),
    "fingerprint_changes": (
        fingerprint_changes,
        "SELECT event_id FROM (SELECT *, lag(fp) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM (SELECT *, event_type || '|' || CAST(floor(value) AS BIGINT) AS fp FROM events)) WHERE p IS DISTINCT FROM fp",
    ),
    "expiry_sweep": (
        expiry_sweep,
        "SELECT event_id FROM (SELECT event_id, t, lead(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS n FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events)) WHERE n IS NOT NULL AND t + 1000 <= n",
    ),
}

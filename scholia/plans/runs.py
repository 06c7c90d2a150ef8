"""Queries on runs and records, made from `events`, `orders`, `lineitem` and others: filters, joins, ledgers, queues, validation.

Events are runs (type: tool, user: sample), orders are papers, line items their attachments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholia.functions import patterns as V
from scholia.functions import text as T
from scholia.operators import identity, select
from scholia.operators.components import kept
from scholia.sources.tables import read

QUERIES: dict = {}


def query(sql: str | None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


RUN = {
    "run": "event_id", "tool": "event_type", "sample": "user_id", "started": "ts", "cents": "CAST(floor(value * 100) AS BIGINT)",
    "status": "CASE WHEN value < 10 THEN 'failed' WHEN value < 80 THEN 'success' ELSE 'running' END",
}
RUNS = "(SELECT " + ", ".join(f"{e} AS {c}" for c, e in RUN.items()) + " FROM events)"


def runs(s, d) -> DataFrame:
    return read(s, d, "events").selectExpr(*[f"{e} AS {c}" for c, e in RUN.items()])


def ids(s, d, name: str, key: str) -> DataFrame:
    return read(s, d, name).select(key)


# ---- filters ----


@query(f"SELECT doc_id FROM documents WHERE regexp_matches(source || ' ' || CASE doc_id % 4 WHEN 0 THEN 'Bone & Joint' WHEN 1 THEN 'FATIGUE of metals' ELSE 'Other' END, '{V.DOMAIN}') AND regexp_matches(lang, 'en|fr')")
def domain_filter(s, d):
    """Journals of the domain, and of a pattern that the user gives."""
    name = F.concat_ws(" ", "source", F.expr("CASE doc_id % 4 WHEN 0 THEN 'Bone & Joint' WHEN 1 THEN 'FATIGUE of metals' ELSE 'Other' END"))
    return read(s, d, "documents").where(F.regexp_like(name, F.lit(V.DOMAIN)) & F.regexp_like("lang", F.lit("en|fr"))).select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 100")
def pending_work(s, d):
    return ids(s, d, "documents", "doc_id").join(ids(s, d, "labels", "doc_id"), "doc_id", "left_anti").orderBy("doc_id").limit(100)


_ERR = "CASE event_id % 5 WHEN 0 THEN 'HTTP Error 404: Not Found' WHEN 1 THEN 'timed out' WHEN 2 THEN 'No open access full text' WHEN 3 THEN 'http error 503' ELSE 'x does not contain a JATS article' END"


@query(f"SELECT event_id FROM (SELECT event_id, lower({_ERR}) AS e FROM events) WHERE " + " OR ".join(f"contains(e, '{m}')" for m in V.PERMANENT_ERRORS))
def permanent_errors(s, d):
    low = F.lower(F.expr(_ERR))
    hit = F.exists(F.array(*[F.lit(m) for m in V.PERMANENT_ERRORS]), lambda m: F.contains(low, m))
    return read(s, d, "events").where(hit).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice >= 1000 AND o_orderkey % 7 <> 0 AND o_orderdate >= TIMESTAMP '1995-01-01'")
def eligible(s, d):
    o = read(s, d, "orders")
    return o.where((F.col("o_orderstatus") != "F") & (F.col("o_totalprice") >= 1000) & (F.col("o_orderkey") % 7 != 0) & (F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp"))).select("o_orderkey")


_TOP5 = "doc_id IN (SELECT doc_id FROM documents ORDER BY sha256('set' || doc_id) LIMIT 5)"


@query(f"SELECT 'smoke' AS part, doc_id FROM documents WHERE doc_id < 3 UNION ALL SELECT 'pilot', doc_id FROM documents WHERE doc_id % 50 = 1 UNION ALL SELECT 'repeat', doc_id FROM documents WHERE {_TOP5} UNION ALL SELECT 'full', doc_id FROM documents")
def sample_sets(s, d):
    t = ids(s, d, "documents", "doc_id")
    part = lambda df, name: df.select(F.lit(name).alias("part"), "doc_id")
    some = select.hash_sample(t, F.col("doc_id").cast("string"), "set", 5)
    return part(t.where("doc_id < 3"), "smoke").unionByName(part(t.where("doc_id % 50 = 1"), "pilot")).unionByName(part(some, "repeat")).unionByName(part(t, "full"))


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 60 OFFSET 20) WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def offset_then_anti(s, d):
    """Offset and limit address the manifest as it is; what exists is left out afterwards."""
    window = ids(s, d, "documents", "doc_id").orderBy("doc_id").offset(20).limit(60)
    return window.join(ids(s, d, "labels", "doc_id"), "doc_id", "left_anti")


_LAG = f"(SELECT *, lag(status) OVER w AS before, lag(epoch(date_trunc('second', started))) OVER w AS at0, epoch(date_trunc('second', started)) AS at1 FROM {RUNS} WINDOW w AS (PARTITION BY tool, sample ORDER BY started, run))"


@query(f"SELECT run, CASE WHEN status = 'running' THEN 'wait' WHEN before = 'failed' AND at1 - at0 < 900 THEN 'back_off' WHEN before = 'failed' THEN 'retry' ELSE 'go' END AS action FROM {_LAG}")
def blocker_backoff(s, d):
    """A run after a failed one of the same tool and sample waits 900 seconds."""
    w = Window.partitionBy("tool", "sample").orderBy("started", "run")
    at = F.unix_seconds(F.col("started").cast("timestamp"))
    t = runs(s, d).withColumn("before", F.lag("status").over(w)).withColumn("gap", at - F.lag(at).over(w))
    failed = F.col("before") == "failed"
    return t.select("run", F.when(F.col("status") == "running", "wait").when(failed & (F.col("gap") < 900), "back_off").when(failed, "retry").otherwise("go").alias("action"))


@query(f"SELECT sample, avg_ok AND least_ok AND NOT busy AS idle FROM (SELECT sample, CAST(sum(cents) AS BIGINT) <= 5000 * count(*) AS avg_ok, min(cents) >= 5 AS least_ok, bool_or(status = 'running' AND cents > 30000) AS busy FROM {RUNS} GROUP BY sample)")
def idle_gate(s, d):
    """A sample is idle if its mean load is low, its least memory is high enough and nothing heavy runs."""
    g = runs(s, d).groupBy("sample").agg((F.sum("cents") <= 5000 * F.count("*")).alias("a"), (F.min("cents") >= 5).alias("b"), F.bool_or((F.col("status") == "running") & (F.col("cents") > 30000)).alias("c"))
    return g.select("sample", (F.col("a") & F.col("b") & ~F.col("c")).alias("idle"))


@query("SELECT page_id FROM pages WHERE NOT regexp_matches(url, '(?i)(?:\\.git/|__pycache__|\\.tmp$|\\?|#)')")
def reproducible_files(s, d):
    return read(s, d, "pages").where(~F.regexp_like("url", F.lit(r"(?i)(?:\.git/|__pycache__|\.tmp$|\?|#)"))).select("page_id")


_CLAIM = "SELECT o_orderkey, o_orderstatus AS kind, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'p.' || o_custkey END AS locator, CASE WHEN o_orderkey % 3 = 0 THEN 'abstract' ELSE 'full_text' END AS access FROM orders"


@query(f"SELECT o_orderkey, issue FROM (SELECT o_orderkey, unnest(list_filter([CASE WHEN access <> 'full_text' THEN 'ACCESS_LEVEL' END, CASE WHEN locator = '' THEN 'LOCATOR_MISSING' END], lambda x: x IS NOT NULL)) AS issue, kind FROM ({_CLAIM})) WHERE kind IN ('F', 'O')")
def claim_gate(s, d):
    """Claims of results need full text and a locator."""
    t = read(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("kind"), F.when(F.col("o_custkey") % 4 == 0, "").otherwise("p").alias("locator"), (F.col("o_orderkey") % 3 == 0).alias("short"))
    issues = F.array_compact(F.array(F.when(F.col("short"), "ACCESS_LEVEL"), F.when(F.col("locator") == "", "LOCATOR_MISSING")))
    return t.where(F.col("kind").isin("F", "O")).select("o_orderkey", F.explode(issues).alias("issue"))


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0 AND strlen('%PDF-1.7 ' || text) >= 4096")
def acceptable_pdf(s, d):
    """Bodies with the right prefix and enough bytes."""
    body = F.concat(F.when(F.col("doc_id") % 3 == 0, "%PDF-1.7 ").otherwise("<html> "), "text")
    return read(s, d, "documents").where(F.startswith(body, F.lit("%PDF")) & (F.octet_length(body) >= 4096)).select("doc_id")


@query("SELECT doc_id FROM documents WHERE (doc_id, md5(text)) NOT IN (SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN text ELSE text || '!' END) FROM documents WHERE doc_id % 3 = 0)")
def upload_candidates(s, d):
    """Files that aren't verified with the same hash."""
    t = read(s, d, "documents").select("doc_id", F.md5("text").alias("h"))
    sent = read(s, d, "documents").where("doc_id % 3 = 0").select("doc_id", F.md5(F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.lit("!")))).alias("h"))
    return t.join(sent, ["doc_id", "h"], "left_anti").select("doc_id")


@query(f"SELECT DISTINCT tool, sample FROM {RUNS} WHERE (tool, sample) NOT IN (SELECT tool, sample FROM {RUNS} WHERE status = 'success' AND cents % 2 = 0)")
def skip_successes(s, d):
    t = runs(s, d)
    done = t.where((F.col("status") == "success") & (F.col("cents") % 2 == 0)).select("tool", "sample")
    return t.select("tool", "sample").distinct().join(done, ["tool", "sample"], "left_anti")


@query(f"SELECT event_id FROM events WHERE regexp_matches({_ERR}, '(?i)404|no open access') AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 400 = 0)")
def surrogate_targets(s, d):
    done = read(s, d, "events").where("event_id % 400 = 0").select("user_id")
    return read(s, d, "events").where(F.regexp_like(F.expr(_ERR), F.lit("(?i)404|no open access"))).join(done, "user_id", "left_anti").select("event_id")


@query(f"SELECT tool, bool_or(status = 'running' AND cents > 40000) AS pause FROM {RUNS} GROUP BY tool")
def pause_predicate(s, d):
    return runs(s, d).groupBy("tool").agg(F.bool_or((F.col("status") == "running") & (F.col("cents") > 40000)).alias("pause"))


# ---- joins ----


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'record_missing' WHEN l.quality = 0 THEN 'low_quality' ELSE '' END AS reason FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def record_join(s, d):
    lab = read(s, d, "labels").select("doc_id", "quality")
    j = ids(s, d, "documents", "doc_id").join(lab, "doc_id", "left")
    return j.select("doc_id", F.when(F.col("quality").isNull(), "record_missing").when(F.col("quality") == 0, "low_quality").otherwise("").alias("reason"))


_HITS = "(SELECT l_orderkey AS id, o.o_orderkey AS meta, l_partkey % 3 AS found FROM lineitem JOIN orders o ON l_orderkey % 5000 = o.o_orderkey)"


@query(f"SELECT id, CASE WHEN max(n_found) = 1 AND bool_or(agree) THEN 'agree' WHEN max(n_found) = 1 THEN 'single' ELSE 'ambiguous' END AS rule FROM (SELECT id, found = meta % 3 AS agree, count(DISTINCT found) OVER (PARTITION BY id) AS n_found FROM {_HITS}) GROUP BY id")
def three_way_match(s, d):
    """An attachment is matched if its metadata and the one identifier in it agree, or if there is one; else it is ambiguous."""
    o = read(s, d, "orders").select(F.col("o_orderkey").alias("meta"))
    t = read(s, d, "lineitem").select(F.col("l_orderkey").alias("id"), (F.col("l_orderkey") % 5000).alias("meta"), (F.col("l_partkey") % 3).alias("found")).join(o, "meta")
    g = t.groupBy("id").agg(F.countDistinct("found").alias("n"), F.bool_or(F.col("found") == F.col("meta") % 3).alias("agree"))
    return g.select("id", F.when((F.col("n") == 1) & F.col("agree"), "agree").when(F.col("n") == 1, "single").otherwise("ambiguous").alias("rule"))


@query("SELECT d.source, count(*) AS hits FROM documents d JOIN labels l ON d.doc_id = l.doc_id JOIN (SELECT doc_id FROM documents WHERE contains(text, 'the')) h ON h.doc_id = d.doc_id GROUP BY d.source")
def record_section_hit(s, d):
    docs = read(s, d, "documents")
    hit = docs.where(F.contains("text", F.lit("the"))).select("doc_id", "source")
    return hit.join(read(s, d, "labels").select("doc_id"), "doc_id").groupBy("source").agg(F.count("*").alias("hits"))


_LATEST = f"(SELECT tool, sample, run, status FROM (SELECT *, row_number() OVER (PARTITION BY tool, sample ORDER BY started DESC, run) AS r FROM {RUNS}) WHERE r = 1)"


def _latest(s, d) -> DataFrame:
    """Latest run of each tool and sample; of equal times the first."""
    return identity.latest(runs(s, d).withColumn("first", -F.col("run")), ["tool", "sample"], [F.col("started"), F.col("first")])


@query(f"SELECT t.tool, c.c_custkey AS sample, r.run, coalesce(r.status, 'missing') AS status FROM (SELECT DISTINCT tool FROM {RUNS}) t, (SELECT c_custkey FROM customer) c LEFT JOIN {_LATEST} r ON r.tool = t.tool AND r.sample = c.c_custkey")
def tools_by_papers(s, d):
    """Every tool with every paper and its latest run; the tools are broadcast if there are few."""
    tools = kept(runs(s, d).select("tool").distinct())
    few = tools.withColumn("tools", F.lit(1))
    few = F.broadcast(few) if tools.count() <= 10_000 else few
    grid = read(s, d, "customer").select(F.col("c_custkey").alias("sample")).withColumn("tools", F.lit(1)).join(few, "tools").drop("tools")
    return grid.join(_latest(s, d).select("tool", "sample", "run", "status"), ["tool", "sample"], "left").select("tool", "sample", "run", F.coalesce("status", F.lit("missing")).alias("status"))


_PAIR = f"(SELECT a.tool, a.sample, a.status = 'success' AND b.status = 'success' AS both_ok, abs(a.cents - b.cents) AS delta FROM (SELECT *, row_number() OVER (PARTITION BY tool, sample ORDER BY started, run) AS k FROM {RUNS}) a LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY tool, sample ORDER BY started, run) AS k FROM {RUNS}) b ON a.tool = b.tool AND a.sample = b.sample AND b.k = 2 WHERE a.k = 1)"


def _pairs(s, d) -> DataFrame:
    """First and second run of each tool and sample."""
    w = Window.partitionBy("tool", "sample").orderBy("started", "run")
    t = runs(s, d).withColumn("k", F.row_number().over(w)).where("k <= 2")
    side = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c)))
    g = t.groupBy("tool", "sample").agg(side(1, "status").alias("a"), side(2, "status").alias("b"), F.abs(side(1, "cents") - side(2, "cents")).alias("delta"))
    return g.select("tool", "sample", F.coalesce((F.col("a") == "success") & (F.col("b") == "success"), F.when(F.col("a") != "success", F.lit(False))).alias("both_ok"), "delta")


@query(f"SELECT tool, sample, both_ok, delta FROM {_PAIR}")
def repeat_pairs(s, d):
    return _pairs(s, d)


@query(f"SELECT tool, count(*) AS requested, count(*) FILTER (both_ok) AS successful, coalesce(quantile_cont(delta, 0.5) FILTER (both_ok), 0) AS median_delta, coalesce(max(delta) FILTER (both_ok), 0) AS largest, count(*) = 5 AND count(*) FILTER (both_ok) = 5 AS stable FROM {_PAIR} GROUP BY tool")
def repeatability(s, d):
    ok = F.col("both_ok")
    g = _pairs(s, d).groupBy("tool").agg(F.count("*").alias("requested"), F.count_if(ok).alias("successful"), F.coalesce(F.percentile(F.when(ok, F.col("delta")), 0.5), F.lit(0.0)).alias("median_delta"), F.coalesce(F.max(F.when(ok, F.col("delta"))), F.lit(0)).alias("largest"))
    return g.withColumn("stable", (F.col("requested") == 5) & (F.col("successful") == 5))


@query(f"SELECT run, CASE WHEN run % 40 = 0 THEN true ELSE cents < 1500 END AS truncated FROM {RUNS}")
def adjudicated(s, d):
    """An adjudication, where there is one, goes before the automatic flag."""
    t = runs(s, d).select("run", (F.col("cents") < 1500).alias("flag"))
    ruled = t.where("run % 40 = 0").select("run", F.lit(True).alias("ruled"))
    return t.join(ruled, "run", "left").select("run", F.coalesce("ruled", "flag").alias("truncated"))


_TOK = "(SELECT {0} AS id, unnest(list_distinct([{1}])) AS tok FROM {2})"


@query(f"SELECT DISTINCT a.id AS card, b.id AS paper FROM {_TOK.format('o_orderkey', chr(39) + 'c' + chr(39) + ' || o_custkey, ' + chr(39) + 'k' + chr(39) + ' || o_orderkey', 'orders')} a JOIN {_TOK.format('c_custkey', chr(39) + 'c' + chr(39) + ' || c_custkey, ' + chr(39) + 'k' + chr(39) + ' || (c_custkey * 7)', 'customer')} b ON a.tok = b.tok")
def any_token_join(s, d):
    """Cards and papers that share any of their tokens."""
    tok = lambda df, key, *xs: df.select(F.col(key).alias("id"), F.explode(F.array_distinct(F.array(*xs))).alias("tok"))
    a = tok(read(s, d, "orders"), "o_orderkey", F.concat(F.lit("c"), "o_custkey"), F.concat(F.lit("k"), "o_orderkey"))
    b = tok(read(s, d, "customer"), "c_custkey", F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("k"), F.col("c_custkey") * 7))
    return a.withColumnRenamed("id", "card").join(b.withColumnRenamed("id", "paper"), "tok").select("card", "paper").distinct()


def _terminal(mode: str) -> str:
    return f"(SELECT sample, run, status FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY run DESC) AS r FROM {RUNS} WHERE tool = '{mode}' AND status <> 'running') WHERE r = 1)"


def _last_terminal(s, d, tool: str) -> DataFrame:
    return identity.latest(runs(s, d).where((F.col("tool") == tool) & (F.col("status") != "running")).select("sample", "run", "status"), ["sample"], [F.col("run")])


@query(f"SELECT c_custkey AS sample, CASE WHEN p.status = 'success' THEN 'primary' WHEN f.status = 'success' THEN 'fallback' END AS mode, CASE WHEN p.status = 'success' THEN p.run WHEN f.status = 'success' THEN f.run END AS run FROM customer LEFT JOIN {_terminal('click')} p ON p.sample = c_custkey LEFT JOIN {_terminal('view')} f ON f.sample = c_custkey")
def preferred_run(s, d):
    """The last ended primary run if it succeeded, else the fallback one."""
    one = lambda tool, x: _last_terminal(s, d, tool).where("status = 'success'").select("sample", F.col("run").alias(x))
    t = read(s, d, "customer").select(F.col("c_custkey").alias("sample")).join(one("click", "p"), "sample", "left").join(one("view", "f"), "sample", "left")
    return t.select("sample", F.when(F.col("p").isNotNull(), "primary").when(F.col("f").isNotNull(), "fallback").alias("mode"), F.coalesce("p", "f").alias("run"))


@query(f"SELECT count(*) AS expected, count(run) AS available, CASE WHEN count(*) = count(run) THEN 'PASS' ELSE 'PARTIAL' END AS verdict FROM (SELECT c_custkey, coalesce(CASE WHEN p.status = 'success' THEN p.run END, CASE WHEN f.status = 'success' THEN f.run END) AS run FROM customer LEFT JOIN {_terminal('click')} p ON p.sample = c_custkey LEFT JOIN {_terminal('view')} f ON f.sample = c_custkey)")
def export_summary(s, d):
    g = preferred_run(s, d).agg(F.count("*").alias("expected"), F.count("run").alias("available"))
    return g.withColumn("verdict", F.when(F.col("expected") == F.col("available"), "PASS").otherwise("PARTIAL"))


@query("SELECT rule, count(DISTINCT l_orderkey) AS supporters, count(DISTINCT o_orderpriority) AS journals, count(DISTINCT l_orderkey) >= 3 AND count(DISTINCT o_orderpriority) >= 2 AND bool_and(o_orderstatus IS NOT NULL) AS promoted FROM (SELECT l_suppkey AS rule, l_orderkey FROM lineitem WHERE l_linenumber = 1) LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P' GROUP BY rule")
def rule_support(s, d):
    """Rules with three supporting cards or more, all of them resolved, from two journals."""
    rules = read(s, d, "lineitem").where("l_linenumber = 1").select(F.col("l_suppkey").alias("rule"), "l_orderkey")
    cards = read(s, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    g = rules.join(cards, "l_orderkey", "left").groupBy("rule").agg(F.countDistinct("l_orderkey").alias("supporters"), F.countDistinct("o_orderpriority").alias("journals"), F.bool_and(F.col("o_orderpriority").isNotNull()).alias("ok"))
    return g.select("rule", "supporters", "journals", ((F.col("supporters") >= 3) & (F.col("journals") >= 2) & F.col("ok")).alias("promoted"))


@query("SELECT p.page_id, p.url, b.item_id FROM pages p LEFT JOIN benchmark b ON p.page_id = b.item_id")
def text_with_bib(s, d):
    return read(s, d, "pages").select("page_id", "url").join(read(s, d, "benchmark").select("item_id"), F.col("page_id") == F.col("item_id"), "left")


@query("SELECT d.doc_id, concat_ws(';', CASE WHEN l.doc_id IS NULL THEN 'card_missing' END, CASE WHEN md5(d.text) <> md5(CASE WHEN d.doc_id % 6 = 0 THEN d.text || 'x' ELSE d.text END) THEN 'hash_mismatch' END, CASE WHEN l.toxic = 1 THEN 'flagged' END) AS issues FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def packet_agreement(s, d):
    """Hashes of packets and sources, and their cards, as a list of issues."""
    docs = read(s, d, "documents")
    packet = docs.select("doc_id", F.md5(F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))).alias("packet"), F.md5("text").alias("source"))
    j = packet.join(read(s, d, "labels"), "doc_id", "left")
    issues = F.concat_ws(";", F.when(F.col("toxic").isNull(), "card_missing"), F.when(F.col("packet") != F.col("source"), "hash_mismatch"), F.when(F.col("toxic") == 1, "flagged"))
    return j.select("doc_id", issues.alias("issues"))


_OLD = "(SELECT o_custkey AS id, min(o_orderkey) AS place FROM orders WHERE o_custkey % 3 = 0 GROUP BY o_custkey)"


@query(f"WITH o AS {_OLD}, m AS (SELECT max(place) AS top FROM o) SELECT c_custkey AS id, coalesce(o.place, m.top + row_number() OVER (PARTITION BY o.place IS NULL ORDER BY c_custkey)) AS reading_order FROM customer LEFT JOIN o ON o.id = c_custkey, m")
def merge_upsert(s, d):
    """Rows keep the reading order that they have; new ones follow by id.

    The places of new rows come from counts of earlier ranges of ids, so no window spans the table.
    """
    old = read(s, d, "orders").where("o_custkey % 3 = 0").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderkey").alias("place"))
    t = read(s, d, "customer").select(F.col("c_custkey").alias("id")).join(old, "id", "left")
    new = select.running_number(t.where("place is null").select("id"), "id", "nth")
    top = old.agg(F.max("place").alias("top"))
    return t.where("place is not null").select("id", F.col("place").alias("reading_order")).unionByName(new.crossJoin(F.broadcast(top)).select("id", (F.col("top") + F.col("nth")).alias("reading_order")))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 5)")
def not_deleted(s, d):
    gone = read(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    parts = read(s, d, "part").where("p_size < 5").select(F.col("p_partkey").alias("l_partkey"))
    return read(s, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").join(gone, "l_orderkey", "left_anti").join(parts, "l_partkey", "left_anti").select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"))


@query("SELECT e.event_id, s.score FROM (SELECT event_id, event_id % 40 AS blind FROM events) e JOIN (SELECT item_id AS blind, length(text) % 5 AS score FROM benchmark WHERE length(text) % 5 BETWEEN 1 AND 4) s ON s.blind = e.blind")
def blind_scores(s, d):
    """Manual scores in range, joined over the blind map; rows out of range go."""
    score = read(s, d, "benchmark").select(F.col("item_id").alias("blind"), (F.length("text") % 5).cast("long").alias("score")).where(F.col("score").between(1, 4))
    return read(s, d, "events").select("event_id", (F.col("event_id") % 40).alias("blind")).join(score, "blind").select("event_id", "score")


@query("SELECT coalesce(a.k, b.k) AS path, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unexpected' WHEN a.n <> b.n THEN 'size' WHEN a.h <> b.h THEN 'hash' ELSE 'ok' END AS issue FROM (SELECT doc_id AS k, length(text) AS n, md5(text) AS h FROM documents WHERE doc_id % 10 <> 1) a FULL JOIN (SELECT doc_id AS k, length(text) + CAST(doc_id % 8 = 0 AS INT) AS n, md5(CASE WHEN doc_id % 9 = 0 THEN upper(text) ELSE text END) AS h FROM documents WHERE doc_id % 10 <> 2) b ON a.k = b.k")
def bundle_check(s, d):
    docs = read(s, d, "documents")
    a = docs.where("doc_id % 10 <> 1").select(F.col("doc_id").alias("path"), F.length("text").alias("n"), F.md5("text").alias("h"))
    text = F.when(F.col("doc_id") % 9 == 0, F.upper("text")).otherwise(F.col("text"))
    b = docs.where("doc_id % 10 <> 2").select(F.col("doc_id").alias("path"), (F.length("text") + (F.col("doc_id") % 8 == 0).cast("int")).alias("m"), F.md5(text).alias("g"))
    j = a.join(b, "path", "full")
    return j.select("path", F.when(F.col("m").isNull(), "missing").when(F.col("n").isNull(), "unexpected").when(F.col("n") != F.col("m"), "size").when(F.col("h") != F.col("g"), "hash").otherwise("ok").alias("issue"))


@query(f"SELECT c_mktsegment AS queue, count(*) AS rows, count(*) FILTER (status = 'running') AS leased, count(*) FILTER (status = 'success') AS completed, count(*) FILTER (status IS NULL OR status = 'failed') AS open FROM customer LEFT JOIN (SELECT sample, arg_max(status, run) AS status FROM {RUNS} GROUP BY sample) ON sample = c_custkey GROUP BY c_mktsegment")
def queue_status(s, d):
    last = runs(s, d).groupBy("sample").agg(F.max_by("status", "run").alias("status"))
    t = read(s, d, "customer").join(last, F.col("sample") == F.col("c_custkey"), "left")
    st = F.col("status")
    return t.groupBy(F.col("c_mktsegment").alias("queue")).agg(F.count("*").alias("rows"), F.count_if(st == "running").alias("leased"), F.count_if(st == "success").alias("completed"), F.count_if(st.isNull() | (st == "failed")).alias("open"))


@query("SELECT l_orderkey AS batch, count(*) AS items, count(*) FILTER (p_size >= 10) AS verified, bool_and(p_size >= 10) AS passed FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY l_orderkey")
def batch_verification(s, d):
    live = read(s, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    items = read(s, d, "lineitem").select("l_orderkey", "l_partkey").join(live, "l_orderkey", "left_semi")
    t = items.join(read(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    return t.groupBy(F.col("l_orderkey").alias("batch")).agg(F.count("*").alias("items"), F.count_if(F.col("p_size") >= 10).alias("verified"), F.bool_and(F.col("p_size") >= 10).alias("passed"))


@query("SELECT c_custkey AS id, coalesce(n.status, o.status, 'pending') AS status FROM customer LEFT JOIN (SELECT DISTINCT user_id, 'override' AS status FROM events WHERE event_id % 3 = 0) n ON n.user_id = c_custkey LEFT JOIN (SELECT DISTINCT o_custkey, 'downloaded' AS status FROM orders WHERE o_orderstatus = 'O') o ON o.o_custkey = c_custkey")
def manifest_overlay(s, d):
    """Download state onto the rows, then overrides, which win; the same joins upsert overrides."""
    state = read(s, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("id")).distinct().withColumn("a", F.lit("downloaded"))
    over = read(s, d, "events").where("event_id % 3 = 0").select(F.col("user_id").alias("id")).distinct().withColumn("b", F.lit("override"))
    t = read(s, d, "customer").select(F.col("c_custkey").alias("id")).join(state, "id", "left").join(over, "id", "left")
    return t.select("id", F.coalesce("b", "a", F.lit("pending")).alias("status"))


# ---- aggregates, windows, sets ----


@query("SELECT count(*) AS manifest, count(l.doc_id) AS records, floor(count(l.doc_id) * 1e4 / count(*) + 0.5) / 1e4 AS completion, greatest(count(*) - 2 * count(l.doc_id), 0) AS reserve FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def corpus_stats(s, d):
    j = ids(s, d, "documents", "doc_id").join(read(s, d, "labels").select("doc_id", F.lit(1).alias("r")), "doc_id", "left")
    g = j.agg(F.count("*").alias("manifest"), F.count("r").alias("records"))
    return g.select("manifest", "records", T.scaled(F.col("records"), F.col("manifest")).alias("completion"), F.greatest(F.col("manifest") - 2 * F.col("records"), F.lit(0)).alias("reserve"))


_AUDIT = {
    "duplicate_text": ("SELECT count(*) FROM (SELECT 1 FROM documents GROUP BY md5(text) HAVING count(*) > 1)", None),
    "missing_source": ("SELECT count(*) FROM documents WHERE source IS NULL", None),
    "zero_content": ("SELECT count(*) FROM documents WHERE length(trim(text)) = 0", None),
    "unlabelled": ("SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)", None),
    "mismatched_length": ("SELECT count(*) FROM documents WHERE length(text) <> n_chars", None),
}


@query("SELECT *, CASE WHEN issue IN ('mismatched_length', 'missing_source') AND n > 0 THEN 'invalid' WHEN n > 0 THEN 'partial' ELSE 'ready' END AS verdict FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS issue, ({q}) AS n" for k, (q, _) in _AUDIT.items()) + ")")
def corpus_audit(s, d):
    """Structural checks and what each means for the corpus, in one pass besides the duplicates."""
    docs = read(s, d, "documents").join(read(s, d, "labels").select("doc_id", F.lit(1).alias("r")), "doc_id", "left")
    flat = docs.agg(
        F.count_if(F.col("source").isNull()).alias("missing_source"), F.count_if(F.length(F.trim("text")) == 0).alias("zero_content"),
        F.count_if(F.col("r").isNull()).alias("unlabelled"), F.count_if(F.length("text") != F.col("n_chars")).alias("mismatched_length"),
    )
    one = flat.select(F.explode(F.array(*[F.struct(F.lit(c).alias("issue"), F.col(c).alias("n")) for c in flat.columns])).alias("x")).select("x.*")
    twice = read(s, d, "documents").groupBy(F.md5("text").alias("h")).agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("n")).select(F.lit("duplicate_text").alias("issue"), "n")
    fatal = F.col("issue").isin("mismatched_length", "missing_source")
    return one.unionByName(twice).withColumn("verdict", F.when(fatal & (F.col("n") > 0), "invalid").when(F.col("n") > 0, "partial").otherwise("ready"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY source, md5(text), doc_id) AS r FROM documents) WHERE r > 1")
def duplicate_hash_after_order(s, d):
    t = read(s, d, "documents").select("doc_id", "source", F.md5("text").alias("h"))
    kept = identity.first_wins(t, ["h"], [F.col("source"), F.col("doc_id")]).select("doc_id")
    return t.select("doc_id").join(kept, "doc_id", "left_anti")


@query(f"SELECT tool, count(*) AS runs, CAST(sum(cents) AS BIGINT) AS cents, count(DISTINCT sample) AS samples, count(*) FILTER (status = 'success') AS clean, coalesce(quantile_cont(cents, 0.5) FILTER (status = 'success'), 0) AS median, count(*) FILTER (status = 'success') >= 900 AND count(*) FILTER (status = 'failed') <= 400 AS eligible FROM {RUNS} GROUP BY tool")
def tool_gates(s, d):
    """Totals of each tool: means over all runs, medians over successes, and whether it is eligible."""
    ok = F.col("status") == "success"
    g = runs(s, d).groupBy("tool").agg(F.count("*").alias("runs"), F.sum("cents").alias("cents"), F.countDistinct("sample").alias("samples"), F.count_if(ok).alias("clean"), F.coalesce(F.percentile(F.when(ok, F.col("cents")), 0.5), F.lit(0.0)).alias("median"), F.count_if(F.col("status") == "failed").alias("bad"))
    return g.select("tool", "runs", "cents", "samples", "clean", "median", ((F.col("clean") >= 900) & (F.col("bad") <= 400)).alias("eligible"))


@query("SELECT lang, hits, least(hits, 300) AS candidate_limit, hits // 4 AS quota FROM (SELECT lang, count(*) AS hits FROM documents GROUP BY lang)")
def stratum_estimate(s, d):
    g = read(s, d, "documents").groupBy("lang").agg(F.count("*").alias("hits"))
    return g.select("lang", "hits", F.least("hits", F.lit(300)).alias("candidate_limit"), F.floor(F.col("hits") / 4).alias("quota"))


@query(_terminal("error")[1:-1])
def last_terminal_attempt(s, d):
    return _last_terminal(s, d, "error")


@query("SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag = 'R', l_quantity DESC, l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS r FROM lineitem) WHERE r = 1")
def best_attachment(s, d):
    t = read(s, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), (F.col("l_returnflag") == "R").alias("cue"), (-F.col("l_quantity")).alias("q"), (-F.col("l_extendedprice")).alias("p"), "l_partkey", "l_suppkey")
    return identity.first_wins(t, ["l_orderkey"], [F.col(c) for c in ("cue", "q", "p", "l_partkey", "l_suppkey", "l_linenumber")]).select("l_orderkey", "l_linenumber")


@query(f"SELECT sample, min(run) AS first_run, count(*) AS runs FROM (SELECT *, sum(CASE WHEN gap <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY sample ORDER BY k) AS island FROM (SELECT sample, run, k, k - lag(k) OVER (PARTITION BY sample ORDER BY k) AS gap FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY started, run) AS k FROM {RUNS}) WHERE status = 'success')) GROUP BY sample, island HAVING count(*) >= 8")
def gap_tolerant_runs(s, d):
    """Stretches of successes with at most one other run between two of them, of eight or more."""
    w = Window.partitionBy("sample").orderBy("started", "run")
    t = runs(s, d).withColumn("k", F.row_number().over(w)).where("status = 'success'")
    v = Window.partitionBy("sample").orderBy("k")
    t = t.withColumn("begins", F.when(F.col("k") - F.lag("k").over(v) <= 2, 0).otherwise(1)).withColumn("island", F.sum("begins").over(v))
    return t.groupBy("sample", "island").agg(F.min("run").alias("first_run"), F.count("*").alias("runs")).where("runs >= 8").select("sample", "first_run", "runs")


@query("SELECT doc_id, r = 1 AS pilot, r IN (1, 5, 10) AS manual FROM (SELECT doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY sha256(CAST(doc_id AS VARCHAR))) AS r FROM documents) WHERE r <= 10")
def pilot_flags(s, d):
    r = F.row_number().over(Window.partitionBy("source", "lang").orderBy(F.sha2(F.col("doc_id").cast("string"), 256)))
    t = read(s, d, "documents").select("doc_id", "source", "lang").withColumn("r", r).where("r <= 10")
    return t.select("doc_id", (F.col("r") == 1).alias("pilot"), F.col("r").isin(1, 5, 10).alias("manual"))


@query("SELECT conv_id, turn, CASE WHEN r1 = 'assistant' THEN turn + 1 WHEN r2 = 'assistant' THEN turn + 2 END AS linked FROM (SELECT conv_id, turn, role, lead(role) OVER w AS r1, lead(role, 2) OVER w AS r2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user'")
def lead_search(s, d):
    """The line, among the next two, that a claim is linked from."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = read(s, d, "conversations").select("conv_id", "turn", "role", F.lead("role").over(w).alias("a"), F.lead("role", 2).over(w).alias("b"))
    return t.where("role = 'user'").select("conv_id", "turn", F.when(F.col("a") == "assistant", F.col("turn") + 1).when(F.col("b") == "assistant", F.col("turn") + 2).alias("linked"))


@query(f"SELECT tool, sample, max(run % 100) + 1 AS attempt FROM {RUNS} GROUP BY tool, sample")
def next_attempt(s, d):
    return runs(s, d).groupBy("tool", "sample").agg((F.max(F.col("run") % 100) + 1).alias("attempt"))


@query("SELECT doc_id FROM documents WHERE doc_id % 9 <> 0 ORDER BY n_chars, lang, sha256(CAST(doc_id AS VARCHAR)), doc_id LIMIT 25")
def claim_batch(s, d):
    t = read(s, d, "documents").where("doc_id % 9 <> 0").select("doc_id", "n_chars", "lang")
    return t.orderBy("n_chars", "lang", F.sha2(F.col("doc_id").cast("string"), 256), "doc_id").limit(25).select("doc_id")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 10")
def worst_ten(s, d):
    return read(s, d, "documents").select("doc_id", "n_chars").orderBy("n_chars", "doc_id").limit(10)


@query("WITH n AS (SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents), i AS (SELECT doc_id, n, least(n, 40) AS k FROM n) SELECT doc_id, CAST(unnest(list_distinct(list_transform(range(k), lambda i: round_even(i * (n - 1) / greatest(k - 1, 1), 0)))) AS BIGINT) AS anchor FROM i")
def even_anchors(s, d):
    n = F.size(F.split("text", "\n"))
    return read(s, d, "documents").select("doc_id", F.explode(select.evenly_spaced(n)).alias("anchor"))


@query("SELECT doc_id FROM (SELECT doc_id FROM documents WHERE lang = 'en' INTERSECT SELECT doc_id FROM labels WHERE quality = 1)")
def active_parsed(s, d):
    return read(s, d, "documents").where("lang = 'en'").select("doc_id").intersect(read(s, d, "labels").where("quality = 1").select("doc_id"))


@query("SELECT user_id AS id FROM events WHERE event_type = 'click' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def active_ids(s, d):
    a = read(s, d, "events").where("event_type = 'click'").select(F.col("user_id").alias("id"))
    b = read(s, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return a.union(b).union(read(s, d, "customer").where("c_acctbal < 0").select("c_custkey")).distinct()


@query("SELECT conv_id, len(list_filter(range(n), lambda i: NOT list_contains(have, i))) AS missing, len(list_filter(have, lambda t: t >= n)) AS extra, have = list_sort(have) AS ordered FROM (SELECT conv_id, list(turn ORDER BY length(text), turn) AS have, count(*) + 1 AS n FROM conversations GROUP BY conv_id)")
def locator_lists(s, d):
    """Locators that are missing, extra or out of order, against the list that ought to be."""
    t = read(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.length("text").alias("n"), "turn"))).alias("a"))
    have = F.transform("a", lambda x: x["turn"])
    want = F.sequence(F.lit(0).cast("long"), F.size("a").cast("long"))
    return t.select("conv_id", F.size(F.array_except(want, have)).cast("long").alias("missing"), F.size(F.array_except(have, want)).cast("long").alias("extra"), (have == F.array_sort(have)).alias("ordered"))


@query("SELECT doc_id, 'old' AS part FROM labels UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def append_only_union(s, d):
    old = read(s, d, "labels").select("doc_id")
    return old.withColumn("part", F.lit("old")).unionByName(ids(s, d, "documents", "doc_id").join(old, "doc_id", "left_anti").withColumn("part", F.lit("new")))


@query("SELECT doc_id, coalesce(TRY_CAST(substr(regexp_replace(md5(text), '[a-f]', '', 'g'), 1, 4) AS INTEGER), 0) AS n, coalesce(CASE WHEN regexp_matches(md5(text), '^[0-9]{3}') THEN CAST(substr(md5(text), 1, 3) AS INTEGER) END, -1) AS m FROM documents")
def safe_int(s, d):
    h = F.md5("text")
    n = F.substring(F.regexp_replace(h, "[a-f]", ""), 1, 4)
    return read(s, d, "documents").select("doc_id", F.coalesce(n.try_cast("int"), F.lit(0)).alias("n"), F.coalesce(F.when(F.regexp_like(h, F.lit("^[0-9]{3}")), F.substring(h, 1, 3)).try_cast("int"), F.lit(-1)).alias("m"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, CAST(floor(epoch(ts)) AS BIGINT) AS epoch FROM events")
def iso_times(s, d):
    t = F.col("ts").cast("timestamp")
    return read(s, d, "events").select("event_id", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.unix_seconds(t).alias("epoch"))


@query("SELECT conv_id, sha256(string_agg(turn || ' ' || md5(text), chr(10) ORDER BY turn)) AS tree FROM conversations GROUP BY conv_id")
def tree_digest(s, d):
    """Digest of a tree of files (a conversation and its turns): a hash of the sorted lines of names and hashes."""
    line = F.concat_ws(" ", "turn", F.md5("text"))
    g = read(s, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("a"))
    return g.select("conv_id", F.sha2(F.array_join(F.transform("a", lambda x: x["l"]), "\n"), 256).alias("tree"))


@query("SELECT page_id, CAST(words AS BIGINT) AS words, CASE WHEN words < 200 THEN 'short' WHEN words < 1000 THEN 'medium' ELSE 'long' END AS size FROM (SELECT page_id, len(regexp_extract_all(html, '[A-Za-z]+(?:[-''][A-Za-z]+)?')) AS words FROM pages)")
def batch_size_policy(s, d):
    w = T.word_count(F.col("html"))
    return read(s, d, "pages").select("page_id", w.alias("words"), F.when(w < 200, "short").when(w < 1000, "medium").otherwise("long").alias("size"))

"""Queries on documents and conversations: text primitives, distributions, identity, screening, chunks, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholia.functions import text as T
from scholia.operators import identity, select
from scholia.sources.tables import read

from .profile import SENTENCES_SQL, WORDS_SQL


def docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents")


def lines(df: DataFrame) -> DataFrame:
    """doc_id, ord (from 1), line."""
    return df.select("doc_id", F.posexplode(F.split("text", "\n")).alias("o", "line")).select("doc_id", (F.col("o") + 1).cast("long").alias("ord"), "line")


LINES_SQL = "(SELECT doc_id, unnest(range(1, len(l) + 1)) AS ord, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"


def word_count(s, d):
    return docs(s, d).select("doc_id", T.word_count(F.col("text")).alias("words"))


def sentence_count(s, d):
    return docs(s, d).select("doc_id", F.size(T.sentences(F.col("text"))).cast("long").alias("sentences"))


def doc_sha256(s, d):
    return docs(s, d).select("doc_id", F.sha2("text", 256).alias("sha256"))


def compact_text(s, d):
    return docs(s, d).select("doc_id", F.length(T.compact(F.col("text"))).cast("long").alias("n"), F.md5(T.compact(F.col("text"))).alias("h"))


def title_norm(s, d):
    first = F.substring_index("text", "\n", 1)
    return docs(s, d).select("doc_id", T.title_key(first).alias("title_key"))


def doi_norm(s, d):
    made = F.concat(F.lit(" HTTPS://doi.org/10.1000/"), F.col("source"), F.lit("."), F.col("doc_id"), F.lit(".)"))
    return docs(s, d).select("doc_id", T.doi(made).alias("doi"))


def first_person_density(s, d):
    c = docs(s, d).select("doc_id", T.first_person(F.col("text")).alias("hits"), T.word_count(F.col("text")).alias("words"))
    return c.select("doc_id", "hits", T.scaled(F.col("hits") * 1000, F.greatest("words", F.lit(1))).alias("per_1000"))


def describe_by_lang(s, d):
    w = docs(s, d).select("lang", T.word_count(F.col("text")).alias("w"))
    q = F.percentile("w", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    g = w.groupBy("lang").agg(F.count("*").alias("n"), F.sum("w").alias("t"), q.alias("q"))
    return g.select("lang", "n", T.scaled(F.col("t"), F.col("n")).alias("mean"), F.col("q")[1].alias("median"), F.col("q")[0].alias("p25"), F.col("q")[2].alias("p75"))


def top_terms_first_seen(s, d):
    """The ten commonest words of each language, ties by first occurrence."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    w = docs(s, d).select("lang", "doc_id", F.posexplode(words).alias("pos", "term"))
    # document and place in one number, so that counts stay in a hash table
    g = w.groupBy("lang", "term").agg(F.count("*").alias("n"), F.min(F.shiftleft(F.col("doc_id"), 24) + F.col("pos")).alias("first"))
    r = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "first"))
    return g.withColumn("rank", r.cast("long")).where("rank <= 10").select("lang", "rank", "term", "n")


MARKERS = {"contrast": "(?:however|but|although|mais|aber|pero)", "cause": "(?:because|therefore|thus|donc|daher)", "aim": "(?:aim|goal|objective|that|this)"}


def marker_prevalence(s, d):
    flags = [F.coalesce(F.regexp_like("text", F.lit(rf"(?i)\b{p}\b")), F.lit(False)).cast("long").alias(k) for k, p in MARKERS.items()]
    return docs(s, d).select("lang", *flags).groupBy("lang").agg(F.count("*").alias("n"), *[F.sum(k).alias(k) for k in MARKERS])


ASCII_SQL = r"regexp_replace(text, '[^\x00-\x7F\P{L}]', 'x', 'g')"


def move_counts(s, d):
    counts = [F.coalesce(F.regexp_count("text", F.lit(rf"(?i)\b{p}\b")), F.lit(0)).cast("long").alias(k) for k, p in MARKERS.items()]
    return docs(s, d).select("doc_id", *counts)


def move_sequence_top(s, d):
    at = lambda k, p: F.when(F.regexp_instr("text", F.lit(rf"(?i)\b{p}\b")) > 0, F.struct(F.regexp_instr("text", F.lit(rf"(?i)\b{p}\b")).alias("at"), F.lit(k).alias("name")))
    seq = F.array_join(F.array_sort(F.array_compact(F.array(*[at(k, p) for k, p in MARKERS.items()])))["name"], ">")
    return docs(s, d).select(seq.alias("sequence")).groupBy("sequence").agg(F.count("*").alias("n"))


def duplicate_texts(s, d):
    return identity.duplicate_values(docs(s, d).select(F.sha2("text", 256).alias("h")), F.col("h"))


def first_row_wins(s, d):
    return identity.first_wins(docs(s, d).select(F.sha2("text", 256).alias("h"), "doc_id", "source"), ["h"], [F.col("doc_id")])


def merge_fill_if_empty(s, d):
    rows = docs(s, d).select(F.sha2("text", 256).alias("h"), "doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source"), "n_chars", F.array("lang").alias("strata"), (F.col("doc_id") % 2 == 0).alias("open"))
    return identity.merge_candidates(rows, "h", "doc_id", ["source"], ["n_chars"], ["strata"], ["open"]).select("h", "source", "n_chars", F.array_join("strata", ";").alias("strata"), "open")


KINDS = [("review", "(?i)^(?:the|in)\\b"), ("protocol", "(?i)^of\\b"), ("editorial", "(?i)^(?:la|der)\\b")]


def kind_classifier(s, d):
    kind = F.lit("other_substantive")
    for name, p in reversed(KINDS):
        kind = F.when(F.regexp_like("text", F.lit(p)), F.lit(name)).otherwise(kind)
    return docs(s, d).select("doc_id", kind.alias("kind"))


FEATURES = {"animal": "rat", "model": "mod", "trial": "tri", "imaging": "ima"}


def feature_multilabel(s, d):
    """Raw substring cues, as an ordered list; 'unclassified' if there are none."""
    low = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(c)), F.lit(k)) for k, c in FEATURES.items()]))
    return docs(s, d).select("doc_id", F.when(F.size(found) == 0, F.lit("unclassified")).otherwise(F.array_join(found, ";")).alias("features"))


def exclusion_reasons(s, d):
    n = T.word_count(F.col("text"))
    reasons = F.array_compact(F.array(F.when(n == 0, "zero_content"), F.when(n < 50, "non_substantive"), F.when(F.contains("text", F.lit("!!")), "shouting"), F.when(n < 50, "non_substantive")))
    return docs(s, d).select("doc_id", F.array_join(F.array_distinct(reasons), ";").alias("reasons"))


def screening_rollup(s, d):
    n = T.word_count(F.col("text"))
    rows = docs(s, d).select(F.col("source").alias("stratum"), (n >= 50).alias("eligible"), ((n >= 50) & (F.col("doc_id") % 10 == 0)).alias("selected"))
    return rows.groupBy("stratum").agg(F.count("*").alias("screened"), F.count_if("eligible").alias("eligible"), F.count_if("selected").alias("selected"))


def coverage_matrix(s, d):
    lab = read(s, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "invalid").when(F.col("quality") == 1, "completed").otherwise("pending").alias("status"))
    rows = docs(s, d).select("doc_id", "lang", "source").join(lab, "doc_id")
    cats = rows.select("status", F.explode(F.array(F.struct(F.lit("lang").alias("category"), F.col("lang").alias("value")), F.struct(F.lit("source").alias("category"), F.col("source").alias("value")))).alias("c"))
    g = cats.groupBy("c.category", "c.value").agg(F.count("*").alias("selected"), *[F.count_if(F.col("status") == k).alias(k) for k in ("completed", "pending", "invalid")])
    return g


def rank_in_stratum(s, d):
    lab = read(s, d, "labels").select("doc_id", "quality")
    rows = docs(s, d).select("doc_id", "lang", "n_chars").join(lab, "doc_id")
    # buckets of quality and 64 characters, so that no language is sorted in one task
    rows = rows.withColumn("bucket", F.floor(-(F.col("quality") * F.lit(float(1 << 32)) + F.col("n_chars")) / 64))
    order = [F.desc("quality"), F.desc("n_chars"), F.col("doc_id")]
    return select.numbered(rows, ["lang"], "bucket", order, "rank").select("doc_id", "lang", F.col("rank").cast("long").alias("rank"))


def quota_select(s, d):
    rows = docs(s, d).select(F.col("doc_id").alias("k"), F.array("lang").alias("strata"), F.struct((-F.col("n_chars")).alias("n"), "doc_id").alias("r"))
    out = select.quota_select(rows, [("de", 5), ("en", 7), ("fr", 3)], 30, "k", "strata", "r")
    return out.select(F.col("k").alias("doc_id"), F.col("selection_rank").cast("long").alias("selection_rank"))


def hash_repeat_sample(s, d):
    return select.hash_sample(docs(s, d).select("doc_id"), F.col("doc_id").cast("string"), "repeat", 5)


def blind_labels(s, d):
    tools = docs(s, d).select("doc_id", F.explode(F.array(*[F.lit(t) for t in ("alpha", "beta", "gamma")])).alias("tool"))
    r = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.sha2(F.concat(F.lit("blind"), F.col("doc_id").cast("string"), F.col("tool")), 256)))
    return tools.select("doc_id", "tool", F.char(r + 64).alias("label"))


def shard_assignment(s, d):
    return docs(s, d).select("doc_id", select.shard(F.concat(F.lit("PMC"), F.col("doc_id").cast("string")), 7).alias("shard"))


def round_robin_sample(s, d):
    out = select.round_robin_sample(docs(s, d).select("doc_id", "lang"), "lang", F.col("doc_id").cast("string"), 50)
    return out.select("doc_id", "lang", F.col("position").cast("long").alias("position"))


def diversity_select(s, d):
    rows = docs(s, d).select("lang", F.col("doc_id").cast("string").alias("id"), "source", F.substring("text", 1, 1).alias("kind"), F.floor(F.col("n_chars") / 1000).cast("string").alias("year"), F.array("source").alias("features"))
    return select.diversity_select(rows, "lang", "id", 5, ["source", "kind", "year"], "features")


def fixed_chunks(s, d):
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs(s, d).select("doc_id", words.alias("w")).where(F.size("w") > 0)
    rows = rows.select("doc_id", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 100).cast("int"))).alias("c"))
    return rows.select("doc_id", (F.col("c") + 1).cast("long").alias("chunk"), F.md5(F.array_join(F.slice("w", F.col("c") * 100 + 1, 100), " ")).alias("h"))


def locators(s, d):
    """Chunk locators S%03d:C%02d of a conversation's turns in chunks of 20 words."""
    rows = read(s, d, "conversations").select("conv_id", "turn", T.word_count(F.col("text")).alias("w"))
    n = F.greatest(F.ceil(F.col("w") / 20), F.lit(1)).cast("int")
    rows = rows.select("conv_id", "turn", F.explode(F.sequence(F.lit(1), n)).alias("c"))
    return rows.select("conv_id", F.format_string("S%03d:C%02d", F.col("turn") + 1, F.col("c")).alias("locator"))


def greedy_pack(s, d):
    """Lines packed in order into chunks of at most 150 words."""
    sizes = F.transform(F.split("text", "\n"), lambda x: F.greatest(F.coalesce(F.regexp_count(x, F.lit(T.ASCII_WORD)), F.lit(0)), F.lit(1)))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"))
    step = lambda a, x: F.when((a["n"] == 0) | (a["used"] + x > 150), F.struct((a["n"] + 1).alias("n"), x.alias("used"))).otherwise(F.struct(a["n"].alias("n"), (a["used"] + x).alias("used")))
    return docs(s, d).select("doc_id", F.aggregate(sizes, zero, step, lambda a: a["n"]).cast("long").alias("chunks"))


def repeated_paragraphs(s, d):
    rows = lines(docs(s, d)).where(F.length("line") >= 60)
    nth = F.row_number().over(Window.partitionBy("doc_id", F.lower("line")).orderBy("ord"))
    return rows.withColumn("nth", nth).where("nth > 1").groupBy("doc_id").agg(F.count("*").alias("repeated"))


def uniform_rhythm(s, d):
    """Documents with five sentences in a row whose lengths differ by five words at most."""
    n = F.transform(T.sentences(F.col("text")), lambda x: F.regexp_count(x, F.lit(T.ASCII_WORD)))
    narrow = lambda n: (F.size(n) >= 5) & F.exists(F.sequence(F.lit(1), F.greatest(F.size(n) - 4, F.lit(1))), lambda i: F.array_max(F.slice(n, i, 5)) - F.array_min(F.slice(n, i, 5)) <= 5)
    return docs(s, d).where(T.let(n, narrow)).select("doc_id")


def long_sentences(s, d):
    n = F.filter(T.sentences(F.col("text")), lambda x: F.regexp_count(x, F.lit(T.ASCII_WORD)) > 50)
    return docs(s, d).select("doc_id", F.size(n).cast("long").alias("n")).where("n > 0")


def section_order(s, d):
    """Consecutive-distinct roles of a conversation, joined."""
    rows = identity.collapse_runs(read(s, d, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"], "role")
    return rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ">").alias("roles"))


def contiguity(s, d):
    """Turns that don't follow the one before by one, where turns of some lengths are taken out."""
    before = F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn"))
    return read(s, d, "conversations").where("length(text) % 7 <> 0").select("conv_id", "turn", before.alias("before")).where("coalesce(before, -1) + 1 <> turn").select("conv_id", "turn")


SENT_LENGTHS = SENTENCES_SQL.removeprefix("len(").removesuffix(")")
_W = "len(regexp_extract_all(s, '[A-Za-z]+(?:[-''][A-Za-z]+)?'))"
_M = {k: rf"(?i)\b{p}\b" for k, p in MARKERS.items()}

QUERIES = {
    "word_count": (word_count, f"SELECT doc_id, CAST({WORDS_SQL} AS BIGINT) AS words FROM documents"),
    "sentence_count": (sentence_count, f"SELECT doc_id, CAST({SENTENCES_SQL} AS BIGINT) AS sentences FROM documents"),
    "doc_sha256": (doc_sha256, "SELECT doc_id, sha256(text) AS sha256 FROM documents"),
    "compact_text": (compact_text, r"SELECT doc_id, length(t) AS n, md5(t) AS h FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)"),
    "title_norm": (title_norm, r"SELECT doc_id, regexp_replace(replace(lower(split_part(text, chr(10), 1)), 'ß', 'ss'), '[^\p{L}\p{N}]', '', 'g') AS title_key FROM documents"),
    "doi_norm": (doi_norm, "SELECT doc_id, '10.1000/' || source || '.' || doc_id AS doi FROM documents"),
    "first_person_density": (
        first_person_density,
        rf"SELECT doc_id, CAST(h AS BIGINT) AS hits, floor(h * 1000 / greatest(w, 1) * 1e4 + 0.5) / 1e4 AS per_1000 FROM (SELECT doc_id, len(regexp_extract_all({ASCII_SQL}, '(?i)\b(?:we|our|us)\b')) AS h, {WORDS_SQL} AS w FROM documents)",
    ),
    "describe_by_lang": (
        describe_by_lang,
        f"SELECT lang, count(*) AS n, floor(CAST(sum(w) AS BIGINT) / count(*) * 1e4 + 0.5) / 1e4 AS mean, quantile_cont(w, 0.5) AS median, quantile_cont(w, 0.25) AS p25, quantile_cont(w, 0.75) AS p75 FROM (SELECT lang, {WORDS_SQL} AS w FROM documents) GROUP BY lang",
    ),
    "top_terms_first_seen": (
        top_terms_first_seen,
        "WITH t AS (SELECT lang, doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM (SELECT lang, doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents)), g AS (SELECT lang, term, count(*) AS n, min({'a': doc_id, 'b': pos}) AS f FROM t GROUP BY lang, term) SELECT lang, rank, term, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, f) AS rank FROM g) WHERE rank <= 10",
    ),
    "marker_prevalence": (
        marker_prevalence,
        f"SELECT lang, count(*) AS n, {', '.join(f'CAST(sum(CAST(regexp_matches({ASCII_SQL}, {p!r}) AS BIGINT)) AS BIGINT) AS {k}' for k, p in _M.items())} FROM documents GROUP BY lang".replace("\\\\b", "\\b"),
    ),
    "move_counts": (
        move_counts,
        f"SELECT doc_id, {', '.join(f'CAST(len(regexp_extract_all({ASCII_SQL}, {p!r})) AS BIGINT) AS {k}' for k, p in _M.items())} FROM documents".replace("\\\\b", "\\b"),
    ),
    "move_sequence_top": (
        move_sequence_top,
        (
            "WITH m AS ("
            + " UNION ALL ".join(rf"SELECT doc_id, '{k}' AS name, length(regexp_extract({ASCII_SQL}, '(?is)^(.*?)\b{p}\b', 1)) + 1 AS at_ FROM documents WHERE regexp_matches({ASCII_SQL}, '(?i)\b{p}\b')" for k, p in MARKERS.items())
            + ") SELECT sequence, count(*) AS n FROM (SELECT d.doc_id, coalesce(string_agg(name, '>' ORDER BY at_, name), '') AS sequence FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id GROUP BY d.doc_id) GROUP BY sequence"
        ),
    ),
    "duplicate_texts": (duplicate_texts, "SELECT sha256(text) AS value, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1"),
    "first_row_wins": (first_row_wins, "SELECT h, doc_id, source FROM (SELECT sha256(text) AS h, doc_id, source, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1"),
    "merge_fill_if_empty": (
        merge_fill_if_empty,
        "SELECT sha256(text) AS h, arg_min(source, doc_id) FILTER (doc_id % 3 <> 0) AS source, max(n_chars) AS n_chars, array_to_string(list_sort(list(DISTINCT lang)), ';') AS strata, bool_or(doc_id % 2 = 0) AS open FROM documents GROUP BY 1",
    ),
    "kind_classifier": (
        kind_classifier,
        f"SELECT doc_id, CASE {' '.join(rf'''WHEN regexp_matches({ASCII_SQL}, '{p}') THEN '{k}' ''' for k, p in KINDS)} ELSE 'other_substantive' END AS kind FROM documents",
    ),
    "feature_multilabel": (
        feature_multilabel,
        f"SELECT doc_id, coalesce(nullif(concat_ws(';', {', '.join(f'CASE WHEN contains(lower(text), {c!r}) THEN {k!r} END' for k, c in FEATURES.items())}), ''), 'unclassified') AS features FROM documents",
    ),
    "exclusion_reasons": (
        exclusion_reasons,
        f"SELECT doc_id, concat_ws(';', CASE WHEN w = 0 THEN 'zero_content' END, CASE WHEN w < 50 THEN 'non_substantive' END, CASE WHEN contains(text, '!!') THEN 'shouting' END) AS reasons FROM (SELECT *, {WORDS_SQL} AS w FROM documents)",
    ),
    "screening_rollup": (
        screening_rollup,
        f"SELECT source AS stratum, count(*) AS screened, count(*) FILTER (w >= 50) AS eligible, count(*) FILTER (w >= 50 AND doc_id % 10 = 0) AS selected FROM (SELECT *, {WORDS_SQL} AS w FROM documents) GROUP BY source",
    ),
    "coverage_matrix": (
        coverage_matrix,
        "WITH r AS (SELECT lang, source, CASE WHEN toxic = 1 THEN 'invalid' WHEN quality = 1 THEN 'completed' ELSE 'pending' END AS status FROM documents JOIN labels USING (doc_id)), c AS (SELECT 'lang' AS category, lang AS value, status FROM r UNION ALL SELECT 'source', source, status FROM r) SELECT category, value, count(*) AS selected, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'invalid') AS invalid FROM c GROUP BY category, value",
    ),
    "rank_in_stratum": (rank_in_stratum, "SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY quality DESC, n_chars DESC, doc_id) AS rank FROM documents JOIN labels USING (doc_id)"),
    "quota_select": (
        quota_select,
        "WITH b AS (SELECT doc_id, lang, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS r FROM documents), q AS (SELECT *, CASE WHEN lang = 'de' AND k <= 5 THEN 0 WHEN lang = 'en' AND k <= 7 THEN 1 WHEN lang = 'fr' AND k <= 3 THEN 2 ELSE 3 END AS turn FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY r) AS k FROM b)) SELECT doc_id, row_number() OVER (ORDER BY turn, r) AS selection_rank FROM q QUALIFY selection_rank <= 30",
    ),
    "hash_repeat_sample": (hash_repeat_sample, "SELECT doc_id FROM documents ORDER BY sha256('repeat' || doc_id) LIMIT 5"),
    "blind_labels": (
        blind_labels,
        "SELECT doc_id, tool, chr(CAST(64 + row_number() OVER (PARTITION BY doc_id ORDER BY sha256('blind' || doc_id || tool)) AS INTEGER)) AS label FROM documents, (SELECT unnest(['alpha', 'beta', 'gamma']) AS tool)",
    ),
    "shard_assignment": (
        shard_assignment,
        "SELECT doc_id, CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(sha256('pmc' || doc_id), ''), lambda c: CAST(strpos('0123456789abcdef', c) - 1 AS BIGINT))), lambda a, x: (a * 16 + x) % 7) AS BIGINT) AS shard FROM documents",
    ),
    "round_robin_sample": (round_robin_sample, None),
    "diversity_select": (diversity_select, None),
    "fixed_chunks": (
        fixed_chunks,
        r"WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents), c AS (SELECT doc_id, w, unnest(range(CAST(ceil(len(w) / 100.0) AS BIGINT))) AS c FROM w) SELECT doc_id, c + 1 AS chunk, md5(array_to_string(w[c * 100 + 1 : c * 100 + 100], ' ')) AS h FROM c",
    ),
    "locators": (
        locators,
        f"SELECT conv_id, 'S' || lpad(CAST(turn + 1 AS VARCHAR), 3, '0') || ':C' || lpad(CAST(c AS VARCHAR), 2, '0') AS locator FROM (SELECT conv_id, turn, unnest(range(1, CAST(greatest(ceil({WORDS_SQL} / 20.0), 1) AS BIGINT) + 1)) AS c FROM conversations)",
    ),
    "greedy_pack": (
        greedy_pack,
        "SELECT doc_id, CAST(list_reduce(list_prepend({'n': CAST(0 AS BIGINT), 'u': CAST(0 AS BIGINT)}, list_transform(string_split(text, chr(10)), lambda s: {'n': CAST(0 AS BIGINT), 'u': CAST(greatest(len(regexp_extract_all(s, '[A-Za-z]+(?:[-''][A-Za-z]+)?')), 1) AS BIGINT)})), lambda a, x: CASE WHEN a.n = 0 OR a.u + x.u > 150 THEN {'n': a.n + 1, 'u': x.u} ELSE {'n': a.n, 'u': a.u + x.u} END).n AS BIGINT) AS chunks FROM documents",
    ),
    "repeated_paragraphs": (
        repeated_paragraphs,
        f"SELECT doc_id, count(*) AS repeated FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY ord) AS nth FROM {LINES_SQL} WHERE length(line) >= 60) WHERE nth > 1 GROUP BY doc_id",
    ),
    "uniform_rhythm": (
        uniform_rhythm,
        f"SELECT doc_id FROM (SELECT doc_id, list_transform({SENT_LENGTHS}, lambda s: {_W}) AS n FROM documents) WHERE len(n) >= 5 AND len(list_filter(range(1, len(n) - 3), lambda i: list_max(n[i : i + 4]) - list_min(n[i : i + 4]) <= 5)) > 0",
    ),
    "long_sentences": (long_sentences, f"SELECT doc_id, CAST(n AS BIGINT) AS n FROM (SELECT doc_id, len(list_filter({SENT_LENGTHS}, lambda s: {_W} > 50)) AS n FROM documents) WHERE n > 0"),
    "section_order": (
        section_order,
        "SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p IS DISTINCT FROM role GROUP BY conv_id",
    ),
    "contiguity": (contiguity, "SELECT conv_id, turn FROM (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations WHERE length(text) % 7 <> 0) WHERE coalesce(p, -1) + 1 <> turn"),
}

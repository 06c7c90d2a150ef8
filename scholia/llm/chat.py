"""Preference formatting: the turns that chosen and rejected conversations share become the prompt, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import read

START, END = "<|im_start|>", "<|im_end|>"
#: Roles whose words are trained on.
TRAINED = "assistant"


def _safe(text: Column) -> Column:
    """Text without the template's own marks: a space goes between '<' and '|'."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), "")


def _mask(turns: Column) -> Column:
    """start:end of the trained words in the rendered turns, in code points and comma-joined; a trained turn's end mark is trained too."""
    head, tail = len(START) + 1, len(END) + 1
    step = lambda a, t: F.struct(
        (a["at"] + head + F.length(t["role"]) + F.length(t["text"]) + tail).alias("at"),
        F.when(
            t["role"] == TRAINED,
            F.concat(a["spans"], F.array(F.concat_ws(":", a["at"] + head + F.length(t["role"]), a["at"] + head + F.length(t["role"]) + F.length(t["text"]) + len(END)))),
        )
        .otherwise(a["spans"])
        .alias("spans"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(turns, zero, step, lambda a: a["spans"]), ",")


def format_preferences(turns: DataFrame) -> DataFrame:
    """(pair_id, side, turn, role, text), side being 'chosen' or 'rejected', to one row a pair.

    Columns: pair_id, n_shared (turns of the longest common prefix, compared by role and text),
    prompt (these turns, rendered once), chosen and rejected (the remaining turns, rendered),
    chosen_mask and rejected_mask (start:end of what is trained on in the completion, in code
    points), status: 'pair', 'same' (no turn differs) or 'single' (one side has no turns).

    Turns go in order of turn, then role, text; null turns go first, a null role is 'user', a null
    text empty. A null pair_id is a pair of its own; other sides and columns are ignored. Repeated
    rows are turns like others. An empty table gives no rows. Every result holds whole
    conversations, so a pair's turns have to fit in one row.
    """
    side = lambda s: _turns(F.col("side") == s)
    return format_pairs(turns.where(F.col("side").isin("chosen", "rejected")).groupBy("pair_id").agg(side("chosen").alias("a"), side("rejected").alias("b")))


def _turns(which: Column) -> Column:
    """Turns (role, text) of a group's rows, in order."""
    one = F.struct(F.col("turn"), _safe(F.coalesce("role", F.lit("user"))).alias("role"), _safe(F.col("text")).alias("text"))
    return F.transform(F.array_sort(F.collect_list(F.when(which, one))), lambda t: F.struct(t["role"], t["text"]))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, a, b), arrays of turns (role, text) of the chosen and the rejected conversation, to what `format_preferences` gives."""
    equal = F.zip_with("a", "b", lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(equal, False).cast("int")
    pairs = pairs.withColumn("n_shared", F.when(first == 0, F.size("a")).otherwise(first - 1))
    rest = lambda c: F.slice(c, F.col("n_shared") + 1, F.greatest(F.size(c), F.lit(1)))
    status = F.when((F.size("a") == 0) | (F.size("b") == 0), "single").when((F.size(rest("a")) == 0) & (F.size(rest("b")) == 0), "same").otherwise("pair")
    return pairs.select(
        "pair_id", F.col("n_shared").cast("long").alias("n_shared"),
        _render(F.slice("a", 1, F.col("n_shared"))).alias("prompt"),
        _render(rest("a")).alias("chosen"), _render(rest("b")).alias("rejected"),
        _mask(rest("a")).alias("chosen_mask"), _mask(rest("b")).alias("rejected_mask"),
        status.alias("status"),
    )


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is the chosen one of a pair; the rejected one has the same turns, but the words of the last one in reverse order."""
    pairs = read(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("pair_id")).agg(_turns(F.lit(True)).alias("a"))
    last = F.element_at("a", -1)
    other = F.struct(last["role"].alias("role"), F.array_join(F.reverse(F.split(last["text"], " ")), " ").alias("text"))
    return format_pairs(pairs.withColumn("b", F.concat(F.slice("a", 1, F.size("a") - 1), F.array(other))))


_TURNS = """
    SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown
    FROM (SELECT pair_id, side, role, nth, CASE WHEN side = 'b' AND nth = n THEN array_to_string(list_reverse(string_split(text, ' ')), ' ') ELSE text END AS text
          FROM (SELECT conv_id AS pair_id, replace(coalesce(role, 'user'), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text,
                       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth, count(*) OVER (PARTITION BY conv_id) AS n
                FROM conversations), (SELECT unnest(['a', 'b']) AS side))
"""
OP4_SQL = f"""
WITH t AS ({_TURNS}),
met AS (SELECT pair_id, nth, max(CASE WHEN side = 'a' THEN shown END) AS a, max(CASE WHEN side = 'b' THEN shown END) AS b FROM t GROUP BY ALL),
pre AS (SELECT pair_id, coalesce(min(CASE WHEN a IS DISTINCT FROM b THEN nth END) - 1, max(nth)) AS n_shared FROM met GROUP BY pair_id),
placed AS (SELECT t.*, n_shared, nth <= n_shared AS shared,
                  coalesce(sum(length(shown)) FILTER (nth > n_shared) OVER (PARTITION BY t.pair_id, side ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                    + 13 + length(role) AS pos
           FROM t JOIN pre ON t.pair_id = pre.pair_id),
said AS (SELECT *, CASE WHEN role = 'assistant' THEN CAST(pos AS BIGINT) || ':' || CAST(pos + length(text) + 10 AS BIGINT) END AS span FROM placed)
SELECT pair_id, CAST(max(n_shared) AS BIGINT) AS n_shared,
       coalesce(string_agg(shown, '' ORDER BY nth) FILTER (side = 'a' AND shared), '') AS prompt,
       coalesce(string_agg(shown, '' ORDER BY nth) FILTER (side = 'a' AND NOT shared), '') AS chosen,
       coalesce(string_agg(shown, '' ORDER BY nth) FILTER (side = 'b' AND NOT shared), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY nth) FILTER (side = 'a' AND NOT shared), '') AS chosen_mask,
       coalesce(string_agg(span, ',' ORDER BY nth) FILTER (side = 'b' AND NOT shared), '') AS rejected_mask,
       CASE WHEN count(DISTINCT side) < 2 THEN 'single' WHEN bool_and(shared) THEN 'same' ELSE 'pair' END AS status
FROM said GROUP BY pair_id
"""

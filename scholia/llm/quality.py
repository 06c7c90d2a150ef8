"""Quality rules and robust multivariate outliers, in DataFrame functions only.

Statistics of each text are turned into a vector; for each language and source the location and
scatter of the vectors are estimated by minimum covariance determinant (concentration steps from
deterministic starts until the determinants settle, then one reweighting), and documents far from
it in Mahalanobis distance are rejected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import GAP_JAVA, SPACE, beside, durable, read

#: Rules on the base statistics.
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW_WORDS = 8
SYMBOLS = "#*$%&|<>"

#: Dimensions of the vector, with the resolution below which spread is not told from none: word
#: lengths that differ by 3 percent, one symbol in 2,500 characters, one line or word in 400. Its
#: square is added to the scatter, so that a group without any spread has distances. Each is so
#: small that its statistic alone can go beyond CUTOFF, repeated words (30 percent at most) too.
FLOORS = {"word_length": 0.03, "symbols": 0.02, "dup_lines": 0.05, "repeats": 0.05}
#: Units of the vectors' integers; sums of them are exact in any order.
SCALE = 1000
#: Share of a group that the estimate rests on.
CORE = 0.75
#: Concentration ends when no group's determinant falls any more, which takes a few steps.
MOST_STEPS = 50
#: Fewer documents than this are too few to estimate from: a small group of language and source is
#: held against its whole language, a small language against all documents.
LEAST_GROUP = 60
#: Squared distances are counted in bins of this ratio, so that the core is found without a sort.
BIN_RATIO = 1.02
#: Chi-square quantiles with 4 degrees of freedom: of the core's share, of the rows that the
#: reweighted estimate takes (0.975) and of the verdict (0.999).
CORE_QUANTILE, WEIGHT_QUANTILE, CUTOFF = 5.3853, 11.1433, 18.4668


def consistency(quantile: float) -> float:
    """What the scatter of a normal sample's rows within a squared distance has to be multiplied by, in 4 dimensions.

    P(chi-square of 4 degrees <= q) / P(chi-square of 6 degrees <= q), in closed form.
    """
    h = quantile / 2
    four, six = 1 - math.exp(-h) * (1 + h), 1 - math.exp(-h) * (1 + h + h * h / 2)
    return four / six


def words_of(text: Column) -> Column:
    """Array of words; empty for null or blank."""
    stripped = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(stripped) > 0, F.split(stripped, GAP_JAVA)).otherwise(F.array().cast("array<string>"))


def repeat_words(hashes: Column, n: int = WINDOW_WORDS) -> Column:
    """Words inside n-word windows that occur twice or more; `hashes` holds one for each window, by start."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        F.aggregate(
            F.array_sort(_starts_of_repeats(ordered)),
            F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(n), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )
    )


def _starts_of_repeats(ordered: Column) -> Column:
    """Of windows in order of hash, the starts of those that have an equal neighbour."""
    marked = F.zip_with(
        F.zip_with(ordered, F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1))), lambda x, y: F.struct(x["i"].alias("i"), x["h"].alias("h"), (x["h"] == y["h"]).alias("next"))),
        F.concat(F.array(F.lit(None).cast("long")), ordered["h"]),
        lambda x, before: F.struct(x["i"].alias("i"), (x["next"] | (x["h"] == before)).alias("twice")),
    )
    return F.filter(marked, lambda x: x["twice"])["i"]


def _joined(hashes: str, by: int) -> Column:
    """For each element its hash with the one `by` places on; the last `by` have none and are to be cut off."""
    return F.zip_with(hashes, F.slice(hashes, by + 1, F.greatest(F.size(hashes), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, text_key (hash of the text) and the base statistics of each row; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = docs.select(
        "doc_id", "lang", "source", F.xxhash64("text").alias("text_key"), text.alias("__text"), F.transform(words_of(text), lambda w: F.xxhash64(w)).alias("__words")
    )
    n = F.size("__words")
    # hashes of eight words from those of four, these from those of two: three hashes a window and no copies
    hashed = hashed.withColumn("__windows", F.col("__words"))
    by = 1
    while by < WINDOW_WORDS:
        hashed, by = hashed.withColumn("__windows", _joined("__windows", by)), 2 * by
    windows = F.slice("__windows", 1, F.greatest(n - (WINDOW_WORDS - 1), F.lit(0)))
    bare = F.translate("__text", SPACE, "")
    lines = F.filter(F.split("__text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    return hashed.withColumn("__windows", windows).select(
        "doc_id", "lang", "source", "text_key",
        n.cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("__windows")).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
    )


def vectors(stats: DataFrame) -> DataFrame:
    """Adds x0..x3: transformed statistics as integers of 1/SCALE.

    log of the mean word length; square roots of the shares of symbols, repeated lines and repeated
    words, which evens out the spread of shares near zero.
    """
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    dims = [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))), share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]
    return stats.withColumns({f"x{i}": F.round(d * SCALE).cast("long") for i, d in enumerate(dims)})


P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _moments(n: str, factor: float = 1.0) -> dict[str, Column]:
    """Mean and scatter (times `factor`, with its floors) from sums s{i} and s{i}{j} over n rows."""
    floors = list(FLOORS.values())
    mean = [F.col(f"s{i}") / F.col(n) / SCALE for i in range(P)]
    low: dict[tuple[int, int], Column] = {}
    for i, j in PAIRS:
        cov = (F.col(f"s{i}{j}") / F.col(n) / (SCALE * SCALE) - mean[i] * mean[j]) * factor
        cov = F.greatest(cov, F.lit(0.0)) + floors[i] ** 2 if i == j else cov
        low[i, j] = cov
    return {f"m{i}": mean[i] for i in range(P)} | {f"c{i}{j}": low[i, j] for i, j in PAIRS}


def _factor(df: DataFrame) -> DataFrame:
    """Cholesky factor columns from covariance columns, one column after the other so that expressions stay small."""
    for j in range(P):
        for i in range(j, P):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
    return df.withColumn("logdet", sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0)))


def distance(df: DataFrame, out: str) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution through the factor's columns."""
    for i in range(P):
        rest = F.col(f"x{i}") / SCALE - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"_y{k}")
        df = df.withColumn(f"_y{i}", rest / F.col(f"l{i}{i}"))
    return df.withColumn(out, sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(P)), F.lit(0.0))).drop(*[f"_y{i}" for i in range(P)])


def _sums() -> list[Column]:
    one = [F.sum(f"x{i}").alias(f"s{i}") for i in range(P)]
    return [F.count("*").alias("n"), *one, *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS]]


ESTIMATE = ["n", "logdet", *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in PAIRS]]


ANY = "*"


def grouped(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Rows with `grp`, the group that a row is judged by; rows by each group whose estimate they enter; and the number of groups at most.

    Rows enter more than their own group only where a smaller group is judged by their language or
    by all documents.
    """
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    counts = durable(rows.groupBy("lang", "source").agg(F.count("*").alias("__n")))
    langs = counts.groupBy(F.col("lang").alias("__lang")).agg(F.sum("__n").alias("__in_lang"), F.count_if(F.col("__n") < LEAST_GROUP).alias("__small"))
    counts = counts.join(langs, F.col("lang").eqNullSafe(F.col("__lang")))
    one, small_lang = F.concat_ws("\x01", name("lang"), name("source")), F.col("__in_lang") < LEAST_GROUP
    grp = F.when(F.col("__n") >= LEAST_GROUP, one).when(~small_lang, name("lang")).otherwise(F.lit(ANY))
    counts = durable(counts.select("lang", "source", grp.alias("grp"), one.alias("__one"), "__n", (~small_lang & (F.col("__small") > 0)).alias("__lang_too")))
    n, any_too = counts.agg(F.count("*"), F.coalesce(F.bool_or(F.col("grp") == ANY), F.lit(False))).first()
    into = F.array_compact(F.array(F.when(F.col("__n") >= LEAST_GROUP, F.col("__one")), F.when(F.col("__lang_too"), name("lang")), F.when(F.lit(any_too), F.lit(ANY))))
    members = beside(rows, counts.select("lang", "source", into.alias("__into")), ["lang", "source"], n)
    members = members.select(F.explode("__into").alias("grp"), *[f"x{i}" for i in range(P)])
    return beside(rows, counts.select("lang", "source", "grp"), ["lang", "source"], n), members, 2 * n + 1


def _core(rows: DataFrame, params: DataFrame, n_groups: int) -> DataFrame:
    """One concentration step for every group and start: moments of the CORE nearest rows, as new parameters.

    Rows are summed up by bins of distance; the core ends with the bin in which its share is reached.
    """
    near = distance(beside(rows, params, ["grp"], n_groups, how="inner"), "__d2")
    bin_ = F.floor(F.log(F.col("__d2") + 1e-6) / F.log(F.lit(BIN_RATIO))).cast("int")
    bins = near.withColumn("__bin", bin_).groupBy("grp", "start", "__bin").agg(*_sums())
    up = Window.partitionBy("grp", "start").orderBy("__bin")
    bins = bins.withColumn("__below", F.coalesce(F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bins = bins.withColumn("__all", F.sum("n").over(Window.partitionBy("grp", "start"))).where(F.col("__below") < F.ceil(F.col("__all") * CORE))
    kept = [c for c in bins.columns if c[0] in "ns" and c != "start"]
    return _factor(bins.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in kept]).select("grp", "start", "n", *[v.alias(k) for k, v in _moments("n").items()])).select("grp", "start", *ESTIMATE)


def _starts(rows: DataFrame, n_groups: int) -> DataFrame:
    """Three starts a group: the plain moments; medians with quartile widths, uncorrelated; and the same with the directions' shape."""
    plain = _factor(rows.groupBy("grp").agg(*_sums()).select("grp", "n", *[v.alias(k) for k, v in _moments("n").items()])).withColumn("start", F.lit(0)).select("grp", "start", *ESTIMATE)
    # exact medians from counts of the integers, of which a group has some thousands at most
    parts = None
    for i in range(P):
        counts = rows.groupBy("grp", F.col(f"x{i}").alias("v")).agg(F.count("*").alias("k"))
        w = Window.partitionBy("grp").orderBy("v")
        counts = counts.withColumn("upto", F.sum("k").over(w)).withColumn("all", F.sum("k").over(Window.partitionBy("grp")))
        quart = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("v")))
        one = counts.groupBy("grp").agg(F.max("all").alias("n") if i == 0 else F.lit(0).alias("_"), (quart(0.5) / SCALE).alias(f"m{i}"), ((quart(0.75) - quart(0.25)) / SCALE / 1.349).alias(f"w{i}"))
        one = one.drop("_")
        parts = one if parts is None else parts.join(one, "grp")
    floors = list(FLOORS.values())
    spread = {f"c{i}{j}": (F.col(f"w{i}") * F.col(f"w{i}") + floors[i] ** 2) if i == j else F.lit(0.0) for i, j in PAIRS}
    robust = _factor(parts.withColumns(spread)).select("grp", *ESTIMATE)
    return plain.unionByName(robust.withColumn("start", F.lit(1))).unionByName(_signs(rows, robust, n_groups).withColumn("start", F.lit(2)))


def _signs(rows: DataFrame, robust: DataFrame, n_groups: int) -> DataFrame:
    """The median with the shape of the directions in which rows lie from it, each row counting the same."""
    unit = beside(rows, robust, ["grp"], n_groups, how="inner")
    for i in range(P):
        unit = unit.withColumn(f"_z{i}", (F.col(f"x{i}") / SCALE - F.col(f"m{i}")) / F.col(f"l{i}{i}"))
    length = F.greatest(F.sqrt(sum((F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(P)), F.lit(0.0))), F.lit(1e-9))
    unit = unit.withColumn("_length", length).select("grp", *[F.round(F.col(f"_z{i}") / F.col("_length") * SCALE).cast("long").alias(f"x{i}") for i in range(P)])
    shape = unit.groupBy("grp").agg(F.count("*").alias("__n"), *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS])
    floors = list(FLOORS.values())
    cov = {(i, j): F.col(f"s{i}{j}") / F.col("__n") / (SCALE * SCALE) * P * F.col(f"__w{i}") * F.col(f"__w{j}") for i, j in PAIRS}
    both = robust.withColumnsRenamed({f"l{i}{i}": f"__w{i}" for i in range(P)}).select("grp", "n", *[f"m{i}" for i in range(P)], *[f"__w{i}" for i in range(P)]).join(shape, "grp")
    both = both.withColumns({f"c{i}{j}": c + floors[i] ** 2 if i == j else c for (i, j), c in cov.items()})
    return _factor(both).select("grp", *ESTIMATE)


def raw_estimates(rows: DataFrame, n_groups: int, most_steps: int = MOST_STEPS) -> DataFrame:
    """MCD of each group (grp, x0..x3): of the three starts the one that ends with the least determinant."""
    params, before = durable(_starts(rows, n_groups)), None
    for _ in range(most_steps):
        params = durable(_core(rows, params, n_groups))
        # sums of rounded numbers, so that the order of rows doesn't matter
        now = params.agg(F.sum(F.round(F.col("logdet") * 1000).cast("long"))).first()[0]
        if now is None or before is not None and now >= before:
            break
        before = now
    best = Window.partitionBy("grp").orderBy("logdet", "start")
    return params.withColumn("__r", F.row_number().over(best)).where("__r = 1").drop("__r", "start")


def estimates(rows: DataFrame, n_groups: int) -> DataFrame:
    """Location and scatter of each group (grp, x0..x3), by MCD and one reweighting; `n` is the number of the group's rows.

    The MCD's scatter is made consistent for normal rows; the rows within WEIGHT_QUANTILE of it give
    the final estimate.
    """
    near = distance(beside(rows, raw_estimates(rows, n_groups), ["grp"], n_groups, how="inner"), "__d2")
    near = near.where(F.col("__d2") <= WEIGHT_QUANTILE * consistency(CORE_QUANTILE)).select("grp", *[f"x{i}" for i in range(P)])
    factor = consistency(WEIGHT_QUANTILE)
    final = _factor(near.groupBy("grp").agg(*_sums()).select("grp", "n", *[v.alias(k) for k, v in _moments("n", factor).items()])).select("grp", *ESTIMATE).drop("n")
    sizes = rows.groupBy(F.col("grp").alias("__grp")).agg(F.count("*").alias("n"))
    return durable(final.join(sizes, F.col("grp") == F.col("__grp")).select("grp", *ESTIMATE))


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics and verdict of each row of `docs` (doc_id, text, lang, source).

    Columns: doc_id, lang, source, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, base_failed, grp, distance (squared, null if base_failed), kept.

    Nulls: a null text has no words and fails the base rules; null languages and sources are groups
    like any other. A group of fewer than LEAST_GROUP rows that pass the base rules is held against its
    language, a language of fewer against all documents; a table of fewer keeps its rows, since there
    is nothing to hold them against. Repeated rows count as often as they occur; other columns are
    ignored; an empty table gives no rows.
    """
    stats = durable(statistics(docs)).withColumn(
        "base_failed", (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    )
    rows, members, n_groups = grouped(vectors(stats.where("not base_failed")))
    params = estimates(durable(members), n_groups)
    near = distance(beside(rows, params, ["grp"], n_groups), "distance")
    passed = near.withColumn("kept", (F.col("distance") <= cutoff) | (F.col("n") < LEAST_GROUP) | F.col("distance").isNull())
    columns = [*stats.columns, "grp", "distance", "kept"]
    failed = stats.where("base_failed").select("*", F.lit(None).cast("string").alias("grp"), F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return passed.select(*columns).unionByName(failed.select(*columns))


def op5_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule, piecewise linear over training time 0..1. Its integral is the
source's weight; the integral up to t, scaled to the source's target, is the cumulative demand
D(t) for its words. Documents of a source are read in a keyed order, again from the start when
all are used; the read that begins after c words is placed at the time t with D(t) = c, and
reads are range-sorted by that position.

Time runs over each source's own demand: at time t the share D(t) of every source's target is
taken. How many words are taken at a time follows the schedules, it isn't held even.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import apart, beside, durable, fraction, n_words, read, running_total

#: Rows dealt into one bucket of the prefix sums.
BUCKET_ROWS = 256
#: Copies of a row numbered at once.
COPIES = 4096
#: Rows of a plan up to which it is broadcast (about 80 bytes each).
BROADCAST_READS = 500_000
#: A source is read this many times at most.
MAX_READS = 3


def source_plan(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_reads: int = MAX_READS) -> DataFrame:
    """Targets by source from (source, n_docs, source_size): one row a source.

    Sources in code point order, null last, weigh `weights`, repeating, and share the total of all
    sizes. A target stops at max_reads times its source's size and the excess is reshared by weight
    until none is above: in order of (cap / weight) a source is capped as long as its share of what
    the smaller ones have left exceeds its cap, which one ordered pass decides. The windows here
    span sources, not documents. A source of no words has target 0.
    """
    # UTF-8 keeps code point order, and Spark compares strings by their bytes
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("__i", (F.col("rank") - 1) % len(weights))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__i") + 1).cast("int"))).drop("__i")
    ranked = ranked.withColumn("__cap", F.col("source_size") * F.lit(float(max_reads)))
    by_level = Window.orderBy((F.col("__cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    ranked = (
        ranked.withColumn("__total", F.sum(F.col("source_size").cast("double")).over(every))
        .withColumn("__weights", F.sum("weight").over(every))
        .withColumn("__capped", F.coalesce(F.sum("__cap").over(earlier), F.lit(0.0)))
        .withColumn("__used", F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("__level", (F.col("__total") - F.col("__capped")) / (F.col("__weights") - F.col("__used")))
        .withColumn("__is_capped", F.col("__cap") <= F.col("__level") * F.col("weight"))
        # capped sources come first; the level of the first free one is everyone's
        .withColumn("__free", F.min(F.when(~F.col("__is_capped"), F.struct(F.col("__capped"), F.col("__used"), F.col("__level")))).over(every))
    )
    share = F.coalesce(F.col("__free.__level") * F.col("weight"), F.col("__cap"))
    target = F.when(F.col("__is_capped"), F.col("__cap")).otherwise(share)
    return ranked.withColumn("target", F.least(target, F.col("__cap"))).select("source", "rank", "n_docs", "source_size", "weight", "target")


def linear_schedule(start: Column, end: Column) -> Column:
    """Knots of a weight that goes evenly from `start` to `end`."""
    return F.array(F.struct(F.lit(0.0).alias("t"), start.cast("double").alias("w")), F.struct(F.lit(1.0).alias("t"), end.cast("double").alias("w")))


def demand_segments(knots: Column) -> Column:
    """Integrated schedule, scaled to 1: an array of (t, span, rate, slope, before) by segment."""
    area = lambda i: (F.element_at(knots, i + 1)["t"] - F.element_at(knots, i)["t"]) * (F.element_at(knots, i + 1)["w"] + F.element_at(knots, i)["w"]) / 2
    index = F.sequence(F.lit(1), F.size(knots) - 1)
    total = F.aggregate(index, F.lit(0.0), lambda a, i: a + area(i))
    return F.transform(
        index,
        lambda i: F.struct(
            F.element_at(knots, i)["t"].alias("t"),
            (F.element_at(knots, i + 1)["t"] - F.element_at(knots, i)["t"]).alias("span"),
            (F.element_at(knots, i)["w"] / total).alias("rate"),
            ((F.element_at(knots, i + 1)["w"] - F.element_at(knots, i)["w"]) / total).alias("rise"),
            (F.aggregate(F.filter(index, lambda j: j < i), F.lit(0.0), lambda a, j: a + area(j)) / total).alias("before"),
        ),
    )


def invert_demand(segments: Column, share: Column) -> Column:
    """The time at which the share (0..1) of a source's demand is reached."""
    seg = F.element_at(F.filter(segments, lambda s: s["before"] <= share), -1)
    need = share - seg["before"]
    a, b = seg["rise"] / 2 * seg["span"], seg["rate"] * seg["span"]
    # need = b x + a x^2 for x in 0..1 of the segment; this form has no cancellation
    root = F.sqrt(F.greatest(b * b + 4 * a * need, F.lit(0.0)))
    x = F.when(need <= 0, F.lit(0.0)).otherwise(2 * need / (b + root))
    return seg["t"] + seg["span"] * F.least(x, F.lit(1.0))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), seed: int = 17, max_reads: int = MAX_READS, tilt: float = 0.5, whole: bool = False, ordered: bool = True) -> DataFrame:
    """One row for each row of `docs` (doc_id, source, text): what the mix reads of it and when.

    Columns: doc_id, source, text_key (a hash of the text), copies (rows equal in these three), size,
    source_size, target, taken, positions (array of times in 0..1, one for each read), first_position
    (null if it is never read); range-sorted by first_position, unless ordered=False.

    Schedules: sources of odd rank in the order of their names rise from 1-tilt to 1+tilt times their
    weight, the others fall; the integral stays the weight. With whole=False the last read of a
    source stops where its target is met, so taken words equal the rounded target; with whole=True
    a read is taken entirely if its middle lies before the target, so the error is half a document.

    Nulls: a null or blank text has size 0 and is never read; a null source is a source, ordered
    last; a null doc_id is an id like others. Rows that are equal in id, source and text are ordered
    as one row of that many times the size and dealt out again, so neither copies nor null ids crowd
    a bucket; reruns agree, however the table is partitioned. An empty table gives no rows. Other
    columns are ignored.
    """
    narrow = docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), n_words(F.col("text")).alias("size"))
    narrow = durable(narrow.groupBy("doc_id", "source", "text_key", "size").agg(F.count("*").alias("__many")).withColumn("__all", F.col("size") * F.col("__many")))
    sizes = source_plan(narrow.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("__all").alias("source_size")), weights, max_reads)
    side = F.when(F.col("rank") % 2 == 1, F.lit(tilt)).otherwise(F.lit(-tilt))
    # integrated once for a source; in the rows' own plan they would be written out for each use
    sizes = durable(sizes.withColumn("__segments", demand_segments(linear_schedule(F.col("weight") * (1 - side), F.col("weight") * (1 + side)))))
    n_sources, most = sizes.agg(F.count("*"), F.coalesce(F.max("n_docs"), F.lit(0))).first()
    rows = beside(narrow, sizes, ["source"], n_sources)
    deal = F.ceil(F.col("n_docs") / BUCKET_ROWS)
    rows = rows.withColumn("__key", F.xxhash64("doc_id", "text_key", F.lit(seed))).withColumn("__bucket", F.floor(fraction(F.col("__key")) * deal))
    rows = running_total(rows, ["source"], "__bucket", [F.col("__key"), F.col("doc_id"), F.col("text_key"), F.col("size")], "__all", "__before", -(-most // BUCKET_ROWS))
    # equal rows follow each other; numbers of many of them are made in blocks, so that no array is long
    rows = rows.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__many") - 1) / COPIES))))
    last = F.least(F.col("__many") - F.col("__block") * COPIES, F.lit(COPIES)) - 1
    rows = rows.withColumn("__nth", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.withColumn("__before", F.col("__before") + F.col("size") * (F.col("__block") * COPIES + F.col("__nth")))
    quota = F.round("target").cast("long")
    begins = F.transform(F.sequence(F.lit(0), F.lit(max_reads - 1)), lambda j: F.col("__before") + j * F.col("source_size"))
    if whole:
        begins = F.filter(begins, lambda c: (c * 2 + F.col("size") <= quota * 2) & (F.col("size") > 0))
        taken = F.size("__begins") * F.col("size")
    else:
        begins = F.filter(begins, lambda c: (c < quota) & (F.col("size") > 0))
        taken = F.aggregate("__begins", F.lit(0).cast("long"), lambda a, c: a + F.least(quota - c, F.col("size")))
    rows = rows.withColumn("__begins", begins).withColumn("taken", taken.cast("long"))
    rows = rows.withColumn("positions", F.transform("__begins", lambda c: invert_demand(F.col("__segments"), c / F.greatest(F.col("target"), F.lit(1e-9)))))
    rows = rows.withColumn("first_position", F.when(F.size("positions") > 0, F.element_at("positions", 1)))
    placed = rows.select("doc_id", "source", "text_key", F.col("__many").alias("copies"), "size", "source_size", "target", "taken", "positions", "first_position")
    if not ordered:
        return placed
    return placed.repartitionByRange(F.col("first_position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(F.col("first_position").asc_nulls_last(), "doc_id")


def op1_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_position", "positions")


def mix_texts(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix reads, each as often as it is read, range-sorted by position.

    Whole reads are taken, so texts stay whole. The plan is brought to the texts by doc_id, source
    and a hash of the text: rows equal in these have equal texts, and each stands for all their
    reads divided among them, so texts are moved once, by the sort. Nulls, repeated rows and empty
    tables are as in `mix`; all columns of `docs` are kept.
    """
    names, docs = docs.columns, apart(docs, ("doc_id", "source", "text"))
    plan = durable(mix(docs, whole=True, ordered=False, **options).where(F.size("positions") > 0).select("doc_id", "source", "text_key", "copies", "positions"))
    rows = docs.withColumn("__text_key", F.xxhash64("text"))

    def beside_texts(rows: DataFrame, plan: DataFrame, how: str = "inner") -> DataFrame:
        side = plan.withColumnsRenamed({"doc_id": "__id", "source": "__source", "text_key": "__key"})
        side = F.broadcast(side) if plan.count() <= BROADCAST_READS else side
        on = rows["doc_id"].eqNullSafe(F.col("__id")) & rows["source"].eqNullSafe(F.col("__source")) & (F.col("__text_key") == F.col("__key"))
        return rows.join(side, on, how)

    some = beside_texts(rows, plan.where("copies = 1"))
    copied = plan.where("copies > 1")
    if not copied.isEmpty():
        keys = copied.select("doc_id", "source", "text_key").distinct()
        one = beside_texts(rows, keys, "left_semi").dropDuplicates(["doc_id", "source", "__text_key"])
        some = some.unionByName(beside_texts(one, copied))
    some = some.withColumn("__reads", F.col("positions"))
    placed = some.withColumn("__at", F.explode("__reads"))
    return placed.repartitionByRange("__at", "doc_id").sortWithinPartitions("__at", "doc_id").select(*docs.columns).toDF(*names)

"""Shared pieces: word rules, durable checkpoints, prefix sums without a one-task window, size-checked joins."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space of every word rule here: U+0020 and U+0009..U+000D.
SPACE = " \t\n\x0b\f\r"
WORD_JAVA = r"[^\x20\x09-\x0D]+"
GAP_JAVA = r"[\x20\x09-\x0D]+"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so a lost executor costs a reread.

    The folder is the one the cluster names in spark.checkpoint.dir. Only a local session, as in
    tests, may leave it unset and gets a temporary one.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
        master = spark.sparkContext.master
        if not named and master != "local" and not master.startswith("local["):  # local-cluster has other processes
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="scholia-checkpoint-"))
    return df.checkpoint(eager=True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def apart(df: DataFrame, used: tuple[str, ...]) -> DataFrame:
    """The same rows with all columns but `used` under names that no operator uses; `toDF` with the old names brings them back."""
    return df.toDF(*[c if c in used else f"__extra_{k}" for k, c in enumerate(df.columns)])


def n_words(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_JAVA)), F.lit(0)).cast("long")


def fraction(key: Column) -> Column:
    """A number in [0, 1) from a 64-bit hash."""
    return F.shiftrightunsigned(key, 11).cast("double") / F.lit(float(1 << 53))


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality over keys."""
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[k])
    return on


def beside(large: DataFrame, small: DataFrame, keys: list[str], rows: int, limit: int = 20_000, how: str = "left") -> DataFrame:
    """Join on null-safe keys; broadcasts only a side of at most `limit` rows, else both are shuffled.

    The shuffled form is an ordinary sort-merge join, whose hot keys adaptive execution splits.
    """
    renamed = small.withColumnsRenamed({k: f"__{k}" for k in keys})
    renamed = F.broadcast(renamed) if rows <= limit else renamed
    on = F.lit(True)
    for k in keys:
        on = on & large[k].eqNullSafe(renamed[f"__{k}"])
    return large.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, out: str, buckets: int, width: int = 1024) -> DataFrame:
    """Exclusive prefix sum of `value` within `keys`, in order of (bucket, *order), as column `out`.

    `bucket` is a long that grows with the order and deals a key's rows into `buckets` groups at most.
    No window spans a key: sums of the buckets are themselves summed up by this function, `width`
    of them to a window, until one window of at most `width` rows a key is left. Buckets sums are
    brought back by a join on (keys, bucket), so a hot key is spread over its buckets.
    """
    inner = F.sum(value).over(Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_value"))
    if buckets <= width:
        earlier = F.sum("_value").over(Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
        sums = sums.withColumn("_earlier", earlier)
    else:
        sums = sums.withColumn("_coarse", F.floor(F.col(bucket) / width))
        sums = running_total(sums, keys, "_coarse", [F.col(bucket)], "_value", "_earlier", -(-buckets // width), width)
    sums = sums.select(*[F.col(k).alias(f"_of_{k}") for k in [*keys, bucket]], "_earlier")
    on = F.lit(True)
    for k in [*keys, bucket]:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    joined = df.withColumn("_inner", F.coalesce(inner, F.lit(0))).join(sums, on)
    return joined.select(*df.columns, (F.col("_inner") + F.coalesce("_earlier", F.lit(0))).alias(out))

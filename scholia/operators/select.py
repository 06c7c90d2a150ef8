"""Deterministic samplers and shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def hex_mod(digest: Column, n: int) -> Column:
    """A hex digest as one number, modulo n."""
    digits = F.filter(F.split(digest, ""), lambda c: c != "")
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, c: (a * 16 + F.conv(c, 16, 10).cast("long")) % n)


def shard(key: Column, n: int) -> Column:
    return hex_mod(F.sha2(F.lower(key), 256), n)


def hash_sample(df: DataFrame, key: Column, seed: str, n: int) -> DataFrame:
    """The n rows of least sha256(seed + key)."""
    return df.withColumn("__h", F.sha2(F.concat(F.lit(seed), key), 256)).orderBy("__h").limit(n).drop("__h")


def quota_select(ranked: DataFrame, strata: list[tuple[str, int]], total: int, key: str, strata_array: str, rank: str) -> DataFrame:
    """Strata take their quota of unused rows in rank order, then the best of the rest fill up to the total.

    A stratum takes one row at least, as its quota is compared after a row is taken. The loop is
    over the few strata; each step keeps `quota` rows.
    """
    picked: list[DataFrame] = []
    left = ranked
    count = 0
    for k, (name, quota) in enumerate(strata):
        take = min(max(quota, 1), total - count)
        if take <= 0:
            break
        some = left.where(F.array_contains(strata_array, name)).orderBy(rank).limit(take).withColumn("turn", F.lit(k))
        picked.append(some)
        left = left.join(some.select(key), key, "left_anti")
        count += take
    rest = left.orderBy(rank).limit(max(total, 0)).withColumn("turn", F.lit(len(strata)))
    out = reduce(DataFrame.unionByName, [*picked, rest])
    place = F.row_number().over(Window.orderBy("turn", rank))
    return out.orderBy("turn", rank).limit(total).withColumn("selection_rank", place).drop("turn")


def round_robin_positions(sizes: dict[str, int], total: int) -> list[tuple[str, int, int]]:
    """(stratum, rank within it, position) of a round robin over sorted names that starts anew when a bucket empties.

    Only bucket sizes matter, and there are few buckets.
    """
    left, names = dict(sizes), sorted(k for k, v in sizes.items() if v)
    taken, out, cursor = dict.fromkeys(sizes, 0), [], 0
    while names and len(out) < total:
        at = cursor % len(names)
        name = names[at]
        taken[name] += 1
        out.append((name, taken[name], len(out) + 1))
        left[name] -= 1
        if left[name]:
            cursor += 1
        else:
            names.pop(at)
            cursor = 0
    return out


def round_robin_sample(df: DataFrame, stratum: str, key: Column, total: int) -> DataFrame:
    """Rows in order of sha256(key) within strata, dealt by `round_robin_positions`; adds rank and position."""
    sizes = {r[stratum]: r["n"] for r in df.groupBy(stratum).agg(F.count("*").alias("n")).collect()}
    plan = df.sparkSession.createDataFrame(round_robin_positions(sizes, total) or [("", 0, 0)], f"`{stratum}` string, rank int, position int")
    ranked = rank_within(df, [stratum], [F.sha2(key, 256)]).where(F.col("rank") <= total)  # cut before strata are gathered
    return ranked.join(F.broadcast(plan), [stratum, "rank"])  # `total` rows at most


def numbered(df: DataFrame, keys: list[str], bucket: str, order: list[str | Column], out: str) -> DataFrame:
    """Rows numbered from 1 within keys by (bucket, order), where `bucket` grows with the order.

    A key of very many rows is numbered bucket by bucket; only counts of buckets are summed along it.
    """
    counts = df.groupBy(*keys, bucket).agg(F.count("*").alias("__n"))
    earlier = F.sum("__n").over(Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*keys, bucket, F.coalesce(earlier, F.lit(0)).alias("__before"))
    nth = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order))
    return df.withColumn("__nth", nth).join(counts, [*keys, bucket]).withColumn(out, F.col("__before") + F.col("__nth")).drop("__before", "__nth")


def running_number(df: DataFrame, key: str, out: str, parts: int = 64) -> DataFrame:
    """Rows numbered from 1 in order of a unique key, without a window over all of them.

    Rows are range-partitioned by the key; the number of rows in the earlier partitions (one row for
    each partition) is added to a row's number in its own.
    """
    placed = df.repartitionByRange(parts, key).withColumn("__p", F.spark_partition_id())
    # the key's bounds name the ranges, so that the counts hold however often the rows are read
    bounds = placed.groupBy("__p").agg(F.min(key).alias("__low"), F.max(key).alias("__high"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bounds = F.broadcast(bounds.select("__low", "__high", before.alias("__before")))  # `parts` rows at most
    rows = df.join(bounds, (F.col(key) >= F.col("__low")) & (F.col(key) <= F.col("__high")))
    nth = F.row_number().over(Window.partitionBy("__low").orderBy(key))
    return rows.withColumn(out, F.col("__before") + nth).drop("__low", "__high", "__before")


def evenly_spaced(n: Column, most: int = 40) -> Column:
    """Up to `most` indices spread over 0..n-1, rounded half to even."""
    count = F.least(n, F.lit(most))
    at = lambda i: F.bround(i * (n - 1) / F.greatest(count - 1, F.lit(1))).cast("long")
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), at))).otherwise(F.array().cast("array<bigint>"))


def diversity_select(df: DataFrame, stratum: str, key: str, per_stratum: int, single: list[str], multi: str) -> DataFrame:
    """Greedy picks: most novelty in `single` columns and in the array `multi`, in order, ties by sha256.

    Greedy choice is sequential, so each stratum is one group; rows that can't be told apart by
    their novelty are first reduced to the `per_stratum` of least hash, which no pick goes beyond.
    """
    import hashlib

    import pandas as pd

    like = Window.partitionBy(stratum, *single, F.array_sort(multi)).orderBy(F.sha2(F.concat(F.col(stratum), F.lit("\0"), F.col(key)), 256))
    reduced = df.withColumn("__r", F.row_number().over(like)).where(F.col("__r") <= per_stratum).drop("__r").select(stratum, key, *single, multi)

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(hashlib.sha256(f"{r[stratum]}\0{r[key]}".encode()).hexdigest(), k, r) for k, r in enumerate(pdf.to_dict("records"))]
        seen = {c: set() for c in [*single, multi]}
        chosen = []
        while rows and len(chosen) < per_stratum:
            def novelty(item):
                r = item[2]
                news = [r[c] not in seen[c] for c in single[:2]] + [bool(set(r[multi]) - seen[multi])] + [r[c] not in seen[c] for c in single[2:]]
                return tuple(-int(x) for x in news), item[0]

            best = min(rows, key=novelty)
            rows.remove(best)
            for c in single:
                seen[c].add(best[2][c])
            seen[multi] |= set(best[2][multi])
            chosen.append((best[2][stratum], best[2][key], len(chosen) + 1))
        return pd.DataFrame(chosen, columns=[stratum, key, "pick"])

    return reduced.groupBy(stratum).applyInPandas(pick, f"`{stratum}` string, `{key}` string, pick int")

"""Identity of records: aliases, duplicates, first and latest rows, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholia.functions import text as T


def aliases(doi: Column, pmcid: Column, pmid: Column, title: Column, year: Column) -> Column:
    """Aliases of a paper in order of preference; missing ones are left out."""
    tag = lambda name, c: F.when(T.nz(c).isNotNull(), F.concat(F.lit(name), c))
    by_title = F.when(T.nz(title).isNotNull(), F.concat_ws(":", F.lit("title"), T.title_key(title), F.coalesce(year.cast("string"), F.lit(""))))
    return F.array_compact(F.array(tag("doi:", T.doi(doi)), tag("pmcid:", F.upper(pmcid)), tag("pmid:", pmid), by_title))


def duplicate_values(df: DataFrame, value: Column) -> DataFrame:
    """value and n of values (lower-cased, not blank) that occur more than once."""
    key = F.lower(T.nz(value))
    return df.select(key.alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n")).where("n > 1")


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; combined before the shuffle, so no key's rows are sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("__row")).select(*keys, "__row.*")


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(*keys, "__row.*")


def merge_candidates(df: DataFrame, key: str, seq: str, fill: list[str], largest: list[str], union: list[str], either: list[str]) -> DataFrame:
    """One row for each key: first non-blank value by arrival, maxima, sorted unions, disjunctions."""
    out = [F.min_by(c, F.when(T.nz(F.col(c)).isNotNull(), F.col(seq))).alias(c) for c in fill]
    out += [F.max(c).alias(c) for c in largest]
    out += [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in union]
    out += [F.bool_or(c).alias(c) for c in either]
    return df.groupBy(key).agg(*out)


def collapse_runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__before", before).where(~F.col(value).eqNullSafe(F.col("__before"))).drop("__before")


def unused(candidates: DataFrame, used: DataFrame, row: str, alias_array: str, alias: str) -> DataFrame:
    """Candidates none of whose aliases is used."""
    hit = candidates.select(row, F.explode(alias_array).alias("__alias")).join(used.select(F.col(alias).alias("__alias")), "__alias", "left_semi").select(row).distinct()
    return candidates.join(hit, row, "left_anti")

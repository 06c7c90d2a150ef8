"""All registered queries with their SQL, gathered from the modules in `plans`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import articles, candidates, cards, contracts, corpus, indexed, papers, profile, records, runs, texts

MODULES = [profile, articles, candidates, cards, contracts, corpus, indexed, records, papers, runs, texts]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for m in MODULES for name, (run, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}

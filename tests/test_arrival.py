"""Identity in order of arrival against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from scholia.operators import arrival
from scholia.operators.components import components

KINDS = [("doi", True), ("pmcid", True), ("pmid", True), ("title", False)]


def plain_loop(rows):
    """Each row's record, straight from the rule."""
    index, records, out = {}, {}, {}
    for seq, aliases in sorted(rows):
        found = [index[a] for a in aliases if a and a in index]
        record = found[0] if found else seq
        mine = records.setdefault(record, list(aliases))
        for k in range(3):
            mine[k] = mine[k] or aliases[k]
        for a in mine:
            if a:
                index[a] = record
        out[seq] = record
    return out


def made(n, spread, seed, nulls=0.4):
    rng = random.Random(seed)
    pick = lambda kind, most: f"{kind}:{rng.randrange(most)}" if rng.random() > nulls else None
    return [(k, [pick(kind, max(2, int(spread * f))) for kind, f in (("doi", 1), ("pmcid", 1.3), ("pmid", 0.8), ("title", 0.5))]) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(s, *a, "x") for s, a in rows], "seq long, doi string, pmcid string, pmid string, title string, record string").repartition(3)


def result(spark, rows):
    got = arrival.arrivals(frame(spark, rows), "seq", KINDS).collect()
    assert len(got) == len(rows)
    return {r["seq"]: r["record"] for r in got}


@pytest.mark.parametrize(("n", "spread", "nulls"), [(10_000, 6_000, 0.4), (3_000, 40, 0.5), (400, 5, 0.6), (2_000, 2_000, 0.0)])
def test_equal_to_a_plain_loop(spark, n, spread, nulls):
    rows = made(n, spread, n, nulls)
    assert result(spark, rows) == plain_loop(rows)


def test_records_are_never_fused_and_aliases_change_hands(spark):
    rows = [
        (1, ["doi:a", None, None, None]), (2, [None, None, "pmid:p", None]), (3, ["doi:a", None, "pmid:p", None]),
        (4, [None, None, "pmid:p", None]), (5, ["doi:z", None, None, None]), (6, [None, None, None, None]), (7, [None, None, None, ""]),
    ]
    assert result(spark, rows) == {1: 1, 2: 2, 3: 1, 4: 1, 5: 5, 6: 6, 7: 7} == plain_loop(rows)


def test_copies_and_hot_values_go_through_once(spark, monkeypatch):
    """A third of the rows are copies, a third share but a title: hardly a row is gone through in order."""
    rows = [(k, ["doi:hot", None, None, "title:hot"]) for k in range(0, 3000, 3)] + [(k, [None, f"pmcid:{k}", None, "title:same"]) for k in range(1, 3000, 3)]
    rows += [(k, [f"doi:{k}", None, None, f"title:{k}"]) for k in range(2, 3000, 3)]
    assert result(spark, rows) == plain_loop(rows)
    seen = spark.sparkContext.accumulator(0)
    original = arrival._replayed

    def counted(fills):
        run = original(fills)

        def wrapped(table):
            seen.add(table.num_rows)
            return run(table)

        return wrapped

    monkeypatch.setattr(arrival, "_replayed", counted)
    result(spark, rows)
    assert seen.value == 0  # neither class has company in its component


def test_no_rows(spark):
    assert result(spark, []) == {}


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, f"v{k}") for k in range(300)] + [(k, f"v{k + 1}") for k in range(300)]
    star = [(1000 + k, "hub") for k in range(300)] + [(2000, "other")]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain + star, "node long, value string")).collect()}
    assert {v for k, v in got.items() if k < 1000} == {0} and {v for k, v in got.items() if 1000 <= k < 2000} == {1000} and got[2000] == 2000
    none = spark.createDataFrame([], "node long, value string")
    assert components(none).withColumn("n", F.lit(1)).collect() == []

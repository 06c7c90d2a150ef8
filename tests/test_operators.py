"""Operators with sequential rules, on made-up rows."""

from scholia.operators import fidelity, papers, select
from scholia.operators.components import dealt
from pyspark.sql import functions as F


def test_round_robin_starts_anew_when_a_bucket_empties():
    assert [x[0] for x in select.round_robin_positions({"a": 1, "b": 3, "c": 2}, 10)] == ["a", "b", "c", "b", "c", "b"]


def test_quota_of_zero_takes_one_row(spark):
    df = spark.createDataFrame([(i, ["x" if i % 2 else "y"], i) for i in range(1, 9)], "k int, s array<string>, r int")
    got = [r.k for r in select.quota_select(df, [("y", 0), ("x", 2)], 5, "k", "s", "r").orderBy("selection_rank").collect()]
    assert got == [2, 1, 3, 4, 5]


def test_f1_conventions_for_empty_sides(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 3, 0), (2, 2, 4)], "c int, e int, a int")
    assert [r[0] for r in df.select(fidelity.f1(F.col("c"), F.col("e"), F.col("a"))).collect()] == [1.0, 0.0, 2 / 3]


def test_shard_is_the_whole_digest_modulo_n(spark):
    import hashlib

    got = spark.sql("select 'PMC7' as k").select(select.shard(F.col("k"), 11)).first()[0]
    assert got == int(hashlib.sha256(b"pmc7").hexdigest(), 16) % 11


def test_features_lower_a_text_once(spark):
    rows = spark.createDataFrame([(1, "A Finite Element model", ["methods", "results"]), (2, "nothing", ["methods"]), (3, None, ["other"])], "k int, t string, s array<string>")
    out = rows.select("k", papers.design_features(F.concat_ws(" ", "t"), F.col("s")).alias("f"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1
    got = {r["k"]: r["f"] for r in out.collect()}
    assert got[1] == ["finite_element_or_computational", "methods_results_modeling"] and got[2] == got[3] == ["unclassified"]


def test_a_partition_of_items_has_so_many_rows_however_many_there_are(spark):
    rows = spark.range(600).select(F.col("id").alias("k"), F.array(F.lit("a"), F.lit("a"), F.lit("b")).alias("e"), F.array(F.lit("a")).alias("a"))
    out = fidelity.overlaps(dealt(rows, "k", 50), "k", "e", "a")
    assert out.collect()[0][1:] == (3, 1, 1)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(k" in plan and ", 13)" in plan
    assert max(len(x) for x in out.rdd.glom().collect()) < 120


def test_documents_are_dealt_by_number(spark, data):
    from scholia.plans import texts

    for name in ("token_f1", "truncation_flags", "trigram_f1"):
        assert "REPARTITION_BY_NUM" in texts.QUERIES[name][0](spark, data)._jdf.queryExecution().executedPlan().toString()

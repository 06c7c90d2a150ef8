"""The stored index: what a query reads, and hits against a plain loop."""

import re

from pyspark.sql import functions as F

from scholia.operators.stored_index import Index, build

ROWS = [(1, "Bone bone", "the plate. The bone of a PLATE"), (2, None, "plate"), (3, "", None), (4, "x", "of the")]


def made(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "id long, head string, body string").repartition(2)
    build(docs, "id", {"head": 2.0, "body": 1.0}, str(tmp_path / "i"), "0", 8)
    return Index(spark, str(tmp_path / "i"))


def test_postings(spark, tmp_path):
    index = made(spark, tmp_path)
    got = {(r["key"], r["term"]): (r["f"], r["length"], [tuple(p) for p in r["positions"]]) for r in index.postings(["bone", "plate", "none"]).collect()}
    want = {}
    for key, *texts in ROWS:
        found = [re.findall("[a-z0-9]+", (t or "").lower()) for t in texts]
        for term in ("bone", "plate"):
            places = [(f, k) for f, tokens in enumerate(found) for k, t in enumerate(tokens) if t == term]
            if places:
                want[key, term] = (sum((2.0, 1.0)[f] for f, _ in places), sum(map(len, found)), places)
    assert got == want
    assert [r["key"] for r in index.search(["plate", "bone"]).collect()] == [1] and index.search(["none", "plate"]).collect() == []


def test_only_the_buckets_of_the_terms_are_read(spark, tmp_path):
    index = made(spark, tmp_path)
    plan = index.postings(["bone"])._jdf.queryExecution().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "bucket" in filters and "PushedFilters" in plan and "EqualTo(term,bone)" in plan
    files = index.postings(["bone"]).select(F.input_file_name()).distinct().collect()
    assert len(files) == 1


def test_readers_keep_their_batch(spark, tmp_path):
    index = made(spark, tmp_path)
    build(spark.createDataFrame([(9, "bone", "")], "id long, head string, body string"), "id", {"head": 2.0, "body": 1.0}, str(tmp_path / "i"), "1", 8)
    assert [r["key"] for r in index.search(["bone"]).collect()] == [1]
    assert [r["key"] for r in Index(spark, str(tmp_path / "i")).search(["bone"]).collect()] == [9]


def test_postings_are_made_in_their_row(spark, tmp_path, monkeypatch):
    from scholia.operators import stored_index

    made_of = {}
    monkeypatch.setattr(stored_index.publish, "publish", lambda s, root, batch, tables, parts: made_of.update(tables))
    build(spark.createDataFrame(ROWS, "id long, head string, body string"), "id", {"head": 2.0, "body": 1.0}, str(tmp_path / "i"), "0", 8)
    plan = made_of["postings"]._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "rangepartitioning" not in plan and plan.count("Exchange") == 1

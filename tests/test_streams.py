"""Streams against their batch forms, and tolerant JSONL scans."""

from scholia.sources import jsonl
from scholia.streaming import changes, leases

EVENTS = "item string, event_id long, ts long, action string, worker string, ttl long"
ROWS = [
    ("a", 1, 0, "claim", "w1", 10), ("a", 2, 5, "claim", "w2", 10), ("a", 3, 10, "claim", "w2", 10), ("a", 4, 12, "complete", "w1", 0),
    ("a", 5, 13, "complete", "w2", 0), ("a", 6, 14, "complete", "w2", 0), ("b", 7, 0, "claim", "w1", 5), ("b", 8, 1, "release", "w1", 0), ("b", 9, 2, "claim", "w3", 5),
]


def test_leases(spark, tmp_path):
    events = spark.createDataFrame(ROWS, EVENTS)
    got = {r.event_id: r.outcome for r in leases.replay(events).collect()}
    assert got == {1: "granted", 2: "refused", 3: "granted", 4: "refused", 5: "done", 6: "repeated", 7: "granted", 8: "done", 9: "granted"}
    events.coalesce(1).write.json(str(tmp_path / "in"))
    stream = leases.stream(spark.readStream.schema(EVENTS).json(str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("leases").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.event_id: r.outcome for r in spark.table("leases").collect()} == got


def test_changes_and_bounded_batches(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("y", 1, "c")], "id string, seq long, v string")
    first = changes.changed(rows, spark.createDataFrame([], "id string, fp string"), "id", ["v"])
    assert {(r.id, r.v) for r in first.collect()} == {("x", "b"), ("y", "c")}
    assert changes.changed(rows, first, "id", ["v"]).count() == 0
    for k in range(5):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text(f'{{"k": {k}}}\n')
    sizes = []
    changes.watch(spark, str(tmp_path / "in"), "k long", str(tmp_path / "cp"), lambda df, _: sizes.append(df.count()), 2).awaitTermination(120)
    assert sizes == [2, 2, 1]


def test_tolerant_scan(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('﻿{"a": 1}\n\n{"a": 2}\n[3]\n{"a": \n', encoding="utf-8")
    good, bad = jsonl.scan(spark, str(tmp_path / "t.jsonl"), "a long")
    assert sorted(r.a for r in good.collect()) == [1, 2] and bad.count() == 2

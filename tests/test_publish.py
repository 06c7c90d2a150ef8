"""Batches of tables whose write is broken off at every step."""

import pytest
from pyspark.sql import functions as F

from scholia.sinks import publish


class Killed(Exception):
    pass


def tables(spark, n):
    return {"a": spark.range(n).withColumn("v", F.lit(n)), "b": spark.range(2 * n).withColumn("v", F.lit(n))}


def state(spark, root):
    """The value that all rows of both tables have, and their counts."""
    a, b = (publish.read(spark, root, t) for t in ("a", "b"))
    values = {r[0] for t in (a, b) for r in t.select("v").distinct().collect()}
    assert len(values) == 1
    return values.pop(), a.count(), b.count()


STEPS = ["write a", "write b", "prepare", "switch", "commit"]


@pytest.mark.parametrize("kill", STEPS)
def test_readers_see_one_batch_whole(spark, tmp_path, kill):
    root = str(tmp_path / "p")
    assert publish.publish(spark, root, "0", tables(spark, 3))
    assert state(spark, root) == (3, 3, 6)

    def step(name):
        if name == kill:
            raise Killed(name)

    with pytest.raises(Killed):
        publish.publish(spark, root, "1", tables(spark, 5), step=step)
    before = (3, 3, 6) if STEPS.index(kill) <= STEPS.index("switch") else (5, 5, 10)
    assert state(spark, root) == before
    prepared = STEPS.index(kill) > STEPS.index("prepare")
    assert publish.recover(spark, root) == (["1"] if prepared else [])
    assert state(spark, root) == ((5, 5, 10) if prepared else (3, 3, 6))
    assert publish.publish(spark, root, "1", tables(spark, 5)) is not prepared
    assert state(spark, root) == (5, 5, 10) and not publish.publish(spark, root, "1", tables(spark, 9))
    assert [e["state"] for e in publish.ledger(spark, root)] == ["committed", "committed"]
    assert publish.sweep(spark, root) == ["0"] and state(spark, root) == (5, 5, 10)


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        publish.read(spark, str(tmp_path / "none"), "a")


def test_batches_of_a_stream_are_published_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text(f'{{"k": {k}}}\n')
    root = str(tmp_path / "p")
    seen = []

    def work(df, batch):
        seen.append(publish.publish(spark, root, f"{batch:09d}", {"t": df}))
        seen.append(publish.publish(spark, root, f"{batch:09d}", {"t": df}))  # as after a failure behind the sink

    stream = spark.readStream.schema("k long").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    stream.writeStream.foreachBatch(work).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert seen == [True, False] * 3 and publish.current(spark, root) == "000000002"

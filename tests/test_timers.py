"""Timers that fire without new events, and after a restart from the checkpoint."""

import json
import time

import pytest

from scholia.streaming import timers

SEEN = "id string, seq long, event string, fingerprint string, reasons array<string>"
CLAIMS = "item string, event_id long, action string, worker string, ttl long"


@pytest.fixture(scope="module", autouse=True)
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    timers.use_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


class Run:
    """A query over a folder of JSON files whose rows go to another folder."""

    def __init__(self, spark, tmp_path, schema, build):
        self.spark, self.path, self.schema, self.build, self.n = spark, tmp_path, schema, build, 0
        (tmp_path / "in").mkdir()

    def start(self):
        events = self.spark.readStream.schema(self.schema).json(str(self.path / "in"))
        out = self.build(events).writeStream.format("json").option("path", str(self.path / "out")).option("checkpointLocation", str(self.path / "cp"))
        self.query = out.outputMode("append").trigger(processingTime="1 second").start()

    def put(self, *rows):
        names = [c.split()[0] for c in self.schema.split(", ")]
        self.n += 1
        (self.path / "in" / f"{self.n}.json").write_text("".join(json.dumps(dict(zip(names, r, strict=True))) + "\n" for r in rows))

    def stop(self, seconds=60):
        """Stops between batches, once all files were read."""
        done = lambda: len(list((self.path / "cp" / "sources").glob("*/[0-9]*"))) >= self.n
        end = time.time() + seconds
        while time.time() < end and not (done() and (self.query.lastProgress or {}).get("batchId", -1) > self.n and not self.query.status["isTriggerActive"]):
            time.sleep(0.05)
        self.query.stop()

    def rows(self):
        return [r.asDict() for r in self.spark.read.schema(self.build.schema).json(str(self.path / "out")).collect()] if (self.path / "out" / "_spark_metadata").exists() else []

    def wait(self, test, seconds=60):
        end = time.time() + seconds
        while time.time() < end:
            assert self.query.exception() is None
            found = self.rows()
            if test(found):
                return found
            time.sleep(0.5)
        raise AssertionError(self.rows())


def test_changes_are_given_out_once_and_blocked_items_again_after_a_delay(spark, tmp_path):
    def build(events):
        return timers.work(events, interval_s=0.5, least_s=4)

    build.schema = timers.WORK
    run = Run(spark, tmp_path, SEEN, build)
    run.put(("a", 1, "seen", "f1", None), ("a", 2, "seen", "f1", None), ("b", 1, "seen", "g1", None), ("c", 1, "seen", "h1", None))
    run.start()
    found = run.wait(lambda rows: len(rows) == 3)
    assert {(r["id"], r["fingerprint"], r["cause"]) for r in found} == {("a", "f1", "changed"), ("b", "g1", "changed"), ("c", "h1", "changed")}
    run.put(("a", 3, "blocked", "f1", ["active_lease: x"]), ("b", 2, "blocked", "g1", ["no_references"]), ("c", 2, "blocked", "h1", ["pending_overlay_or_draft"]), ("c", 3, "done", "h1", None))
    run.stop()
    run.start()  # the timer is in the checkpoint
    found = run.wait(lambda rows: any(r["cause"] == "retry" for r in rows))
    assert [(r["id"], r["fingerprint"]) for r in found if r["cause"] == "retry"] == [("a", "f1")] and len(found) == 4
    run.put(("b", 3, "seen", "g1", None), ("b", 4, "seen", "g2", None))
    found = run.wait(lambda rows: len(rows) == 5)
    assert [(r["id"], r["fingerprint"], r["cause"]) for r in found if r["fingerprint"] == "g2"] == [("b", "g2", "changed")]
    run.query.stop()


def test_leases_expire_without_an_event(spark, tmp_path):
    def build(events):
        return timers.leased(events)

    build.schema = timers.TURN
    run = Run(spark, tmp_path, CLAIMS, build)
    run.put(("a", 1, "claim", "w1", 3), ("b", 2, "claim", "w1", 3), ("b", 3, "complete", "w1", 0), ("c", 4, "claim", "w1", 3600), ("a", 5, "claim", "w2", 3))
    run.start()
    found = run.wait(lambda rows: any(r["action"] == "expire" for r in rows))
    assert {r["event_id"]: r["outcome"] for r in found if r["event_id"]} == {1: "granted", 2: "granted", 3: "done", 4: "granted", 5: "refused"}
    assert [(r["item"], r["worker"], r["status"]) for r in found if r["action"] == "expire"] == [("a", "w1", "open")]
    run.put(("a", 6, "claim", "w2", 3600), ("b", 7, "claim", "w2", 3), ("c", 8, "complete", "w2", 0))
    found = run.wait(lambda rows: len(rows) == 9)
    assert {r["event_id"]: r["outcome"] for r in found if (r["event_id"] or 0) > 5} == {6: "granted", 7: "refused", 8: "refused"}
    assert next(r for r in found if r["event_id"] == 6)["attempts"] == 2
    run.query.stop()


def test_delay():
    assert timers.retry_delay_ms(300) == 900_000 and timers.retry_delay_ms(400) == 1_200_000

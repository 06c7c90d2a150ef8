"""Tables published together: readers see all tables of one batch or all of another, never a mix.

A batch is written under its own folder, noted in a ledger as prepared once all of it is there, and
then becomes current by one rename of a small pointer. A batch that was prepared but isn't current yet
is rolled forward by `recover`; what wasn't prepared is never seen and is written anew by a retry. Folders
are those of any file system that Spark reads.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER, LEDGER, BATCHES = "CURRENT", "ledger", "batches"

#: Called with the name of each step before it is taken; tests raise here.
Step = Callable[[str], None]


class _Folder:
    """Small files of a folder by the session's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.java, self.gateway, self.root = spark._jvm, spark.sparkContext._gateway, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.java.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def names(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(name))) if self.exists(name) else []

    def get(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self.fs.open(self._path(name))
        try:
            return self.java.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Writes beside the file, then renames over it."""
        beside = f"{name}.new"
        stream = self.fs.create(self._path(beside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.java.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        over = self.java.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.gateway.new_array(self.java.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = over
        context.rename(self._path(beside), self._path(name), options)

    def drop(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def current(spark: SparkSession, root: str) -> str | None:
    """The batch that readers see."""
    return _Folder(spark, root).get(POINTER)


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current batch."""
    batch = current(spark, root)
    if batch is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return spark.read.parquet(f"{root}/{BATCHES}/{batch}/{table}")


def _note(folder: _Folder, batch: str, state: str, tables: list[str]) -> None:
    folder.put(f"{LEDGER}/{batch}.json", json.dumps({"batch": batch, "state": state, "tables": tables}))


def ledger(spark: SparkSession, root: str) -> list[dict]:
    """What is noted of each batch, by name."""
    folder = _Folder(spark, root)
    return [json.loads(folder.get(f"{LEDGER}/{n}")) for n in folder.names(LEDGER) if n.endswith(".json")]


def publish(spark: SparkSession, root: str, batch: str, tables: dict[str, DataFrame], partition_by: dict[str, list[str]] | None = None, step: Step = lambda name: None) -> bool:
    """Publishes a batch of tables; False if this batch was committed before, which then stays as it is.

    `batch` names it, as a stream's batch id does, so a repeated batch does no harm. Batches before
    stay on disk for readers that are at them; `sweep` removes those.
    """
    folder = _Folder(spark, root)
    known = folder.get(f"{LEDGER}/{batch}.json")
    if known and json.loads(known)["state"] == "committed":
        return False
    recover(spark, root)
    for name, df in tables.items():
        step(f"write {name}")
        writer = df.write.mode("overwrite")
        if partition_by and name in partition_by:
            writer = writer.partitionBy(*partition_by[name])
        writer.parquet(f"{root}/{BATCHES}/{batch}/{name}")
    step("prepare")
    _note(folder, batch, "prepared", sorted(tables))
    step("switch")
    folder.put(POINTER, batch)
    step("commit")
    _note(folder, batch, "committed", sorted(tables))
    return True


def recover(spark: SparkSession, root: str) -> list[str]:
    """Makes batches that were prepared, but not committed, current in their order; gives their names."""
    folder, done = _Folder(spark, root), []
    for entry in ledger(spark, root):
        if entry["state"] == "prepared" and all(folder.exists(f"{BATCHES}/{entry['batch']}/{t}/_SUCCESS") for t in entry["tables"]):
            folder.put(POINTER, entry["batch"])
            _note(folder, entry["batch"], "committed", entry["tables"])
            done.append(entry["batch"])
    return done


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Removes the folders of all batches but the current one."""
    folder, now = _Folder(spark, root), current(spark, root)
    old = [b for b in folder.names(BATCHES) if b != now]
    for batch in old:
        folder.drop(f"{BATCHES}/{batch}")
    return old

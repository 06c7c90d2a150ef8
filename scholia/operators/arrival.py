"""Identity of records in order of arrival.

A row joins the record that owns the first of its aliases that is known, or else starts one. The
record takes over those of the row's values that it lacks, and all aliases of the record then point
to it, also those that pointed to another. Two records are never fused, so this is no matter of
connected components: those only bound what has to be gone through in order.

What is gone through is small. An alias that only one row has can't be met again, so it counts as a
mere mark that the value is there; rows that then agree in all aliases are one class. A row
of a class that went through before changes nothing unless an alias of the class or of its record
has changed hands since; so of each class the first row goes through, and all its rows only if that
happened. Classes of many copies, and values that many rows share, take a row or so.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, kept

#: What a value that no other row has is replaced by.
OWN = ""


class Replay:
    """Rows of a component, one after another; `fills` says of each kind of alias whether a record that lacks it takes it over."""

    def __init__(self, fills: list[bool]):
        self.fills = fills
        self.owner: dict[str, int] = {}
        self.values: dict[int, list[str | None]] = {}
        #: the last record of each class that went through and isn't stale, and who has to hear of a change
        self.joined: dict[int, int] = {}
        self.of_alias: dict[str, set[int]] = defaultdict(set)
        self.of_record: dict[int, set[int]] = defaultdict(set)
        self.stale: set[int] = set()

    def add(self, seq: int, kind: int, aliases: list[str | None]) -> int:
        """The record of a row: the number of the row that started it."""
        record = next((self.owner[a] for a in aliases if a and a in self.owner), None)
        if record is None:
            record = seq
            self.values[record] = list(aliases)
        mine = self.values[record]
        for k, alias in enumerate(aliases):
            if mine[k] is None and self.fills[k]:
                mine[k] = alias
        for alias in mine:
            if alias and self.owner.get(alias) != record:
                self._moved(alias, self.owner.get(alias), record)
                self.owner[alias] = record
        self.joined[kind] = record
        self.of_record[record].add(kind)
        for alias in aliases:
            if alias:
                self.of_alias[alias].add(kind)
        return record

    def _moved(self, alias: str, before: int | None, after: int) -> None:
        """Classes that would act otherwise now: those with the alias and those of the record that lost it."""
        for kind in [*self.of_alias[alias], *(self.of_record[before] if before is not None else ())]:
            if self.joined.get(kind, after) != after:
                self.stale.add(kind)


def _replayed(fills: list[bool]) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        replay, records = Replay(fills), []
        seqs, kinds = table["seq"].to_pylist(), table["kind"].to_pylist()
        for seq, kind, aliases in zip(seqs, kinds, table["aliases"].to_pylist(), strict=True):
            records.append(replay.add(seq, kind, aliases))
        return pa.table({"seq": pa.array(seqs, pa.int64()), "kind": pa.array(kinds, pa.int64()), "record": pa.array(records, pa.int64()), "stale": pa.array([k in replay.stale for k in kinds], pa.bool_())})

    return run


def arrivals(rows: DataFrame, seq: str, kinds: Iterable[tuple[str, bool]]) -> DataFrame:
    """seq and record (the seq of the row that started it) of each row.

    `seq` is a long that no two rows share; `kinds` names the columns of aliases in order of
    preference and whether a record takes such a value over. Values of different columns have to
    differ, so give them prefixes; null or empty means none. A row without aliases is a record
    of its own. Columns of other names are ignored; an empty table gives no rows.

    Groups that go through in one task have a row for each class of a component, and all rows of
    its stale classes: copies and rows that only a hot value links aren't among them.
    """
    kinds = list(kinds)
    names, fills = [k for k, _ in kinds], [f for _, f in kinds]
    own = [F.nullif(F.col(k).cast("string"), F.lit("")) for k in names]
    base = rows.select(F.col(seq).cast("long").alias("seq"), F.array(*own).alias("aliases"))
    each = base.select("seq", F.posexplode("aliases").alias("place", "alias")).where("alias is not null")
    shared = each.groupBy("alias").agg(F.count("*").alias("n")).where("n > 1").select("alias", F.lit(True).alias("shared"))
    marked = each.join(shared, "alias", "left").withColumn("alias", F.when(F.col("shared"), F.col("alias")).otherwise(F.lit(OWN)))
    at = lambda k: F.max(F.when(F.col("place") == k, F.col("alias")))
    marked = kept(marked.groupBy("seq").agg(F.array(*[at(k) for k in range(len(names))]).alias("aliases"), F.bool_or("shared").alias("linked")))
    linked = marked.where("linked").select("seq", "aliases")
    classes = kept(linked.groupBy("aliases").agg(F.min("seq").alias("kind"), F.max("seq").alias("last")))
    edges = classes.select(F.col("kind").alias("node"), F.explode("aliases").alias("value")).where(F.col("value") != OWN)
    of = components(edges)
    crowded = of.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    classes = kept(classes.join(of, F.col("kind") == F.col("node")).drop("node").join(crowded, "component", "left_semi"))
    first = classes.select("component", F.col("kind").alias("seq"), "kind", "aliases")
    through, stale = first, None
    while True:
        done = kept(through.groupBy("component").applyInArrow(_replayed(fills), "seq long, kind long, record long, stale boolean"))
        again = done.where("stale").select("kind").distinct()
        again = again if stale is None else again.join(stale, "kind", "left_anti")
        again = kept(again.join(classes.where("last > kind"), "kind").select("kind"))
        if again.isEmpty():
            break
        stale = kept(again if stale is None else stale.unionByName(again))
        later = linked.join(classes.join(stale, "kind"), "aliases").where("seq > kind").select("component", "seq", "kind", "aliases")
        through = first.unionByName(later)
    by_row = done.select("seq", "record")
    # classes alone in their component join their own first row
    by_class = done.where("seq = kind").select("kind", "record") if stale is None else done.where("seq = kind").join(stale, "kind", "left_anti").select("kind", "record")
    settled = linked.join(by_row, "seq", "left_anti")
    firsts = linked.groupBy("aliases").agg(F.min("seq").alias("kind")).join(by_class, "kind", "left").select("aliases", F.coalesce("record", "kind").alias("record"))
    settled = settled.join(firsts, "aliases").select("seq", "record")
    alone = base.select("seq").join(linked, "seq", "left_anti").select("seq", F.col("seq").alias("record"))
    return by_row.unionByName(settled).unionByName(alone)

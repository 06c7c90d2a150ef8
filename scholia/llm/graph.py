"""Connected components of a graph of long ids, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import durable

#: Each round about halves the longest path, so this is never reached; it ends a loop that a fault would make endless.
MOST_ROUNDS = 100
#: Cells (a cell, a node and a count) up to which they are broadcast.
BROADCAST_CELLS = 500_000
#: Pairs of a cell beyond which it is dealt into finer parts.
MOST_PAIRS = 1_000_000


def _stars(edges: DataFrame, upward: bool) -> DataFrame:
    """Point neighbours of each node to the least of its neighbourhood: the larger ones (upward) or the smaller ones."""
    if upward:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "__u")
    near = both.join(least, F.col("u") == F.col("__u"))
    if upward:
        near = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        near = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("__u").alias("u"), F.col("m").alias("v")))
    return near.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) of longs, without nulls, to (node, component): the least id that each linked node reaches.

    Nodes without a link to another are left out; loops and repeated links don't matter. Each round
    is written to the checkpoint folder and compared with the one before by order-free sums, so
    the driver sees a few numbers only. Minima are combined before each shuffle; the links of a hub
    are an ordinary join, which adaptive execution splits.
    """
    edges = durable(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    mark, before = (F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.min("v")), None
    for _ in range(MOST_ROUNDS):
        edges = durable(_stars(_stars(edges, True), False))
        now = tuple(edges.agg(*mark).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _parted_pairs(placed: DataFrame, parts_of: Callable[[DataFrame], DataFrame], share: float) -> DataFrame:
    """Pairs (u, v) of different components, one outside the largest, by cell; of crowded cells by part too."""
    dealt = parts_of(placed.where("crowded").select("node").distinct()).withColumnRenamed("node", "__node")
    known = placed.join(dealt, F.col("node") == F.col("__node"), "left").drop("__node")
    parts = F.when(F.col("crowded"), F.col("parts")).otherwise(F.array(F.lit(0).cast("long")))
    head = ~F.col("crowded") | (F.col("at") < F.col("heads"))
    known = durable(known.select("cell", "comp", "major", "node", "crowded", "heads", F.when(F.col("crowded"), F.col("size")).otherwise(0).alias("size"), F.posexplode(parts).alias("at", "part")).select("cell", "part", "comp", "major", F.struct("size", "node").alias("rank"), (F.col("size") - F.col("at")).alias("left"), head.alias("head")))
    a = known.where("comp <> major").select("cell", "part", F.col("rank").alias("a"), F.col("comp").alias("ca"), "major", F.col("left").alias("la"), F.col("head").alias("ha"))
    b = known.select(F.col("cell").alias("__cell"), F.col("part").alias("__part"), F.col("rank").alias("b"), F.col("comp").alias("cb"), F.col("left").alias("lb"), F.col("head").alias("hb"))
    met = (F.col("cell") == F.col("__cell")) & (F.col("part") == F.col("__part")) & (F.col("ca") != F.col("cb"))
    met &= F.least("la", "lb") >= share * (F.col("a.size") + F.col("b.size")) - 1e-9
    less = a.where("ha").join(b, met & (F.col("a") < F.col("b")))
    # of two nodes outside the largest component one order is enough
    more = a.join(b.where("hb"), met & (F.col("cb") == F.col("major")) & (F.col("a") > F.col("b")))
    return less.select("a.node", F.col("b.node").alias("v")).unionByName(more.select("a.node", F.col("b.node").alias("v"))).withColumnRenamed("node", "u").distinct()


def cell_links(members: DataFrame, verified: Callable[[DataFrame], DataFrame], finer: Callable[[Column], Column] | None = None, parts_of: Callable[[DataFrame], DataFrame] | None = None, share: float = 0.0, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Links (u, v) whose components are those of all pairs that share a cell and are near.

    `members` has cell and node (long), without repeats, and perhaps n, a weight of the node (how often
    it occurs: what others are variants of is heavy); it is read more than once. verified(pairs)
    keeps the near ones of different pairs (u, v). Cells of two nodes are one pair each. Larger
    cells don't emit all their pairs: every member is first held against the heaviest one of the cell and the
    components of these links are found; then only nodes of different components are compared, of
    which one is outside the cell's largest component. Cells are counted before any shuffle of
    their members, and no window spans one. Cells that would still give more than `most_pairs`
    pairs are dealt into parts of which near nodes share one at least: finer(node), or
    parts_of(nodes) to (node, size, parts, heads) where that takes more than the node itself. Of two
    near nodes, the one less by (size, node) has one of its first `heads` parts among the other's parts,
    and both have at least `share` of the sum of their sizes from the first common part on.
    """
    hub = F.max(F.struct("n", "node"))["node"] if "n" in members.columns else F.max("node")
    hubs = durable(members.groupBy("cell").agg(F.count("*").alias("many"), hub.alias("hub")).where("many > 1"))
    side = F.broadcast(hubs) if hubs.count() <= BROADCAST_CELLS else hubs
    met = members.join(side.withColumnRenamed("cell", "__cell"), F.col("cell") == F.col("__cell")).drop("__cell")
    first = durable(verified(met.where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()))
    large = hubs.where("many > 2").select(F.col("cell").alias("__cell"))
    if large.isEmpty():
        return first
    known = components(first).withColumnRenamed("node", "__node")
    placed = members.join(large, F.col("cell") == F.col("__cell")).join(known, F.col("node") == F.col("__node"), "left").select("cell", "node", F.coalesce("component", "node").alias("comp"))
    placed = durable(placed)
    sizes = placed.groupBy("cell", "comp").agg(F.count("*").alias("k"))
    mixed = sizes.groupBy("cell").agg(F.count("*").alias("comps"), F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("k")).where("comps > 1")
    crowded = (F.col("k") - F.col("top.k")) * F.col("k") > most_pairs
    mixed = mixed.select(F.col("cell").alias("__cell"), F.col("top.comp").alias("major"), crowded.alias("crowded"))
    placed = durable(placed.join(mixed, F.col("cell") == F.col("__cell")).select("cell", "node", "comp", "major", "crowded"))
    whole = F.array(F.lit(0).cast("long"))
    parts = whole if finer is None else F.when(F.col("crowded"), finer(F.col("node"))).otherwise(whole)
    if parts_of is not None:
        return first.unionByName(verified(_parted_pairs(placed, parts_of, share)))
    a = placed.where("comp <> major").select("cell", F.explode(parts).alias("part"), F.col("node").alias("u"), F.col("comp").alias("cu"), "major")
    b = placed.select(F.col("cell").alias("__cell"), F.explode(parts).alias("__part"), F.col("node").alias("v"), F.col("comp").alias("cv"))
    # of two nodes outside the largest component one order is enough
    apart = (F.col("cu") != F.col("cv")) & ((F.col("cv") == F.col("major")) | (F.col("u") > F.col("v")))
    rest = a.join(b, (F.col("cell") == F.col("__cell")) & (F.col("part") == F.col("__part")) & apart).select("u", "v").distinct()
    return first.unionByName(verified(rest))

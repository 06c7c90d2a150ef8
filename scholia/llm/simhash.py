"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint's 32 segments of 2 bits are mapped to their bit counts. The Manhattan distance of two
such vectors is at most the Hamming distance of the fingerprints, so fingerprints within 4
bits have vectors within 4. The vectors' coordinates are dealt into 7 blocks (more for very many
fingerprints); vectors within 4 agree in all but 4 of them or more, so a grid on each choice of
the others brings every such pair into a common cell. Pairs of a cell are verified on the
fingerprints themselves.

Cells of many fingerprints don't emit all their pairs (see graph.cell_links).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import cell_links, components
from .util import durable, read

SHINGLE_WORDS = 4
BITS = 4
SEED = 42
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Shingles whose bits are counted at once.
CHUNK = 65_536


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of the text's word shingles, repeats included; 0 without words."""
    # bytes.split() without arguments splits at U+0020 and U+0009..U+000D
    parts = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return 0
    joined, n = b" ".join(parts), max(1, len(parts) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(words, len(parts)) - 1 :].tolist()
    of = xxhash.xxh64_intdigest
    hashes = np.fromiter((of(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        ones += np.unpackbits(hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp and text_key of each row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [fingerprint(t.as_py(), words) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fp, pa.int64()), batch["text_key"]], ["doc_id", "fp", "text_key"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key")).mapInArrow(run, "doc_id long, fp long, text_key long")


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 segments of two bits in one long, each as 00, 01 or 11, so that the Manhattan distance of two is the number of differing bits."""
    odd = F.lit(0x5555555555555555)
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(odd), fp.bitwiseAND(odd)
    return F.shiftleft(high.bitwiseAND(low), 1).bitwiseOR(high.bitwiseOR(low))


def manhattan(a: Column, b: Column) -> Column:
    """Distance of two embeddings, at most the number of differing bits of the fingerprints."""
    return F.bit_count(a.bitwiseXOR(b))


def blocks_for(n: int) -> int:
    """Blocks of coordinates: one more for each time that the grids' cells would hold many chance neighbours.

    Any number above the distance finds all pairs; more blocks mean finer and more grids.
    """
    return 7 if n <= 20_000 else 8 if n <= 1_000_000 else 9 if n <= 12_000_000 else 10


def _grids(blocks: int, bits: int) -> list[int]:
    """Masks over the embedding: the kept coordinates of each grid."""
    parts = [sum(3 << (2 * i) for i in range(32) if i * blocks // 32 == b) for b in range(blocks)]
    masks = [sum(x) for x in combinations(parts, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, n: int, bits: int = BITS) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of the n rows of `fps` (fp, distinct) within `bits` bits.

    A cell is named by a hash of grid and place; cells that meet in it only add candidates. Pairs of
    a cell are held against the Manhattan bound, then verified. A crowded cell is dealt by one in
    bits + 1 of the coordinates at a time: of vectors within `bits` one such share is equal.
    """
    emb = embedding(F.col("fp"))
    grids = F.array(*[F.xxhash64(F.lit(g), emb.bitwiseAND(F.lit(m))) for g, m in enumerate(_grids(blocks_for(n), bits))])
    members = fps.select(F.explode(grids).alias("cell"), F.col("fp").alias("node"))

    def verified(pairs: DataFrame) -> DataFrame:
        u, v = F.col("u"), F.col("v")
        return pairs.where(manhattan(embedding(u), embedding(v)) <= bits).where(F.bit_count(u.bitwiseXOR(v)) <= bits)

    shares = [sum(3 << (2 * i) for i in range(32) if i % (bits + 1) == k) for k in range(bits + 1)]
    shares = [m - (1 << 64) if m >> 63 else m for m in shares]
    finer = lambda node: F.array(*[F.xxhash64(F.lit(k), embedding(node).bitwiseAND(F.lit(m))) for k, m in enumerate(shares)])
    return cell_links(members, verified, finer)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, fp, text_key (hash of the text), component and component_id of each row of `docs` (doc_id, text).

    component_id is the least doc_id among the rows whose fingerprints are linked with this one's,
    over any number of links, itself included. Rows of equal fingerprints are one node, so copies
    are never paired. Nulls: a null, empty or blank text has fingerprint 0, which links like any
    other; a row without doc_id takes part, and its component's id is the least that there is (null
    if none). Repeated rows stay; other columns are ignored; an empty table gives no rows.
    """
    rows = durable(fingerprints(docs, words))
    fps = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comps = components(links(fps.select("fp"), fps.count(), bits))
    nodes = fps.join(comps, F.col("fp") == F.col("node"), "left").withColumn("component", F.coalesce("component", "fp"))
    ids = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = nodes.select(F.col("fp").alias("__fp"), F.col("component").alias("__c")).join(ids, F.col("__c") == F.col("component")).select("__fp", "component", "component_id")
    return rows.join(named, F.col("fp") == F.col("__fp")).select("doc_id", "fp", "text_key", "component", "component_id")


def op7_simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""Passages that repeat across documents: MinHash banding of paragraphs, exact verification, components.

Paragraphs are the lines of a text of LEAST_WORDS words or more. Their five-word shingles are
MinHashed into bands; paragraphs that share a band are verified by exact Jaccard similarity.

Equal passages are found wherever they begin and end: every window of LEAST_WORDS words that occurs
twice is in a unit that matches, so a repeated stretch is covered from its first word to its last.
The windows of a text are dealt into groups by their anchor, the least hash of ANCHOR_WORDS words in
each, so equal windows have equal anchors. A group (about eight windows) that repeats as a whole is
one unit. Where one anchor has different groups, as at the edges of a stretch, their windows are
units too, but only those of each different group's first occurrence: its others go as a whole. Of
each component of matching units the first occurrence is kept and the others are removed.

Texts are read five times. Two readings only count hashes, of anchors and bands, and of windows; the
others write what these counts leave: candidate paragraphs with their shingles, groups with their
places, and the windows of some of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .graph import cell_links, components
from .util import durable, read

SHINGLE_WORDS = 5
THRESHOLD = 0.8
LEAST_WORDS = 20
#: Words whose hash can be the anchor of a window; fewer make larger groups, which changes no result.
ANCHOR_WORDS = 6
#: Most bits of a set of keys that is sent to the workers, as a power of two. A fuller set lets more
#: rows through to the exact join, it never holds one back.
FILTER_BITS = 27
RECALL = 0.998
#: Characters worked on at once, and rows filtered at once: more take more memory of a worker and no less time.
CHUNK = 1 << 17
SLICE_ROWS = 1000
KEPT_POWERS = CHUNK + (1 << 15)
#: Rows up to which a table of units (80 bytes each), and of pairs of paragraphs (16 bytes each), is broadcast;
#: beyond, both sides are shuffled, but for units of HOT_UNIT occurrences or more, which are few.
BROADCAST_UNITS, BROADCAST_PAIRS = 200_000, 1_000_000
HOT_UNIT = 1000
#: Pairs of a cell of bands beyond which only lines that share a rare shingle are compared.
MOST_PAIRS = 1000
#: Counters of shingles, a power of two, that are sent to the workers. Fewer make a worse order, which loses no link.
COUNTERS = 1 << 20

_P, _Q = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93)
_P_BACK, _Q_BACK = (np.uint64(pow(int(x), -1, 1 << 64)) for x in (_P, _Q))


def tuned_bands(threshold: float = THRESHOLD, recall: float = RECALL, least_rows: int = 3, most: int = 64) -> tuple[int, int]:
    """(bands, rows) that find pairs at the threshold with this probability.

    A paragraph is written once for each band, so the fewest bands are taken whose rows are
    `least_rows` at least, which keeps apart paragraphs that share little.
    """
    for bands in range(1, most // least_rows + 1):
        if 1 - (1 - threshold**least_rows) ** bands >= recall:
            return bands, least_rows
    raise ValueError("no bands reach this recall")


BANDS, ROWS = tuned_bands()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _new_powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Powers of each base, kept by a worker up to KEPT_POWERS.
_KEPT: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    if n > KEPT_POWERS:
        return _new_powers(base, n)
    if int(base) not in _KEPT:
        _KEPT[int(base)] = _new_powers(base, KEPT_POWERS)
    return _KEPT[int(base)][:n]


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64, back: np.uint64) -> np.ndarray:
    """Hashes of values[start:end], by one running sum for all of them."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values)), dtype=np.uint64)])
    inverse = _powers(back, len(values) + 1)
    return _mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _letters(codes: np.ndarray) -> np.ndarray:
    """Hashes of code points, A-Z as a-z."""
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint64)
    return _mix(lower + np.uint64(1))


_COMMON = _letters(np.arange(1 << 12, dtype=np.uint32))


class Words:
    """The words of some texts, side by side: hashes of lower-cased words, places, lines and sentences."""

    def __init__(self, texts: list[str]):
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        space = (codes == 32) | ((codes >= 9) & (codes <= 13))
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        letters = _COMMON[codes] if len(codes) and codes.max() < len(_COMMON) else _letters(codes)
        self.hashes = _ranges(letters, self.starts, self.ends, _P, _P_BACK) if len(self.starts) else np.zeros(0, np.uint64)
        self.line = np.cumsum(codes == 10)[self.starts] if len(self.starts) else np.zeros(0, np.int64)
        self.begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1]
        self.text = np.searchsorted(self.begins, self.starts, "right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """First and end words of the lines with enough words."""
        if not len(self.line):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.flatnonzero(np.diff(self.line, prepend=-1))
        end = np.append(first[1:], len(self.line))
        enough = end - first >= LEAST_WORDS
        return first[enough], end[enough]

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors' first words, and first and end windows (named by their first word) of the groups."""
        n = len(self.line) - LEAST_WORDS + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.arange(len(self.line) - ANCHOR_WORDS + 1)
        low = np.uint64((1 << 31) - 1)
        # hash and place in one number: of equal hashes in a window the leftmost is the anchor, so no group holds a window twice
        least = (_ranges(self.hashes, at, at + ANCHOR_WORDS, _Q, _Q_BACK) & ~low) | at.astype(np.uint64)
        span, most = 1, LEAST_WORDS - ANCHOR_WORDS + 1
        while span < most:
            step = min(span, most - span)
            least, span = np.minimum(least[:-step], least[step:]), span + step
        window = np.flatnonzero(self.text[:n] == self.text[LEAST_WORDS - 1 :])
        anchor = (least[window] & low).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        count = np.diff(np.append(first, len(window)))
        return anchor[first], window[first], window[first] + count

    def keys(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _ranges(self.hashes, first, end, _Q, _Q_BACK).view(np.int64) if len(first) else np.zeros(0, np.int64)

    def checks(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A second hash, so that equal units agree in 128 bits."""
        return _ranges(self.hashes, first, end, _P, _P_BACK).view(np.int64) if len(first) else np.zeros(0, np.int64)

    def overlapping(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which of these stretches overlap an equal one that begins before them in their own text."""
        keys = self.keys(first, end)
        order = np.argsort(keys, kind="stable")
        a, b = order[:-1], order[1:]
        out = np.zeros(len(first), bool)
        out[b] = (keys[a] == keys[b]) & (self.text[first[a]] == self.text[first[b]]) & (first[b] < end[a])
        return out

    def marks(self, first: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
        """Keys whose lowest bit tells anchors (0) from bands (1)."""
        return (self.keys(first, end) & ~np.int64(1)) | np.int64(kind)

    def shingles(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles of the lines, and where each line's begin."""
        count = end - first - (SHINGLE_WORDS - 1)
        offsets = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(first - offsets[:-1], count) + np.arange(offsets[-1])
        return _ranges(self.hashes, at, at + SHINGLE_WORDS, _Q, _Q_BACK), offsets

    def places(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, and start and end in its code points."""
        text = self.text[first]
        return text, self.starts[first] - self.begins[text], self.ends[end - 1] - self.begins[text]


#: Bits of a key in a filter word are named by these of its own bits and the five above; the word, by its low bits.
FILTER_SHIFTS = (58, 52, 46)


def key_filter(keys: DataFrame, n: int) -> tuple[np.ndarray, tuple[int, ...]]:
    """Bits of a set of n keys (column key), of bounded size, and the shifts in use; the keys' lowest bit doesn't count.

    A key has up to three bits of one word; fewer where the words are so full that more would let more through.
    """
    slots = 1 << min((64 * n + (1 << 15)).bit_length(), FILTER_BITS) - 6
    shifts = FILTER_SHIFTS[: max(1, round(0.69 * 64 * slots / max(n, 1)))]
    slot = F.shiftrightunsigned("key", 1).bitwiseAND(F.lit(slots - 1).cast("long"))
    bit = F.lit(0).cast("long")
    for s in shifts:
        bit = bit.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("key", s).bitwiseAND(F.lit(63)).cast("int")))
    found = keys.select(slot.alias("slot"), bit.alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(slots, np.int64)
    out[found["slot"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64), shifts


def maybe_in(known: tuple[np.ndarray, tuple[int, ...]], keys: np.ndarray) -> np.ndarray:
    """False only for keys that aren't in the set."""
    bits, shifts = known
    k = keys.view(np.uint64)
    words = bits[((k >> np.uint64(1)) & np.uint64(len(bits) - 1)).astype(np.int64)]
    for s in shifts:
        words = words & -((words >> ((k >> np.uint64(s)) & np.uint64(63))) & np.uint64(1))
    return words != 0


_SEEDS = _mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * _P)


def bands_of(words: Words, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(lines, BANDS) hashes of the MinHash bands."""
    shingles, offsets = words.shingles(first, end)
    out = np.zeros((len(first), BANDS), np.uint64)
    for b in range(BANDS):
        for r in range(ROWS):
            k = b * ROWS + r
            least = np.minimum.reduceat((shingles ^ _SEEDS[2 * k]) * (_SEEDS[2 * k + 1] | np.uint64(1)), offsets[:-1])
            out[:, b] = _mix(out[:, b] * _Q + least + np.uint64(b))
    return (out.view(np.int64) & ~np.int64(1)) | np.int64(1)


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[int, Words]]:
    """First row and words of some texts each."""
    row, texts, total = 0, [], 0
    for t in batch["text"]:
        texts.append(t.as_py() or "")
        total += len(texts[-1])
        if total >= CHUNK:
            yield row, Words(texts)
            row, texts, total = row + len(texts), [], 0
    if texts:
        yield row, Words(texts)


def _scan(docs: DataFrame, schema: str, work, only=None) -> DataFrame:
    """Rows of `work(batch, first row, words)`; doc_id and text_key (a hash of the text) are in the batch.

    Texts whose text_key can't be in the filter `only` have nothing to give and are passed over.
    """
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                if only is not None:
                    batch = batch.filter(pa.array(maybe_in(only.value, batch["text_key"].to_numpy(zero_copy_only=False))))
                for row, words in _portions(batch):
                    yield pa.RecordBatch.from_arrays(work(batch, row, words), names)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def marks(docs: DataFrame) -> DataFrame:
    """(mark, of): anchors with the keys of their groups, bands with the keys of their lines."""

    def work(_, __, words: Words) -> list[pa.Array]:
        (anchor, first, end), (a, b) = words.groups(), words.lines()
        bands = bands_of(words, a, b).ravel() if len(a) else np.zeros(0, np.int64)
        of = np.concatenate([words.keys(first, end + LEAST_WORDS - 1), np.repeat(words.keys(a, b), BANDS)])
        return [pa.array(np.concatenate([words.marks(anchor, anchor + ANCHOR_WORDS, 0), bands])), pa.array(of)]

    return _scan(docs, "mark long, of long", work)


def repeated_marks(docs: DataFrame) -> tuple:
    """Broadcast filters of the anchors that repeat with one group, of those with different groups, and of the bands of different lines."""
    counts = marks(docs).groupBy("mark").agg(F.count("*").alias("n"), F.min("of").alias("low"), F.max("of").alias("high"))
    is_band, mixed = F.col("mark").bitwiseAND(F.lit(1).cast("long")) == 1, F.col("low") != F.col("high")
    found = durable(counts.where((F.col("n") > 1) & (mixed | ~is_band)).select(F.col("mark").alias("key"), is_band.alias("band"), mixed.alias("mixed")))
    send = docs.sparkSession.sparkContext.broadcast
    sets = [found.where("not mixed"), found.where("mixed and not band"), found.where("band")]
    return tuple(send(key_filter(x, x.count())) for x in sets)


def candidate_lines(docs: DataFrame, bands) -> DataFrame:
    """key, cells and shingles of the different lines that may share a band with another one, and n, how often each occurs."""

    def work(_, __, words: Words) -> list[pa.Array]:
        first, end = words.lines()
        if len(first):
            at = bands_of(words, first, end)
            met = maybe_in(bands.value, at.ravel()).reshape(at.shape)
            own = met.any(axis=1)
            # of equal lines of a portion one is enough
            _, one, count = np.unique(words.keys(first, end), return_index=True, return_counts=True)
            one, count = one[own[one]], count[own[one]]
            first, end, at, met = first[one], end[one], at[one], met[one]
        if not len(first):
            return [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64())), pa.array([], pa.list_(pa.int64()))]
        shingles, offsets = words.shingles(first, end)
        cells = _lists(at[met], np.concatenate([[0], np.cumsum(met.sum(axis=1))]))
        return [pa.array(words.keys(first, end)), pa.array(count), cells, _lists(shingles.view(np.int64), offsets)]

    rows = _scan(docs, "key long, n long, cells array<long>, shingles array<long>", work)
    one = rows.groupBy("key").agg(F.sum("n").alias("n"), F.first("cells").alias("cells"), F.first("shingles").alias("shingles"))
    return one.select("key", "n", "cells", F.array_distinct("shingles").alias("shingles"))


PLACES = "key long, check long, kind int, doc_id long, text_key long, at long"
#: Kinds of units: groups whose anchor has no other group, groups of other anchors, near lines, windows.
WHOLE, MIXED, LINE, WINDOW = range(4)


def _rows(batch: pa.RecordBatch, row: int, words: Words, units: list[tuple[np.ndarray, np.ndarray, int]]) -> list[pa.Array]:
    """Units (first words, end words, kind) with their hashes and places; `at` is start and length, 32 bits each."""
    first, end = (np.concatenate([u[k] for u in units]) for k in (0, 1))
    kind = np.concatenate([np.full(len(u[0]), u[2], np.int32) for u in units])
    text, start, stop = words.places(first, end) if len(first) else (first, first, end)
    owner = pa.array(text.astype(np.int64) + row)
    check = np.where(kind == LINE, 0, words.checks(first, end))
    at = (start.astype(np.int64) << 32) | (stop - start).astype(np.int64)
    return [pa.array(words.keys(first, end)), pa.array(check), pa.array(kind), batch["doc_id"].take(owner), batch["text_key"].take(owner), pa.array(at)]


def units(docs: DataFrame, whole, mixed, near) -> DataFrame:
    """Groups that may repeat, and near lines: key, check, kind, doc_id, text_key, at."""

    def work(batch: pa.RecordBatch, row: int, words: Words) -> list[pa.Array]:
        (a, b), (anchor, first, end) = words.lines(), words.groups()
        mark = words.marks(anchor, anchor + ANCHOR_WORDS, 0)
        line, one, some = maybe_in(near.value, words.keys(a, b)), maybe_in(whole.value, mark), maybe_in(mixed.value, mark)
        end = end + LEAST_WORDS - 1
        some |= (one | some) & words.overlapping(first, end)
        one &= ~some
        return _rows(batch, row, words, [(first[one], end[one], WHOLE), (first[some], end[some], MIXED), (a[line], b[line], LINE)])

    return _scan(docs, PLACES, work)


#: A number of a place (d being the doc_id, 0 if null) for filters, in SQL and in Python. Places of one
#: text differ in few bits, so these are hashed; otherwise all would crowd one word of a filter.
PLACE_SQL = "xxhash64(text_key ^ shiftleft(at, 20) ^ shiftrightunsigned(at, 13) ^ shiftleft(d, 7) ^ shiftleft(d, 41))"
_PRIMES = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def xxhash_longs(x: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of each long."""
    n, (a, b, c, d, e) = np.uint64, _PRIMES
    turned = lambda v, k: (v << n(k)) | (v >> n(64 - k))
    h = turned(turned(x * b, 31) * a ^ (np.full(1, 50, np.uint64) + e), 27) * a + d
    h = (h ^ (h >> n(33))) * b
    h = (h ^ (h >> n(29))) * c
    return h ^ (h >> n(32))


def _place_number(d: np.ndarray, text_key: np.ndarray, at: np.ndarray) -> np.ndarray:
    n = np.uint64
    return xxhash_longs(text_key ^ (at << n(20)) ^ (at >> n(13)) ^ (d << n(7)) ^ (d << n(41))).view(np.int64)


def _windows_of(batch: pa.RecordBatch, row: int, words: Words, mixed, firsts) -> np.ndarray:
    """First words of the windows of the groups of mixed anchors whose place may be in the filter `firsts`.

    And of groups that overlap an equal one before them, as in "a b a b a b": there the group's first
    occurrence stays, and what it leaves of this one begins after the first window, not after the group.
    """
    anchor, first, end = words.groups()
    again = words.overlapping(first, end + LEAST_WORDS - 1)
    some = again | maybe_in(mixed.value, words.marks(anchor, anchor + ANCHOR_WORDS, 0))
    # the equal ones before them, whose anchor may have no other group
    some |= np.isin(keys := words.keys(first, end + LEAST_WORDS - 1), keys[again]) if again.any() else False
    first, end, again = first[some], end[some], again[some]
    if len(first):
        _, __, ___, doc, text, at = _rows(batch, row, words, [(first, end + LEAST_WORDS - 1, MIXED)])
        doc, text, at = (x.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) for x in (doc, text, at))
        own = maybe_in(firsts.value, _place_number(doc, text, at))
        # of those that overlap, the first window is enough: they begin later by as many windows as a group has
        end = np.where(own, end, first + 1)
        first, end = first[own | again], end[own | again]
    count = end - first
    offsets = np.cumsum(count) - count
    return np.repeat(first - offsets, count) + np.arange(count.sum())


def window_keys(docs: DataFrame, mixed, firsts, only) -> DataFrame:
    """Keys of those windows in texts of the filter `only`, to count them before their places are written."""

    def work(batch: pa.RecordBatch, row: int, words: Words) -> list[pa.Array]:
        at = _windows_of(batch, row, words, mixed, firsts)
        return [pa.array(words.keys(at, at + LEAST_WORDS))]

    return _scan(docs, "key long", work, only)


def windows(docs: DataFrame, mixed, firsts, repeated, only) -> DataFrame:
    """Those windows whose key may be in the filter `repeated`, with their places."""

    def work(batch: pa.RecordBatch, row: int, words: Words) -> list[pa.Array]:
        at = _windows_of(batch, row, words, mixed, firsts)
        at = at[maybe_in(repeated.value, words.keys(at, at + LEAST_WORDS))]
        return _rows(batch, row, words, [(at, at + LEAST_WORDS, WINDOW)])

    return _scan(docs, PLACES, work, only)


def jaccard_at_least(a: Column, b: Column, threshold: float = THRESHOLD) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both >= threshold * (F.size(a) + F.size(b) - both)


def rare_shingles(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, size, parts, heads): the rarest shingles of these lines, by counts that shingles of equal last bits share.

    Two sets of sizes m <= n at a Jaccard similarity of t share t n members at least, and 2 t / (1 + t) m:
    so in any common order one of the first m - ceil(2 t / (1 + t) m) + 1 (heads) of the one is among
    the first n - ceil(t n) + 1 (parts) of the other.
    """
    own = durable(lines.join(nodes, F.col("line") == F.col("node"), "left_semi").select(F.col("line").alias("node"), "shingles"))
    slot = F.col("shingle").bitwiseAND(F.lit(COUNTERS - 1).cast("long")).alias("slot")
    found = own.select(F.explode("shingles").alias("shingle")).groupBy(slot).agg(F.count("*").alias("k")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[found["slot"].to_numpy()] = found["k"].to_numpy()
    counts = own.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pc.list_value_length(batch["shingles"]).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch["shingles"].flatten().to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            flat = flat[np.lexsort((flat, counts.value[flat & (COUNTERS - 1)], row))]
            first = lambda share: n - np.ceil(n * share - 1e-9).astype(np.int64) + 1
            own, heads = first(THRESHOLD), first(2 * THRESHOLD / (1 + THRESHOLD))
            parts = flat[np.arange(len(flat)) - (np.cumsum(n) - n)[row] < own[row]]
            parts = _lists(parts, np.concatenate([[0], np.cumsum(own)]))
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(n), parts, pa.array(heads)], ["node", "size", "parts", "heads"])

    return own.mapInArrow(run, "node long, size long, parts array<long>, heads long")


def near_paragraphs(docs: DataFrame, bands) -> DataFrame:
    """(key, component) of the paragraphs that are near another one, equal ones being one node."""
    lines = durable(candidate_lines(docs, bands)).withColumnRenamed("key", "line")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = durable(pairs)
        few = pairs.count() <= BROADCAST_PAIRS
        sent = F.broadcast if few else lambda x: x
        # shingles are shuffled once for each pair, to those of the second line
        own = lines.join(sent(pairs), F.col("line") == F.col("u")).select("u", "v", F.col("shingles").alias("a"))
        other = lines.join(sent(pairs.select(F.col("v").alias("__v")).distinct()), F.col("line") == F.col("__v"), "left_semi").select(F.col("line").alias("v"), F.col("shingles").alias("b"))
        return own.join(other, "v").where(jaccard_at_least(F.col("a"), F.col("b"))).select("u", "v")

    members = lines.select(F.explode("cells").alias("cell"), F.col("line").alias("node"), "n")
    return components(cell_links(members, verified, parts_of=lambda nodes: rare_shingles(lines, nodes), share=THRESHOLD / (1 + THRESHOLD), most_pairs=MOST_PAIRS)).withColumnRenamed("node", "key")


def _place() -> Column:
    """Places in order: doc_id, null last, then text_key and start."""
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "at")


def _firsts(rows: DataFrame) -> DataFrame:
    """component, check, n, kind and the first place of each unit."""
    return rows.groupBy("component", "check").agg(F.count("*").alias("n"), F.max("kind").alias("kind"), F.min(_place()).alias("first"))


#: What goes on of units with their first place; the check of near lines is 0.
FOUND = ["doc_id", "text_key", "at", "component", "first", "check"]


def _with_firsts(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows of the units in `firsts`. Few units are broadcast; of many, those of very many rows are, and the others are shuffled."""
    side = firsts.select(F.col("component").alias("__c"), F.col("check").alias("__k"), "n", "first")
    on = (F.col("component") == F.col("__c")) & (F.col("check") == F.col("__k"))
    if firsts.count() <= BROADCAST_UNITS:
        return rows.join(F.broadcast(side), on).select(*FOUND)
    hot, cold = side.where(F.col("n") >= HOT_UNIT), side.where(F.col("n") < HOT_UNIT)
    if hot.count() > BROADCAST_UNITS:
        return rows.join(side, on).select(*FOUND)
    known = rows.join(F.broadcast(hot), on, "left")
    # one reading of the rows for both kinds: those of no hot unit go on to the shuffle
    return known.where("first is not null").select(*FOUND).unionByName(known.where("first is null").drop("first", "n", "__c", "__k").join(cold, on).select(*FOUND))


def _counted_with_firsts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of the units of two or more rows, with the first place; `counts` has the number n of each component's rows, where over one.

    Units of few rows are shuffled once, to a window of at most HOT_UNIT rows; those of more are
    combined before the shuffle and their first places are broadcast.
    """
    hot = counts.where(F.col("n") >= HOT_UNIT).select(F.col("component").alias("__c"), F.lit(True).alias("hot"))
    n_hot = hot.count()
    if n_hot > BROADCAST_UNITS:
        return _with_firsts(rows, durable(_firsts(rows).where("n > 1")))
    unit = Window.partitionBy("component", "check")
    if n_hot:
        rows = rows.join(F.broadcast(hot), F.col("component") == F.col("__c"), "left")
    cold = rows.where("hot is null") if n_hot else rows
    cold = cold.withColumns({"n": F.count("*").over(unit), "first": F.min(_place()).over(unit)}).where("n > 1").select(*FOUND)
    if not n_hot:
        return cold
    rows = rows.where("hot").drop("hot", "__c")
    return cold.unionByName(_with_firsts(rows, durable(_firsts(rows).where("n > 1"))))


def repeats(docs: DataFrame) -> DataFrame:
    """Occurrences of repeated units: doc_id, text_key, copy, n_rows, start, stop (code points, end exclusive), component, removed, kept_in.

    Rows of equal doc_id and text are told apart as the first of them (n_rows 1) and all others
    (copy true, n_rows their number), of which everything repeated is removed. kept_in is the doc_id of the
    component's first occurrence, in order of doc_id, text_key (a hash of the text) and start. An
    occurrence that overlaps the first one of its own text starts where that one stops.

    Nulls: a null text has no units; a null doc_id goes last and is kept null. Other columns are
    ignored; an empty table gives no rows.
    """
    send = docs.sparkSession.sparkContext.broadcast
    whole, mixed, bands = repeated_marks(docs)
    near = durable(near_paragraphs(docs, bands))
    n_near = near.count()
    found = durable(units(docs, whole, mixed, send(key_filter(near, n_near))))
    lines = near.select(F.col("key").alias("__key"), "component")
    lines = found.where(F.col("kind") == LINE).join(F.broadcast(lines) if n_near <= BROADCAST_UNITS else lines, F.col("key") == F.col("__key")).drop("key", "__key")
    rows = lines.unionByName(found.where(F.col("kind") != LINE).withColumnRenamed("key", "component"))
    firsts = durable(_firsts(rows).where((F.col("n") > 1) | (F.col("kind") == MIXED)))
    one = firsts.where(F.col("kind") == MIXED).select(F.coalesce("first.doc_id", F.lit(0)).alias("d"), "first.text_key", "first.at")
    xor = one.select(F.expr(PLACE_SQL).alias("key"))
    heads = send(key_filter(xor, firsts.count()))
    owners = one.select(F.col("text_key").alias("key")).distinct()
    only = send(key_filter(owners, owners.count()))
    counts = durable(window_keys(docs, mixed, heads, only).groupBy(F.col("key").alias("component")).agg(F.count("*").alias("n")).where("n > 1"))
    twice = send(key_filter(counts.select(F.col("component").alias("key")), counts.count()))
    parts = durable(windows(docs, mixed, heads, twice, only).withColumnRenamed("key", "component"))
    parts = _counted_with_firsts(parts, counts)
    rows = _with_firsts(rows, firsts.where("n > 1")).withColumn("part", F.lit(False)).unionByName(parts.withColumn("part", F.lit(True)))
    # equal rows of the table have equal units; a group of one window is a window too, and may be a line
    line = F.col("check") == 0
    many = F.greatest(F.count_if("part"), F.count_if(~F.col("part") & ~F.col("line")), F.count_if("line"))
    # of the first place go on its document, and where it is if it lies in the text itself
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    rows = rows.select("doc_id", "text_key", "at", "component", "part", line.alias("line"), F.col("first.doc_id").alias("kept_in"), F.when(own, F.col("first.at")).alias("first"))
    rows = rows.groupBy("doc_id", "text_key", "at", "component", "kept_in", "first").agg(many.alias("__many"))
    others = F.struct((F.col("__many") - 1).alias("n_rows"), F.lit(True).alias("other"))
    once = F.struct(F.lit(1).cast("long").alias("n_rows"), F.lit(False).alias("other"))
    rows = rows.withColumn("__rows", F.explode(F.when(F.col("__many") > 1, F.array(once, others)).otherwise(F.array(once))))
    low = lambda c: F.shiftrightunsigned(c, 32)
    high = lambda c: F.shiftrightunsigned(c, 32) + c.bitwiseAND(F.lit((1 << 32) - 1))
    rows = rows.withColumns({"start": low(F.col("at")), "stop": high(F.col("at")), "__start": low(F.col("first")), "__stop": high(F.col("first"))})
    own = F.col("first").isNotNull() & ~F.col("__rows.other")
    removed = ~(own & (F.col("start") == F.col("__start")))
    meets = own & (F.col("start") > F.col("__start")) & (F.col("start") < F.col("__stop")) & (F.col("stop") > F.col("__stop"))
    start = F.when(meets, F.col("__stop")).otherwise(F.col("start"))
    return rows.select("doc_id", "text_key", F.col("__rows.other").alias("copy"), "__rows.n_rows", start.alias("start"), "stop", "component", removed.alias("removed"), "kept_in")


def removals(rows: DataFrame) -> DataFrame:
    """Occurrences to one row for each of doc_id, text_key and copy: n_rows, n_units, n_removed, spans without overlaps, kept_in.

    Spans are merged along the sorted occurrences of a text, whose number its length bounds.
    """
    keys = ["doc_id", "text_key", "copy", "n_rows"]
    order = Window.partitionBy(*keys).orderBy("start", "stop")
    reach = F.max(F.when(F.col("removed"), F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("removed"), (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int")).otherwise(0)
    rows = rows.withColumn("__begins", begins).withColumn("__span", F.sum("__begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = rows.groupBy(*keys, "__span").agg(
        F.count("*").alias("n"), F.count_if("removed").alias("gone"), F.collect_set("kept_in").alias("kept"),
        F.min(F.when(F.col("removed"), F.col("start"))).alias("start"), F.max(F.when(F.col("removed"), F.col("stop"))).alias("stop"),
    )
    span = F.when(F.col("start").isNotNull(), F.struct("start", "stop"))
    return spans.groupBy(*keys).agg(
        F.sum("n").alias("n_units"), F.sum("gone").alias("n_removed"), F.array_sort(F.collect_list(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("kept")))).alias("kept_in"),
    )


def op6_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document with a repeated unit: its spans to remove and the documents that keep them."""
    found = removals(repeats(read(spark, sf_dir, "documents")))
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["stop"])), ",")
    return found.select("doc_id", "copy", "n_rows", "n_units", "n_removed", text.alias("removed_spans"), "kept_in")

"""Best-fit packing planned over a histogram of lengths.

Documents are tokenized once; those longer than a sequence are cut. Best-fit decreasing then runs
over the counts of each length (at most `capacity` of them, whatever the corpus) and plans slots;
pieces take the slots by their rank within their length.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import durable, fraction, read, running_total

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
BUCKET_ROWS = 256
#: Texts of these characters are coded by ranks, with words split by `SPLIT`, which takes the same
#: words as the tokenizer's own pattern with less backtracking; libraries may differ on the classes
#: of other characters, so any other text goes to the tokenizer, and so does a text that holds the
#: string of one of the tokenizer's added tokens, or a run of white space so long that a pattern
#: with a look ahead could run out of stack on it.
PLAIN = re.compile(r"[\t-\r\x20-\x7E\u00A1-\u024F\u2010-\u2027\u2030-\u205E]*")
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
LONG_GAP = re.compile(r"\s{5000}")
RANKS = "byte_bpe_50k.tiktoken"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, ranks: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added)) if added else None
        with open(ranks, "rb") as lines:
            order = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=order, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        ranked = PLAIN.fullmatch(text) and not (self.special and self.special.search(text)) and not LONG_GAP.search(text)
        ids = self.plain(text) if ranked else self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()


@lru_cache(maxsize=2)
def encoder_for(path: str, ranks: str) -> Encoder:
    """A worker's encoder, which its later tasks find again."""
    return Encoder(path, ranks)


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all are full but the first."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False, ranks: str | None = None) -> DataFrame:
    """Pieces of the tokenized documents: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    `path` and `ranks` are the tokenizer's file and the file of the same vocabulary as ranks.

    A null or empty text is the end id alone. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_for(path or tokenizer_path(), ranks or tokenizer_path(RANKS)), np.asarray([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            ids: list[np.ndarray] = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                data = encoder.encode(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append((doc, k, start, length, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype("i4"))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays, names = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing over counts; runs (length, first_rank, n, first_sequence, per_sequence, offset) and the number of sequences.

    The pieces of `length` with ranks first_rank..first_rank+n-1 go, per_sequence to each, to the
    sequences from first_sequence on, the first at `offset`. Sequences of like fill are kept as
    ranges, so the work follows the number of different lengths, not of pieces: each length splits
    one range at most, and a sequence holds fewer than sqrt(2 * capacity) different lengths.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    open_: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first, count)
    made = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def put(first: int, count: int, room: int, length: int = length) -> None:
            """Fill sequences of a range as far as pieces are left."""
            nonlocal left, rank
            each = room // length
            while count and left:
                k = min(each, left)
                many = min(count, left // k)
                runs.append((length, rank, many * k, first, k, capacity - room))
                if room - k * length:
                    open_.setdefault(room - k * length, []).append((first, many))
                first, count, left, rank = first + many, count - many, left - many * k, rank + many * k
            if count and room < capacity:
                open_.setdefault(room, []).append((first, count))

        for room in sorted(r for r in open_ if r >= length):
            if not left:
                break
            for first, count in open_.pop(room):
                put(first, count, room)
        if left:
            new = -(-left // (capacity // length))
            put(made, new, capacity)
            made += new
    return runs, made


def pack(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset for each piece of `cuts` (doc_id, piece, length and others); one row each.

    `cuts` has to give the same rows in the same partitions each time it is read, as a checkpoint or
    a table does: ranks within a length come from a hash of the row's number, by prefix sums over
    buckets, so neither a length that very many pieces share nor pieces of one doc_id (nulls, say)
    are ordered in one task. Repeated rows are pieces of their own.
    """
    spark = cuts.sparkSession
    histogram = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs, _ = plan(histogram, capacity)
    bounds = spark.createDataFrame([(k, -(-n // BUCKET_ROWS)) for k, n in histogram.items()] or [(0, 1)], "__length long, __deal long")
    slots = spark.createDataFrame(runs or [(0, 0, 0, 0, 1, 0)], "__length long, __from long, __n long, __first long, __each long, __at long")
    # both tables are bounded by the capacity: a row for each length, and the runs of the plan
    rows = cuts.withColumn("__key", F.xxhash64(F.monotonically_increasing_id())).join(F.broadcast(bounds), F.col("length") == F.col("__length")).drop("__length")
    rows = rows.withColumn("__bucket", F.floor(fraction(F.col("__key")) * F.col("__deal"))).withColumn("__one", F.lit(1).cast("long"))
    most = max(histogram.values(), default=0)
    rows = running_total(rows, ["length"], "__bucket", [F.col("__key")], "__one", "__rank", -(-most // BUCKET_ROWS))
    own = (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__from") + F.col("__n"))
    rows = rows.join(F.broadcast(slots), own)
    nth = F.col("__rank") - F.col("__from")
    rows = rows.withColumn("sequence_id", (F.col("__first") + F.floor(nth / F.col("__each"))).cast("long"))
    return rows.withColumn("offset", (F.col("__at") + F.col("length") * (nth % F.col("__each"))).cast("long")).select(*cuts.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces of all documents (doc_id, text) with their sequence and offset.

    Nulls: a null text counts as empty, which is the end id alone; a null doc_id is kept. Repeated
    rows are packed as often as they occur. An empty table gives no rows.
    """
    return pack(durable(pieces(docs, capacity, path)), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, doc_ids and starts, in order of offset."""
    packed = pack(durable(pieces(docs, capacity, path, with_ids=True)), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return whole.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("starts"))


def op10_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

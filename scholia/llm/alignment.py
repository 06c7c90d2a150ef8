"""Alignment of two tokenizers' tokens by the bytes that they own.

Tokens of both are laid over the same bytes: repeating each token's number once a byte gives an array
of owners for A and one for B. Consecutive different pairs of owners are the links, and places
where both owners change are the cuts between groups. Documents of a chunk are worked on as one array.

How many documents hold a pair is summed over the corpus. Each chunk lists its different pairs once,
so what is shuffled is a row for each pair of a chunk, not for each link of a document; the sums
come back to the chunk and meet its packed links, which are read a second time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .infill import blocks, utf8
from .packing import RANKS, VOCABULARY, Encoder, encoder_for, tokenizer_path
from .util import durable, read

PIECES = "piece_bpe_32k.model"
#: A chunk holds so many documents and bytes of text at most, or one longer document.
CHUNK_ROWS, CHUNK_BYTES = 8192, 4 << 20
#: A pair of ids is one long: the id of A, then this many bits for the id of B.
B_BITS = 20
SEPARATORS = (b",", b"|", b";")

COLUMNS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
#: Rows of the first pass. `figures` has five longs a document: its tokens in A and B, groups, links
#: and different pairs. `gaps` has their numbers among the chunk's `pairs`, each less the one before,
#: `times` how often each occurs; `docs` is how many of the chunk's documents hold each pair.
CHUNKS = "chunk long, doc_ids array<long>, figures binary, digests array<string>, gaps binary, times binary, pairs array<long>, docs array<int>"


RESULT = pa.schema([(part.split()[0], pa.string() if part.endswith("string") else pa.int64()) for part in COLUMNS.split(", ")])


class Side:
    """A tokenizer's ids for texts, and the bytes of each id."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        #: for each separator, each id's decimal form followed by it
        self.named = [[b"%d%s" % (k, s) for k in range(len(pieces))] for s in SEPARATORS]


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters stand for themselves, and those from U+0100 on for the other bytes in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(others)}


class PlainEncoder(Encoder):
    """Codes with the strings of special tokens as ordinary text."""

    def __init__(self, path: str, ranks: str):
        super().__init__(path, ranks)
        self.tokenizer.encode_special_tokens = True
        self.special = None


@lru_cache(maxsize=2)
def sides(path_a: str, ranks: str, path_b: str) -> tuple[Side, Side]:
    """Both tokenizers of a worker, which its later tasks find again."""
    import sentencepiece

    encoder = PlainEncoder(path_a, ranks)
    byte = byte_of_character()
    names = [encoder.tokenizer.id_to_token(k) for k in range(encoder.tokenizer.get_vocab_size())]
    a = [bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode() for name in names]
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    b = []
    for k in range(model.get_piece_size()):
        name = model.id_to_piece(k)
        b.append(bytes([int(name[3:5], 16)]) if model.is_byte(k) else name.replace("▁", " ").encode())
    encode_a = lambda texts: [np.frombuffer(encoder.encode(" " + t), "<u4").tolist() for t in texts]
    return Side(encode_a, a), Side(lambda texts: model.encode(texts, num_threads=1), b)


def joined(side: Side, ids: list[int]) -> bytes:
    return b"".join(map(side.pieces.__getitem__, ids))


def owners(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each byte the number of the token that it belongs to."""
    return np.repeat(np.arange(len(ids)), lengths[ids])


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the A and B tokens of each link, and whether the link is the first of a group.

    `a` and `b` are owners of the same bytes.
    """
    if not len(a):
        return a, b, np.zeros(0, bool)
    new_a, new_b = a[1:] != a[:-1], b[1:] != b[:-1]
    at = np.concatenate([[0], np.flatnonzero(new_a | new_b) + 1])
    cut = np.concatenate([[True], (new_a & new_b)[at[1:] - 1]])
    return a[at], b[at], cut


def group_names(side_a: Side, side_b: Side, ids: tuple[np.ndarray, np.ndarray], groups: tuple[np.ndarray, np.ndarray], firsts: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` for each document.

    `groups` numbers each token's group over the chunk, `firsts` each document's first token. Within
    a group A's tokens come first; a comma follows a token but the last of its side, which a bar
    follows in A and a semicolon in B.
    """
    parts: list[list[bytes]] = []
    for side, own, group, last in ((side_a, ids[0], groups[0], 1), (side_b, ids[1], groups[1], 2)):
        kind = np.zeros(len(own), np.int64)
        if len(own):
            kind[:-1][group[1:] != group[:-1]] = last
            kind[-1] = last
        parts.append([side.named[s][k] for s, k in zip(kind.tolist(), own.tolist(), strict=True)])
    # a token's place: those of its own side before it, and the other side's tokens of earlier groups (for B, of its own group too)
    place_a = np.arange(len(ids[0])) + np.searchsorted(groups[1], groups[0], "left")
    place_b = np.arange(len(ids[1])) + np.searchsorted(groups[0], groups[1], "right")
    row = np.empty(len(ids[0]) + len(ids[1]), object)
    row[place_a], row[place_b] = parts
    starts = (firsts[0] + firsts[1]).tolist()
    return [b"".join(row[x:y])[:-1] for x, y in zip(starts[:-1], starts[1:], strict=True)]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2**32 - 1, byte by byte of their four, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True) if n else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(n).astype(np.int64)


def align(side_a: Side, side_b: Side, texts: list[str], wants_groups: bool = True) -> dict[str, np.ndarray | list]:
    """Tokens, links and groups of a chunk's texts, one after another.

    first_a, first_b, first_link: where each document's tokens and links begin, and the totals;
    ids_a, ids_b: ids; link_a, link_b: numbers of the linked tokens; n_groups and, if wanted, groups
    (as text) of each document. A text whose tokens' bytes aren't a space and the text has no tokens.
    """
    all_a, all_b = side_a.encode(texts), side_b.encode(texts)
    for k, text in enumerate(texts):
        whole = b" " + text.encode()
        if not text or joined(side_a, all_a[k]) != whole or joined(side_b, all_b[k]) != whole:
            all_a[k] = all_b[k] = []
    first_a, first_b = (np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64) for ids in (all_a, all_b))
    ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (all_a, all_b))
    link_a, link_b, cut = overlaps(owners(ids_a, side_a.lengths), owners(ids_b, side_b.lengths))
    # documents end in a cut, as both owners change there
    first_link = np.searchsorted(link_a, first_a, "left")
    number = np.cumsum(cut) - 1
    group_a, group_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    group_a[link_a], group_b[link_b] = number, number
    cuts = np.concatenate([[0], np.cumsum(cut)])
    out = {"first_a": first_a, "first_b": first_b, "first_link": first_link, "ids_a": ids_a, "ids_b": ids_b, "link_a": link_a, "link_b": link_b, "n_groups": np.diff(cuts[first_link])}
    if wants_groups:
        out["groups"] = group_names(side_a, side_b, (ids_a, ids_b), (group_a, group_b), (first_a, first_b))
    return out


def chunk_row(side_a: Side, side_b: Side, ids: list[int | None], texts: list[str]) -> dict:
    """The columns of CHUNKS, but the first, for some documents."""
    found = align(side_a, side_b, texts)
    n_links = np.diff(found["first_link"])
    pair = (found["ids_a"][found["link_a"]] << B_BITS) | found["ids_b"][found["link_b"]]
    pairs, number = np.unique(pair, return_inverse=True)
    of = np.repeat(np.arange(len(texts)), n_links)
    held, times = np.unique(of * max(len(pairs), 1) + number, return_counts=True)  # in order of document and pair
    doc, number = np.divmod(held, max(len(pairs), 1))
    different = np.bincount(doc, minlength=len(texts))
    gaps = np.diff(number, prepend=0)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    gaps[first] = number[first]
    figures = np.stack([np.diff(found["first_a"]), np.diff(found["first_b"]), found["n_groups"], n_links, different])
    return {
        "doc_ids": ids, "figures": figures.astype("<i8").tobytes(), "digests": [hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]],
        "gaps": packed(gaps), "times": packed(times), "pairs": pairs, "docs": np.bincount(number, minlength=len(pairs)).astype("i4"),
    }


def chunks(docs: DataFrame, paths: tuple[str | None, str | None, str | None] = (None, None, None)) -> DataFrame:
    """Rows of CHUNKS over (doc_id, text). `paths`: A's tokenizer, its ranks, B's model.

    Chunks are numbered within their partition, so a table of them has to be kept before it is used twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = sides(paths[0] or tokenizer_path(VOCABULARY), paths[1] or tokenizer_path(RANKS), paths[2] or tokenizer_path(PIECES))
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, starts = utf8(batch["text"])
            whole = memoryview(data)
            for p, q in blocks(starts, CHUNK_BYTES):
                for x in range(p, q, CHUNK_ROWS):
                    y = min(q, x + CHUNK_ROWS)
                    at = starts[x : y + 1].tolist()
                    texts = [str(whole[s:e], "utf-8") for s, e in zip(at[:-1], at[1:], strict=True)]
                    row = {"chunk": number} | chunk_row(a, b, batch["doc_id"][x:y].to_pylist(), texts)
                    number += 1
                    yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

    longs, schema = pa.list_(pa.int64()), pa.schema([])
    for name, kind in (("chunk", pa.int64()), ("doc_ids", longs), ("figures", pa.binary()), ("digests", pa.list_(pa.string())), ("gaps", pa.binary()), ("times", pa.binary()), ("pairs", longs), ("docs", pa.list_(pa.int32()))):
        schema = schema.append(pa.field(name, kind))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, CHUNKS)


def pair_counts(listed: DataFrame) -> DataFrame:
    """pair, n (documents that hold it) and best (whether no pair of the same A id has more)."""
    counts = listed.groupBy("pair").agg(F.sum("docs").alias("n"))
    owner = F.shiftright("pair", B_BITS)
    most = counts.groupBy(owner.alias("owner")).agg(F.max("n").alias("most"))  # a row for each id of A: bounded by its vocabulary
    return counts.join(F.broadcast(most), owner == F.col("owner")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _documents(chunk: pa.Table, sums: pa.Table) -> pa.Table:
    """A chunk's documents with the corpus-wide counts of their links."""
    rows = chunk.to_pylist()
    if not rows:
        return pa.table([[]] * len(RESULT), schema=RESULT)
    row = rows[0]
    n_a, n_b, n_groups, n_links, different = np.frombuffer(row["figures"], "<i8").reshape(5, -1)
    order = np.argsort(sums["number"].to_numpy())
    n, best = sums["n"].to_numpy()[order], sums["best"].to_numpy()[order]
    held = int(different.sum())
    gaps, times = unpacked(row["gaps"], held), unpacked(row["times"], held)
    ends = np.cumsum(different)
    number = np.cumsum(gaps)
    first = (ends - different)[different > 0]  # a document's first gap is counted from nought
    number -= np.repeat(np.concatenate([[0], number])[first], different[different > 0])
    total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])])
    columns = [row["doc_ids"], n_a, n_b, n_groups, n_links, total(times * best[number]), total(times * n[number]), row["digests"]]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)], schema=RESULT)


def alignments(docs: DataFrame, paths: tuple[str | None, str | None, str | None] = (None, None, None)) -> DataFrame:
    """Figures of each document's alignment, COLUMNS, one row for each row of `docs` (doc_id, text).

    A link is a pair of an A and a B token that share a byte, a group the tokens between two cuts.
    n_best counts the links whose pair of ids is held by as many documents as any of the same A id,
    count_sum adds up the documents of all links. A null or empty text, or one whose tokens don't
    give back a space and the text, has no tokens: zeros and an empty digest. Repeated rows are
    documents of their own; a null id is kept; other columns of any name are ignored; an empty
    table gives no rows.
    """
    made = durable(chunks(docs, paths))
    listed = made.select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("number", "held")).select("chunk", "number", F.col("held.pairs").alias("pair"), F.col("held.docs").alias("docs"))
    sums = listed.drop("docs").join(pair_counts(listed), "pair").select(F.col("chunk").alias("of"), "number", "n", "best")
    return made.drop("pairs", "docs").groupBy("chunk").cogroup(sums.groupBy("of")).applyInArrow(_documents, COLUMNS)


def token_links(docs: DataFrame, paths: tuple[str | None, str | None, str | None] = (None, None, None)) -> DataFrame:
    """The links themselves: doc_id, a_ids, b_ids, and for each link the numbers of its tokens (link_a, link_b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(paths[0] or tokenizer_path(VOCABULARY), paths[1] or tokenizer_path(RANKS), paths[2] or tokenizer_path(PIECES))
        names = ["doc_id", "a_ids", "b_ids", "link_a", "link_b"]
        for batch in batches:
            for k, text in enumerate(batch["text"].to_pylist()):
                found = align(a, b, [text or ""], wants_groups=False)
                arrays = [pa.array([found[c]], pa.list_(pa.int64())) for c in ("ids_a", "ids_b", "link_a", "link_b")]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(k, 1), *arrays], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, a_ids array<long>, b_ids array<long>, link_a array<long>, link_b array<long>")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' alignments between the byte-level and the piece vocabulary."""
    return alignments(read(spark, sf_dir, "documents"))

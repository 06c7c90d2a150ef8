"""Fill-in-middle: documents are cut into prefix, middle and suffix, and the middle goes last.

All rows of an Arrow batch are cut together, on the bytes of its UTF-8 buffer: a table of byte
classes gives white space, a mask over neighbouring bytes gives the ends of tokens, cumulative sums
taken back at each document's first byte number them, and one `searchsorted` finds all cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import SPACE, read

SEED = 42
#: Of 100 documents so many are rearranged, and of 100 of those so many start with the suffix.
RATE, SPM_SHARE = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text worked on at once; a longer text is worked on alone.
BLOCK_BYTES = 4 << 20

COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE.encode())] = True
#: Bytes that begin a character.
IS_START = (np.arange(256) & 0xC0) != 0x80
IS_MARK = np.zeros(256, bool)
IS_MARK[[ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)]] = True


def token_ends(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mask of the last bytes of tokens; `starts` has the documents' first bytes and the total last.

    A token is white space and the word behind it, or white space that ends a document.
    """
    space = IS_SPACE[data]
    ends = np.zeros(len(data), bool)
    ends[:-1] = ~space[:-1] & space[1:]
    ends[starts[1:][starts[1:] > starts[:-1]] - 1] = True
    return ends


def marked(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether each document holds one of the three marks."""
    found = np.flatnonzero((data[:-2] == ord("<")) & IS_MARK[data[1:-1]] & (data[2:] == ord(">"))) if len(data) > 2 else np.zeros(0, int)
    of = np.searchsorted(starts, found, "right") - 1
    out = np.zeros(len(starts) - 1, bool)
    out[of[found + 2 < starts[of + 1]]] = True
    return out


def keys(ids: list[int | None], seed: int) -> np.ndarray:
    """Four unsigned numbers of each id, from the SHA-256 of the seed and the id; a null id is no digits."""
    data = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(data, ">u4").reshape(-1, 4).astype(np.int64)


def rearrange(ids: list[int | None], data: np.ndarray, starts: np.ndarray, seed: int, rate: int, spm_share: int) -> list[pa.Array]:
    """The columns after doc_id for documents whose UTF-8 bytes are `data[starts[k]:starts[k + 1]]`."""
    h = keys(ids, seed)
    ended = np.concatenate([[0], np.cumsum(token_ends(data, starts))])
    before = ended[starts[:-1]]
    n = ended[starts[1:]] - before
    places = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    # the first position at which so many tokens have ended; no token is the document's first byte
    cuts = np.maximum(np.searchsorted(ended, before[:, None] + places, "left"), starts[:-1, None])
    plain = (n == 0) | marked(data, starts) | (h[:, 2] % 100 >= rate)
    spm = ~plain & (h[:, 3] % 100 < spm_share)
    chars = np.concatenate([[0], np.cumsum(IS_START[data])])
    at = chars[cuts]
    whole, p, s, m = memoryview(data).cast("B"), PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    output = []
    for a, b, x, y, is_plain, is_spm in zip(starts[:-1].tolist(), starts[1:].tolist(), cuts[:, 0].tolist(), cuts[:, 1].tolist(), plain.tolist(), spm.tolist(), strict=True):
        if is_plain:
            output.append(whole[a:b].tobytes())
        elif is_spm:
            output.append(b"".join((s, whole[y:b], p, whole[a:x], m, whole[x:y])))
        else:
            output.append(b"".join((p, whole[a:x], s, whole[y:b], m, whole[x:y])))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return [
        pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
        pa.array(at[:, 0] - chars[starts[:-1]], pa.int64(), mask=plain), pa.array(at[:, 1] - at[:, 0], pa.int64(), mask=plain),
        pa.array(output, pa.binary()).cast(pa.string()),
    ]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts, the total last; a null is empty."""
    wide = isinstance(texts, pa.LargeStringArray)
    _, offsets, values = texts.buffers()
    starts = np.frombuffer(offsets, "<i8" if wide else "<i4")[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.null_count:  # a null's slot may have bytes
        return utf8(texts.fill_null(""))
    data = np.frombuffer(values, np.uint8)[starts[0] : starts[-1]] if values is not None else np.zeros(0, np.uint8)
    return data, starts - starts[0]


def blocks(starts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` bytes, or of one row."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + most, "right")) - 1)
        yield first, min(last, rows)
        first = last


def infill(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """Documents (doc_id, text) rearranged: doc_id, n tokens, form, prefix_chars, middle_chars, output.

    Forms are plain (the text), psm (`<P>` prefix `<S>` suffix `<M>` middle) and spm (`<S>` suffix
    `<P>` prefix `<M>` middle). Cuts and form follow from the seed and the id alone. A null text is
    empty; an empty text and one that holds a mark stay plain; a null id hashes as no digits; a text
    of white space is one token. Repeated rows give repeated rows, other columns of any name are
    ignored, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in COLUMNS.split(", ")]
        for batch in batches:
            data, starts = utf8(batch["text"])
            for a, b in blocks(starts, BLOCK_BYTES):
                ids = batch["doc_id"].slice(a, b - a)
                columns = rearrange(ids.to_pylist(), data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], seed, rate, spm_share)
                yield pa.RecordBatch.from_arrays([ids, *columns], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COLUMNS)


def restored(form: Column, output: Column) -> Column:
    """The text that an output of `infill` was made of."""
    part = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged, with digests of the output and of the text rebuilt from it."""
    rows = infill(read(spark, sf_dir, "documents"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


OP13_SQL = r"""
WITH tokens AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), hashes AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
    ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
  FROM tokens
), places AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM hashes
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s
  FROM places
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

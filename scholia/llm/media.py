"""Media columns: payloads as lossless motion JPEG in AVI files, and clips found by shot detection.

A payload is cut into 24 x 24 frames of 8-bit samples. Each is a lossless JPEG (process 14, left
predictor) with one Huffman table, in an AVI file with an index. Frames of many files are coded
and decoded side by side, in blocks of bounded size. Shots end where the difference of two frames'
histograms stands out from those before it in the shot.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import read

SIDE = 24
FRAME = SIDE * SIDE
FPS = 8
#: Frames coded at once, and payload bytes of the files taken together.
CHUNK_FRAMES = 2048
CHUNK_BYTES = 2 << 20
FOURCC = b"LJPG"
#: Shot detection: histogram bins, spread of earlier differences, least difference (of 2), least shot.
BINS, SPREADS, LEAST_DIFF, LEAST_SHOT = 16, 3.0, 0.35, 2

# Differences of 8 bits have categories 0..8; all codes have 4 bits, the value's bits follow.
_DIFFS = np.arange(-255, 256)
_CATS = np.array([int(abs(d)).bit_length() for d in _DIFFS])
_WIDE = 12
_DHT = b"\xff\xc4" + struct.pack(">HB", 2 + 17 + 9, 0) + bytes([0, 0, 0, 9] + [0] * 12) + bytes(range(9))
_SOF3 = b"\xff\xc3" + struct.pack(">HBHHBBBB", 11, 8, SIDE, SIDE, 1, 1, 0x11, 0)
_SOS = b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0, 1, 0, 0)
_HEAD, _EOI = b"\xff\xd8" + _DHT + _SOF3 + _SOS, b"\xff\xd9"


def _code_rows() -> tuple[np.ndarray, np.ndarray]:
    """Bits, left-aligned, and lengths: of the differences, then of 0 to 7 bits of padding."""
    bits, size = np.zeros((len(_DIFFS) + 8, _WIDE), np.uint8), np.zeros(len(_DIFFS) + 8, np.int64)
    for k, (d, s) in enumerate(zip(_DIFFS.tolist(), _CATS.tolist(), strict=True)):
        value = d if d >= 0 else d + (1 << s) - 1
        size[k] = 4 + s
        bits[k, : 4 + s] = [int(b) for b in f"{(s << s) | value:0{4 + s}b}"]
    for pad in range(8):
        size[len(_DIFFS) + pad] = pad
        bits[len(_DIFFS) + pad, :pad] = 1
    return bits, size


_BITS, _SIZE = _code_rows()
_USED = np.arange(_WIDE)[None, :] < _SIZE[:, None]


def encode_frames(samples: np.ndarray) -> Iterator[bytes]:
    """JPEG files of (n, FRAME) 8-bit samples."""
    for at in range(0, len(samples), CHUNK_FRAMES):
        x = samples[at : at + CHUNK_FRAMES].reshape(-1, SIDE, SIDE).astype(np.int16)
        diff = np.empty_like(x)
        diff[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
        diff[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
        diff[:, 0, 0] = x[:, 0, 0] - 128
        rows = np.empty((len(x), FRAME + 1), np.int64)
        rows[:, :FRAME] = diff.reshape(-1, FRAME) + 255
        total = _SIZE[rows[:, :FRAME]].sum(axis=1)
        rows[:, FRAME] = len(_DIFFS) + (-total) % 8
        packed = np.packbits(_BITS[rows][_USED[rows]])
        ends = np.cumsum((total + 7) // 8)
        full = np.flatnonzero(packed == 255)
        stuffed = np.insert(packed, full + 1, 0).tobytes()
        ends = ends + np.searchsorted(full, ends)
        start = 0
        for end in ends.tolist():
            yield _HEAD + stuffed[start:end] + _EOI
            start = end


def _lookup(lengths: bytes, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Difference and number of bits used for each 12-bit window, from a Huffman table."""
    diff, used = np.zeros(1 << _WIDE, np.int32), np.zeros(1 << _WIDE, np.int64)
    code, k = 0, 0
    for size in range(1, 17):
        for _ in range(lengths[size - 1]):
            cat = symbols[k]
            if size + cat > _WIDE:
                raise ValueError("a code and its value take more than 12 bits")
            for value in range(1 << cat):
                low = (((code << cat) | value) << (_WIDE - size - cat)) & ((1 << _WIDE) - 1)
                span = slice(low, low + (1 << (_WIDE - size - cat)))
                diff[span] = value if cat == 0 or value >> (cat - 1) else value - (1 << cat) + 1
                used[span] = size + cat
            code, k = code + 1, k + 1
        code <<= 1
    return diff, used


def _scan_of(jpeg: bytes) -> tuple[bytes, bytes]:
    """The Huffman table and the entropy-coded bytes of a file."""
    if jpeg[:2] != b"\xff\xd8" or jpeg[-2:] != _EOI:
        raise ValueError("not a JPEG file")
    at, table = 2, b""
    while True:
        kind, size = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        part = jpeg[at + 4 : at + 2 + size]
        if kind == 0xC4:
            table = part
        elif kind == 0xC3 and struct.unpack_from(">BHHB", part) != (8, SIDE, SIDE, 1):
            raise ValueError("frames of another size or depth")
        at += 2 + size
        if kind == 0xDA:
            return table, jpeg[at:-2]


def decode_frames(jpegs: list[bytes]) -> np.ndarray:
    """(n, FRAME) samples of JPEG files that share a Huffman table, read in step with each other."""
    out = np.empty((len(jpegs), FRAME), np.uint8)
    for at in range(0, len(jpegs), CHUNK_FRAMES):
        parts = [_scan_of(j) for j in jpegs[at : at + CHUNK_FRAMES]]
        if any(t != parts[0][0] for t, _ in parts):
            raise ValueError("Huffman tables differ")
        diff_of, used_of = _lookup(parts[0][0][1:17], parts[0][0][17:])
        data = np.frombuffer(b"".join(s for _, s in parts), np.uint8)
        sizes = np.array([len(s) for _, s in parts])
        # a zero after 255 is stuffing; a frame's first byte never is
        keep = np.ones(len(data), bool)
        keep[1:] = ~((data[1:] == 0) & (data[:-1] == 255))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        keep[starts] = True
        bits = (np.cumsum(keep)[starts] - 1) * 8
        data = np.concatenate([data[keep], np.zeros(3, np.uint8)]).astype(np.uint32)
        windows = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        diff = np.empty((FRAME, len(parts)), np.int32)
        for k in range(FRAME):
            w = (windows[bits >> 3] >> (12 - (bits & 7)).astype(np.uint32)) & 0xFFF
            diff[k] = diff_of[w]
            bits += used_of[w]
        x = diff.T.reshape(-1, SIDE, SIDE)
        x[:, 0, 0] += 128
        x[:, :, 0] = np.cumsum(x[:, :, 0], axis=1)
        out[at : at + CHUNK_FRAMES] = np.cumsum(x, axis=2).astype(np.uint8).reshape(-1, FRAME)
    return out


def _chunk(kind: bytes, data: bytes) -> bytes:
    return kind + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)


def write_avi(frames: list[bytes]) -> bytes:
    """An AVI file of one video stream with an index."""
    largest = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, len(frames), 0, 1, largest, SIDE, SIDE, 0, 0, 0, 0)
    strh = b"vids" + FOURCC + struct.pack("<IHHIIIIIIIIHHHH", 0, 0, 0, 0, 1, FPS, 0, len(frames), largest, 0, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, FOURCC, FRAME, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(_chunk(b"00dc", f))
        at += len(movi[-1])
    return _chunk(b"RIFF", b"AVI " + hdrl + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def _walk(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        size = struct.unpack_from("<I", data, at + 4)[0]
        if at + 8 + size > end:
            raise ValueError("a chunk is cut off")
        yield data[at : at + 4], at + 8, size
        at += 8 + size + size % 2


def read_avi(data: bytes) -> tuple[list[bytes], float]:
    """Frames in the order of the index, and frames a second."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    movi, index, fps = None, None, 0.0
    for kind, at, size in _walk(data, 12, 8 + struct.unpack_from("<I", data, 4)[0]):
        if kind == b"LIST" and data[at : at + 4] == b"movi":
            movi = at
        elif kind == b"idx1":
            index = np.frombuffer(data, np.dtype([("id", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")]), size // 16, at)
        elif kind == b"LIST" and data[at : at + 4] == b"hdrl":
            for inner, a, n in _walk(data, at + 4, at + size):
                if inner == b"LIST":
                    for part, b, _ in _walk(data, a + 4, a + n):
                        if part == b"strh":
                            scale, rate = struct.unpack_from("<II", data, b + 20)
                            fps = rate / scale
    if movi is None or index is None:
        raise ValueError("no frames or no index")
    own = index[index["id"] == b"00dc"]
    return [data[movi + a + 8 : movi + a + 8 + n] for a, n in zip(own["at"].tolist(), own["size"].tolist(), strict=True)], fps


def shots(samples: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) frames of each shot.

    A shot ends before a frame whose histogram differs from the last one's by more than LEAST_DIFF
    and by more than SPREADS deviations above the mean of the differences so far in the shot.
    """
    n = len(samples)
    hist = np.bincount((np.arange(n)[:, None] * BINS + (samples >> 4)).ravel(), minlength=n * BINS).reshape(n, BINS) / FRAME
    diffs = np.abs(np.diff(hist, axis=0)).sum(axis=1).tolist()
    out, first, count, mean, square = [], 0, 0, 0.0, 0.0
    for k, d in enumerate(diffs, 1):
        spread = (square / count) ** 0.5 if count else 0.0
        if k - first >= LEAST_SHOT and d > LEAST_DIFF and d > mean + SPREADS * spread:
            out.append((first, k))
            first, count, mean, square = k, 0, 0.0, 0.0
            continue
        count += 1
        step = d - mean
        mean += step / count
        square += step * (d - mean)
    return [*out, (first, n)]


def payload_of(text: str | None) -> tuple[bytes, int]:
    """The text's bytes, filled up with 255, and their number before."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b"\xff" * (-len(data) % FRAME or (0 if data else FRAME)), len(data)


def encode_files(payloads: list[bytes]) -> list[bytes]:
    frames = encode_frames(np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, FRAME))
    return [write_avi([next(frames) for _ in range(len(p) // FRAME)]) for p in payloads]


def decode_files(files: list[bytes]) -> list[tuple[np.ndarray, float]]:
    parsed = [read_avi(f) for f in files]
    samples, at, out = decode_frames([j for frames, _ in parsed for j in frames]), 0, []
    for frames, fps in parsed:
        out.append((samples[at : at + len(frames)], fps))
        at += len(frames)
    return out


def _portions(values: list, size) -> Iterator[list]:
    """Lists of values of CHUNK_BYTES together, or of one that is larger."""
    own, total = [], 0
    for v in values:
        if own and total + size(v) > CHUNK_BYTES:
            yield own
            own, total = [], 0
        own.append(v)
        total += size(v)
    if own:
        yield own


def to_avi(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the AVI file (avi) of each text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((d.as_py(), *payload_of(t.as_py())) for d, t in zip(batch["doc_id"], batch["text"], strict=True))
            for part in _portions(rows, lambda r: len(r[1])):
                columns = [pa.array([r[0] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int64()), pa.array(encode_files([r[1] for r in part]), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "avi"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, avi binary")


def clips(files: DataFrame) -> DataFrame:
    """Timed clips of a table of files (doc_id, avi): doc_id, clip, first_frame, end_frame, start_s, end_s.

    A null file has no clips; a file that is no AVI of the frames above fails.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "clip", "first_frame", "end_frame", "start_s", "end_s"]
        for batch in batches:
            rows = ((d.as_py(), f.as_py()) for d, f in zip(batch["doc_id"], batch["avi"], strict=True) if f.is_valid)
            for part in _portions(rows, lambda r: len(r[1])):
                found = [(d, k, a, b, a / fps, b / fps) for (d, _), (x, fps) in zip(part, decode_files([f for _, f in part]), strict=True) for k, (a, b) in enumerate(shots(x))]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    return files.select(F.col("doc_id").cast("long"), "avi").mapInArrow(run, "doc_id long, clip int, first_frame long, end_frame long, start_s double, end_s double")


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digests(docs: DataFrame) -> DataFrame:
    """What each row's file gives when it is read back: sizes, hashes and shots.

    Nulls: a null or empty text is one frame of bytes 255; a null doc_id is kept. Repeated rows and
    equal texts give equal values; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((d.as_py(), *payload_of(t.as_py())) for d, t in zip(batch["doc_id"], batch["text"], strict=True))
            for part in _portions(rows, lambda r: len(r[1])):
                files = encode_files([r[1] for r in part])
                out = []
                for (doc, _, n), avi, (x, fps) in zip(part, files, decode_files(files), strict=True):
                    back = x.tobytes()
                    feature = f"{len(x)} frames at {fps:g}: " + ",".join(f"{a}-{b}" for a, b in shots(x))
                    out.append((doc, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(avi), hashlib.sha256(avi).hexdigest(), feature))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [c.split()[0] for c in DIGEST.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DIGEST)


def op9_avi_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))

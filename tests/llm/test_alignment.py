"""Token alignment against plain loops over byte ranges."""

import collections
import hashlib
import random

import numpy as np
import pytest

from scholia.llm import alignment
from scholia.llm.packing import tokenizer_path


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def texts():
    rng = random.Random(11)
    parts = ["the ", "tion", "é", "日本", "🙂", " ", "  ", "\n", "123", "<|endoftext|>", "<s>", "ﬁ", "anti", "-", "\xa0", "X", "wor"]
    made = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(120)]
    return [*made, None, "", " ", "x", "▁", "a ▁b", "\x00", "the cat " * 3000, "🙂" * 500, made[0], made[0]]


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def tokens(coders, text):
    """(id, bytes) of both sides by the tokenizers themselves, or none."""
    a, b = coders
    if not text:
        return [], []
    byte = alignment.byte_of_character()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    side_a = [(k, bytes(byte[c] for c in a.id_to_token(k))) for k in ids_a]
    side_b = []
    for k in b.encode(text):
        p = b.id_to_piece(k)
        side_b.append((k, bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(p for _, p in side_a) != whole or b"".join(p for _, p in side_b) != whole:
        return [], []
    return side_a, side_b


def brute(coders, rows):
    links, facts = [], []
    for doc, text in rows:
        a, b = tokens(coders, text)
        sa, sb = spans([p for _, p in a]), spans([p for _, p in b])
        own = [(a[i][0], b[j][0]) for i, (x, y) in enumerate(sa) for j, (u, v) in enumerate(sb) if x < v and u < y] if len(a) < 900 else merge(a, b, sa, sb)
        ends = sorted({y for _, y in sa} & {y for _, y in sb})
        groups, i, j = [], 0, 0
        for e in ends:
            left, right = [], []
            while i < len(sa) and sa[i][1] <= e:
                left.append(str(a[i][0]))
                i += 1
            while j < len(sb) and sb[j][1] <= e:
                right.append(str(b[j][0]))
                j += 1
            groups.append(f"{','.join(left)}|{','.join(right)}")
        links.append(own)
        facts.append((doc, len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    count = collections.Counter(p for own in links for p in set(own))
    most = collections.defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return sorted(((*f[:5], sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own), f[5]) for f, own in zip(facts, links, strict=True)), key=str)


def merge(a, b, sa, sb):
    """Pairs of overlapping ranges by two pointers, for long texts."""
    out, i, j = [], 0, 0
    while i < len(sa) and j < len(sb):
        out.append((a[i][0], b[j][0]))
        x, y = sa[i][1], sb[j][1]
        i, j = i + (x <= y), j + (y <= x)
    return out


def test_alignments_equal_plain_loops(spark, coders, monkeypatch):
    rows = [*enumerate(texts()), (None, "the cat"), (3, texts()[3])]
    docs = spark.createDataFrame([(d, t, 1, "c", "p") for d, t in rows], "doc_id long, text string, chunk int, number string, pairs string").repartition(3)
    got = sorted((tuple(r) for r in alignment.alignments(docs).collect()), key=str)
    assert got == brute(coders, rows)
    assert sum(g[1] == 0 for g in got) == 4 and max(g[3] for g in got) > 1000  # null, empty and the two whose pieces read as spaces


def test_small_chunks_give_the_same(spark, coders, monkeypatch):
    from scholia.llm.alignment import chunk_row, sides

    a, b = sides(*map(tokenizer_path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")))
    made = texts()
    whole = chunk_row(a, b, list(range(len(made))), [t or "" for t in made])
    parts = [chunk_row(a, b, [k], [t or ""]) for k, t in enumerate(made)]
    assert whole["digests"] == [p["digests"][0] for p in parts]
    figures = np.frombuffer(whole["figures"], "<i8").reshape(5, -1)
    assert (figures == np.concatenate([np.frombuffer(p["figures"], "<i8").reshape(5, -1) for p in parts], axis=1)).all()


def test_links_of_one_text(spark, coders):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, None)], "doc_id long, text string")
    by = {r["doc_id"]: r for r in alignment.token_links(docs).collect()}
    assert by[2]["a_ids"] == by[2]["link_a"] == []
    a, b = tokens(coders, "the cat sat")
    assert by[1]["a_ids"] == [k for k, _ in a] and by[1]["b_ids"] == [k for k, _ in b]
    assert [(a[i][0], b[j][0]) for i, j in zip(by[1]["link_a"], by[1]["link_b"], strict=True)] == merge(a, b, spans([p for _, p in a]), spans([p for _, p in b]))


def test_no_rows(spark):
    assert alignment.alignments(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    only = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in alignment.alignments(only).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_packed_numbers():
    values = np.array([0, 1, 255, 256, 70_000, 2**32 - 1])
    assert (alignment.unpacked(alignment.packed(values), len(values)) == values).all() and not len(alignment.unpacked(alignment.packed(values[:0]), 0))

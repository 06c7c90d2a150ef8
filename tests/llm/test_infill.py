"""Fill-in-middle against a plain loop over code points."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

from scholia.llm import infill

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_rule(doc, text, seed=42, rate=50, spm_share=80):
    text = text or ""
    units = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc, n, "plain", None, None, text
    if h4 % 100 < spm_share:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    alphabet = ["a", "bc", "é", "日本", "🙂", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\xa0", "\x85", " ", "<", ">", "P", "<P", "S>", "\x00", "\x1c"]
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(600)]
    return [*made, None, "", " ", "\n\n", "x", " x", "x ", "<P>", "a <M> b", "<S", ">", "<", "<P", "P>", "a" * 70_000, " " * 70_000 + "x", "w " * 50_000]


def expected(rows, **kw):
    return sorted((plain_rule(d, t, **kw) for d, t in rows), key=str)


@pytest.mark.parametrize("most", [64, infill.BLOCK_BYTES])
def test_infill_equals_a_plain_loop(most):
    rows = list(enumerate(texts())) + [(None, "a b c"), (5, "same id"), (5, "same id"), (-7, "x y z")]
    data, starts = infill.utf8(pa.array([t for _, t in rows], pa.string()))
    got = []
    for x, y in infill.blocks(starts, most):
        ids = [d for d, _ in rows[x:y]]
        columns = infill.rearrange(ids, data[starts[x] : starts[y]], starts[x : y + 1] - starts[x], 42, 50, 80)
        got += zip(ids, *[c.to_pylist() for c in columns], strict=True)
    assert sorted(got, key=str) == expected(rows)


def test_infill_in_spark(spark):
    rows = list(enumerate(texts())) + [(None, "a b c"), (5, "same id"), (5, "same id")]
    docs = spark.createDataFrame([(d, t, "x", "y", 3) for d, t in rows], "doc_id long, text string, output string, form string, n int").repartition(3)
    out = infill.infill(docs).cache()
    assert sorted((tuple(r) for r in out.collect()), key=str) == expected(rows)
    assert {r[0] for r in out.select("form").collect()} == {"plain", "psm", "spm"}
    back = out.select("doc_id", infill.restored(out["form"], out["output"])).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    other = infill.infill(docs, seed=7, rate=100, spm_share=0)
    assert sorted((tuple(r) for r in other.collect()), key=str) == expected(rows, seed=7, rate=100, spm_share=0)


def test_infill_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert infill.infill(none).collect() == []


def test_utf8_of_a_slice_with_nulls():
    data, starts = infill.utf8(pa.array(["zz", None, "é", "", None]).slice(1))
    assert bytes(data) == "é".encode() and starts.tolist() == [0, 0, 2, 2, 2]

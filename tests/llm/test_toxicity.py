"""The clause grammar by hand-made clauses, its learning by plain counts and held-out accuracy."""

import collections
import random
import zlib

import numpy as np
import pytest

from scholia.llm import toxicity
from scholia.llm.toxicity import AIMED, END, FUTURE, INSULT, MENACING, NEGATED, NEGATION, REPORT, REPORTED, TARGET, THREAT

UNITS = {"idiot$": 4.0, "rotten": 2.0, "table$": 0.1}


def forms(text):
    names = list(toxicity.FORMS)
    return [(names[f], w) for f, w in toxicity.Scorer(UNITS).clauses(text)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("What an idiot. A table.", [("insult", 4.0)]),
        ("You idiot!", [("aimed insult", 4.0)]),
        ("IDIOT, said nobody", [("aimed insult", 4.0)]),
        ("not an idiot", [("negated", 4.0)]),
        ("not a very long way from an idiot", [("insult", 4.0)]),
        ("she said idiot", [("reported", 4.0)]),
        ("she said this. rottenness", [("insult", 2.0)]),
        ("I will kill you", [("threat", 1.0)]),
        ("I will not kill you", []),
        ("kill the process", []),
        ("rotten idiot\nidiot", [("insult", 6.0), ("insult", 4.0)]),
        ("idiotic tables", []),
        ("", []),
        (".!\n", []),
    ],
)
def test_clauses(text, expected):
    assert forms(text) == expected


def test_the_composition_equals_its_parts_in_a_row():
    rng = random.Random(5)
    parts = [(toxicity.SCOPE + 1, toxicity._negation), (2, toxicity._report), (2, toxicity._threat), (2, toxicity._target), (16, toxicity._insult)]
    table = toxicity.compiled(toxicity.GRAMMAR)
    marks = [0, INSULT, THREAT, TARGET, NEGATION, REPORT, FUTURE, END, INSULT | TARGET]
    state, states = 0, [0] * len(parts)
    for _ in range(5000):
        symbol = rng.choice(marks)
        passed = symbol
        for k, (_, step) in enumerate(parts):
            states[k], passed = step(states[k], passed)
        state, out = table[state][symbol]
        assert out == passed
        index = 0
        for (n, _), s in zip(parts, states, strict=True):
            index = index * n + s
        assert state == index
    assert toxicity.clause_form(END | MENACING | AIMED) == 4 and toxicity.clause_form(END | INSULT | NEGATED | REPORTED) == 3 and toxicity.clause_form(END) is None


def test_unit_counts_and_weights(spark):
    texts = [("Idiot idiots!", 1), ("idiot", 1), ("plain text", 0), ("text 7 _", 0), ("", 0)]
    rows = spark.createDataFrame([(t, y, 1) for t, y in texts], "text string, toxic int, part int").repartition(3)
    expected = collections.Counter((u, y) for t, y in texts for u in {u for w in toxicity.TOKEN.findall(t.lower()) if w[0].isalpha() for u in toxicity.units_of(w)})
    assert {(r["unit"], r["toxic"]): r["n"] for r in toxicity.unit_counts(rows).collect()} == expected
    weights = toxicity.unit_weights([("abc", 10, 2), ("abcd", 10, 0), ("abcd$", 10, 0), ("abce$", 0, 2), ("xyz", 0, 5)], 20, 20)
    assert weights["abcd$"] > weights["abc"] > 0 > weights["xyz"] and "abcd" not in weights and weights["abce$"] < weights["abc"]


def test_fitted_stays_at_the_priors_without_evidence_and_separates():
    x = np.zeros((40, len(toxicity.PRIORS)))
    x[:, -1] = 1
    x[:20, 0] = 3
    y = np.array([1.0] * 20 + [0.0] * 20)
    w = toxicity.fitted(x, y)
    assert ((x @ w > 0) == (y > 0)).all() and w[4] == toxicity.PRIORS[4]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "you idiot", 9), (3, "word " * 20_000, 9), (3, "x", 9)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (1, 1), (77, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.toxicity(none, labels).collect() == []
    assert toxicity.toxicity(docs, labels.limit(0)).count() == 5
    found = toxicity.clauses(docs, UNITS).collect()
    assert [(r["doc_id"], r["form"], r["weight"]) for r in found] == [(None, "aimed insult", 4.0)]


def test_labels_outside_the_fold_alone_teach(spark):
    docs = spark.createDataFrame([(k, "you grubnik" if k % 2 else "fine words here") for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    changed = spark.createDataFrame([(k, k % 2 if zlib.crc32(str(k).encode()) % 5 else 1 - k % 2) for k in range(200)], "doc_id long, toxic int")
    own = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.toxicity(docs, labels).collect()}
    assert own == {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.toxicity(docs, changed).collect()}
    assert all(predicted == k % 2 for k, (_, predicted) in own.items())


def test_held_out_accuracy(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.join(labels.select("doc_id"), "doc_id", "left_semi")  # scores don't depend on other rows
    rows = toxicity.toxicity(some, labels).join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    table = collections.Counter((r["toxic"], r["predicted"]) for r in rows)
    assert table[1, 1] >= 0.88 * (table[1, 1] + table[1, 0])
    assert table[0, 1] <= 0.02 * (table[0, 0] + table[0, 1])

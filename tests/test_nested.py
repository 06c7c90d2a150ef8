"""Nested records against recursion over Python dicts."""

import json
import random

from pyspark.sql import functions as F

from scholia.functions import patterns as V
from scholia.operators import nested


def deep(base, overlay):
    out = dict(base)
    for k, v in overlay.items():
        out[k] = deep(out[k], v) if isinstance(out.get(k), dict) and isinstance(v, dict) else v
    return out


def some(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    if kind < 2:
        return rng.choice([1, -2, "text", "", 'q"\\\n é', True, None, "S001:C02", "at S010:C11, xS010:C12"])
    if kind == 2:
        return [some(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(["a", "b", "c", "source", "d.e", 'x"y', "Status"]): some(rng, depth + 1) for _ in range(rng.randrange(4))}


def record(rng):
    return {k: some(rng) for k in rng.sample(["a", "b", "c", "reading", "pmcid"], rng.randrange(4))}


def frame(spark, records):
    return spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "k int, json string").repartition(3)


def test_merge_equals_recursion(spark):
    rng = random.Random(4)
    pairs = [(record(rng), record(rng)) for _ in range(400)] + [({}, {}), ({"a": {}}, {"a": {"b": {}}}), ({"a": 1}, {"a": {}}), ({"a": {"b": 1}}, {"a": {}}), ({"a": {}}, {"a": 2}), ({"a": {"b": 1}}, {"a": None})]
    base, over = (nested.leaves(frame(spark, [p[i] for p in pairs]), "json", lists=False) for i in (0, 1))
    got = {r["k"]: json.loads(r["json"]) for r in nested.rebuilt(nested.merged(base, over, "k"), "k").collect()}
    expected = {k: deep(*p) for k, p in enumerate(pairs)}
    # a record without any leaf is an empty object, whose one leaf is itself
    assert {k: got[k] for k in expected} == expected


def iterate(value, path=""):
    if isinstance(value, str):
        yield path, value
    elif isinstance(value, dict):
        for k, v in value.items():
            yield from iterate(v, f"{path}.{k}" if path else k)
    elif isinstance(value, list):
        for k, v in enumerate(value):
            yield from iterate(v, f"{path}[{k}]")


def test_strings_and_locators(spark):
    rng = random.Random(9)
    records = [record(rng) for _ in range(200)]
    rows = nested.leaves(frame(spark, records), "json")
    got = {(r["k"], r["p"], r["text"]) for r in nested.strings(rows).select("k", nested.named(F.col("path")).alias("p"), "text").collect()}
    assert got == {(k, p, s) for k, r in enumerate(records) for p, s in iterate(r)}
    found = sorted((r["k"], r["p"], r["locator"]) for r in nested.locators(rows).select("k", nested.named(F.col("path")).alias("p"), "locator").collect())
    assert found == sorted((k, p, s[-9:] if s == "S001:C02" else "S010:C11") for k, r in enumerate(records) for p, s in iterate(r) if s.startswith(("S001", "at S")))


def violations(value, path=()):
    out = []
    if isinstance(value, dict):
        for k, v in value.items():
            root = path[0].casefold() if path else ""
            if k.casefold() in V.PROTECTED_KEYS or k.casefold() in V.PROTECTED_ROOTS or root in V.PROTECTED_ROOTS:
                out.append(".".join((*path, k)))
            out += violations(v, (*path, k))
    elif isinstance(value, list):
        for k, v in enumerate(value):
            out += violations(v, (*path, f"[{k}]"))
    return out


def test_protected_paths(spark):
    rng = random.Random(2)
    records = [record(rng) for _ in range(200)] + [{"reading": {"x": [{"y": {}}]}}, {"a": [{"STATUS": 1}]}]
    got = sorted((r["k"], r["path"]) for r in nested.protected_paths(nested.leaves(frame(spark, records), "json"), "k").collect())
    assert got == sorted((k, p) for k, r in enumerate(records) for p in violations(r))


def test_no_rows_and_no_json(spark):
    none = spark.createDataFrame([], "k int, json string")
    assert nested.leaves(none, "json").collect() == []
    odd = spark.createDataFrame([(1, None), (2, "{"), (3, "{}")], "k int, json string")
    assert [(r["k"], r["path"], r["value"]) for r in nested.leaves(odd, "json").collect()] == [(3, [], "{}")]


def test_assembly_names_the_first_identity_that_disagrees(spark):
    cards = [{"pmcid": "PMC-7"}, {"pmcid": "PMC8"}, {"paper": {"paper_id": "q"}}, {"card_id": "semantic:PMC9"}, {"card_id": "else"}, {"source": {"source_hash": "BB"}}, {"provenance": {"source_hash": "AA"}, "selection": {"x": 1}, "schema_version": "2"}]
    cols = "k int, card string, expected_pmcid string, paper_id string, record_hash string, selection_reason string, primary_stratum string, reading_order int, packet_sha256 string, locators array<string>, read_at string, role string, model string, effort string"
    df = spark.createDataFrame([(k, json.dumps(c), "PMC7", "p", "aa", "r", "s", 1, "h", ["S001:C01"], "t", "ro", "mo", "ef") for k, c in enumerate(cards)], cols)
    got = {r["k"]: (r["issue"], json.loads(r["patch"])) for r in nested.assembled(df, "k").collect()}
    assert [got[k][0] for k in range(7)] == [None, "pmcid_mismatch", "paper_id_mismatch", "pmcid_mismatch", "card_id_mismatch", "source_record_sha256_mismatch", None]
    assert got[0][1]["pmcid"] == "PMC-7" and got[0][1]["card_id"] == "semantic:PMC7" and got[0][1]["source"] == {"source_record_sha256": "aa"} and got[0][1]["selection"]["reading_order"] == 1
    assert "selection" not in got[6][1] and "schema_version" not in got[6][1] and got[6][1]["source_record_sha256"] == "AA" and got[6][1]["reading"]["omissions"] == []


def test_merge_of_keys_that_begin_alike(spark):
    rng = random.Random(12)
    keys = ["a", "a.", "a!", "", "A", "é", "😀", "ab", "[0]"]

    def tree(depth):
        return {k: tree(depth + 1) if depth < 3 and rng.random() < 0.6 else rng.choice([1, [], [{"a": 1}], "x"]) for k in rng.sample(keys, rng.randrange(4))}

    pairs = [(tree(0), tree(0)) for _ in range(300)]
    base, over = (nested.leaves(frame(spark, [p[i] for p in pairs]), "json", lists=False) for i in (0, 1))
    got = {r["k"]: json.loads(r["json"]) for r in nested.rebuilt(nested.merged(base, over, "k"), "k").collect()}
    assert got == {k: deep(*p) for k, p in enumerate(pairs)}


def test_merge_reads_leaves_once_and_shuffles_them_by_key(spark):
    base, over = (nested.leaves(frame(spark, [{"a": {"b": 1}}, {}]), "json", lists=False) for _ in range(2))
    plan = nested.rebuilt(nested.merged(base, over, "k"), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 1 and "Join" not in plan
    assert plan.count("Exchange RoundRobin") == 2  # that of frame(), one for each side


def test_depth_equals_recursion(spark):
    def levels(value):
        return 1 + max(map(levels, value.values() if isinstance(value, dict) else value), default=0) if isinstance(value, dict | list) else 0

    rng = random.Random(5)
    records = [record(rng) for _ in range(200)] + [[[[[]]], {"a": "]}"}], "{[", 'q"\\{', 3, None, {"{": [{'"[': {}}]}]
    df = frame(spark, records)
    assert {r["k"]: r["n"] for r in df.select("k", nested.depth(F.col("json")).alias("n")).collect()} == {k: levels(r) for k, r in enumerate(records)}


def test_assembly_parses_a_card_once(spark):
    cols = "k int, card string, expected_pmcid string, paper_id string, record_hash string, selection_reason string, primary_stratum string, reading_order int, packet_sha256 string, locators array<string>, read_at string, role string, model string, effort string"
    df = spark.createDataFrame([], cols)
    plan = nested.assembled(df, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json(") + plan.count("parseJson(") == 1

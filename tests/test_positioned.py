"""Scans with places, on files written here."""

import pytest

from scholia.sources import jsonl, positioned


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_strict_scan_names_the_line(spark, tmp_path):
    good = put(tmp_path / "g.jsonl", '﻿{"a": 1}\r\n\n{"a": 2}\n')
    assert sorted((r["a"], r["_line"]) for r in positioned.strict(spark, good, "a long").collect()) == [(1, 1), (2, 3)]
    bad = put(tmp_path / "b.jsonl", '{"a": 1}\n\n[3]\n')
    with pytest.raises(Exception, match=r"b\.jsonl:3"):
        positioned.strict(spark, bad, "a long").collect()
    assert positioned.strict(spark, str(tmp_path / "none.jsonl"), "a long").collect() == []


def test_tolerant_scan_keeps_places(spark, tmp_path):
    path = put(tmp_path / "t.jsonl", '{"a": 1}\nno\n{"a": 2}\n{"a": "x"}\n')
    good, bad = positioned.tolerant(spark, path, "a long")
    assert sorted((r["a"], r["_line"]) for r in good.collect()) == [(1, 1), (2, 3)] and sorted(r["line"] for r in bad.collect()) == [2, 4]


def test_manifest(spark, tmp_path):
    path = put(tmp_path / "m.jsonl", '{"id": "b", "n": 1}\n\n{"id": "a", "n": 2}\n')
    rows = positioned.manifest(spark, path, "id string, n long", "id").collect()
    assert sorted((r["id"], r["n"], r["_manifest_line"], r["_manifest_rank"]) for r in rows) == [("a", 2, 3, 2), ("b", 1, 1, 1)]
    with pytest.raises(ValueError, match=r"r\.jsonl:4: repeated id 'a'"):
        positioned.manifest(spark, put(tmp_path / "r.jsonl", '{"id": "a"}\n{"id": "b"}\n\n{"id": " A"}\n{"id": ""}\n'), "id string", "id")
    with pytest.raises(ValueError, match=r"k\.jsonl:2: missing id"):
        positioned.manifest(spark, put(tmp_path / "k.jsonl", '{"id": "a"}\n{"x": "b"}\n{"id": "a"}\n'), "id string", "id")


def test_directories(spark, tmp_path):
    for name, text in {"pmc-1.json": '{"tool": "b", "n": 1}', "PMC1.json": '{"tool": "a", "n": 2}', "PMC2.json": "[1]", "PMC3.json": '{"a":', "PMC4.json": "\n"}.items():
        put(tmp_path / "d" / name, text)
    pattern = str(tmp_path / "d" / "*.json")
    paths = {r["key"]: r["path"].rsplit("/", 1)[1] for r in positioned.record_paths(spark, pattern).collect()}
    assert paths == {"PMC1": "pmc-1.json", "PMC2": "PMC2.json", "PMC3": "PMC3.json", "PMC4": "PMC4.json"}
    issues = {r["path"].rsplit("/", 1)[1]: r["issue"] for r in positioned.json_files(spark, pattern).collect()}
    assert issues == {"pmc-1.json": None, "PMC1.json": None, "PMC2.json": "not_an_object", "PMC3.json": "invalid_json", "PMC4.json": "invalid_json"}
    assert [(r["tool"], r["n"]) for r in positioned.run_index(spark, pattern, ["tool", "n"]).collect()] == [("a", "2"), ("b", "1")]


def test_gzipped_tables_and_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    jsonl.write(df.coalesce(1), str(tmp_path / "w"), once=True)
    assert sorted(tuple(r) for r in jsonl.strict(spark, str(tmp_path / "w"), "a long, b string").collect()) == [(1, "x"), (2, "y")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        jsonl.write(df, str(tmp_path / "w"), once=True)
    jsonl.write(df.limit(1), str(tmp_path / "w"))
    put(tmp_path / "r" / "b.json", '{"a": 2}')
    put(tmp_path / "r" / "a.json", '{\n"a": 1}')
    assert [(r["a"], r["file_name"]) for r in jsonl.records(spark, str(tmp_path / "r" / "*.json"), "a long").collect()] == [(1, "a.json"), (2, "b.json")]
    assert [r["a"] for r in jsonl.records(spark, str(tmp_path / "r" / "*.json"), "a long", 1).collect()] == [1]
    with pytest.raises(ValueError, match="positive"):
        jsonl.records(spark, "x", "a long", 0)

"""Queries on contracts of cards: every document has a card that breaks one rule or another, or none."""

from __future__ import annotations

import copy
import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholia.functions import patterns as V
from scholia.operators import validate
from scholia.sources.tables import read

QUERIES: dict = {}


def query(sql: str | None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


#: A card that keeps its contract. @ID@, @PMC@, @REC@ and @PACK@ stand for the document's own values.
CARD = {
    "card_id": "semantic:@PMC@", "paper_id": "@ID@", "pmcid": "@PMC@", "source_record_sha256": "@REC@",
    "reading": {
        "status": "completed", "access_level": "full_text_read", "reader_role": "first", "reader_model": "m", "reasoning_effort": "high", "read_at": "2024", "packet_sha256": "@PACK@",
        "section_locators_read": ["S001:C01", "S001:C02", "S002:C01"], "omissions": [], "adjudication_status": "self_reviewed",
    },
    "section_moves": [{"locator": "S001:C01", "transferable_principle": "p"}], "limitations": {"scope_boundary": "not reported"},
    "study": {"article_kind": "k", "research_problem": "p", "exact_gap": "g", "objective_or_hypothesis": "o", "study_design": {"a": [0]}, "method_spine": ["m"], "primary_outcomes": ["o"]},
    "argument_map": {"central_claim": "c", "warrant": "w", "data": [1]}, "evidence_boundary": {"measured": ["m"], "predicted": [], "inferred": [], "recommended": []},
    "quality": {k: 3 for k in V.QUALITY_FIELDS}, "summary_zh": "s",
    "writing_capability_candidates": [{"capability": "c", "confidence": "High", "supporting_locators": ["S002:C01"]}],
}
ROW = {
    "selected": True, "paper_id": "@ID@", "pmcid": "@PMC@", "record_hash": "@REC@", "record_path": "records/@PMC@.json", "row_packet_hash": "@PACK@", "reading_order": 10, "record_bytes_hash": "@REC@",
    "packet": "# Packet\n- Source SHA-256: `@REC@`\n\n### S001:C01 Start\n@TEXT@\n\n### S001:C02\nmore\n#### S002:C01 End\n",
}
OTHER = "0123456789abcdef" * 4

Change = Callable[[dict, dict], None]
#: Changes of the card and its selection row, with the issues that each one has to raise.
CASES: list[tuple[Change, list[tuple[str, str]]]] = [(lambda c, r: None, [])]


def case(change: Change, *expected: tuple[str, str]) -> None:
    CASES.append((change, list(expected)))


def _put(path: str, value) -> Change:
    def change(card: dict, row: dict) -> None:
        *parents, last = path.split(".")
        for p in parents:
            card = card[p]
        if value is None:
            del card[last]
        else:
            card[last] = value

    return change


def _row(**values) -> Change:
    return lambda c, r: r.update(values)


case(_row(selected=False), ("COMPLETED_ORPHAN", ""))
case(_put("paper_id", None), ("IDENTITY_MISSING", "paper_id"))
case(lambda c, r: c.update(paper={"paper_id": c.pop("paper_id")}))
case(_put("paper_id", "else"), ("IDENTITY_MISMATCH", "paper_id"))
case(_put("pmcid", "PMCX"), ("IDENTITY_MISMATCH", "pmcid"))
case(_row(record_hash="short", record_bytes_hash=None), ("IDENTITY_MISMATCH", "source_record_sha256"), ("SOURCE_HASH_FORMAT", "selection"), ("SOURCE_RECORD_MISSING", ""), ("PACKET_SOURCE_HASH_MISMATCH", "selection"))
case(_put("source_record_sha256", OTHER), ("IDENTITY_MISMATCH", "source_record_sha256"), ("SOURCE_RECORD_HASH_MISMATCH", "card"), ("PACKET_SOURCE_HASH_MISMATCH", "card"))
case(_put("source_record_sha256", "zz"), ("IDENTITY_MISMATCH", "source_record_sha256"), ("SOURCE_HASH_FORMAT", "card"), ("SOURCE_RECORD_HASH_MISMATCH", "card"), ("PACKET_SOURCE_HASH_MISMATCH", "card"))
case(_row(record_path=" "), ("SOURCE_RECORD_PATH", ""))
case(_row(record_bytes_hash=None), ("SOURCE_RECORD_MISSING", ""))
case(_row(record_bytes_hash=OTHER), ("SOURCE_RECORD_HASH_MISMATCH", "selection"), ("SOURCE_RECORD_HASH_MISMATCH", "card"), ("PACKET_SOURCE_HASH_MISMATCH", "source record"))
case(_put("reading", "done"), ("READING_FIELDS", ""))
case(_put("reading.access_level", "abstract"), ("READING_ACCESS", ""))
case(_put("reading.read_at", " "), ("READER_METADATA", "read_at"))
case(_put("reading.adjudication_status", None), ("READER_METADATA", "adjudication_status"))
case(_put("reading.reader_role", "Luna_Primary"), ("READER_PROVENANCE", "reader_model"), ("READER_PROVENANCE", "reasoning_effort"))
case(_row(reading_order=46), ("READER_POLICY", "reader_role"), ("READER_POLICY", "reader_model"), ("READER_POLICY", "reasoning_effort"))
case(_put("reading.section_locators_read", []), ("LOCATORS_EMPTY", ""), ("LOCATORS_EMPTY", "of a packet"), ("LOCATORS_INCOMPLETE", "S001:C01"), ("LOCATORS_INCOMPLETE", "S001:C02"), ("LOCATORS_INCOMPLETE", "S002:C01"))
case(_put("reading.omissions", None), ("OMISSIONS_UNDECLARED", ""))
case(_put("reading.omissions", "none"), ("OMISSIONS_TYPE", ""))
case(_put("reading.omissions", ["S001:C01"]), ("OMISSIONS_PRESENT", ""))
case(lambda c, r: (c.pop("pmcid"), r.update(pmcid="")), ("IDENTITY_MISSING", "pmcid"), ("PACKET_PMCID", ""))
case(_row(packet=None), ("PACKET_MISSING", ""), ("LOCATOR_MISSING", "S001:C01"), ("CAPABILITY_CANDIDATE", "none sound"))
case(_put("reading.packet_sha256", ""), ("PACKET_HASH_MISSING", "reading"))
case(_row(row_packet_hash=""), ("PACKET_HASH_MISSING", "selection"))
case(_put("reading.packet_sha256", OTHER), ("PACKET_HASH_MISMATCH", "reading"))
case(_row(row_packet_hash=OTHER), ("PACKET_HASH_MISMATCH", "selection"))
case(_row(row_packet_hash="abc"), ("PACKET_HASH_FORMAT", "selection"))
case(_row(packet=ROW["packet"].replace("- Source", "Source")), ("PACKET_SOURCE_HASH_MISSING", ""))
case(_row(packet=ROW["packet"].replace("@REC@", OTHER)), ("PACKET_SOURCE_HASH_MISMATCH", "selection"), ("PACKET_SOURCE_HASH_MISMATCH", "card"), ("PACKET_SOURCE_HASH_MISMATCH", "source record"))
case(_put("reading.section_locators_read", ["S001:C01", "S001:C02", "S002:C01", "S2:C1"]), ("LOCATOR_FORMAT", "S2:C1"), ("LOCATORS_EXTRA", "S2:C1"))
case(_put("reading.section_locators_read", ["S001:C01", "S001:C02", "S002:C01", "S009:C01"]), ("LOCATOR_MISSING", "S009:C01"), ("LOCATORS_EXTRA", "S009:C01"))
case(_put("notes", ["see S001:C02", {"S077:C01": "and xS004:C01 or S005:C01."}]), ("LOCATOR_MISSING", "S005:C01"))
case(_row(packet="- Source SHA-256: `@REC@`\n## S001:C01\n"), ("LOCATOR_MISSING", "S001:C01"), ("LOCATOR_MISSING", "S001:C02"), ("LOCATOR_MISSING", "S002:C01"), ("PACKET_LOCATORS", ""), ("LOCATOR_MISSING", "S001:C01"), ("LOCATOR_MISSING", "S002:C01"), ("CAPABILITY_CANDIDATE", "none sound"))
case(_row(packet=ROW["packet"] + "### S002:C01\n"), ("PACKET_LOCATORS_DUPLICATE", "S002:C01"), ("PACKET_LOCATOR_SEQUENCE", "S002:C01"), ("LOCATORS_ORDER", ""))
case(lambda c, r: (r.update(packet=r["packet"] + "### S004:C01\n"), c["reading"]["section_locators_read"].append("S004:C01")), ("PACKET_LOCATOR_SEQUENCE", "S004:C01"))
case(_row(packet=ROW["packet"] + "### S002:C02\n"), ("LOCATORS_INCOMPLETE", "S002:C02"))
case(_put("reading.section_locators_read", ["S001:C01", "S001:C02", "S002:C01", "S002:C01"]), ("LOCATORS_DUPLICATE", "S002:C01"), ("LOCATORS_ORDER", ""))
case(_put("reading.section_locators_read", ["S001:C02", "S001:C01", "S002:C01"]), ("LOCATORS_ORDER", ""))
case(_put("section_moves", {}), ("SECTION_MOVES", ""))
case(_put("section_moves", ["x", {"locator": "S001:C01"}, {"locator": 5, "transferable_principle": "p"}]), ("SECTION_MOVES", "0"), ("SECTION_MOVES", "1"), ("LOCATOR_FORMAT", "5"))
case(_put("limitations", {"scope_boundary": [" ", None, {"a": ""}]}), ("LIMITATIONS", ""))
case(_put("study.exact_gap", ""), ("STUDY_FIELDS", "exact_gap"))
case(_put("study.method_spine", "m"), ("STUDY_FIELDS", "method_spine"))
case(_put("study", []), ("STUDY_FIELDS", ""))
case(_put("argument_map", {"central_claim": "c", "data": []}), ("ARGUMENT_FIELDS", "warrant"), ("ARGUMENT_FIELDS", "data"))
case(_put("evidence_boundary", {"measured": [""], "predicted": "p", "inferred": []}), ("EVIDENCE_BOUNDARY", "predicted"), ("EVIDENCE_BOUNDARY", "recommended"))
case(_put("evidence_boundary.measured", []), ("EVIDENCE_BOUNDARY", "any"))
case(_put("quality.overall_credibility", None), ("QUALITY_FIELDS", "overall_credibility"))
case(lambda c, r: c.update(summary=c.pop("summary_zh")))
case(_put("summary_zh", "  "), ("SUMMARY_FIELDS", ""))
case(_put("writing_capability_candidates", []), ("CAPABILITY_CANDIDATE", ""))
case(lambda c, r: c.update(capability_candidates=c.pop("writing_capability_candidates")))
case(_put("writing_capability_candidates", [{"capability": "c", "confidence": "sure", "supporting_locators": ["S001:C01"]}, 3]), ("CAPABILITY_CANDIDATE", "1"), ("CAPABILITY_CANDIDATE", "none sound"), ("CAPABILITY_CONFIDENCE", "0"))
case(_put("writing_capability_candidates", [{"capability": "", "confidence": "low", "supporting_locators": "S001:C01"}]), ("CAPABILITY_CANDIDATE", "0"), ("CAPABILITY_CANDIDATE", "none sound"), ("CAPABILITY_LOCATORS", "0"))
case(_put("writing_capability_candidates", [{"capability": "c", "confidence": "low", "supporting_locators": ["S1"]}]), ("CAPABILITY_CANDIDATE", "none sound"), ("LOCATOR_FORMAT", "S1"))

WARNINGS = {("SOURCE_HASH_FORMAT", "selection")}
_CASE_COLUMNS = "k int, card string, selected boolean, paper_id string, pmcid string, record_hash string, record_path string, row_packet_hash string, reading_order int, record_bytes_hash string, packet string"
POLICY = {"reader_role": "luna_primary", "reader_model": "gpt-5.6-luna", "reasoning_effort": "max"}


def cards(s, d) -> DataFrame:
    """Each document's card and selection row, by the case of its id."""
    made = []
    for k, (change, _) in enumerate(CASES):
        card, row = copy.deepcopy(CARD), dict(ROW)
        change(card, row)
        made.append((k, json.dumps(card), *row.values()))
    docs = read(s, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (F.col("doc_id") % len(CASES)).cast("int").alias("of"))
    rows = docs.join(F.broadcast(s.createDataFrame(made, _CASE_COLUMNS)), F.col("of") == F.col("k"))  # a row for each case
    own = {"@ID@": F.concat(F.lit("doi:10.1/"), F.col("doc_id").cast("string")), "@PMC@": F.concat(F.lit("PMC"), F.col("doc_id").cast("string")), "@REC@": F.sha2("text", 256), "@TEXT@": F.col("text")}

    def filled(name: str, marks: dict):
        out = F.col(name)
        for mark, value in marks.items():
            out = F.replace(out, F.lit(mark), value)
        return out

    rows = rows.withColumn("packet", filled("packet", own)).withColumn("packet_bytes_hash", F.sha2("packet", 256))
    own["@PACK@"] = F.coalesce("packet_bytes_hash", F.lit(OTHER))
    for name in ("card", "paper_id", "pmcid", "record_hash", "record_path", "row_packet_hash", "record_bytes_hash"):
        rows = rows.withColumn(name, filled(name, {m: v for m, v in own.items() if m != "@TEXT@"}))
    return rows.drop("text", "of", "k")


_EXPECTED = ", ".join(f"({k}, '{'WARNING' if e in WARNINGS else 'ERROR'}', '{e[0]}', '{e[1]}')" for k, (_, expected) in enumerate(CASES) for e in expected)


@query(f"SELECT doc_id, severity, code, detail FROM documents JOIN (VALUES {_EXPECTED}) AS e(k, severity, code, detail) ON doc_id % {len(CASES)} = k")
def completed_card_issues(s, d):
    """All issues of completed cards, one scan for all rules. The SQL has the issues that each case is made to raise."""
    return validate.card_issues(cards(s, d), "doc_id", POLICY, 46)


@query(f"SELECT severity, code, count(*) AS n, count(DISTINCT doc_id) AS cards FROM documents JOIN (VALUES {_EXPECTED}) AS e(k, severity, code, detail) ON doc_id % {len(CASES)} = k GROUP BY severity, code")
def issue_codes(s, d):
    """How often each code is raised, and by how many cards."""
    return validate.card_issues(cards(s, d), "doc_id", POLICY, 46).groupBy("severity", "code").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("cards"))

"""Validation by a table of rules, compiled to one array of issues a row: however many rules, the table is read once."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholia.functions import patterns as V

ISSUE = "struct<severity string, code string, detail string>"
NOTHING = "array<string>"


@dataclass
class Rule:
    """A code and the details that it is raised with, one issue each; `when` says where the rule applies."""

    code: str
    found: Column
    severity: str = "ERROR"
    when: Column | None = None


def none() -> Column:
    return F.array().cast(NOTHING)


def flag(condition: Column, detail: str = "") -> Column:
    """One detail where a condition holds; an unknown condition does not."""
    return F.when(condition, F.array(F.lit(detail))).otherwise(none())


def each(conditions: Iterable[tuple[str, Column]]) -> Column:
    """The names of the conditions that hold."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in conditions]))


def issues(rules: Iterable[Rule]) -> Column:
    """Array of issues of a row, in order of the rules."""

    def raised(rule: Rule):
        return lambda d: F.struct(F.lit(rule.severity).alias("severity"), F.lit(rule.code).alias("code"), d.alias("detail"))

    parts = []
    for r in rules:
        found = r.found if r.when is None else F.when(r.when, r.found)
        found = F.coalesce(found, none())
        parts.append(F.transform(found, raised(r)))
    return F.concat(*parts).cast(f"array<{ISSUE}>")


# ---- values of nested records ----


def at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "variant")


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, VOID, STRING or another scalar's type; '' for what is missing."""
    return F.coalesce(F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1), F.lit(""))


def is_map(v: Column) -> Column:
    return kind(v) == "OBJECT"


def is_list(v: Column) -> Column:
    return kind(v) == "ARRAY"


def text(v: Column) -> Column:
    """A scalar as trimmed text; '' for containers, null and what is missing."""
    return F.when(kind(v).isin("OBJECT", "ARRAY", "VOID", ""), "").otherwise(F.trim(F.coalesce(v.try_cast("string"), F.lit(""))))


def items(v: Column) -> Column:
    """A list's values; none for anything else."""
    return F.when(is_list(v), F.coalesce(v.try_cast("array<variant>"), F.array().cast("array<variant>"))).otherwise(F.array().cast("array<variant>"))


def filled(v: Column) -> Column:
    """Whether there is anything in a value: a string that isn't blank, or another scalar, at any depth."""
    bare = F.regexp_replace(F.to_json(v), r'"(?:[^"\\]++|\\.)*+"\s*:', "")
    bare = F.regexp_replace(bare, r'"(?:\s|\\[nrtfb])*+"', "")
    return F.coalesce(F.regexp_replace(bare, r"null|[\[\]{},\s]", "") != "", F.lit(False))


def listed(v: Column) -> Column:
    """Whether a value is a list with something in it."""
    return is_list(v) & (F.size(items(v)) > 0)


def first_text(*found: Column) -> Column:
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in found], F.lit(""))


# ---- locators ----


def packet_locators(packet: Column) -> Column:
    """Locators of a packet's chunk headings, in order."""
    return F.regexp_extract_all(packet, F.lit(V.PACKET_HEADING), F.lit(1))


def sequence_break(found: Column) -> Column:
    """The first locator that doesn't follow the one before: chunks count up, a new section starts at 1."""
    section, chunk = lambda x: F.substr(x, F.lit(2), F.lit(3)).cast("int"), lambda x: F.substr(x, F.lit(7), F.lit(2)).cast("int")

    def broken(x: Column, k: Column) -> Column:
        before = F.get(found, k - 1)
        follows = ((section(x) == section(before)) & (chunk(x) == chunk(before) + 1)) | ((section(x) == section(before) + 1) & (chunk(x) == 1))
        return F.when(k == 0, ~((section(x) == 1) & (chunk(x) == 1))).otherwise(~follows)

    return F.get(F.filter(found, broken), F.lit(0))


def repeats(found: Column) -> Column:
    """Values that occur more than once, in order, each once."""
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: F.size(F.filter(found, lambda y: y == x)) > 1)))


def locator_issues(found: Column, known: Column) -> tuple[Column, Column]:
    """Of texts: those that are no locators, and locators that no heading has."""
    wrong = F.filter(found, lambda x: ~F.regexp_like(x, F.lit(r"^S\d{3}:C\d{2}$")))
    missing = F.filter(found, lambda x: F.regexp_like(x, F.lit(r"^S\d{3}:C\d{2}$")) & ~F.array_contains(known, x))
    return wrong, missing


#: What a card has beside its reading.
PARTS = ("section_moves", "study", "argument_map", "evidence_boundary", "quality", "limitations")


def card_facts(c: dict[str, Column], policy: Iterable[str] = ()) -> dict[str, Column]:
    """What several rules ask of a card, as columns, so it is found once for each row and not for each rule."""
    card = c["card"]
    own = lambda key: first_text(text(at(card, key)), text(at(card, f"paper.{key}")))
    kinds = kind(at(card, "writing_capability_candidates"))
    said = {k: text(at(card, f"reading.{k}")) for k in dict.fromkeys(("access_level", "reader_role", "packet_sha256", *V.READER_PROVENANCE, "reader_model", "reasoning_effort", *policy))}
    return {
        "f_has_reading": is_map(at(card, "reading")), "f_own_paper_id": own("paper_id"), "f_own_pmcid": own("pmcid"),
        "f_own_hash": first_text(*[text(at(card, p + k)) for p in ("", "provenance.", "source.") for k in ("source_record_sha256", "source_hash")]),
        "f_said": F.struct(*[v.alias(k) for k, v in said.items()]), "f_read_list": at(card, "reading.section_locators_read"), "f_omissions": at(card, "reading.omissions"),
        **{f"f_{k}": at(card, k) for k in PARTS}, "f_offered": F.when(kinds.isin("", "VOID"), at(card, "capability_candidates")).otherwise(at(card, "writing_capability_candidates")),
        "f_source_line": F.lower(F.regexp_extract(F.coalesce(c["packet"], F.lit("")), V.PACKET_SOURCE_HASH, 1)),
    }


def row_facts(c: dict[str, Column]) -> dict[str, Column]:
    """What follows from those."""
    pmcid = first_text(c["f_own_pmcid"], F.trim(F.coalesce(c["pmcid"], F.lit(""))))
    return {
        "f_pmcid": pmcid, "f_there": c["f_has_reading"] & (pmcid != "") & c["packet"].isNotNull(), "f_is_list": is_list(c["f_read_list"]), "f_omissions_kind": kind(c["f_omissions"]),
        "f_read_texts": F.transform(items(c["f_read_list"]), text), "f_moves_items": items(c["f_section_moves"]), "f_offered_items": items(c["f_offered"]),
    }


def read_facts(c: dict[str, Column]) -> dict[str, Column]:
    """And what follows from the locators that were read."""
    declared = F.filter(c["f_read_texts"], lambda x: x != "")
    return {
        "f_named": c["f_there"] & (F.size(c["headings"]) > 0), "f_listed": c["f_is_list"] & (F.size(c["f_read_texts"]) > 0), "f_declared": declared,
        "f_unread": F.array_sort(F.array_except(c["headings"], declared)), "f_extra": F.array_sort(F.array_except(declared, c["headings"])),
    }


def completed_card_rules(c: dict[str, Column], policy: dict[str, str] | None = None, policy_from: int | None = None) -> list[Rule]:
    """The contract of a completed card.

    `c` has: card (variant), headings (the packet's locators), selected (boolean), paper_id, pmcid, record_hash, record_path, row_packet_hash
    (text of the selection row), reading_order, record_bytes_hash (null: no such record), packet
    (text, null: no packet) and packet_bytes_hash, and what `card_facts` and the two after it add. `policy` is what reading.* must be from
    reading_order `policy_from` on.
    """
    card = c["card"]
    low = lambda x: F.lower(F.trim(F.coalesce(x, F.lit(""))))
    row = lambda name: F.trim(F.coalesce(c[name], F.lit("")))
    sha = lambda x: F.regexp_like(x, F.lit("^[0-9a-fA-F]{64}$"))
    chosen, has_reading, packet, headings = c["selected"], c["f_has_reading"], c["packet"], c["headings"]
    own_hash, pmcid, there, named, declared, unread, extra = (c[f"f_{k}"] for k in ("own_hash", "pmcid", "there", "named", "declared", "unread", "extra"))
    pairs = [("paper_id", row("paper_id"), c["f_own_paper_id"]), ("pmcid", row("pmcid"), c["f_own_pmcid"]), ("source_record_sha256", row("record_hash"), own_hash)]
    given = row("record_hash")
    said = lambda key: c["f_said"][key]
    read_list, omissions = c["f_read_list"], c["f_omissions"]
    said_hash, row_hash, real_hash = said("packet_sha256"), row("row_packet_hash"), low(c["packet_bytes_hash"])
    source_line = c["f_source_line"]
    record_there = chosen & (row("record_path") != "") & c["record_bytes_hash"].isNotNull()
    agreed = [("selection", F.when(chosen, given).otherwise("")), ("card", own_hash), ("source record", F.when(record_there, low(c["record_bytes_hash"])).otherwise(""))]
    wrong, missing = locator_issues(c["f_read_texts"], headings)
    # locators in any string of the card that reading doesn't list
    values = F.regexp_replace(F.to_json(card), r'"(?:[^"\\]++|\\.)*+"\s*:', "")
    cited = F.array_distinct(F.regexp_extract_all(values, F.lit(V.LOCATOR), F.lit(0)))
    uncited = F.filter(cited, lambda x: ~F.array_contains(declared, x) & ~F.array_contains(headings, x))
    moves, study, argument, boundary, quality, limits = (c[f"f_{k}"] for k in PARTS)
    place = lambda found: F.transform(found, lambda k: k.cast("string"))
    numbered = lambda values, test: place(F.filter(F.transform(values, lambda x, k: F.when(test(x), k)), lambda k: k.isNotNull()))
    move_at = lambda x: text(at(x, "locator"))
    offered = c["f_offered"]
    sure = lambda x: F.lower(text(at(x, "confidence"))).isin(*V.CONFIDENCE)
    supports = lambda x: F.transform(items(at(x, "supporting_locators")), text)
    sound = lambda x: is_map(x) & filled(at(x, "capability")) & sure(x) & (F.size(supports(x)) > 0) & packet.isNotNull() & (packet != "") & ~F.exists(supports(x), lambda s: ~F.array_contains(headings, s))
    maps, backed = F.filter(c["f_moves_items"], is_map), F.flatten(F.transform(F.filter(c["f_offered_items"], is_map), supports))
    rules = [
        Rule("COMPLETED_ORPHAN", flag(~chosen)),
        Rule("IDENTITY_MISSING", each([(k, (a == "") | (b == "")) for k, a, b in pairs]), when=chosen),
        Rule("IDENTITY_MISMATCH", each([(k, (a != "") & (b != "") & (F.lower(a) != F.lower(b))) for k, a, b in pairs]), when=chosen),
        Rule("SOURCE_HASH_FORMAT", flag((given != "") & ~sha(given), "selection"), "WARNING", chosen),
        Rule("SOURCE_HASH_FORMAT", flag((own_hash != "") & ~sha(own_hash), "card"), when=chosen),
        Rule("SOURCE_RECORD_PATH", flag(row("record_path") == ""), when=chosen),
        Rule("SOURCE_RECORD_MISSING", flag((row("record_path") != "") & c["record_bytes_hash"].isNull()), when=chosen),
        Rule("SOURCE_RECORD_HASH_MISMATCH", each([(k, (h != "") & (F.lower(h) != low(c["record_bytes_hash"]))) for k, h in (("selection", given), ("card", own_hash))]), when=record_there),
        Rule("READING_FIELDS", flag(~has_reading)),
        Rule("READING_ACCESS", flag(said("access_level") != "full_text_read"), when=has_reading),
        Rule("READER_METADATA", each([(k, ~filled(at(card, f"reading.{k}"))) for k in V.READER_FIELDS]), when=has_reading),
        Rule("READER_PROVENANCE", each([(k, said(k) != v) for k, v in V.READER_PROVENANCE.items()]), when=has_reading & (F.lower(said("reader_role")) == V.PRIMARY_READER)),
        Rule("LOCATORS_EMPTY", flag(~c["f_listed"]), when=has_reading),
        Rule("LOCATORS_EMPTY", flag(c["f_is_list"] & ~c["f_listed"], "of a packet"), when=there),
        Rule("OMISSIONS_UNDECLARED", flag(c["f_omissions_kind"].isin("", "VOID")), when=has_reading),
        Rule("OMISSIONS_TYPE", flag(~c["f_omissions_kind"].isin("", "VOID", "ARRAY")), when=has_reading),
        Rule("OMISSIONS_PRESENT", flag(listed(omissions)), when=has_reading),
        Rule("PACKET_PMCID", flag(pmcid == ""), when=has_reading),
        Rule("PACKET_MISSING", flag((pmcid != "") & packet.isNull()), when=has_reading),
        Rule("PACKET_HASH_MISSING", each([("reading", said_hash == ""), ("selection", row_hash == "")]), when=there),
        Rule("PACKET_HASH_MISMATCH", each([("reading", (said_hash != "") & (F.lower(said_hash) != real_hash)), ("selection", sha(row_hash) & (F.lower(row_hash) != real_hash))]), when=there),
        Rule("PACKET_HASH_FORMAT", each([("selection", (row_hash != "") & ~sha(row_hash))]), when=there),
        Rule("PACKET_SOURCE_HASH_MISSING", flag(source_line == ""), when=there),
        Rule("PACKET_SOURCE_HASH_MISMATCH", each([(k, (h != "") & (F.lower(h) != source_line)) for k, h in agreed]), when=there & (source_line != "")),
        Rule("LOCATOR_FORMAT", wrong, when=there & c["f_is_list"]),
        Rule("LOCATOR_MISSING", F.concat(F.when(c["f_is_list"], missing).otherwise(none()), uncited), when=there),
        Rule("PACKET_LOCATORS", flag(F.size(headings) == 0), when=there),
        Rule("PACKET_LOCATORS_DUPLICATE", repeats(headings), when=named),
        Rule("PACKET_LOCATOR_SEQUENCE", F.array_compact(F.array(sequence_break(headings))), when=named),
        Rule("LOCATORS_DUPLICATE", repeats(declared), when=named),
        Rule("LOCATORS_INCOMPLETE", unread, when=named),
        Rule("LOCATORS_EXTRA", extra, when=named),
        Rule("LOCATORS_ORDER", flag((F.size(unread) == 0) & (F.size(extra) == 0) & (declared != headings)), when=named),
        Rule("SECTION_MOVES", F.when((F.size(c["f_moves_items"]) == 0), F.array(F.lit(""))).otherwise(F.concat(numbered(c["f_moves_items"], lambda x: ~is_map(x)), numbered(c["f_moves_items"], lambda x: is_map(x) & ~filled(at(x, "transferable_principle"))))), when=has_reading),
        Rule("LOCATOR_FORMAT", F.filter(F.transform(maps, move_at), lambda x: ~F.regexp_like(x, F.lit(r"^S\d{3}:C\d{2}$"))), when=has_reading),
        Rule("LOCATOR_MISSING", locator_issues(F.transform(maps, move_at), headings)[1], when=has_reading),
        Rule("LIMITATIONS", flag(~is_map(limits) | ~filled(at(card, "limitations.scope_boundary"))), when=has_reading),
        Rule("STUDY_FIELDS", F.when(~is_map(study), F.array(F.lit(""))).otherwise(each([(k, ~filled(at(card, f"study.{k}"))) for k in V.STUDY_TEXTS] + [(k, ~listed(at(card, f"study.{k}"))) for k in V.STUDY_LISTS])), when=has_reading),
        Rule("ARGUMENT_FIELDS", F.when(~is_map(argument), F.array(F.lit(""))).otherwise(each([(k, ~filled(at(card, f"argument_map.{k}"))) for k in ("central_claim", "warrant")] + [("data", ~listed(at(card, "argument_map.data")))])), when=has_reading),
        Rule("EVIDENCE_BOUNDARY", F.when(~is_map(boundary), F.array(F.lit(""))).otherwise(each([(k, ~is_list(at(card, f"evidence_boundary.{k}"))) for k in V.BOUNDARY] + [("any", ~F.greatest(*[filled(at(card, f"evidence_boundary.{k}")).cast("int") for k in V.BOUNDARY]).cast("boolean"))])), when=has_reading),
        Rule("QUALITY_FIELDS", F.when(~is_map(quality), F.array(F.lit(""))).otherwise(each([(k, ~filled(at(card, f"quality.{k}"))) for k in V.QUALITY_FIELDS])), when=has_reading),
        Rule("SUMMARY_FIELDS", flag(~(filled(at(card, "summary_zh")) | filled(at(card, "summary")) | filled(at(card, "summary_en")))), when=has_reading),
        Rule("CAPABILITY_CANDIDATE", F.when((F.size(c["f_offered_items"]) == 0), F.array(F.lit(""))).otherwise(F.concat(numbered(c["f_offered_items"], lambda x: ~is_map(x) | ~filled(at(x, "capability"))), flag(~F.exists(c["f_offered_items"], sound), "none sound"))), when=has_reading),
        Rule("CAPABILITY_CONFIDENCE", numbered(c["f_offered_items"], lambda x: is_map(x) & ~sure(x)), when=has_reading),
        Rule("LOCATOR_FORMAT", locator_issues(backed, headings)[0], when=there & (packet != "")),
        Rule("LOCATOR_MISSING", locator_issues(backed, headings)[1], when=there & (packet != "")),
        Rule("CAPABILITY_LOCATORS", numbered(c["f_offered_items"], lambda x: is_map(x) & ~listed(at(x, "supporting_locators"))), when=has_reading),
    ]
    if policy and policy_from:
        late = has_reading & chosen & (c["reading_order"] >= policy_from)
        rules.append(Rule("READER_POLICY", each([(k, said(k) != v) for k, v in policy.items()]), when=late))
    return rules


def card_issues(df: DataFrame, key: str, policy: dict[str, str] | None = None, policy_from: int | None = None) -> DataFrame:
    """key, severity, code and detail of every issue of completed cards; `df` has the columns of the rules and `card` as JSON.

    One scan and no shuffle. A card that is no JSON object is left to the reader of cards: no issues.
    """
    known = df.withColumn("card", F.try_parse_json("card")).withColumn("headings", packet_locators(F.coalesce("packet", F.lit(""))))
    c = {name: F.col(name) for name in df.columns} | {"headings": F.col("headings")}
    for facts in (lambda c: card_facts(c, policy or ()), row_facts, read_facts):
        more = facts(c)
        known = known.withColumns(more)
        c |= {name: F.col(name) for name in more}
    found = F.when(is_map(F.col("card")), issues(completed_card_rules(c, policy, policy_from)))
    return known.select(key, F.explode(found).alias("issue")).select(key, "issue.*")

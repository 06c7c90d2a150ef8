"""Queries on cards: nested records with overlays, made from `documents` as JSON by the same expressions in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholia.functions import patterns as V
from scholia.operators import nested
from scholia.operators.components import kept

from .papers import PAPERS_SQL, table

QUERIES: dict = {}


def query(sql: str | None):
    def add(run):
        QUERIES[run.__name__] = (run, sql)
        return run

    return add


def _json(*parts: str) -> str:
    """Text and, between dollars, expressions of both engines."""
    out = []
    for k, piece in enumerate("".join(parts).split("$")):
        out.append(f"CAST({piece} AS STRING)" if k % 2 else "'" + piece + "'")
    return " || ".join(out)


# cards: identities that agree, disagree or are missing; objects, lists, scalars and empty objects; locators in strings
CARD = _json(
    '{"argument_map": {"claims": [{"at": "S00$1 + doc_id % 9$:C0$1 + n_chars % 9$", "text": "$phrase$"}, {"at": ["S010:C01 and S010:C02", "xS001:C01"]}], "kind": {"name": "$lang$", "n": $n_chars$}}, ',
    '"limitations": {}, "paper": {"paper_id": "p$doc_id - doc_id % 17 % 2$", "title": "$phrase$"}, ',
    '"$CASE WHEN doc_id % 5 = 0 THEN \'pmcid\' ELSE \'other_id\' END$": "pmc-$doc_id % 19 % 3 + doc_id$", "card_id": "$CASE WHEN doc_id % 7 < 2 THEN \'\' WHEN doc_id % 23 = 5 THEN \'semantic:x\' ELSE \'SEMANTIC:PMC\' || doc_id END$", ',
    '"$CASE WHEN doc_id % 3 = 1 THEN \'source\' ELSE \'sources\' END$": {"source_hash": "$CASE WHEN doc_id % 31 = 4 THEN \'ff\' ELSE \'AA\' END$"}, "reading": {"notes": ["n"], "status": "pending"}, "status": "$CASE WHEN doc_id % 2 = 0 THEN \'Blank\' ELSE \'open\' END$"}',
)
_KINDS = [
    '{"argument_map": {"claims": ["new S002:C01"], "kind": "flat"}, "quality": {"score": $doc_id % 6$}}',
    '{"argument_map": {"kind": {"n": {"deep": {}}, "name": {}}}, "limitations": {"text": "see S003:C04", "Reading": [{"Status": "x"}]}, "reading": {"status": "x", "more": {"a": 1}}}',
    '{"limitations": [], "quality": {}, "summary": {"strata": ["$lang$"]}}',
    "{}",
]
OVERLAY = "CASE doc_id % 4 " + " ".join(f"WHEN {k} THEN {_json(o)}" for k, o in enumerate(_KINDS)) + " END"
CARDS_SQL = f"(SELECT doc_id, lang, n_chars, phrase, ({CARD.replace('AS STRING', 'AS VARCHAR')})::JSON AS card, ({OVERLAY.replace('AS STRING', 'AS VARCHAR')})::JSON AS overlay FROM {PAPERS_SQL})"
_TREE = "SELECT {0}.doc_id, regexp_replace(t.fullkey, '^\\$\\.?', '') AS path, CAST(t.value AS VARCHAR) AS value FROM {0}, json_tree({0}.{1}) AS t WHERE t.type NOT IN ('OBJECT', 'ARRAY') OR CAST(t.value AS VARCHAR) IN ('{{}}', '[]')"


def cards(s, d) -> DataFrame:
    """doc_id, lang, card and overlay (JSON text)."""
    return table(s, d).selectExpr("doc_id", "lang", f"{CARD} AS card", f"{OVERLAY} AS overlay")


def _leaves(s, d, column: str, lists: bool = True) -> DataFrame:
    return nested.leaves(cards(s, d).select("doc_id", column), column, lists)


def _merged(s, d) -> DataFrame:
    return kept(nested.rebuilt(nested.merged(_leaves(s, d, "card", False), _leaves(s, d, "overlay", False), "doc_id"), "doc_id"))


@query(f"WITH c AS {CARDS_SQL}, l AS ({_TREE.format('c', 'card')}) SELECT doc_id, path, value FROM l WHERE starts_with(value, '\"')")
def card_strings(s, d):
    """Every string of a card with its path."""
    return nested.strings(_leaves(s, d, "card")).select("doc_id", nested.named(F.col("path")).alias("path"), "value")


@query(f"WITH c AS {CARDS_SQL}, l AS ({_TREE.format('c', 'card')}), f AS (SELECT doc_id, path, unnest(regexp_extract_all(' ' || value, '[^A-Za-z0-9](S\\d{{3}}:C\\d{{2}})\\b', 1)) AS locator FROM l WHERE starts_with(value, '\"')) SELECT doc_id, path, locator FROM f")
def card_locators(s, d):
    """Every locator in a card's strings with the path of the string."""
    return nested.locators(_leaves(s, d, "card")).select("doc_id", nested.named(F.col("path")).alias("path"), "locator")


@query(f"WITH c AS {CARDS_SQL}, m AS (SELECT doc_id, json_merge_patch(card, overlay) AS j FROM c) {_TREE.format('m', 'j')}")
def card_merge(s, d):
    """Leaves of cards merged with their overlays, rebuilt to JSON and flattened again."""
    rows = nested.leaves(_merged(s, d), "json")
    return rows.select("doc_id", nested.named(F.col("path")).alias("path"), "value")


_IN = lambda names: "(" + ", ".join(f"'{n}'" for n in names) + ")"


@query(
    f"WITH c AS {CARDS_SQL}, t AS (SELECT c.doc_id, t.fullkey, lower(t.key) AS last, lower(split_part(regexp_replace(t.fullkey, '\\[', '.['), '.', 2)) AS root FROM c, json_tree(c.overlay) AS t WHERE t.id > 0) "
    f"SELECT doc_id, regexp_replace(replace(fullkey, '[', '.['), '^\\$\\.', '') AS path FROM t WHERE NOT ends_with(fullkey, ']') AND (last IN {_IN(V.PROTECTED_KEYS + V.PROTECTED_ROOTS)} OR (root IN {_IN(V.PROTECTED_ROOTS)} AND '$.' || root <> lower(fullkey)))"
)
def protected_paths(s, d):
    """Places of overlays that may not be written."""
    return nested.protected_paths(_leaves(s, d, "overlay"), "doc_id")


_FIRST = "CASE WHEN x.pmcid <> '' THEN x.pmcid WHEN starts_with(lower(x.card_id), 'semantic:') THEN split_part(x.card_id, ':', 2) ELSE 'PMC' || doc_id END"
_ASSEMBLY = f"""
WITH c AS {CARDS_SQL}, m AS (SELECT doc_id, lang, json_merge_patch(card, overlay) AS j FROM c),
x AS (SELECT doc_id, lang, j, coalesce(j->>'$.pmcid', '') AS pmcid, j->>'$.paper.paper_id' AS own_paper, j->>'$.card_id' AS card_id, coalesce(j->>'$.source.source_hash', '') AS own_hash FROM m),
y AS (SELECT *, {_FIRST} AS own_pmcid, 'p' || doc_id AS paper, 'aa' AS given FROM x),
i AS (SELECT *, CASE WHEN lower(regexp_replace(own_pmcid, '[^A-Za-z0-9]', '', 'g')) <> 'pmc' || doc_id THEN 'pmcid_mismatch' WHEN lower(own_paper) <> lower(paper) THEN 'paper_id_mismatch'
  WHEN card_id <> '' AND lower(card_id) <> 'semantic:pmc' || doc_id THEN 'card_id_mismatch' WHEN own_hash <> '' AND lower(own_hash) <> given THEN 'source_record_sha256_mismatch' END AS issue FROM y)
"""
_PATCH = """json_merge_patch(json_merge_patch(j, json_object(
    'pmcid', own_pmcid, 'paper_id', own_paper, 'card_id', CASE WHEN card_id <> '' THEN card_id ELSE 'semantic:PMC' || doc_id END,
    'source_record_sha256', CASE WHEN own_hash <> '' THEN own_hash ELSE given END, 'schema_version', '1.0',
    'selection', json_object('selection_reason', 'quota', 'primary_stratum', lang, 'reading_order', doc_id % 50),
    'reading', json_object('status', 'completed', 'access_level', 'full_text_read', 'reader_role', 'first', 'reader_model', 'm', 'reasoning_effort', 'max', 'read_at', '2024-01-01T00:00:00Z',
      'packet_sha256', md5(doc_id::VARCHAR), 'section_locators_read', ['S001:C01', 'S001:C02'], 'omissions', []::VARCHAR[], 'adjudication_status', 'self_reviewed'))),
  CASE WHEN (j->'$.source') IS NULL THEN json_object('source', json_object('source_record_sha256', given)) ELSE '{}'::JSON END)"""


def _selected(s, d) -> DataFrame:
    """Merged cards beside their selection and packet."""
    columns = {
        "expected_pmcid": "concat('PMC', doc_id)", "paper_id": "concat('p', doc_id)", "record_hash": "'aa'", "selection_reason": "'quota'", "primary_stratum": "lang", "reading_order": "doc_id % 50",
        "packet_sha256": "md5(CAST(doc_id AS STRING))", "locators": "array('S001:C01', 'S001:C02')", "read_at": "'2024-01-01T00:00:00Z'", "role": "'first'", "model": "'m'", "effort": "'max'",
    }
    joined = _merged(s, d).withColumnRenamed("json", "card").join(cards(s, d).select("doc_id", "lang"), "doc_id")
    return joined.selectExpr("doc_id", "card", *[f"{e} AS {c}" for c, e in columns.items()])


@query(f"{_ASSEMBLY} SELECT issue, count(*) AS n, min(doc_id) AS first_id FROM i GROUP BY issue")
def card_issues(s, d):
    """How many cards can't be assembled, by the first identity that disagrees."""
    return nested.assembled(_selected(s, d), "doc_id").groupBy("issue").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query(f"{_ASSEMBLY}, a AS (SELECT doc_id, {_PATCH} AS j FROM i WHERE issue IS NULL), l AS ({_TREE.format('a', 'j')}) SELECT doc_id, path, value FROM l WHERE NOT (path = 'status' AND lower(value) = '\"blank\"')")
def card_assembly(s, d):
    """Leaves of assembled cards: overlay, identity, selection, source and the completed reading; a blank status goes."""
    sound = kept(nested.assembled(_selected(s, d), "doc_id")).where("issue IS NULL")  # kept first, so the filter doesn't parse cards again
    base, patches = (nested.leaves(sound.select("doc_id", column), column, False) for column in ("card", "patch"))
    done = kept(nested.rebuilt(nested.merged(base, patches, "doc_id"), "doc_id"))
    rows = nested.leaves(done, "json").select("doc_id", nested.named(F.col("path")).alias("path"), "value")
    return rows.where("NOT (path = 'status' AND lower(value) = '\"blank\"')")

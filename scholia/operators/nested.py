"""Nested records as rows of paths: flattened through Variant, merged in the order of paths, checked, rebuilt.

A path is an array of steps, `.key` into an object and `[k]` into a list. Leaves are scalars, empty
containers and, where lists are taken whole, lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholia.functions import patterns as V

EMPTY = "{}"


def depth(json: Column) -> Column:
    """How deep containers are nested in JSON text: how often its innermost brackets can be taken away."""
    bare = F.translate(F.regexp_replace(json, r'(?:[^\[\]{}"]++|"(?:[^"\\]++|\\.)*+")++|"', ""), "[]", "{}")

    def levels(text: Column) -> Column:
        start = F.struct(text.alias("left"), F.lit(0).alias("n"))
        step = lambda s, _: F.struct(F.replace(s["left"], F.lit("{}"), F.lit("")).alias("left"), (s["n"] + F.contains(s["left"], F.lit("{}")).cast("int")).alias("n"))
        return F.aggregate(F.sequence(F.lit(0), F.floor(F.length(text) / 2).cast("int")), start, step)["n"]

    return F.transform(F.array(bare), levels)[0]


def leaves(df: DataFrame, json: str, lists: bool = True) -> DataFrame:
    """The columns of `df` but `json`, with path and value (JSON text) of each leaf; lists go whole if not `lists`.

    One generator for each level that the deepest row has, none of which shuffles; the deepest is found
    by a pass before, so what is costly to make should be kept first. Text that is no
    JSON, and null, gives no rows. Columns named path, value, v or levels may not be among `df`'s.
    """
    others = [c for c in df.columns if c != json]
    most = df.select(F.max(depth(F.col(json)))).first()[0] or 0  # one number
    rows = df.select(*others, F.array().cast("array<string>").alias("path"), F.try_parse_json(json).alias("v")).where("v is not null")
    kept = "".join(f"`{c}`, " for c in others)
    if lists:
        step = "CASE WHEN key IS NOT NULL THEN concat(path, array('.' || key)) WHEN pos IS NOT NULL THEN concat(path, array('[' || pos || ']')) ELSE path END AS path, CASE WHEN pos IS NOT NULL THEN value ELSE v END AS v"
        opened = "variant_explode_outer(v)"
    else:
        step = "CASE WHEN key IS NOT NULL THEN concat(path, array('.' || key)) ELSE path END AS path, CASE WHEN key IS NOT NULL THEN value ELSE v END AS v"
        opened = "explode_outer(try_variant_get(v, '$', 'map<string, variant>')) AS o(key, value)"  # null if it's no object
    for _ in range(most):
        rows = df.sparkSession.sql(f"SELECT {kept}{step} FROM {{rows}}, LATERAL {opened}", rows=rows)
    return rows.select(*others, "path", F.to_json("v").alias("value"))


def named(path: Column) -> Column:
    """A path as text: keys joined by dots, places of lists in brackets."""
    return F.regexp_replace(F.array_join(path, ""), r"^\.", "")


def _prefixes(path: Column, whole: bool) -> Column:
    """Paths from the root down, the root's among them; to the path itself if `whole`, else to the one above it."""
    last = F.size(path) - (0 if whole else 1)
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(path, 1, k))).otherwise(F.array().cast("array<array<string>>"))


def _begins(short: Column, path: Column) -> Column:
    """Whether a path leads to or through the other."""
    return (F.size(short) <= F.size(path)) & (F.slice(path, 1, F.size(short)) == short)


def merged(base: DataFrame, overlay: DataFrame, key: str) -> DataFrame:
    """Leaves (key, path, value) of `base` under those of `overlay`, both from `leaves` with whole lists, one record a key.

    The overlay wins; where both have objects they are merged, anything else, lists too, is
    replaced. An empty object of the overlay replaces a scalar or a list, but leaves an object as it is.

    No leaf of a record leads through another, and paths that begin alike stand together in their order.
    So of the overlay's leaves only the last one up to a leaf can lead to it, and of all leaves only
    the next can lie below it: one shuffle by key and one sort tell which leaves go.
    """
    both = base.select(key, "path", "value", F.lit(1).alias("leaf_side")).unionByName(overlay.select(key, "path", "value", F.lit(0).alias("leaf_side")))
    order = Window.partitionBy(key).orderBy("path", "leaf_side")
    over = F.last(F.when(F.col("leaf_side") == 0, F.struct("path", "value")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    path, o = F.col("path"), F.col("leaf_over")
    below = F.coalesce((F.size("leaf_next") > F.size(path)) & _begins(path, F.col("leaf_next")), F.lit(False))
    replaced = F.coalesce(_begins(o["path"], path) & ((o["value"] != EMPTY) | (F.size(o["path"]) == F.size(path))), F.lit(False))
    goes = F.when(F.col("leaf_side") == 0, below & (F.col("value") == EMPTY)).otherwise(below | replaced)
    return both.withColumns({"leaf_over": over, "leaf_next": F.lead("path").over(order)}).where(~goes).select(key, "path", "value")


def rebuilt(rows: DataFrame, key: str) -> DataFrame:
    """key and json of records from their leaves, keys in order; paths of objects only.

    A record's leaves are put in order by path; each opens and closes what lies between it and the one before.
    """
    order = Window.partitionBy(key).orderBy("path")
    path, before, shared = F.col("path"), F.col("leaf_before"), F.col("leaf_shared")

    def name(step: Column) -> Column:
        bare = F.substr(step, F.lit(2))
        for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            bare = F.replace(bare, F.lit(a), F.lit(b))
        return F.concat(F.lit('"'), bare, F.lit('":'))

    # where two paths of a record part: neither leads through the other
    parts = F.array_position(F.zip_with(before, path, lambda a, b: a.eqNullSafe(b)), False)
    placed = rows.select(key, "path", "value", F.lag("path").over(order).alias("leaf_before"), F.row_number().over(order).alias("leaf_no"))
    placed = placed.withColumn("leaf_shared", F.when(before.isNull(), 0).otherwise(parts - 1).cast("int"))
    closed = F.when(before.isNotNull(), F.concat(F.repeat(F.lit("}"), F.size(before) - shared - 1), F.lit(","))).otherwise("")
    opened = F.array_join(F.transform(F.slice(path, shared + 1, F.size(path) - shared), name), "{")
    pieces = placed.select(key, "leaf_no", F.size(path).alias("leaf_deep"), F.concat(closed, opened, F.col("value")).alias("leaf_piece"))
    whole = pieces.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("leaf_no", "leaf_piece"))).alias("leaves"), F.max_by("leaf_deep", "leaf_no").alias("leaf_deep"))
    text = F.array_join(F.col("leaves")["leaf_piece"], "")
    return whole.select(key, F.when(F.col("leaf_deep") == 0, text).otherwise(F.concat(F.lit("{"), text, F.repeat(F.lit("}"), F.col("leaf_deep")))).alias("json"))


def protected_paths(rows: DataFrame, key: str) -> DataFrame:
    """key and path of every place of an overlay (leaves through lists) that may not be written.

    That is a protected key at any depth, a protected root's name at any depth, and all below such a root.
    """
    at = rows.select(key, F.explode(_prefixes(F.col("path"), True)).alias("at")).where(F.size("at") > 0).distinct()
    last, first = F.lower(F.element_at("at", -1)), F.lower(F.element_at("at", 1))
    keys, roots = [f".{k}" for k in V.PROTECTED_KEYS], [f".{k}" for k in V.PROTECTED_ROOTS]
    hit = last.startswith(".") & (last.isin(keys + roots) | (first.isin(roots) & (F.size("at") > 1)))
    steps = F.transform("at", lambda s: F.regexp_replace(s, r"^\.", ""))
    return at.where(hit).select(key, F.array_join(steps, ".").alias("path"))


def strings(rows: DataFrame) -> DataFrame:
    """The rows whose value is a string, with it decoded as `text`."""
    return rows.where(F.col("value").startswith('"')).withColumn("text", F.expr("CAST(parse_json(value) AS STRING)"))


def locators(rows: DataFrame) -> DataFrame:
    """Each locator in each string, in the columns of `rows` but value, with `locator`."""
    found = F.regexp_extract_all("text", F.lit(V.LOCATOR), F.lit(0))
    return strings(rows).withColumn("locator", F.explode(found)).drop("text", "value")


def assembled(cards: DataFrame, key: str) -> DataFrame:
    """key, card, issue and patch for merged cards: `card` JSON beside selection and packet columns.

    Columns read: card, expected_pmcid, paper_id, record_hash, selection_reason, primary_stratum,
    reading_order, packet_sha256, locators (array), read_at, role, model, effort. `issue` names
    the first identity that disagrees, null if none; `patch` is the JSON that `merged` puts over the
    card: identity, selection and source where it has none, and the completed reading. A card is parsed
    once, unless a filter on the result makes Spark do it for the filter as well.
    """
    first = lambda *found: F.coalesce(*[F.nullif(f, F.lit("")) for f in found], F.lit(""))
    slim = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z0-9]+", ""))
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    c = F.col
    hashes = [p + h for p in ("", "source.", "provenance.") for h in ("source_record_sha256", "source_hash")]
    said = F.struct(*[
        F.coalesce(F.trim(F.expr(f"try_variant_get(f_card, '$.{path}', 'string')")), F.lit("")).alias(path.replace(".", "_"))
        for path in ("pmcid", "paper.pmcid", "card_id", "paper_id", "paper.paper_id", *hashes)
    ])
    has = F.struct(*[F.expr(f"variant_get(f_card, '$.{k}') IS NOT NULL").alias(k) for k in ("selection", "source", "schema_version")])
    text = lambda path: c("f_said")[path.replace(".", "_")]
    facts = cards.withColumn("f_card", F.parse_json("card")).withColumns({"f_said": said, "f_has": has}).drop("f_card")
    facts = facts.withColumns({
        "f_pmcid": first(text("pmcid"), text("paper.pmcid"), F.when(F.lower(text("card_id")).startswith("semantic:"), F.trim(F.regexp_extract(text("card_id"), r"(?s)^[^:]*:(.*)$", 1))), c("expected_pmcid")),
        "f_paper": first(text("paper_id"), text("paper.paper_id")), "f_hash": first(*[text(h) for h in hashes]),
    })
    own_pmcid, own_paper, own_card, own_hash = c("f_pmcid"), c("f_paper"), text("card_id"), c("f_hash")
    wanted_card, given_paper = F.concat(F.lit("semantic:"), c("expected_pmcid")), F.coalesce(F.trim("paper_id"), F.lit(""))
    given_hash = F.coalesce(F.trim("record_hash"), F.lit(""))
    issue = (
        F.when(slim(own_pmcid) != slim(c("expected_pmcid")), "pmcid_mismatch")
        .when((own_paper != "") & (given_paper != "") & (low(own_paper) != low(given_paper)), "paper_id_mismatch")
        .when((own_card != "") & (low(own_card) != low(wanted_card)), "card_id_mismatch")
        .when((own_hash != "") & (given_hash != "") & (F.lower(own_hash) != F.lower(given_hash)), "source_record_sha256_mismatch")
    )
    absent = lambda k, value: F.when(~c("f_has")[k], value)
    reading = F.struct(
        F.lit("completed").alias("status"), F.lit("full_text_read").alias("access_level"), c("role").alias("reader_role"), c("model").alias("reader_model"), c("effort").alias("reasoning_effort"),
        c("read_at"), c("packet_sha256"), c("locators").alias("section_locators_read"), F.array().cast("array<string>").alias("omissions"), F.lit("self_reviewed").alias("adjudication_status"),
    )
    patch = F.struct(
        own_pmcid.alias("pmcid"), F.nullif(first(own_paper, given_paper), F.lit("")).alias("paper_id"), first(own_card, wanted_card).alias("card_id"),
        F.when(text("source_record_sha256") == "", F.nullif(first(own_hash, given_hash), F.lit(""))).alias("source_record_sha256"),
        absent("selection", F.struct("selection_reason", "primary_stratum", "reading_order")).alias("selection"),
        absent("source", F.struct(c("record_hash").alias("source_record_sha256"))).alias("source"), reading.alias("reading"), absent("schema_version", F.lit("1.0")).alias("schema_version"),
    )
    return facts.select(key, "card", issue.alias("issue"), F.to_json(patch).alias("patch"))


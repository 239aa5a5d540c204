"""Policy tables: look-up, defaults, checks, and bulk forms of create and replace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.fixed_values import (
    CRITICALITIES, ENTITIES, FIRST_SIGNATURE_ID, FUNCTIONALITIES, NEW_POLICY, THREAT_LEVEL, THREATS,
)
from burstline.functions.parsing import filled, not_blank, to_integer
from burstline.operators.joins import attach
from burstline.operators.paging import numbered
from burstline.schema import GROUP
from burstline.session import pin

ALL_GROUPS = -1
META = (1, 2, 3)


def policy_by_id(policies: DataFrame, ids: DataFrame | int) -> DataFrame:
    """Policies with the given id, or with an id in a table of ids. An id must be positive."""
    if isinstance(ids, int):
        if ids <= 0:
            raise ValueError(f"invalid policy id: {ids}")
        return policies.where(F.col("id") == ids)
    return attach(policies, ids.where("id > 0").select("id"), ["id"], "left_semi", ["name"])


def policy_by_name(requested: DataFrame, policies: DataFrame) -> DataFrame:
    """Each requested name with the id of the policy that has it, or null."""
    known = policies.select(F.col("name").alias("policyname"), F.col("id").alias("policy_id"))
    return attach(requested, known, ["policyname"], "left", requested.columns)


def groups_of_functionality(groups: DataFrame, functionality: str) -> DataFrame:
    return groups.where(F.col("functionality") == functionality).select("id")


def policy_groups(policies: DataFrame, groups: DataFrame) -> DataFrame:
    """Each policy with every resource group it applies to, as column ``rg_id``.

    One join with a plain key: the functionality where no group is set; a set group needs no partner.
    """
    by = policies.withColumn("_by", F.when(F.col("resourcegroupid") == ALL_GROUPS, F.col("functionality")))
    listed = groups.select(F.col("functionality").alias("_by"), F.col("id").cast("long").alias("_group"))
    own = F.when(F.col("resourcegroupid") != ALL_GROUPS, F.col("resourcegroupid").cast("long"))
    return (
        attach(by, listed, ["_by"], "left", ["id"]).withColumn(GROUP, F.coalesce(own, "_group"))
        .where(F.col(GROUP).isNotNull()).drop("_by", "_group")
    )


def with_category_name(policies: DataFrame, categories: DataFrame) -> DataFrame:
    """``category`` by ``categoryid``; an unknown id has an empty name."""
    names = categories.select(F.col("id").alias("categoryid"), F.col("name").alias("category"))
    return attach(policies.drop("category"), names, ["categoryid"], "left", ["name"]).withColumn(
        "category", F.coalesce("category", F.lit(""))
    )


def with_score(policies: DataFrame, scores: DataFrame) -> DataFrame:
    """``risk_score`` by criticality; null where the criticality has no score."""
    return attach(policies, scores.select("criticality", F.col("score").alias("risk_score")),
                  ["criticality"], "left", ["name"])


def default_criticality(criticality: Column) -> Column:
    return F.when(not_blank(criticality), criticality).otherwise(F.lit(CRITICALITIES[0]))


def policy_defaults(requests: DataFrame) -> DataFrame:
    """Requests with missing settings filled in and blank options dropped.

    An entity that is present but blank stays as it is; only a missing one gets the default.
    """
    options = [
        "verboseinformation", "grouping_attribute", "level2_primaryattribute",
        *[f"level{level}_metadataattribute{i}" for level in (1, 2) for i in META],
    ]
    return requests.withColumns({
        "criticality": default_criticality(F.col("criticality")),
        "violationentity": F.coalesce("violationentity", F.lit(ENTITIES[0])),
        **{name: filled(F.col(name)) for name in options if name in requests.columns},
    })


def display_config(requests: DataFrame) -> DataFrame:
    """Options of the display tree as columns, with gaps in the attribute lists closed.

    Level-1 attributes count only under a grouping attribute, level-2 ones only under a primary.
    """
    def attributes(level: int, under: str) -> Column:
        given = F.array(*[filled(F.col(f"level{level}_metadataattribute{i}")) for i in META])
        kept = F.array_compact(given)
        return F.when(not_blank(F.col(under)) & (F.size(kept) > 0), kept)

    return requests.withColumns({
        "grouping_attribute": filled(F.col("grouping_attribute")),
        "level1_meta": attributes(1, "grouping_attribute"),
        "level2_attribute": filled(F.col("level2_primaryattribute")),
        "level2_meta": attributes(2, "level2_primaryattribute"),
    })


# The display settings as one document, and the columns they are from.
DISPLAY_XML = "displayAttributes string, metadataAttributes array<string>, level2Attributes string, level2MetaDataAttr array<string>"
DISPLAY_COLUMNS = ["grouping_attribute", "level1_meta", "level2_attribute", "level2_meta"]
DISPLAY_ROOT = "violationDisplayConfig"
# Characters that no XML document can hold, escaped or not.
NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"


def _xml_text(text: Column) -> Column:
    """Text that a document can hold: characters that XML has no way to write are left out, and what is empty then is missing."""
    clean = F.regexp_replace(text, NOT_XML, "")
    return F.when(clean != "", clean)


def to_display_xml(policies: DataFrame, name: str = "violationdisplayconfig") -> DataFrame:
    """Policies with their display settings as one XML document in column ``name``; null where none is set."""
    one = {c: _xml_text(F.col(c)) for c in ("grouping_attribute", "level2_attribute")}
    many = {c: F.array_compact(F.transform(c, _xml_text)) for c in ("level1_meta", "level2_meta")}
    values = one | {c: F.when(F.size(kept) > 0, kept) for c, kept in many.items()}
    fields = [field.split()[0] for field in DISPLAY_XML.split(", ")]
    document = F.struct(*[values[c].alias(field) for c, field in zip(DISPLAY_COLUMNS, fields)])
    some = reduce(lambda a, b: a | b, [values[c].isNotNull() for c in DISPLAY_COLUMNS])
    return policies.withColumn(name, F.when(some, F.to_xml(document, {"rowTag": DISPLAY_ROOT})))


def from_display_xml(policies: DataFrame, name: str = "violationdisplayconfig") -> DataFrame:
    """The display settings read back from column ``name`` into their columns.

    Without a document all are unset. A document that cannot be read has unset columns and is told by ``display_unreadable``.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unread", "ignoreSurroundingSpaces": "false"}
    read = policies.withColumn("_display", F.from_xml(F.col(name), f"{DISPLAY_XML}, _unread string", options))
    fields = [field.split()[0] for field in DISPLAY_XML.split(", ")]
    unread = F.col("_display._unread").isNotNull()
    columns = {c: F.when(~unread, F.col(f"_display.{field}")) for c, field in zip(DISPLAY_COLUMNS, fields)}
    return read.withColumns(columns | {"display_unreadable": F.coalesce(unread, F.lit(False))}).drop("_display")


def validate(requests: DataFrame, policies: DataFrame) -> DataFrame:
    """One flag per check on each request, and ``accepted``.

    A request whose name exists reuses that policy, so only its name and category are checked.
    Names outside the offered lists of functionalities and threats are only flagged.
    """
    known = policies.select(F.col("name").alias("policyname"), F.lit(True).alias("exists"))
    checked = attach(requests, known, ["policyname"], "left", requests.columns)
    exists = F.coalesce("exists", F.lit(False))
    given = {
        name: F.coalesce(not_blank(F.col(name)), F.lit(False))
        for name in ("policyname", "functionality", "riskthreatname")
    }
    flags = {
        "exists": exists,
        "name_ok": given["policyname"],
        "category_ok": to_integer(F.col("categoryid"), T.IntegerType()).isNotNull(),
        "threat_ok": exists | given["riskthreatname"],
        "functionality_ok": exists | given["functionality"],
        "criticality_ok": exists | default_criticality(F.col("criticality")).isin(CRITICALITIES),
        "entity_ok": exists | F.coalesce("violationentity", F.lit(ENTITIES[0])).isin(ENTITIES),
        "functionality_listed": F.coalesce(F.col("functionality").isin(FUNCTIONALITIES), F.lit(False)),
        "threat_listed": F.coalesce(F.col("riskthreatname").isin(THREATS), F.lit(False)),
    }
    needed = ["name_ok", "category_ok", "threat_ok", "functionality_ok", "criticality_ok", "entity_ok"]
    checked = checked.withColumns(flags)
    return checked.withColumn("accepted", F.expr(" AND ".join(needed)))


def assign_ids(rows: DataFrame, order: str, columns: dict[str, int]) -> DataFrame:
    """Consecutive ids in the order of a unique column, each after the last one given out."""
    counted = numbered(rows, [], [order], "_number")
    return counted.withColumns(
        {name: F.col("_number") + F.lit(last) for name, last in columns.items()}
    ).drop("_number")


def assign_signature_ids(policies: DataFrame, last: str | None = None) -> DataFrame:
    """Text ids counted on from ``last``, or from the first one when that is blank."""
    return assign_ids(policies, "name", {"signatureid": _after(last)}).withColumn(
        "signatureid", F.col("signatureid").cast("string")
    )


def _after(last: str | None) -> int:
    return int(last) if last and last.strip() else FIRST_SIGNATURE_ID


def last_ids(table: DataFrame, columns: list[str]) -> dict[str, int]:
    """The largest id in each column, in one pass; 0 where there is none. Text that is no number counts as none."""
    known = [c for c in columns if c in table.columns]
    row = table.agg(*[F.max(F.col(c).try_cast("long")).alias(c) for c in known]).first() if known else None
    return {c: (row[c] if c in known else None) or 0 for c in columns}


def last_id(table: DataFrame, column: str = "id") -> int:
    return last_ids(table, [column])[column]


def threat_ids(names: DataFrame, threats: DataFrame, last: int = 0) -> DataFrame:
    """Distinct ``threatname`` with their id and level; names not in ``threats`` get new ids, after the largest there and after ``last``."""
    wanted = names.select("threatname").dropna().distinct()
    ids = threats.select(F.col("name").alias("threatname"), F.col("id").alias("riskthreatid"))
    known = pin(attach(wanted, ids, ["threatname"], "left", ["threatname"]))
    missing = known.where(F.col("riskthreatid").isNull()).select("threatname")
    made = assign_ids(missing, "threatname", {"riskthreatid": max(last, last_id(threats))})
    return (
        known.where(F.col("riskthreatid").isNotNull()).withColumn("is_new", F.lit(False))
        .unionByName(made.withColumn("is_new", F.lit(True)))
        .withColumn("level", F.when(F.col("is_new"), F.lit(THREAT_LEVEL)))
    )


IDS_OF_CATEGORY = ["riskthreatid", "risktypeid"]
# Kinds of ids that are counted on and never given out twice.
ID_KINDS = ["id", "signatureid", "risktypeid", "riskthreatid"]


def category_rows(policies: DataFrame) -> DataFrame:
    """The category row of each policy: policy, category, and the policy's threat and risk-type ids."""
    return policies.select(F.col("id").alias("policyid"), "categoryid", *IDS_OF_CATEGORY, "category")


def listed_categories(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From a list of categories for each policy (``policyid``, ``categoryids``), the rows they make and the policies they replace.

    An empty list is a legal one: it makes no rows, and the policy's old ones go. A null list leaves the policy as it is. A category
    that a list repeats, or that is null, makes no row of its own.
    """
    given = lists.where(F.col("categoryids").isNotNull())
    rows = given.select("policyid", F.explode("categoryids").alias("categoryid")).dropna().distinct()
    return rows, given.select("policyid").distinct()


def replace_categories(old: DataFrame, new: DataFrame, categories: DataFrame, policies: DataFrame | None = None,
                       replaced: DataFrame | None = None) -> DataFrame:
    """The rows of every policy in ``replaced`` (``policyid``) give way to its rows in ``new``, of which it may have none.

    Without ``replaced`` these are the policies named in ``new``. Threat and risk-type ids that ``new`` lacks are those of the policy in
    ``policies``, null for an unknown policy.
    """
    missing = [c for c in IDS_OF_CATEGORY if c in old.columns and c not in new.columns]
    if missing:
        if policies is None:
            raise ValueError(f"the old rows have {missing}: policies are needed to fill them in")
        ids = policies.select(F.col("id").alias("policyid"), *missing)
        new = attach(new, ids, ["policyid"], "left", ["policyid", "categoryid"])
    named = with_category_name(new, categories).select(*old.columns)
    gone = (new if replaced is None else replaced).select("policyid")
    kept = attach(old, gone, ["policyid"], "left_anti", ["policyid", "categoryid"])
    return kept.unionByName(named)


# What a new policy sets. Columns that the table of policies lacks are added to it.
SETTINGS = [
    "id", "name", "functionality", "categoryid", "category", "criticality", "threatname", "riskthreatid", "risktypeid", "riskname",
    "violator", "signatureid", "verboseinfotemplate", "grouping_attribute", "level1_meta", "level2_attribute", "level2_meta", *NEW_POLICY,
]


def merge_policies(
    requests: DataFrame,
    policies: DataFrame,
    categories: DataFrame,
    threats: DataFrame,
    last_signature: str | None = None,
    last_risk_type: int | None = None,
    marks: dict[str, int] | None = None,
) -> DataFrame:
    """``policies`` and a new row for each accepted request whose name is not among them.

    Where several requests share a name, the first by ``request_no`` makes the policy. Ids go on from the largest
    in ``policies`` unless the last ones given out are told; with ``marks`` (the last id ever given out, by ``ID_KINDS``) they go on from the greater
    of the two. ``category_rows`` of the new rows belong into the table of categories.
    """
    accepted = display_config(policy_defaults(validate(requests, policies).where("accepted AND NOT exists")))
    fields = [c for c in accepted.columns if c not in ("policyname", "request_no")]
    first = accepted.groupBy("policyname").agg(
        F.min_by(F.struct(*fields), "request_no").alias("_request")
    ).select(F.col("policyname").alias("name"), "_request.*")
    last, marks = last_ids(policies, ["id", "signatureid", "risktypeid"]), marks or {}
    last = {kind: max(largest, marks.get(kind, 0)) for kind, largest in last.items()}
    made = assign_ids(first, "name", {
        "id": last["id"],
        "signatureid": max(_after(last_signature), last["signatureid"] if last_signature is None else 0),
        "risktypeid": last["risktypeid"] if last_risk_type is None else last_risk_type,
    }).withColumns({
        "signatureid": F.col("signatureid").cast("string"),
        "categoryid": F.col("categoryid").cast("int"),
        "threatname": F.col("riskthreatname"),
        "violator": F.col("violationentity"),
        "verboseinfotemplate": F.col("verboseinformation"),
        "riskname": risk_name(F.col("name")),
        **{name: F.lit(value) for name, value in NEW_POLICY.items()},
    })
    ids = threat_ids(made, threats, marks.get("riskthreatid", 0)).select("threatname", "riskthreatid")
    made = attach(with_category_name(made, categories), ids, ["threatname"], "left", ["name"])
    return policies.withColumn("is_new", F.lit(False)).unionByName(
        made.select(*SETTINGS).withColumn("is_new", F.lit(True)), allowMissingColumns=True
    )


def risk_name(name: Column) -> Column:
    return F.concat(name, F.lit(" Risk"))

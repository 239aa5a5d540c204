"""The whole line: detect, drill down, read fields, tag, describe."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from burstline.functions.parsing import parse_fields, quarantined, readable, unreadable
from burstline.functions.templates import with_parsed_template
from burstline.operators import joins
from burstline.operators.detect import Rule, detect
from burstline.operators.drilldown import HIT, drilldown, measured_hits
from burstline.operators.policies import policy_groups, with_score
from burstline.operators.violations import (
    DISPLAY_FIELDS, VALUES, event_day, sentences, tag_policy, violations_nested, with_values, with_violation_id,
)
from burstline.operators.paging import EVENT_ORDER, PAGE_SIZE, page_number
from burstline.session import pin
from burstline.sinks.publish import PageLog, Sender, Sent
from burstline.sources.activity import groups_without_events, scan_activity_multi

# An analyzer turns events into the keys of violating groups: the columns of
# ``rule.group_keys``, and whatever else it has to say of them. With a column ``events``,
# the number of matching rows, large groups are spread by it. The engine does the rest.
Analyzer = Callable[[DataFrame, Rule], DataFrame]


@dataclass(frozen=True)
class Found:
    """``hits`` with what the analyzer says of them; ``few`` if they were measured to fit a broadcast."""

    hits: DataFrame
    events: DataFrame
    rejected: DataFrame
    few: bool


@dataclass(frozen=True)
class Violations:
    """``violations``; events of violating groups set ``rejected`` as unreadable; ``skipped`` groups without events."""

    violations: DataFrame
    rejected: DataFrame
    skipped: DataFrame


def find_events(events: DataFrame, rule: Rule, groups: DataFrame | None = None,
                analyzer: Analyzer = detect, once: bool = False, with_rejected: bool = False,
                seen: Observation | None = None, few: bool | None = None) -> Found:
    """Violating events of the given groups (column ``rg_id``; all groups if none are given).

    With ``once`` the readable rows of the hits are pinned, so that events and totals come from them and the event table is read twice in
    all, detection included. The rejected rows are looked for when they are used, in another pass; ``with_rejected`` pins them too, with all
    their columns, in the same pass. ``seen`` counts all rows of the hits (``rows``) and the rejected ones (``rejected``) in that pass.
    ``few`` as in ``drilldown``.
    """
    if groups is not None:
        events = scan_activity_multi(events, groups)
    hits, size = measured_hits(analyzer(events, rule))
    few = size.bytes <= joins.BROADCAST_BYTES if few is None else few
    raw = drilldown(events, hits, rule, few=few, count=size.rows)
    if seen is not None:
        raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(unreadable(raw)).alias("rejected"))
    if once and with_rejected:
        raw = pin(raw)
    good = readable(raw)
    good = pin(good) if once and not with_rejected else good
    return Found(hits.drop(HIT), parse_fields(good), quarantined(raw), few)


def used_variables(applied: DataFrame, events: DataFrame) -> tuple[list[str], list[tuple[str, str]]]:
    """Event columns, and totals of them, that some policy's template or display tree names.

    What comes to the driver is at most three names per event column.
    """
    keys = F.concat(
        F.coalesce("template_keys", F.array()), F.array("grouping_attribute", "level2_attribute"),
        F.coalesce("level1_meta", F.array()), F.coalesce("level2_meta", F.array()),
        # The verbose values have the event's own value of a variable that the sentence totals.
        F.coalesce("template_names", F.array()),
    )
    parts = F.split("key", r"\$")
    named = applied.select(F.explode(keys).alias("key")).where(parts[0].isin(events.columns)).distinct()
    used = {row["key"] for row in named.collect()}
    totals = [(c, kind) for c in events.columns for kind in ("COUNT", "SUM") if f"{c}${kind}" in used]
    return [c for c in events.columns if c in used], totals


def applied_policies(policies: DataFrame, groups: DataFrame) -> DataFrame:
    """A row per policy and resource group, templates read, pinned."""
    return pin(with_parsed_template(policy_groups(policies, groups)))


def tagged_events(events: DataFrame, applied: DataFrame, keys: list[str] | None = None, few_groups: bool = False) -> DataFrame:
    """Events with each policy of their group and the values that its texts look up; see ``with_values``."""
    columns, totals = used_variables(applied, events)
    return tag_policy(with_values(events, columns, totals, keys, few_groups), applied)


def describe(events: DataFrame, applied: DataFrame, keys: list[str] | None = None, few_groups: bool = False,
             time: str = "eventtime", zone: str = "tenanttz") -> DataFrame:
    """Violating events tagged with each policy of their group, and with id, day and sentence.

    ``applied`` comes from ``applied_policies``; ``keys`` name the groups that totals in a template count over. Whoever finds
    violating events in another way than by keys starts here.
    """
    tagged = with_violation_id(tagged_events(events, applied, keys, few_groups))
    day = event_day(time, zone if zone in tagged.columns else None)
    return sentences(tagged.withColumn("day_epoch", day)).drop(VALUES, *DISPLAY_FIELDS)


def records(events: DataFrame, applied: DataFrame, keys: list[str] | None = None, few_groups: bool = False,
            time: str = "eventtime", zone: str = "tenanttz") -> DataFrame:
    """The record to publish: each event with its nested violation, tree and verbose values, and the violation's id."""
    tagged = with_violation_id(tagged_events(events, applied, keys, few_groups))
    return violations_nested(tagged, time, zone if zone in tagged.columns else None)


def find_violations(
    events: DataFrame,
    policies: DataFrame,
    groups: DataFrame,
    scores: DataFrame,
    rule: Rule,
    analyzer: Analyzer = detect,
    with_rejected: bool = False,
) -> Violations:
    """Violations of a rule among the events of all groups that the policies apply to, and what was left out.

    ``with_rejected`` says that the rejected rows will be used as well: they then come from the same pass.
    """
    applied = applied_policies(with_score(policies, scores), groups)
    scanned = scan_activity_multi(events, applied)
    found = find_events(scanned, rule, analyzer=analyzer, once=True, with_rejected=with_rejected)
    return Violations(
        describe(found.events, applied, rule.group_keys, found.few), found.rejected, groups_without_events(scanned, applied)
    )


@dataclass(frozen=True)
class Published:
    """Events ``read`` in violating groups, of these ``rejected`` as unreadable, records ``formed`` from the others, and what was ``sent``."""

    read: int
    rejected: int
    formed: int
    sent: Sent


def publish_violations(
    events: DataFrame,
    policies: DataFrame,
    groups: DataFrame,
    scores: DataFrame,
    rule: Rule,
    log: PageLog,
    analyzer: Analyzer = detect,
    page_size: int = PAGE_SIZE,
    send: Sender | None = None,
) -> Published:
    """Find violations, form their records and send them page by page; what the log has already is not sent again.

    The counts are taken along in the passes that do the work.
    """
    seen, formed = Observation(), Observation()
    applied = applied_policies(with_score(policies, scores), groups)
    found = find_events(events, rule, applied, analyzer, once=True, with_rejected=True, seen=seen)
    rows = records(found.events, applied, rule.group_keys, found.few).observe(formed, F.count(F.lit(1)).alias("rows"))
    paged = page_number(rows, rule.group_keys, page_size, (*EVENT_ORDER, "violation_id"))
    sent = log.publish(paged, rule.group_keys, send=send)
    return Published(seen.get["rows"], seen.get["rejected"], formed.get["rows"], sent)

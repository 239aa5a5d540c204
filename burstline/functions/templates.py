"""Sentences with variables: ``${name!"default"}``, ``${name$COUNT!"default"}``, ``$SUM``.

A template can be a Python string, which is read once while the plan is built and becomes a
``concat``, or a column, so that each policy row brings its own: that is read once per policy, into arrays
that the policy carries along.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: syntax of a variable. Groups: name, aggregate, default.
VARIABLE = r'\$\{([A-Za-z0-9_]+)(?:\$(COUNT|SUM))?(?:!"([^"]*)")?\}'
# Of a parsed template: variable names, keys of their values, defaults, and the texts around them.
PARSED_FIELDS = ["template_names", "template_keys", "template_defaults", "template_texts"]


def template_vars(template: Column) -> Column:
    """Names used by a template, in order, as an array."""
    return F.regexp_extract_all(template, F.lit(VARIABLE), F.lit(1))


def variable_names(template: str) -> list[tuple[str, str | None]]:
    return [(m[1], m[2]) for m in re.finditer(VARIABLE, template)]


def value_key(name: str, aggregate: str | None = None) -> str:
    return f"{name}${aggregate}" if aggregate else name


def filled_or(value: Column, default: Column) -> Column:
    return F.coalesce(F.when(value != "", value), default)


def render(template: str, value_of: Callable[[str, str | None], Column]) -> Column:
    """The sentence for one fixed template; ``value_of`` gives a variable's text column."""
    parts: list[Column] = []
    end = 0
    for match in re.finditer(VARIABLE, template):
        parts.append(F.lit(template[end:match.start()]))
        parts.append(filled_or(value_of(match[1], match[2]), F.lit(match[3] or "")))
        end = match.end()
    parts.append(F.lit(template[end:]))
    return F.concat(*parts)


def with_parsed_template(policies: DataFrame, template: str = "verboseinfotemplate") -> DataFrame:
    """Policies with their template taken apart (``PARSED_FIELDS``); null where there is none."""
    text = F.col(template)
    names, kinds, defaults = (F.regexp_extract_all(text, F.lit(VARIABLE), F.lit(group)) for group in (1, 2, 3))
    keys = F.zip_with(names, kinds, lambda n, k: F.when(k != "", F.concat_ws("$", n, k)).otherwise(n))
    return policies.withColumns(dict(zip(PARSED_FIELDS, (names, keys, defaults, F.split(text, VARIABLE, -1)))))


def render_parsed(values: Column) -> Column:
    """The sentence of a row with a parsed template; ``values`` maps keys to text."""
    found = F.transform("template_keys", lambda key: F.try_element_at(values, key))
    filled = F.zip_with(found, F.col("template_defaults"), filled_or)
    return F.array_join(F.zip_with("template_texts", filled, lambda text, value: F.concat(text, F.coalesce(value, F.lit("")))), "")

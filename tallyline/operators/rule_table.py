"""Agent rules as data: rows of a table, and handlers for groups.

A row has a name, patterns, and a template from paths of the details record to text. ``{name}`` stands
for a named group there, ``{1}`` for the first group without a name (named ones are not counted), and
both may stand beside other text. Rows become rules of columns, in the order of ``position``; a row that
cannot become one is refused with its fault, and no other with it. A group that took no part in a
match, or took no text, is null, and so is the text it is part of.

A handler is for what a template cannot say: a function over the groups of many agents at once.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.text import regex
from tallyline.operators.agents import DETAILS_TYPE, PIP_JSON, Group, PandasRule, Rule, group_numbers, leaf_paths

RULE_ROW = (
    "position int, name string, patterns array<string>, template map<string,string>, "
    "starts array<string>, holds array<string>, ignore_case boolean"
)
_HOLE = re.compile(r"\{(\w+)\}")


@dataclass(frozen=True)
class Fault:
    """A row that was refused, and why."""

    position: int | None
    name: str | None
    fault: str


def rules_from_table(
    table: DataFrame, details_type: T.StructType = DETAILS_TYPE, max_rules: int = 1000
) -> tuple[list[Rule], list[Fault]]:
    """The rules of a table's rows, and the rows that were refused.

    A rule is part of the plan of every query that uses it, so a table has ``max_rules`` rows at most.
    """
    rows = table.select([F.col(field.name) for field in T.StructType.fromDDL(RULE_ROW)]).limit(max_rules + 1).collect()
    if len(rows) > max_rules:
        raise ValueError(f"the table has over {max_rules} rules")
    rules, faults, names = [], [], {PIP_JSON}
    for row in sorted(rows, key=lambda r: (r.position is None, r.position, r.name or "")):
        fault = _fault(table, row, names, set(leaf_paths(details_type)))
        if fault:
            faults.append(Fault(row.position, row.name, fault))
            continue
        names.add(row.name)
        template = {path: _filled(text) for path, text in (row.template or {}).items()}
        rules.append(
            Rule(row.name, tuple(row.patterns), template, tuple(row.starts or ()), tuple(row.holds or ()), bool(row.ignore_case))
        )
    return rules, faults


def _fault(table: DataFrame, row, names: set[str], paths: set[str]) -> str | None:
    if not row.name or row.name in names:
        return "the name is missing or taken"
    if row.position is None:
        return "it has no position"
    if not row.patterns or None in row.patterns:
        return "it has no pattern"
    if odd := sorted(set(row.template or {}) - paths):
        return f"details have no {odd}"
    if any(text is None for text in (row.template or {}).values()):
        return "a template is null"
    groups = None
    for pattern in row.patterns:
        try:
            mine = set(group_numbers(pattern, bool(row.ignore_case)))
            table.sparkSession.range(1).select(F.lit("").rlike(regex(pattern, bool(row.ignore_case)))).collect()
        except (re.error, ValueError, PySparkException) as error:
            return f"pattern {pattern!r}: {type(error).__name__}"
        groups = mine if groups is None else groups & mine
    for text in (row.template or {}).values():
        if odd := sorted(set(_HOLE.findall(text)) - groups):
            return f"not every pattern has the groups {odd}"
    return None


def _filled(text: str) -> str | Callable[[Group], Column]:
    """A template's text as a rule takes it: literal, or made from groups."""
    if not _HOLE.search(text):
        return text
    parts = _HOLE.split(text)  # text at even places, groups at odd ones

    def fill(group: Group) -> Column:
        made = [F.nullif(group(part), F.lit("")) if n % 2 else F.lit(part) for n, part in enumerate(parts) if n % 2 or part]
        return made[0] if len(made) == 1 else F.concat(*made)

    return fill


def handler_rule(name: str, patterns: list[str], handler: Callable[..., pd.Series], ignore_case: bool = False) -> PandasRule:
    """A rule whose groups a function turns into details, for many agents at once.

    The first pattern that is found in an agent speaks for it. The function gets a series for each group:
    those without a name in order, the others by name; a group that took no part is None. It returns a
    series of details, None for an agent that it does not take.
    """
    flags = re.IGNORECASE if ignore_case else 0
    compiled = [re.compile(pattern, flags) for pattern in patterns]

    def parse(agents: pd.Series) -> pd.Series:
        made = pd.Series([None] * len(agents), index=agents.index, dtype=object)
        still = agents
        for pattern in compiled:
            found = still.map(pattern.search)
            hit = found[found.notna()]
            still = still[found.isna()]
            if not len(hit):
                continue
            numbers = group_numbers(pattern.pattern, ignore_case)
            series = {g: hit.map(lambda m, n=n: m.group(n)).astype(object) for g, n in numbers.items()}
            named = {g: s for g, s in series.items() if not g.isdigit()}
            made[hit.index] = handler(*[s for g, s in series.items() if g.isdigit()], **named).reindex(hit.index)
        return made

    return PandasRule(name, parse)

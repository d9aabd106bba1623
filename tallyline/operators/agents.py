"""User agents: one rule table, compiled to columns.

A rule has one or more patterns and a template that fills the details record. A
text is handed to the first rule that accepts it, in the order of the table.
Literal text a pattern cannot do without is tested first, on bytes, so that most
patterns are never run.
"""

from __future__ import annotations

import functools
import json
import operator
import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.strict_json import is_strict_json, object_is_intact, parse_sealed_object
from tallyline.functions.text import WHITE_SPACE, regex
from tallyline.functions.versions import at_least_6, from_1_4_below_6
from tallyline.operators.pin import pin
from tallyline.schema import DOWNLOADS, to_struct
from tallyline.session import store

PARSED, IGNORED, UNKNOWN, MALFORMED = "parsed", "ignored", "unknown", "malformed"

Group = Callable[[str], Column]
Value = str | Callable[[Group], Column]


def group_numbers(pattern: str, ignore_case: bool = False) -> dict[str, int]:
    """A pattern's groups by name; those without one are called ``1``, ``2`` and so on."""
    compiled = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    named = dict(compiled.groupindex)
    others = [n for n in range(1, compiled.groups + 1) if n not in named.values()]
    return named | {str(place): n for place, n in enumerate(others, start=1)}


@dataclass(frozen=True)
class Rule:
    """Patterns (searched for, not matched in full) and what they yield.

    ``template`` maps paths of the details record to a literal, to ``{group}``
    for a named group (``{1}`` for the first without a name), or to a function of the groups. ``starts`` and ``holds``
    name literals of which an accepted text must start with, or hold, one.
    ``guard`` is one more condition on the groups.
    """

    name: str
    patterns: tuple[str, ...]
    template: dict[str, Value] = field(default_factory=dict)
    starts: tuple[str, ...] = ()
    holds: tuple[str, ...] = ()
    ignore_case: bool = False
    guard: Callable[[Group], Column] | None = None

    def _quick(self, ua: Column) -> Column | None:
        tests = [F.startswith(ua, F.lit(text)) for text in self.starts]
        tests += [F.contains(ua, F.lit(text)) for text in self.holds]
        return functools.reduce(operator.or_, tests) if tests else None

    def _groups(self, ua: Column, pattern: str) -> Group:
        order = group_numbers(pattern, self.ignore_case)
        return lambda name: F.regexp_extract(ua, regex(pattern, self.ignore_case), order[name])

    def _matches(self, ua: Column, pattern: str) -> Column:
        return ua.rlike(regex(pattern, self.ignore_case))

    def accepts(self, ua: Column) -> Column:
        """Whether the rule takes the text."""
        found = functools.reduce(operator.or_, [self._matches(ua, p) for p in self.patterns])
        quick = self._quick(ua)
        if quick is not None:
            found = quick & found
        if self.guard is not None:
            # The first pattern that matches speaks for the rule.
            found = found & self._first_match(ua, self.guard)
        return found

    def value(self, ua: Column, path: str) -> Column:
        """The template's value at a path, for a text the rule accepts."""
        made = self.template[path]
        if callable(made):
            return self._first_match(ua, made)
        if made.startswith("{"):
            return self._first_match(ua, lambda group: group(made[1:-1]))
        return F.lit(made)

    def _first_match(self, ua: Column, make: Callable[[Group], Column]) -> Column:
        *others, last = self.patterns
        value = make(self._groups(ua, last))
        for pattern in reversed(others):
            value = F.when(self._matches(ua, pattern), make(self._groups(ua, pattern))).otherwise(value)
        return value


@dataclass(frozen=True)
class PandasRule:
    """A rule in Python: gets a batch of agents, returns one details dict or None each.

    Best run on distinct agents, see :func:`classify_by_dimension`.
    """

    name: str
    parse: Callable[[pd.Series], pd.Series]


def _tool(name: str, label: str, *patterns: str, **options) -> Rule:
    return Rule(name, patterns, {"installer.name": label, "installer.version": "{version}"}, **options)


def _unless_unknown(group_name: str) -> Callable[[Group], Column]:
    return lambda group: F.when(F.lower(group(group_name)) != "unknown", group(group_name))


# The patterns of the agents known, and what each one means.
RULES = [
    Rule(
        "pip_1_4",
        (
            r"^pip/(?P<version>\S+) (?P<impl_name>\S+)/(?P<impl_version>\S+) "
            r"(?P<system_name>\S+)/(?P<system_release>\S+)$",
        ),
        {
            "installer.name": "pip",
            "installer.version": "{version}",
            "implementation.name": _unless_unknown("impl_name"),
            "implementation.version": _unless_unknown("impl_version"),
            "system.name": _unless_unknown("system_name"),
            "system.release": _unless_unknown("system_release"),
            "python": lambda group: F.when(F.lower(group("impl_name")) == "cpython", group("impl_version")),
        },
        starts=("pip/",),
        guard=lambda group: from_1_4_below_6(group("version")),
    ),
    Rule(
        "distribute",
        (r"^Python-urllib/(?P<python>\d\.\d) distribute/(?P<version>\S+)$",),
        {"installer.name": "distribute", "installer.version": "{version}", "python": "{python}"},
        starts=("Python-urllib/",),
    ),
    Rule(
        "setuptools",
        (
            r"^Python-urllib/(?P<python>\d\.\d) setuptools/(?P<version>\S+)$",
            r"^setuptools/(?P<version>\S+) Python-urllib/(?P<python>\d\.\d)$",
        ),
        {"installer.name": "setuptools", "installer.version": "{version}", "python": "{python}"},
        starts=("Python-urllib/", "setuptools/"),
    ),
    _tool("pex", "pex", r"pex/(?P<version>\S+)$", holds=("pex/",)),
    _tool("conda", "conda", r"^conda/(?P<version>\S+)(?: .+)?$", starts=("conda/",)),
    _tool("bazel", "Bazel", r"^Bazel/(?:release\s+)?(?P<version>.+)$", starts=("Bazel/",)),
    _tool("bandersnatch", "bandersnatch", r"^bandersnatch/(?P<version>\S+) \(.+\)$", starts=("bandersnatch/",)),
    _tool("devpi", "devpi", r"devpi-server/(?P<version>\S+) \(.+\)$", holds=("devpi-server/",)),
    _tool("z3c_pypimirror", "z3c.pypimirror", r"^z3c\.pypimirror/(?P<version>\S+)$", starts=("z3c.pypimirror/",)),
    _tool("artifactory", "Artifactory", r"^Artifactory/(?P<version>\S+)$", starts=("Artifactory/",)),
    _tool("nexus", "Nexus", r"^Nexus/(?P<version>\S+)", starts=("Nexus/",)),
    _tool("pep381client", "pep381client", r"^pep381client(?:-proxy)?/(?P<version>\S+)$", starts=("pep381client",)),
    Rule(
        "urllib2",
        (r"^Python-urllib/(?P<python>\d\.\d)$",),
        {"python": "{python}"},
        starts=("Python-urllib/",),
    ),
    _tool("requests", "requests", r"^python-requests/(?P<version>\S+)(?: .+)?$", starts=("python-requests/",)),
    Rule(
        "homebrew",
        (
            r"^Homebrew/(?P<version>\S+) \(Macintosh; Intel (?:Mac OS X|macOS) "
            r"(?P<osx_version>[^)]+)\)(?: .+)?$",
        ),
        {
            "installer.name": "Homebrew",
            "installer.version": "{version}",
            "distro.name": "OS X",
            "distro.version": "{osx_version}",
        },
        starts=("Homebrew/",),
    ),
    Rule(
        "os",
        (
            r"^(?:fetch libfetch/\S+$|libfetch/\S+$|OpenBSD ftp$|MacPorts/?|NetBSD-ftp/|slapt-get"
            r"|pypi-install/|slackrepo$|PTXdist|GARstow/|xbps/)",
        ),
        {"installer.name": "OS"},
    ),
    Rule(
        "browser",
        (
            r"^(?:Mozilla|Safari|wget|curl|Opera|aria2|AndroidDownloadManager"
            r"|com\.apple\.WebKit\.Networking/|FDM \S+|URL/Emacs|Firefox/|UCWEB|Links|okhttp"
            r"|Apache-HttpClient)(?:/|$)",
        ),
        {"installer.name": "Browser"},
        ignore_case=True,
    ),
]

# Fixed value: agents that are known noise.
IGNORED_AGENTS = (
    r"^(?:Datadog Agent/|\(null\)$|WordPress/|Chef (?:Client|Knife)/|Ruby$|Slackbot-LinkExpanding"
    r"|TextualInlineMedia/|WeeChat/|Download Master$|Java/|Go \d\.\d package http$|Go-http-client/"
    r"|GNU Guile$|github-olee$|YisouSpider$|Apache Ant/|Salt/|ansible-httpget$"
    r"|ltx71 - \(http://ltx71.com/\)|Scrapy/|spectool/|AWSBrewLinkChecker/|Y!J-ASR/"
    r"|NSIS_Inetc \(Mozilla\)$|Debian uscan"
    r"|Pingdom\.com_bot_version_\d+\.\d+_\(https?://www.pingdom.com/\)$"
    r"|MauiBot \(crawler\.feedback\+dc@gmail\.com\)$)"
)
IGNORED_ANYWHERE = "Nutch"

# The first rule of all: from version 6 on, pip describes itself in JSON.
PIP_JSON = "pip_6"



def details_type(fields: list[dict]) -> T.StructType:
    """The type of the details record in a table's schema."""
    return to_struct(next(f for f in fields if f["name"] == "details")["fields"])


DETAILS_TYPE: T.StructType = details_type(DOWNLOADS)
_JSON_BLANKS = " \t\r\n"


def rule_names(rules: list[Rule] = RULES) -> list[str]:
    """All rules in the order they are tried."""
    return [PIP_JSON, *[rule.name for rule in rules]]


def is_ignored(ua: Column) -> Column:
    """Agents to drop in silence, once no rule has accepted them."""
    return ua.rlike(regex(IGNORED_AGENTS)) | F.contains(ua, F.lit(IGNORED_ANYWHERE))


def json_type(struct: T.StructType = DETAILS_TYPE) -> T.StructType:
    """What pip's JSON is read as: the details and ``ci``, which is not stored, as the table has no such column."""
    return T.StructType([*struct.fields, T.StructField("ci", T.VariantType())])


def _pip_json(df: DataFrame, ua: str, on_unknown_key: str, struct: T.StructType = DETAILS_TYPE) -> DataFrame:
    """Add ``_json_text``, ``_json`` and ``_json_state`` for pip's JSON form."""
    agent = F.col(ua)
    # An extract keeps its compiled pattern, a split compiles it for every row.
    version = F.when(F.startswith(agent, F.lit("pip/")), F.regexp_extract(agent, regex(r"^pip/(\S*)"), 1))
    rest = F.substr(agent, F.length("_version") + len("pip/") + 1)
    text = F.when(at_least_6(F.col("_version")), F.rtrim(F.ltrim(rest, F.lit(WHITE_SPACE)), F.lit(_JSON_BLANKS)))
    state = F.when(object_is_intact(F.col("_json"), F.col("_json_text")), PARSED).when(
        is_strict_json(F.col("_json_text")), MALFORMED
    )
    if on_unknown_key == "reject":
        state = F.when((state == PARSED) & _has_unknown_key(F.col("_json_text"), struct), MALFORMED).otherwise(state)
    elif on_unknown_key != "ignore":
        raise ValueError("on_unknown_key is 'ignore' or 'reject'")
    return (
        pin(df.withColumn("_version", version), "_json_text", text)
        .withColumn("_json", parse_sealed_object(F.col("_json_text"), json_type(struct)))
        .withColumn("_json_state", F.when(F.col("_json_text").isNotNull(), state))
        .drop("_version")
    )


def _has_unknown_key(text: Column, details: T.StructType) -> Column:
    """Whether any record of the JSON has a key its type does not have."""
    found = []

    def visit(struct: T.StructType, path: str, *more: str) -> None:
        part = text if path == "$" else F.get_json_object(text, path)
        known = F.array(*[F.lit(name) for name in [*struct.fieldNames(), *more]])
        keys = F.json_object_keys(part)
        found.append(F.coalesce(F.size(F.array_except(keys, known)) > 0, F.lit(False)))
        for column in struct.fields:
            if isinstance(column.dataType, T.StructType):
                visit(column.dataType, f"{path}.{column.name}")

    visit(details, "$", "ci")
    return functools.reduce(operator.or_, found)


def truth(value: Column) -> Column:
    """Truth of any JSON value: empty, zero, false are not true; null stays null."""
    kind = F.schema_of_variant(value)
    text = F.to_json(value)
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit(None).cast("boolean"))
        .when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", text != '""')
        .when(text.rlike(r"^[\[{]"), ~text.isin("[]", "{}"))
        .otherwise(text.try_cast("double") != 0)
    )


def classify(
    df: DataFrame,
    ua: str = "ua",
    rules: list[Rule | PandasRule] = RULES,
    on_unknown_key: str = "ignore",
    details_type: T.StructType = DETAILS_TYPE,
) -> DataFrame:
    """Add ``ua_status``, ``ua_rule``, ``details`` and ``ci`` for the agent column.

    Column work in place, no shuffle. Rules in Python, if any, are tried last, on
    the agents the others left open; what they raise is in ``ua_error`` then, and the
    next rule is tried. Rows without an agent keep nulls.
    """
    for rule in rules:
        if isinstance(rule, Rule) and (odd := set(rule.template) - set(leaf_paths(details_type))):
            raise ValueError(f"rule {rule.name!r}: details have no {sorted(odd)}")
    in_python = [rule for rule in rules if isinstance(rule, PandasRule)]
    rules = [rule for rule in rules if isinstance(rule, Rule)]
    agent = F.col(ua)
    chain = F.when(F.col("_json_state").isNotNull(), 0)
    for number, rule in enumerate(rules, start=1):
        chain = chain.when(rule.accepts(agent), number)
    chain = chain.when(agent.isNotNull() & is_ignored(agent), -1)
    names = F.array(*map(F.lit, rule_names(rules)))
    number = F.col("_rule")
    parsed = number > 0
    status = (
        F.when(agent.isNull(), F.lit(None).cast("string"))
        .when(number == 0, F.col("_json_state"))
        .when(number == -1, IGNORED)
        .when(parsed, PARSED)
        .otherwise(UNKNOWN)
    )
    details = F.when((number == 0) & (F.col("_json_state") == PARSED), _from_json(details_type, F.col("_json"))).when(
        parsed, _from_rules(details_type, agent, number, rules)
    )
    done = (
        pin(_pip_json(df, ua, on_unknown_key, details_type), "_rule", chain)
        .withColumns(
            {
                "ua_status": status,
                "ua_rule": F.when(number >= 0, F.get(names, number)),
                "details": details,
                "ci": F.when(F.col("_json_state") == PARSED, truth(F.col("_json")["ci"])),
            }
        )
        .drop("_json_text", "_json", "_json_state", "_rule")
    )
    if in_python:
        done = done.withColumn("ua_error", F.lit(None).cast("string"))
    for rule in in_python:
        done = _apply_in_python(done, ua, rule, details_type)
    return done


def leaf_paths(struct: T.StructType, prefix: str = "") -> list[str]:
    """The paths of a record's fields that are not records themselves."""
    found = []
    for column in struct.fields:
        nested = isinstance(column.dataType, T.StructType)
        found += leaf_paths(column.dataType, f"{prefix}{column.name}.") if nested else [prefix + column.name]
    return found


def _from_json(struct: T.StructType, parsed: Column) -> Column:
    return F.struct(*[parsed[name].alias(name) for name in struct.fieldNames()])


def _from_rules(struct: T.StructType, ua: Column, number: Column, rules: list[Rule], prefix: str = "") -> Column:
    """The details record filled from whichever rule has accepted.

    A nested record is null unless one of its fields has a value.
    """

    def leaf(path: str, kind: T.DataType) -> Column:
        filled = F.lit(None).cast(kind)
        by_literal: dict[str, list[int]] = {}
        branches = []
        for position, rule in enumerate(rules, start=1):
            made = rule.template.get(path)
            if isinstance(made, str) and not made.startswith("{"):
                by_literal.setdefault(made, []).append(position)
            elif made is not None:
                branches.append((number == position, rule.value(ua, path)))
        if len(by_literal) > 1:
            texts = [None] * len(rules)
            for text, positions in by_literal.items():
                for position in positions:
                    texts[position - 1] = text
            filled = F.get(F.array(*[F.lit(text).cast("string") for text in texts]), number - 1)
        else:
            branches += [(number.isin(positions), F.lit(text)) for text, positions in by_literal.items()]
        if branches:
            chain = F.when(*branches[0])
            for branch in branches[1:]:
                chain = chain.when(*branch)
            filled = chain if len(by_literal) <= 1 else chain.otherwise(filled)
        return filled

    def node(column: T.StructField, path: str) -> Column:
        if isinstance(column.dataType, T.StructType):
            return _from_rules(column.dataType, ua, number, rules, path + ".")
        return leaf(path, column.dataType)

    columns = {column.name: node(column, prefix + column.name) for column in struct.fields}
    record = F.struct(*[value.alias(name) for name, value in columns.items()])
    if not prefix:
        return record
    touched = [p for rule in rules for p in rule.template if p.startswith(prefix)]
    if not touched:
        return F.lit(None).cast(struct)
    return F.when(functools.reduce(operator.or_, [value.isNotNull() for value in columns.values()]), record)


def leave_open(df: DataFrame, details_type: T.StructType = DETAILS_TYPE) -> DataFrame:
    """Stands in for :func:`classify` where agents are only to be collected."""
    return df.withColumns({"ua_status": F.lit(None).cast("string"), "details": F.lit(None).cast(details_type)})


def distinct_agents(df: DataFrame, ua: str = "ua") -> DataFrame:
    """One row per agent with its number of rows, ``lines``."""
    return df.where(F.col(ua).isNotNull()).groupBy(F.col(ua).alias("ua")).agg(F.count("*").alias("lines"))


def _fits(details: object, struct: T.StructType) -> bool:
    """Whether a dict has the record's fields only, with text and dicts where they belong."""
    if not isinstance(details, dict) or set(details) - set(struct.names):
        return False
    for name, value in details.items():
        kind = struct[name].dataType
        if value is not None and not (_fits(value, kind) if isinstance(kind, T.StructType) else isinstance(value, str)):
            return False
    return True


def _try(parse: Callable[[pd.Series], pd.Series], agents: pd.Series) -> tuple[pd.Series, dict]:
    """What a rule makes of the agents, and what it raised, by index.

    If it raises for a batch, it is asked once more for each agent alone.
    """
    try:
        return parse(agents), {}
    except Exception:  # noqa: BLE001  a rule may raise anything
        made, errors = {}, {}
        for index in agents.index:
            try:
                made[index] = parse(agents.loc[[index]]).iloc[0]
            except Exception as error:  # noqa: BLE001
                errors[index] = f"{type(error).__name__}: {error}"
        return pd.Series(made, dtype=object), errors


def _apply_in_python(df: DataFrame, ua: str, rule: PandasRule, details_type: T.StructType) -> DataFrame:
    """Try a Python rule on the agents that are still open, ignored ones included."""
    parse, name = rule.parse, rule.name
    result = "accepted boolean, details string, error string"

    @F.pandas_udf(result)
    def run(agents: pd.Series) -> pd.DataFrame:
        made, errors = _try(parse, agents.dropna())
        made = made.reindex(agents.index)
        accepted = made.map(lambda details: isinstance(details, dict)).astype(bool)
        texts = made.map(lambda details: json.dumps(details) if _fits(details, details_type) else None)
        error = pd.Series({i: f"{name}: {text}" for i, text in errors.items()}, dtype=object).reindex(agents.index)
        return pd.DataFrame({"accepted": accepted, "details": texts.astype(object), "error": error})

    made = F.col("_made")
    hit = made["accepted"]
    fits = made["details"].isNotNull()
    return (
        df.withColumn("_made", run(F.when(F.col("ua_rule").isNull(), F.col(ua))))
        .withColumns(
            {
                "ua_status": F.when(hit & fits, PARSED).when(hit, MALFORMED).otherwise(F.col("ua_status")),
                "ua_rule": F.when(hit, rule.name).otherwise(F.col("ua_rule")),
                "details": F.when(hit, F.from_json(made["details"], details_type)).otherwise(F.col("details")),
                "ua_error": F.coalesce("ua_error", made["error"]),
            }
        )
        .drop("_made")
    )


def classify_by_dimension(
    df: DataFrame,
    ua: str = "ua",
    rules: list[Rule | PandasRule] = RULES,
    on_unknown_key: str = "ignore",
    details_type: T.StructType = DETAILS_TYPE,
    max_broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Like :func:`classify`, with each distinct agent classified once.

    For rules in Python: they never see an agent twice. The agents are grouped (combined before
    the shuffle, so a frequent agent costs one row per task), classified and stored. Up to a
    measured size they are broadcast back to the rows, beyond it joined by shuffle, where AQE
    splits a frequent agent. ``df`` is evaluated twice: store it if that is dear.
    """
    agents = distinct_agents(df, ua).drop("lines")
    dimension = store(classify(agents, "ua", rules, on_unknown_key, details_type), "agents")
    row_bytes = F.octet_length("ua") + F.coalesce(F.octet_length(F.to_json("details")), F.lit(0)) + 128
    size = dimension.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()["bytes"]
    dimension = dimension.withColumnRenamed("ua", "_agent")
    if size <= max_broadcast_bytes:
        dimension = F.broadcast(dimension)
    return df.join(dimension, F.col(ua) == F.col("_agent"), "left").drop("_agent")


def unknown_agents(agents: DataFrame, **options) -> DataFrame:
    """Every agent that no rule accepts and none ignores, with its number of rows."""
    return classify(agents, **options).where(F.col("ua_status") == UNKNOWN).select("ua", "lines")


def rule_hits(agents: DataFrame, **options) -> DataFrame:
    """Rows per rule that accepts, from distinct agents."""
    done = classify(agents, **options).where(F.col("ua_rule").isNotNull())
    return done.groupBy("ua_rule").agg(F.sum("lines").alias("lines"))


def rule_errors(agents: DataFrame, **options) -> DataFrame:
    """Agents for which a rule in Python raised, with the first error."""
    return classify(agents, **options).where(F.col("ua_error").isNotNull()).select("ua", "lines", "ua_error")


def ambiguous_agents(agents: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Agents that two or more rules accept; for these the order of rules decides."""
    agent = F.col("ua")
    tests = [F.when(F.col("_json_state").isNotNull(), PIP_JSON)]
    tests += [F.when(rule.accepts(agent), rule.name) for rule in rules]
    return (
        _pip_json(agents, "ua", "ignore")
        .withColumn("accepted_by", F.array_compact(F.array(*tests)))
        .where(F.size("accepted_by") > 1)
        .drop("_json_text", "_json", "_json_state")
    )

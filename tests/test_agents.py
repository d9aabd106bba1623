"""Agent rules: known agents, order, extension, and both ways of classifying."""

import json
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyline.operators import agents
from tallyline.operators.agents import RULES, PandasRule, Rule
from tallyline.sources.synth import AGENTS


def _classify(spark, texts, **options):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, ua string")
    rows = agents.classify(df, **options).collect()
    return sorted(rows, key=lambda row: row.n)


def _plain(details):
    """The filled fields of a details row."""
    if details is None:
        return None
    made = {k: _plain(v) if hasattr(v, "asDict") else v for k, v in details.asDict().items()}
    return {k: v for k, v in made.items() if v is not None}


def _by_hand(ua):
    """Which columnar rules accept a text, by Python's own regular expressions."""
    found = []
    for rule in RULES:
        match = next(filter(None, (re.search(p, ua, re.IGNORECASE if rule.ignore_case else 0) for p in rule.patterns)), None)
        if match and (rule.name != "pip_1_4" or re.match(r"(1\.([4-9]|\d\d)|[2-5])(\.\d+)*$", match["version"])):
            found.append((rule.name, match.groupdict().get("version")))
    return found


def test_rules_against_python(spark):
    rng = random.Random(5)
    pieces = [
        "pip/1.5.4", "pip/5", "pip/7", "CPython/2.7", "unknown/x", "Python-urllib/2.7", "distribute/1", "setuptools/3",
        "pex/1.0", "conda/4", "Bazel/release 2", "Bazel/", "bandersnatch/1", "(x)", "devpi-server/2", "z3c.pypimirror/1",
        "Artifactory/6", "Nexus/3", "pep381client-proxy/1", "python-requests/2", "Homebrew/1 (Macintosh; Intel macOS 10)",
        "libfetch/2", "fetch", "slackrepo", "xbps/", "Mozilla/5.0", "curl", "wget/", "Opera", "FDM 3", "Links", "Go-http-client/1",
    ]
    texts = sorted({" ".join(rng.choices(pieces, k=rng.randint(1, 3))) for _ in range(600)})
    for row, ua in zip(_classify(spark, texts), texts, strict=True):
        accepted = _by_hand(ua)
        if accepted:
            name, version = accepted[0]
            assert (row.ua_rule, row.ua_status) == (name, "parsed"), ua
            if version is not None:
                assert row.details.installer.version == version
        else:
            assert row.ua_rule is None, ua
    report = agents.ambiguous_agents(spark.createDataFrame([(t,) for t in texts], "ua string")).collect()
    assert {r.ua: list(r.accepted_by) for r in report} == {
        ua: [name for name, _ in _by_hand(ua)] for ua in texts if len(_by_hand(ua)) > 1
    }


def test_pip_json(spark):
    details = {
        "installer": {"name": "pip", "version": "19"},
        "python": "3.7",
        "distro": {"libc": {"lib": "glibc", "version": "2.27"}},
        "cpu": None,
    }
    cases = {
        "pip/19.0 " + json.dumps(details): "parsed",
        "pip/19.0   " + json.dumps(details) + " ": "parsed",
        "pip/19.0 " + json.dumps(details): "parsed",
        "pip/19.0 {}": "parsed",
        "pip/19.0": "unknown",
        "pip/19.0 ": "unknown",
        "pip/19.0 " + json.dumps(details) + "x": "unknown",
        "pip/5.0 " + json.dumps(details): "unknown",
        "pip/6.0rc1 " + json.dumps(details): "unknown",
        "pip/x " + json.dumps(details): "unknown",
        "xpip/19.0 " + json.dumps(details): "unknown",
        "pip/19.0 12": "malformed",
        "pip/19.0 null": "malformed",
        'pip/19.0 "x"': "malformed",
        'pip/19.0 {"distro":{"libc":"x"}}': "malformed",
        'pip/19.0 {"installer":[]}': "malformed",
        "pip/19.0 {'a':1} pex/1.0": "parsed",
    }
    rows = _classify(spark, list(cases))
    assert [row.ua_status for row in rows] == list(cases.values())
    want = {k: v for k, v in details.items() if v is not None}
    assert [_plain(row.details) for row in rows[:4]] == [want, want, want, {}]
    assert rows[-1].ua_rule == "pex"


def test_scalars_become_text(spark):
    row = _classify(spark, ['pip/19 {"python":3.7,"cpu":64,"installer":{},"ci":0,"distro":null}'])[0]
    assert (row.details.python, row.details.cpu, row.ci, row.details.distro) == ("3.7", "64", False, None)
    assert row.details.installer is not None


def test_unknown_keys(spark):
    texts = ['pip/19 {"x":1}', 'pip/19 {"installer":{"x":1}}', 'pip/19 {"ci":true,"distro":{"libc":{"lib":"g"}}}']
    assert [r.ua_status for r in _classify(spark, texts)] == ["parsed"] * 3
    assert [r.ua_status for r in _classify(spark, texts, on_unknown_key="reject")] == ["malformed", "malformed", "parsed"]
    with pytest.raises(ValueError):
        _classify(spark, texts, on_unknown_key="warn")


def test_ignored_agents(spark):
    noise = [
        "Datadog Agent/5", "(null)", "WordPress/4", "Chef Client/1", "Chef Knife/1", "Ruby", "Slackbot-LinkExpanding 1.0",
        "Java/1.8", "Go 1.1 package http", "Go-http-client/2.0", "GNU Guile", "Apache Ant/1", "Salt/2", "ansible-httpget",
        "ltx71 - (http://ltx71.com/)", "Scrapy/1", "x Nutch y", "Y!J-ASR/0.1", "NSIS_Inetc (Mozilla)", "Debian uscan 2",
        "Pingdom.com_bot_version_1.4_(http://www.pingdom.com/)", "MauiBot (crawler.feedback+dc@gmail.com)",
    ]
    near = ["Rubyx", "x Java/1.8", "(null) ", "Chef Cook/1", "nutch", "", "GNU Guile 2", "Go 1.10 package http"]
    assert [r.ua_status for r in _classify(spark, noise + near)] == ["ignored"] * len(noise) + ["unknown"] * len(near)


def test_custom_rules(spark):
    def read_tool(batch: pd.Series) -> pd.Series:
        made = batch.str.extract(r"^tool (?P<v>\d+)$", expand=False)
        return made.map(lambda v: {"installer": {"name": "tool", "version": v}} if isinstance(v, str) else None)

    rules = [
        Rule("two", (r"^a/(?P<v>\d+)$", r"^b/(?P<w>\d+)/(?P<v>\d+)$"), {"installer.name": "two", "cpu": "{v}"}),
        PandasRule("tool", read_tool),
    ]
    texts = ["a/1", "b/2/3", "b/2", "tool 7", "tool x", "Java/1", "conda/4", None]
    rows = _classify(spark, texts, rules=rules)
    assert [r.ua_rule for r in rows] == ["two", "two", None, "tool", None, None, None, None]
    assert [r.ua_status for r in rows] == ["parsed", "parsed", "unknown", "parsed", "unknown", "ignored", "unknown", None]
    assert [_plain(rows[n].details) for n in (0, 1, 3)] == [
        {"installer": {"name": "two"}, "cpu": "1"},
        {"installer": {"name": "two"}, "cpu": "3"},
        {"installer": {"name": "tool", "version": "7"}},
    ]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_dimension_is_the_same(spark, limit):
    texts = [*AGENTS, None, *AGENTS[:5]]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, ua string")
    done = agents.classify_by_dimension(df, max_broadcast_bytes=limit)
    columns = ["n", "ua_status", "ua_rule", F.to_json("details").alias("d"), "ci"]
    assert sorted(done.select(columns).collect()) == sorted(agents.classify(df).select(columns).collect())
    plan = done._jdf.queryExecution().toString()
    assert ("BroadcastHashJoin" in plan) or limit == 0


def test_rules_that_raise(spark):
    def fussy(batch: pd.Series) -> pd.Series:
        if (batch == "bad 1").any():
            raise KeyError("bad 1")
        return batch.map(lambda text: {"installer": {"name": "fussy"}} if text == "good 1" else None)

    def odd(batch: pd.Series) -> pd.Series:
        return batch.map(lambda text: {"installer": "x"} if text == "odd 1" else {"cpu": "c"} if text == "bad 1" else None)

    texts = ["good 1", "bad 1", "odd 1", "other", None, "conda/4"]
    rows = _classify(spark, texts, rules=[PandasRule("fussy", fussy), PandasRule("odd", odd)])
    assert [r.ua_rule for r in rows] == ["fussy", "odd", "odd", None, None, None]
    assert [r.ua_status for r in rows] == ["parsed", "parsed", "malformed", "unknown", None, "unknown"]
    assert [r.ua_error for r in rows] == [None, "fussy: KeyError: 'bad 1'", None, None, None, None]


def test_templates_must_name_fields(spark):
    with pytest.raises(ValueError):
        _classify(spark, ["a/1"], rules=[Rule("a", (r"^a/(?P<v>\d)$",), {"installer.nam": "a"})])


def test_every_unknown_agent_is_reported(spark):
    df = spark.createDataFrame([(f"nobody {n}",) for n in range(40)] * 2, "ua string")
    found = agents.unknown_agents(agents.distinct_agents(df)).collect()
    assert len(found) == 40 and {r.lines for r in found} == {2}

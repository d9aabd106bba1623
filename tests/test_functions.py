"""Column functions against their Python counterparts."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyline.functions.strict_json import is_strict_json, object_is_intact, parse_sealed_object
from tallyline.functions.text import expand_tabs, regex, utf8_repair
from tallyline.functions.versions import at_least_6, from_1_4_below_6
from tallyline.operators.agents import IGNORED_AGENTS, RULES, json_type, truth


def _column(spark, values, kind):
    return spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")


def _apply(spark, values, kind, make):
    rows = _column(spark, values, kind).select("n", make(F.col("v")).alias("r")).collect()
    return [row.r for row in sorted(rows, key=lambda row: row.n)]


def test_utf8_repair_is_pythons_replace(spark):
    rng = random.Random(1)
    alphabet = [0x20, 0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0]
    values = [bytes(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(500)]
    assert _apply(spark, values, "binary", utf8_repair) == [v.decode("utf8", errors="replace") for v in values]


def test_expand_tabs_is_pythons(spark):
    rng = random.Random(2)
    values = ["".join(rng.choices("ab\té\r", k=rng.randint(0, 40))) for _ in range(500)]
    assert _apply(spark, values, "string", expand_tabs) == [v.expandtabs() for v in values]


def test_regex_dialect(spark):
    patterns = [(p, rule.ignore_case) for rule in RULES for p in rule.patterns] + [(IGNORED_AGENTS, False)]
    heads = [
        "pip/1.5 a/b c/d", "Python-urllib/3.6", "setuptools/1 Python-urllib/3.6", "x pex/1", "conda/4 x", "Bazel/release 1",
        "bandersnatch/2 (a)", "devpi-server/4 (b)", "Nexus/3", "Homebrew/1 (Macintosh; Intel macOS 10) c", "libfetch/2",
        "slackrepo", "MOZILLA/5", "curl", "FDM 3/", "Firefox/60", "Firefox//", "Links", "UCWEB7", "Java/1", "(null)",
        "Go 1.1 package http", "Ruby", "fetch libfetch/x", "ſafari/1", "Python-urllib/٣.٦", "conda/4\x1c5", "okhttp",
    ]
    tails = ["", " ", "\r", "\n", "\x85", "\xa0", "\x1c", " ", " x", "/"]
    values = [head + tail for head in heads for tail in tails]
    df = _column(spark, values, "string")
    found = df.select(
        "n",
        *[F.col("v").rlike(regex(p, i)).alias(f"p{k}") for k, (p, i) in enumerate(patterns)],
        *[
            F.regexp_extract("v", regex(p, i), 1).alias(f"g{k}")
            for k, (p, i) in enumerate(patterns)
            if re.compile(p).groups
        ],
    ).collect()
    for row in found:
        for k, (pattern, ignore_case) in enumerate(patterns):
            match = re.search(pattern, values[row.n], re.IGNORECASE if ignore_case else 0)
            assert row[f"p{k}"] == (match is not None), (pattern, values[row.n])
            if match is not None and match.re.groups:
                assert row[f"g{k}"] == match[1], (pattern, values[row.n])


def test_version_ranges(spark):
    new = ["6", "6.0", "v6", " 6.1", "7rc1", "10.0.dev1", "6.0.post1.dev2", "6.0+x", "1!0.1", "18.0", "06", "6.0-1", "99999999999.1"]
    old = ["1.4", "1.4.1", "1.5rc1", "1.10", "2", "5.9.dev1", "1.4.post1.dev1", "0!2.0", "1.04", "1.4+a.b"]
    none = [
        "", "x", "6.0rc1", "6.dev1", "6.0.0a1", "1.4rc1", "1.4.0.dev0", "1.3", "0.9", "1", "6x", "6..1", "6.0rc1.post1",
        "1.4-alpha-1", "6 .0", "-6",
    ]
    both = _apply(spark, new + old + none, "string", lambda v: F.struct(at_least_6(v), from_1_4_below_6(v)))
    expected = [(True, False)] * len(new) + [(False, True)] * len(old) + [(False, False)] * len(none)
    assert [tuple(pair) for pair in both] == expected


def test_version_ranges_against_packaging(spark):
    version = pytest.importorskip("packaging.version")
    rng = random.Random(3)
    parts = ["", "a1", ".dev0", "rc2", ".post3", "-4", "b", "+l.1", ".post1.dev2", "c3.dev1", "junk"]
    values = [f"{rng.choice(['', '', 'v', '1!'])}{rng.randint(0, 8)}.{rng.randint(0, 6)}{rng.choice(parts)}" for _ in range(300)]

    def within(text, low, high):
        try:
            v = version.Version(text)
        except version.InvalidVersion:
            return False
        below = high is None or (v < version.Version(high) and version.Version(v.base_version) != version.Version(high))
        return v >= version.Version(low) and below

    both = _apply(spark, values, "string", lambda v: F.struct(at_least_6(v), from_1_4_below_6(v)))
    assert [tuple(pair) for pair in both] == [(within(v, "6", None), within(v, "1.4", "6")) for v in values]


JSON_TEXTS = [
    "{}", "{ }", '{"a":1}', '{"a":1} x', '{"a":1}}', '{"a":1},"b":2', '{"a":1},{"a":2}', "{'a':1}", '{"a":1,}', '{"a":}',
    "[]", "[1]", "[1] 2", "12", '"x"', '"x" "y"', "null", "true", "nul", "1}", "1]", "1,2", '1,"y":2', "", " ",
    '{"a":"\t"}', '{"a":"}"}', '{"a":{"b":[1,{"c":null}]}}', '{"a":1', '{"_seal":"1"}', '{"_bad":"1"}', '{"a":1}] {"b":2}',
    '{"a":1,"a":2}', '{a:1}', '{"a":01}', "{,}",
]


def _is_json(text):
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def test_strict_json(spark):
    assert _apply(spark, JSON_TEXTS, "string", is_strict_json) == [_is_json(t) for t in JSON_TEXTS]


def test_sealed_object(spark):
    got = _apply(spark, JSON_TEXTS, "string", lambda v: object_is_intact(parse_sealed_object(v, json_type()), v))
    assert got == [_is_json(t) and isinstance(json.loads(t), dict) for t in JSON_TEXTS]


def test_truth(spark):
    texts = ["true", "false", "null", "0", "0.0", "1", "-2.5", '""', '"false"', "[]", "[0]", "{}", '{"a":0}']
    got = _apply(spark, texts, "string", lambda v: truth(F.parse_json(v)))
    assert got == [None if json.loads(t) is None else bool(json.loads(t)) for t in texts]

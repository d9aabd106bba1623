"""Rules as data, handlers, the kept table of agents, and the table by name."""

import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyline.operators import agents, rule_table
from tallyline.operators.agent_table import AgentTable, version_of
from tallyline.operators.agents import RULES, Rule, group_numbers
from tallyline.plans import evolve, named, table
from tallyline.plans.downloads import assemble, kept, parse_lines
from tallyline.schema import DOWNLOADS, NULLABLE
from tallyline.session import work_folder
from tallyline.sources.synth import TOKEN, lines_of

SF_DIR = "/root/testdata/sf0.001"


def _table(spark, rows):
    return spark.createDataFrame(rows, rule_table.RULE_ROW)


def _row(position, name, patterns, template, ignore_case=None):
    return (position, name, patterns, template, None, None, ignore_case)


def _read(spark, rules, texts):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, ua string")
    return sorted(agents.classify(df, rules=rules).collect(), key=lambda r: r.n)


def test_groups_with_and_without_names():
    assert group_numbers(r"(\w+) (?P<thing>\w+) (\w+) (?P<another>\w+)") == {"thing": 2, "another": 4, "1": 1, "2": 3}
    assert group_numbers("a(?:b)c") == {}


def test_rows_become_rules_in_order(spark):
    rows = [
        _row(2, "late", [r"^Foo/(\S+)"], {"installer.name": "late", "installer.version": "{1}"}),
        _row(1, "early", [r"^foo/(\d+)(?:-(?P<part>\w*))?", r"^bar (?P<part>x)?(y)"], {"installer.name": "{1}!{part}", "python": "{part}"}, True),
    ]
    rules, faults = rule_table.rules_from_table(_table(spark, rows))
    assert [r.name for r in rules] == ["early", "late"] and not faults
    got = _read(spark, rules, ["FOO/12-b", "foo/12", "Foo/x", "foo/x", "bar xy", "Bar y"])
    assert [r.ua_rule for r in got] == ["early", "early", "late", None, "early", "early"]
    assert [r.details and (r.details.installer and r.details.installer.name, r.details.python) for r in got] == [
        ("12!b", "b"), (None, None), ("late", None), None, ("y!x", "x"), (None, None),
    ]


def test_bad_rows_are_refused(spark):
    rows = [
        _row(1, "good", ["^a"], {}), _row(2, "good", ["^b"], {}), _row(3, None, ["^b"], {}), _row(None, "unplaced", ["^b"], {}),
        _row(4, "empty", [], {}), _row(5, "hole", [None], {}), _row(6, "broken", ["("], {}), _row(7, agents.PIP_JSON, ["a"], {}),
        _row(8, "path", ["^a"], {"installer": "x"}), _row(9, "group", ["^(a)", "^b"], {"python": "{1}"}),
        _row(10, "name", ["^(?P<v>a)"], {"python": "{w}"}), _row(11, "null", ["^a"], {"python": None}), _row(12, "java", ["a(?(1)b)"], {}),
    ]
    rules, faults = rule_table.rules_from_table(_table(spark, rows))
    assert [r.name for r in rules] == ["good"] and len(faults) == 12
    assert {f.position: f.fault for f in faults}[9] == "not every pattern has the groups ['1']"
    with pytest.raises(ValueError, match="over 5 rules"):
        rule_table.rules_from_table(_table(spark, rows), max_rules=5)
    assert rule_table.rules_from_table(_table(spark, [])) == ([], [])


def test_handlers_get_groups_of_many_agents(spark):
    seen = []

    def handler(one, two, thing, another):
        seen.append(len(one))
        return pd.Series([None if t == "no" else {"python": f"{a},{b},{t},{n}"} for a, b, t, n in zip(one, two, thing, another)], one.index)

    rule = rule_table.handler_rule("four", [r"^(\w+) (?P<thing>\w+) (\w+) (?P<another>\w+)?$"], handler)
    got = rule.parse(pd.Series(["Foo Bar Widget Frob", "x", "a no c d", "Foo Bar Widget "], index=[3, 5, 7, 9]))
    assert got.to_dict() == {3: {"python": "Foo,Widget,Bar,Frob"}, 5: None, 7: None, 9: {"python": "Foo,Widget,Bar,None"}}
    assert seen == [3]
    rows = _read(spark, [rule], ["Foo Bar Widget Frob", "zzz", None])
    assert [r.ua_rule for r in rows] == ["four", None, None] and rows[0].details.python == "Foo,Widget,Bar,Frob"

    def failing(word):
        if (word == "bad").any():
            raise ValueError("no")
        return word.map(lambda w: {"python": w})

    rows = _read(spark, [rule_table.handler_rule("f", [r"^(\w+)$"], failing)], ["bad", "good"])
    assert [(r.ua_rule, r.ua_error) for r in rows] == [(None, "f: ValueError: no"), ("f", None)]


def test_no_agent_is_classified_twice(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(texts):
        calls.add(len(texts))
        return texts.map(lambda t: {"python": t} if t.startswith("mine") else None)

    rules = [*RULES, agents.PandasRule("mine", count)]
    known = AgentTable(spark, work_folder(spark, "agents"), rules, version="1")
    texts = [f"mine {i}" for i in range(20)] + ["conda/4", None, "", "nobody"]
    first = spark.createDataFrame([(i, texts[i % 24]) for i in range(200)], "n int, ua string")
    second = spark.createDataFrame([(i, (texts + ["mine new"])[i % 25]) for i in range(200)], "n int, ua string")
    rows = known.classify(first, 0).collect()
    assert len(rows) == 200 and calls.value == 22  # all but the one that a rule of columns takes, and no null
    assert {r.ua: r.ua_rule for r in rows} == {t: "mine" if t and t.startswith("mine") else "conda" if t == "conda/4" else None for t in texts}
    again = known.classify(second, 1).collect()
    assert calls.value == 23 and len(again) == 200
    assert known.known().groupBy("ua").count().where("count > 1").count() == 0
    known.learn(agents.distinct_agents(second), 1)  # the batch runs again
    assert known.known().where("batch_id = 1").count() == 1
    shuffled = AgentTable(spark, known.path.rpartition("/rules=")[0], rules, version="1", max_broadcast_bytes=0)
    assert sorted(map(str, shuffled.classify(second, 1).collect())) == sorted(map(str, again))
    assert AgentTable(spark, "x", rules, version="2").path != known.path


def test_version_follows_what_rules_do():
    rule = lambda value, text="a": Rule("r", (text,), {"python": lambda group: group(value)})
    assert version_of([rule("x")]) == version_of([rule("x")]) != version_of([rule("y")])
    assert version_of([rule("x", "b")]) != version_of([rule("x")]) != version_of([rule("x"), rule("x")])
    assert version_of(RULES) != version_of(RULES[::-1]) and version_of(RULES) != version_of(RULES, "reject")


def test_rows_are_parsed_once(spark):
    """The plan that gives the rows reads stored ones, and no line is parsed in it."""
    known = AgentTable(spark, work_folder(spark, "agents"))
    parsed = parse_lines(lines_of(spark, SF_DIR), TOKEN, classify=agents.leave_open)
    done = known.classify(parsed, 0)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" not in plan and "from_json" not in plan and plan.count("Scan parquet") == 2
    assert done.count() == parsed.count()


def test_table_by_name(spark):
    root, name = work_folder(spark, "table"), f"t_{uuid.uuid4().hex[:8]}"
    named.register(spark, name, root, DOWNLOADS[:-1])
    assert named.registered_fields(spark, name) == DOWNLOADS[:-1] == table.current_fields(spark, root)
    assert spark.sql(f"SELECT * FROM {name}").count() == 0
    rows = assemble(kept(parse_lines(lines_of(spark, SF_DIR), TOKEN)))
    table.write_downloads(rows, root, "job", 0)
    named.register(spark, name, root)
    day = spark.sql(f"SELECT details.installer.name FROM {name} WHERE event_date = '20240115'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "ReadSchema: struct<details:struct<installer:struct<name:string>>>" in plan
    assert day.count() == table.read_downloads(spark, root).where("event_date = '20240115'").count() > 0
    named.register(spark, name, root, DOWNLOADS)
    assert named.registered_fields(spark, name) == DOWNLOADS
    assert spark.table(name).where(F.col("tls_cipher").isNotNull()).count() == 0
    with pytest.raises(evolve.SchemaChangeError):
        named.register(spark, name, root, [{**DOWNLOADS[0], "mode": NULLABLE}, {**DOWNLOADS[1], "type": "INTEGER"}, *DOWNLOADS[2:]])
    with pytest.raises(ValueError, match="is at"):
        named.register(spark, name, work_folder(spark, "table"), DOWNLOADS)
    spark.sql(f"DROP TABLE {name}")
    assert table.read_downloads(spark, root).count() == rows.count()

"""A kept table of agents: each agent is classified once, whichever batch brings it.

    <path>/rules=<version>/batch_id=0/...     agents that batch 0 was the first to bring

A batch's rows are parsed and stored once, with the agent left open. Their distinct agents, without those
that the table has, are classified and added; then rows get what the table says. The version names the
rules: other rules begin another table. A batch that runs again replaces the agents it added.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.agents import DETAILS_TYPE, RULES, PandasRule, Rule, classify, distinct_agents
from tallyline.session import store

_KNOWN = ["ua_status", "ua_rule", "details", "ci"]


def _meaning(part: object) -> object:
    """A rule's part as text that changes with what it does: functions by their code and what they close over."""
    if callable(part):
        code = part.__code__
        held = [_meaning(cell.cell_contents) for cell in part.__closure__ or ()]
        consts = [_code_text(c) if hasattr(c, "co_code") else repr(c) for c in code.co_consts]
        return [code.co_code.hex(), *code.co_names, *consts, held]
    if isinstance(part, dict):
        return [[key, _meaning(value)] for key, value in sorted(part.items())]
    return repr(part)


def _code_text(code) -> str:
    return repr([code.co_code.hex(), code.co_names, [_code_text(c) if hasattr(c, "co_code") else repr(c) for c in code.co_consts]])


def version_of(rules: list[Rule | PandasRule], on_unknown_key: str = "ignore", details_type: T.StructType = DETAILS_TYPE) -> str:
    """A name for a set of rules in their order, with what else decides how agents are read."""
    parts = [[type(rule).__name__, *[_meaning(getattr(rule, name)) for name in rule.__dataclass_fields__]] for rule in rules]
    return hashlib.sha256(repr([parts, on_unknown_key, details_type.json()]).encode()).hexdigest()[:16]


class AgentTable:
    """Agents known so far, with what a set of rules makes of them."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        rules: list[Rule | PandasRule] = RULES,
        on_unknown_key: str = "ignore",
        details_type: T.StructType = DETAILS_TYPE,
        version: str | None = None,
        max_broadcast_bytes: int = 64 << 20,
    ):
        self.spark, self.rules, self.on_unknown_key, self.details_type = spark, rules, on_unknown_key, details_type
        self.path = f"{path}/rules={version or version_of(rules, on_unknown_key, details_type)}"
        self.max_broadcast_bytes = max_broadcast_bytes
        more = [T.StructField("ua_error", T.StringType())] if any(isinstance(r, PandasRule) for r in rules) else []
        self.columns = [*_KNOWN, *[f.name for f in more]]
        self.schema = T.StructType(
            [
                T.StructField("ua", T.StringType()),
                T.StructField("ua_status", T.StringType()),
                T.StructField("ua_rule", T.StringType()),
                T.StructField("details", details_type),
                T.StructField("ci", T.BooleanType()),
                *more,
                T.StructField("batch_id", T.LongType()),
            ]
        )

    def known(self) -> DataFrame:
        """``ua`` and what the rules make of it, with the batch that brought it first."""
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def learn(self, agents: DataFrame, batch_id: int) -> None:
        """Classify the agents of a batch that no other batch has brought, and keep them."""
        others = self.known().where(F.col("batch_id") != batch_id).select("ua")
        new = agents.select("ua").join(others, "ua", "left_anti")
        done = classify(new, "ua", self.rules, self.on_unknown_key, self.details_type)
        done.select("ua", *self.columns).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def classify(self, df: DataFrame, batch_id: int, ua: str = "ua") -> DataFrame:
        """A batch's rows with what the rules make of their agents; ``df`` is evaluated once and stored.

        Of the table, the batch's agents only are joined to the rows: by broadcast up to a measured
        size, by shuffle beyond it, where AQE splits a frequent agent. Rows without an agent keep nulls.
        """
        rows = store(df.drop(*self.columns), "rows")
        agents = store(distinct_agents(rows, ua).select("ua"), "agents")
        self.learn(agents, batch_id)
        mine = store(self.known().drop("batch_id").join(agents, "ua", "left_semi").dropDuplicates(["ua"]), "dimension")
        bytes_of = F.octet_length("ua") + F.coalesce(F.octet_length(F.to_json("details")), F.lit(0)) + 128
        size = mine.agg(F.coalesce(F.sum(bytes_of), F.lit(0)).alias("bytes")).first()["bytes"]
        mine = mine.withColumnRenamed("ua", "_agent")
        mine = F.broadcast(mine) if size <= self.max_broadcast_bytes else mine
        return rows.join(mine, F.col(ua) == F.col("_agent"), "left").drop("_agent")

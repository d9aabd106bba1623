"""Running counts over the life of a stream: rows per agent rule, and rows per unknown agent.

The counts are state of the stream and part of its checkpoint. Each micro-batch writes the counts it has
changed, below its own number, so a batch that runs again replaces what it wrote. A count's current
value is its last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators import agents
from tallyline.plans.downloads import parse_lines
from tallyline.session import delete, store

HIT, UNKNOWN = "rule", "unknown"
_COUNTS = "what string, key string, lines bigint, batch_id bigint"


def agent_outcomes(parsed: DataFrame) -> DataFrame:
    """``what, key`` of every line with an agent: the rule that took it, or the agent that none took."""
    hit = F.col("ua_rule").isNotNull()
    lost = F.col("ua_status") == agents.UNKNOWN
    return parsed.where(hit | lost).select(
        F.when(hit, HIT).otherwise(UNKNOWN).alias("what"), F.when(hit, F.col("ua_rule")).otherwise(F.col("ua")).alias("key")
    )


def count_agents(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    token: str | bytes | None = None,
    once: bool = False,
    trigger_seconds: float = 30,
    parse: Callable[..., DataFrame] = parse_lines,
) -> StreamingQuery:
    """Start counting. Rows are combined per task before the shuffle, so a frequent rule is no hot key."""

    def write(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    counted = agent_outcomes(parse(lines, token)).groupBy("what", "key").agg(F.count("*").alias("lines"))
    writer = counted.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": f"{trigger_seconds} seconds"}
    return writer.trigger(**trigger).start()


def running_counts(spark: SparkSession, path: str) -> DataFrame:
    """``what, key, lines``: the counts as they stand."""
    try:
        rows = spark.read.schema(_COUNTS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], _COUNTS)
    return rows.groupBy("what", "key").agg(F.max_by("lines", "batch_id").alias("lines"))


def compact_counts(spark: SparkSession, path: str) -> None:
    """Put the counts of all batches but the last, which may run again, into one folder."""
    rows = spark.read.schema(_COUNTS).parquet(path)
    done = [r.batch_id for r in rows.select("batch_id").distinct().orderBy("batch_id").collect()][:-1]
    if len(done) < 2:
        return
    old = rows.where(F.col("batch_id").isin(done)).groupBy("what", "key").agg(F.max_by("lines", "batch_id").alias("lines"))
    # The folder of the last of them is replaced; until the others are gone they only repeat smaller numbers.
    store(old, "counts").write.mode("overwrite").parquet(f"{path}/batch_id={done[-1]}")
    for number in done[:-1]:
        delete(spark, f"{path}/batch_id={number}")

"""Lines to table, continuously."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.plans.downloads import parse_lines
from tallyline.plans.table import current_fields, to_rows, write_by_file, write_rows
from tallyline.schema import DOWNLOADS
from tallyline.sources.text import mark_truncated

FLUSH_SECONDS = 30


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to; a fresh checkpoint is another writer."""
    return "stream-" + json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def ingest(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    token: str | bytes | None = None,
    once: bool = False,
    flush_seconds: int = FLUSH_SECONDS,
    parse: Callable[..., DataFrame] = parse_lines,
    check_tail: bool = False,
    by_file: bool = False,
) -> StreamingQuery:
    """Start the stream: every trigger writes one batch, an empty one writes nothing.

    ``by_file`` makes each file a batch, however many a trigger takes, see :func:`write_by_file`.

    There is no watermark: a late event goes to the folder of its own day. Writer and number are
    part of a batch's folder, so a batch replayed after a failure replaces itself. Every batch is
    parsed in the schema that the table has at the time, so a change reaches the stream without a
    restart. ``check_tail`` refuses last lines without a line feed, as :func:`mark_truncated`
    finds them; files must be complete when they arrive. ``once`` works off what is there and stops.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if "position" not in batch.columns:
            batch = batch.withColumn("position", F.monotonically_increasing_id())
        if check_tail:
            batch = mark_truncated(batch)
        fields = current_fields(spark, root) or DOWNLOADS
        rows = to_rows(parse(batch, token, fields=fields), fields)
        put = write_by_file if by_file else write_rows
        put(rows, root, writer_of(spark, checkpoint), number, fields=fields)

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": f"{flush_seconds} seconds"}
    return writer.trigger(**trigger).start()

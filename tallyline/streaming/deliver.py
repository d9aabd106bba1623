"""Deliveries of so many rows, or after so much time, whichever comes first, over the life of a stream.

Rows are dealt to lanes; each lane fills deliveries of its own and numbers them from 0. What does not
fill one waits in the lane's state, at most ``size - 1`` rows, and with it the next number and a timer.
State and timers are part of the checkpoint: a stream that is started again goes on where it stopped.
One lane gives one order over all rows, more lanes more tasks.

Rows of a lane are taken in order of file and byte, so a micro-batch that runs again after a failure
makes the same deliveries; its clock is that of its first run. A micro-batch's rows of one lane are
sorted in one task: ``max_files_per_trigger`` or ``max_bytes_per_trigger`` of the source bound them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyline.operators.conform import json_row
from tallyline.plans.downloads import parse_lines
from tallyline.plans.table import to_rows
from tallyline.schema import DOWNLOADS
from tallyline.sources.deliveries import COLUMNS, DELIVERY_SIZE, FORMAT, Deliveries
from tallyline.sources.positions import split_places
from tallyline.streaming.ingest import FLUSH_SECONDS

_ROW = "event_date string, row_id string, json string"
_SENT = f"lane bigint, batch_no bigint, {_ROW}"
#: Spark needs this store for state with timers.
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


class Lane(StatefulProcessor):
    """Fills a lane's deliveries; sends what waits when its time is up."""

    def __init__(self, size: int = DELIVERY_SIZE, flush_ms: int = FLUSH_SECONDS * 1000):
        self.size, self.flush_ms = size, flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counter = handle.getValueState("counter", "next bigint, due bigint")
        self.waiting = handle.getListState("waiting", _ROW)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["source_file", "position"], kind="stable")
        held = list(self.waiting.get()) if self.waiting.exists() else []
        held = [tuple(row) for row in held]
        number, due = self.counter.get() if self.counter.exists() else (0, 0)
        everything = held + list(new[["event_date", "row_id", "json"]].itertuples(index=False, name=None))
        full = len(everything) // self.size
        rest = everything[full * self.size :]
        if due and (full or not rest):
            self.handle.deleteTimer(due)
            due = 0
        if rest and not due:
            due = timerValues.getCurrentProcessingTimeInMs() + self.flush_ms
            self.handle.registerTimer(due)
        self._keep(rest, number + full, due)
        yield from self._sent(key, everything[: full * self.size], number)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, due = self.counter.get()
        if expiredTimerInfo.getExpiryTimeInMs() == due:
            rows = [tuple(row) for row in self.waiting.get()]
            self._keep([], number + 1, 0)
            yield from self._sent(key, rows, number)

    def close(self) -> None:
        pass

    def _keep(self, rows: list[tuple], number: int, due: int) -> None:
        self.waiting.put(rows) if rows else self.waiting.clear()
        self.counter.update((number, due))

    def _sent(self, key, rows: list[tuple], number: int) -> Iterator[pd.DataFrame]:
        for start in range(0, len(rows), self.size):
            part = pd.DataFrame(rows[start : start + self.size], columns=["event_date", "row_id", "json"])
            part.insert(0, "batch_no", number + start // self.size)
            part.insert(0, "lane", key[0])
            yield part[COLUMNS]


def deliver(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    token: str | bytes | None = None,
    lanes: int = 8,
    lane: Column | None = None,
    size: int = DELIVERY_SIZE,
    flush_seconds: float = FLUSH_SECONDS,
    writer: str = "stream",
    fields: list[dict] = DOWNLOADS,
    trigger_seconds: float = 1,
    parse: Callable[..., DataFrame] = parse_lines,
) -> StreamingQuery:
    """Start the stream from lines of :func:`tallyline.sources.text.stream_lines` to deliveries in ``path``.

    ``lane`` (a whole number from the columns of a parsed line, of ``lanes`` values) is by file unless given. Each file is
    read as one split, so that a row's id, made from file and byte, stays the same whatever reads it.
    """
    spark = lines.sparkSession
    spark.dataSource.register(Deliveries)
    at_once = F.when(F.col("block_start") == 0, F.col("within")).otherwise(F.raise_error(F.lit("a file was split")).cast("long"))
    placed = split_places(lines).withColumn("position", at_once)
    parsed = parse(placed, token, fields=fields)
    lane = F.pmod(F.xxhash64("source_file"), F.lit(lanes)) if lane is None else lane
    rows = to_rows(parsed.withColumn("_lane", lane.cast("long")), fields, carry=["_lane"]).where("outcome = 'kept'")
    place = F.concat_ws("/", F.lit(writer), "source_file", F.col("position").cast("string"))
    due = rows.select(
        F.col("_lane").alias("lane"),
        "source_file",
        "position",
        "event_date",
        F.sha2(place, 256).alias("row_id"),
        json_row([f["name"] for f in fields]).alias("json"),
    )
    sent = due.groupBy("lane").transformWithStateInPandas(
        Lane(size, int(flush_seconds * 1000)), outputStructType=_SENT, outputMode="Append", timeMode="ProcessingTime"
    )
    query = (
        sent.writeStream.format(FORMAT)
        .options(path=path, writer=writer, size=str(size), checkpointLocation=checkpoint)
        .outputMode("append")
        .trigger(processingTime=f"{trigger_seconds} seconds")
    )
    settings = _STATE_STORE | {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40)}
    # Every partition of the state is a task with a Python process in each trigger, and lanes are all there is to share out.
    settings["spark.sql.shuffle.partitions"] = str(2 * lanes)
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        return query.start()  # the stream keeps the settings of its start
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)

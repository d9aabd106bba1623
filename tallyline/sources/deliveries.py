"""Deliveries as files: a sink for Spark's own writers, in batch and as a stream.

    <root>/data/event_date=20240101/<random name>.ndjson       the rows of one delivery
    <root>/commits/writer=nightly/batch-000000000007.ndjson    one line per delivery

Tasks write every delivery (at most ``size`` rows of one day) to a file of its own and report it in
their commit message. The driver lists what all tasks report in one file, which appears at once. Only
listed files count, so attempts that failed leave nothing behind that is read. A batch number that
was listed before is not listed again: a replay leaves the deliveries as they were.

Paths are those of pyarrow's file systems (local and mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

FORMAT = "deliveries"
DELIVERY_SIZE = 500
#: What a row to deliver has; lanes number their deliveries separately.
COLUMNS = ["lane", "batch_no", "event_date", "row_id", "json"]
_LISTED = "lane bigint, batch_no bigint, event_date string, rows bigint, file string, writer string, batch string"


@dataclass
class Written(WriterCommitMessage):
    """The deliveries that a task has written."""

    deliveries: list[dict] = field(default_factory=list)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), os.path.abspath(path)) if path.startswith("/") else fs.FileSystem.from_uri(path)


class _Sink:
    """What the writers of batches and streams share."""

    def __init__(self, options: dict[str, str]):
        if not options.get("path") or not options.get("writer"):
            raise ValueError("deliveries need the options 'path' and 'writer'")
        self.path, self.writer = options["path"], options["writer"]
        self.size = int(options.get("size", DELIVERY_SIZE))

    def write(self, iterator: Iterator) -> Written:
        system, root = _file_system(self.path)
        out = Written()
        for (lane, number), rows in groupby(iterator, key=lambda row: (row["lane"], row["batch_no"])):
            days: dict[str, list] = {}
            for row in rows:
                day = days.setdefault(row["event_date"], [])
                if len(day) >= self.size:
                    raise ValueError(f"delivery {number} of lane {lane} has over {self.size} rows of {row['event_date']}")
                day.append(f'{{"insertId":{json.dumps(row["row_id"])},"json":{row["json"]}}}\n')
            for day, lines in days.items():
                name = f"data/event_date={day}/{uuid.uuid4().hex}.ndjson"
                system.create_dir(f"{root}/data/event_date={day}")
                with system.open_output_stream(f"{root}/{name}") as file:
                    file.write("".join(lines).encode())
                made = {"lane": lane, "batch_no": number, "event_date": day, "rows": len(lines), "file": name.rpartition("/")[2]}
                out.deliveries.append(made)
        return out

    def list_all(self, messages: list[Written | None], batch: int) -> None:
        made = [delivery for message in messages if message for delivery in message.deliveries]
        if not made:
            return None
        system, root = _file_system(self.path)
        folder = f"{root}/commits/writer={self.writer}"
        target = f"{folder}/batch-{batch:012d}.ndjson"
        if system.get_file_info(target).type != fs.FileType.NotFound:
            return self.forget(messages)
        system.create_dir(folder)
        lines = "".join(json.dumps({**delivery, "batch": str(batch)}) + "\n" for delivery in made)
        hidden = f"{folder}/_{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as file:
            file.write(lines.encode())
        system.move(hidden, target)

    def forget(self, messages: list[Written | None]) -> None:
        system, root = _file_system(self.path)
        for message in messages:
            for delivery in message.deliveries if message else []:
                name = f"{root}/data/event_date={delivery['event_date']}/{delivery['file']}"
                if system.get_file_info(name).type != fs.FileType.NotFound:
                    system.delete_file(name)


class BatchWriter(_Sink, DataSourceWriter):
    """Deliveries of a batch, whose number is the option ``batch``."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.batch = int(options.get("batch", 0))

    def commit(self, messages: list[Written | None]) -> None:
        self.list_all(messages, self.batch)

    def abort(self, messages: list[Written | None]) -> None:
        self.forget(messages)


class StreamWriter(_Sink, DataSourceStreamWriter):
    """Deliveries of a stream, listed for each micro-batch."""

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.list_all(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.forget(messages)


class Deliveries(DataSource):
    """``df.write.format("deliveries")`` and ``df.writeStream.format("deliveries")``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options)


def write_deliveries(rows: DataFrame, path: str, writer: str, batch: int = 0, size: int = DELIVERY_SIZE) -> None:
    """Write rows of ``COLUMNS`` as one batch; a batch that was written before stays as it is.

    The rows of a delivery come together by one exchange; a delivery has at most ``size`` rows a
    day, so no key is large.
    """
    rows.sparkSession.dataSource.register(Deliveries)
    keys = ["lane", "batch_no"]
    dealt = rows.select(*COLUMNS).repartition(*keys).sortWithinPartitions(*keys, "event_date", "row_id")
    options = {"path": path, "writer": writer, "batch": str(batch), "size": str(size)}
    dealt.write.format(FORMAT).options(**options).mode("append").save()


def read_deliveries(spark: SparkSession, path: str) -> DataFrame:
    """One row per delivery that was committed."""
    try:
        return spark.read.schema(_LISTED).json(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LISTED)


def read_delivered(spark: SparkSession, path: str) -> DataFrame:
    """``lane, batch_no, event_date, row_id, json`` of all rows in committed deliveries."""
    lines = spark.read.option("lineSep", "\n").text(f"{path}/data")
    name = F.substring_index(F.col("_metadata.file_path"), "/", -1)
    rows = lines.select(
        name.alias("file"),
        F.get_json_object("value", "$.insertId").alias("row_id"),
        F.get_json_object("value", "$.json").alias("json"),
    )
    listed = read_deliveries(spark, path).select("lane", "batch_no", "event_date", "file")
    return rows.join(listed, "file").select(*COLUMNS)

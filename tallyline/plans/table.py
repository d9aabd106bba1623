"""The stored table: one folder of Parquet files per day, writer and batch.

    <root>/downloads/event_date=20240101/writer=nightly/batch_id=0/...
    <root>/rejects/writer=nightly/batch_id=0/...
    <root>/written/writer=nightly/batch_id=0/...     the schema of that batch's rows, day by day
    <root>/counts/writer=nightly/batch_id=0/...      lines in, kept, refused and stored
    <root>/schema/version=1/...

Downloads hold the table's fields and a ``row_id``, nothing else; rejects the raw line, its
reason and where it stood. Both come from one parse. Every writer has an id: a batch that is
written again replaces the folders of its own writer and number, so a replay leaves the table
as it was, and no writer can touch the rows of another.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.conform import missing_path
from tallyline.plans.downloads import REASONS, assemble, event_date
from tallyline.schema import DOWNLOADS, to_struct
from tallyline.session import delete, store

_KEYS = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("writer", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
_ROW_ID = T.StructField("row_id", T.StringType())
_ORIGIN = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("position", T.LongType())])
_REJECT = T.StructType([T.StructField("reject_reason", T.StringType()), T.StructField("raw", T.BinaryType())])
_BESIDE = ["outcome", "event_date", *_REJECT.names, *_ORIGIN.names]
#: The batch that compacted rows go to; streams and jobs count from 0.
COMPACTED = -1
#: Batches that one trigger may write where each file is one; their numbers begin at this one.
PER_TRIGGER = 1_000_000
_NOTE = T.StructType([T.StructField("value", T.StringType()), *_KEYS.fields[1:]])
_COUNTED = ["rows_in", "kept", "refused", *[f"refused_{reason}" for reason in [*REASONS, "missing_required"]]]
_COUNTS = T.StructType([T.StructField(name, T.LongType()) for name in [*_COUNTED, "delivered"]] + _KEYS.fields[1:])


def to_rows(parsed: DataFrame, fields: list[dict] = DOWNLOADS, carry: Iterable[str] = ()) -> DataFrame:
    """Parsed lines as rows to store.

    Downloads have the table's fields and no raw line, rejects the other way
    round. A download that lacks a REQUIRED field becomes a reject. ``source_file``
    and ``position`` are taken along, and the columns to ``carry``; rows without a position get one.
    """
    keep = F.col("reject_reason").isNull()
    if "position" not in parsed.columns:
        parsed = parsed.withColumn("position", F.monotonically_increasing_id())
    # BINARY again where it is stored; see :func:`parse_lines`.
    assembled = assemble(parsed).withColumn("raw", F.col("raw").cast("string"))
    names = [field["name"] for field in fields if field["name"] in assembled.columns]
    blank = assembled.withColumns({name: F.when(keep, F.col(name)) for name in names})
    lack = F.concat(F.lit("missing "), missing_path(fields))
    table = to_struct(fields)
    more = [blank.schema[name] for name in carry]
    passing = [T.StructField(name, T.StringType()) for name in _REJECT.names]
    rows = blank.to(T.StructType([*table.fields, *passing, *_ORIGIN.fields, *more]))
    rows = rows.withColumn("reject_reason", F.coalesce("reject_reason", lack))
    kept = F.col("reject_reason").isNull()
    return rows.withColumns(
        {
            "raw": F.when(~kept, F.col("raw")).cast("binary"),
            "event_date": F.when(kept, event_date()),
            "outcome": F.when(kept, "kept").otherwise("rejected"),
        }
    )


def write_rows(
    rows: DataFrame,
    root: str,
    writer: str,
    batch_id: int = 0,
    by_day: bool = False,
    fields: list[dict] | None = None,
) -> None:
    """Write the rows of one batch, replacing an earlier attempt at the same batch of this writer.

    ``writer`` names who writes; two jobs must not share a name and a batch number. ``fields`` is
    the schema of the rows (what is declared, unless given), which has to fit the table's.
    Lines arrive nearly in order, so a task meets few days and writes without an
    exchange. ``by_day`` brings a scattered backlog together first; AQE then
    splits the days that are large and joins those that are small.
    """
    spark = rows.sparkSession
    fields = _fitting(spark, root, writer, fields)
    counted, delivered = Observation(), Observation()
    rows = _with_ids(rows.withColumn("batch_id", F.lit(batch_id)), writer).observe(counted, *_counts()).persist()
    try:
        kept = _kept(rows, fields).observe(delivered, F.count(F.lit(1)).alias("delivered"))
        _put(kept.hint("rebalance", "event_date") if by_day else kept, f"{root}/downloads", _KEYS.names)
        _put(_refused(rows), f"{root}/rejects", _KEYS.names[1:])
    finally:
        rows.unpersist()
    note(spark, root, writer, batch_id, {day: fields for day in _days_of(spark, root, writer, batch_id)})
    done = {**counted.get, **delivered.get}
    line = spark.createDataFrame([tuple(done[name] for name in _COUNTS.names[:-2])], T.StructType(_COUNTS.fields[:-2]))
    line.coalesce(1).write.mode("overwrite").parquet(f"{root}/counts/writer={writer}/batch_id={batch_id}")


def write_by_file(rows: DataFrame, root: str, writer: str, trigger: int, fields: list[dict] | None = None) -> None:
    """Write the rows of one trigger of a stream, each file as a batch of its own, replacing an earlier attempt.

    So how many files a trigger takes does not show in the table, and a backlog of small files needs few triggers.
    A batch's number is made of the trigger's and the place of its file, by name, among those of the trigger;
    these are the same when the trigger runs again. Batches without a line are not there.
    """
    spark = rows.sparkSession
    fields = _fitting(spark, root, writer, fields)
    first = (trigger + 1) * PER_TRIGGER
    rows = rows.persist()
    # One row per file of a trigger.
    files = rows.groupBy("source_file").agg(*_counts())
    place = F.row_number().over(Window.orderBy("source_file")) - 1
    files = files.select("source_file", (F.lit(first) + place).alias("batch_id"), *_COUNTED).persist()
    try:
        if files.count() > PER_TRIGGER:
            raise ValueError(f"a trigger has over {PER_TRIGGER} files")
        numbered = _with_ids(rows.join(F.broadcast(files.select("source_file", "batch_id")), "source_file"), writer)
        _put(_kept(numbered, fields), f"{root}/downloads", _KEYS.names)
        _put(_refused(numbered), f"{root}/rejects", _KEYS.names[1:])
        # What is there now, by the names of its folders and the row counts of its files.
        mine = f"{root}/downloads/event_date=*/writer={writer}/batch_id={trigger + 1}{'?' * (len(str(PER_TRIGGER)) - 1)}"
        there = _read(spark, mine, _KEYS, base=f"{root}/downloads").groupBy("event_date", "batch_id")
        there = there.agg(F.count("*").alias("rows")).persist()
        line = F.concat(F.lit('{"event_date": "'), "event_date", F.lit(f'", "fields": {json.dumps(fields)}}}'))
        notes = there.select(line.alias("value"), F.lit(writer).alias("writer"), "batch_id")
        notes = notes.repartition(16, "batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        notes.partitionBy("writer", "batch_id").text(f"{root}/written")
        arrived = there.groupBy("batch_id").agg(F.sum("rows").alias("delivered"))
        counts = files.drop("source_file").join(F.broadcast(arrived), "batch_id", "left").withColumn("writer", F.lit(writer))
        counts = counts.select(*_COUNTED, F.coalesce("delivered", F.lit(0)).alias("delivered"), "writer", "batch_id")
        _put(counts.repartition(16, "batch_id"), f"{root}/counts", _KEYS.names[1:])
        there.unpersist()
    finally:
        files.unpersist()
        rows.unpersist()


def _fitting(spark: SparkSession, root: str, writer: str, fields: list[dict] | None) -> list[dict]:
    """The schema of rows to write, which has to fit the table's."""
    from tallyline.plans.evolve import check_change

    if not re.fullmatch(r"[A-Za-z0-9_-]{1,64}", writer or ""):
        raise ValueError("a writer's id has 1 to 64 letters, digits, '-' and '_'")
    declared = current_fields(spark, root)
    fields = fields or declared or DOWNLOADS
    if declared is not None and declared != fields:
        check_change(spark, fields, declared)
    return fields


def _with_ids(rows: DataFrame, writer: str) -> DataFrame:
    place = F.concat_ws("/", F.lit(writer), F.col("batch_id").cast("string"), "source_file", F.col("position").cast("string"))
    return rows.withColumns({"row_id": F.sha2(place, 256), "writer": F.lit(writer)})


def _kept(rows: DataFrame, fields: list[dict]) -> DataFrame:
    return rows.where(F.col("outcome") == "kept").select(*[field["name"] for field in fields], "row_id", *_KEYS.names)


def _refused(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("outcome") == "rejected").select(*_REJECT.names, *_ORIGIN.names, "row_id", *_KEYS.names[1:])


def _counts() -> list:
    """What is counted of a batch while it is written: lines, downloads, and refused lines by reason."""
    reason = F.col("reject_reason")
    refused = [F.count_if(reason == name).alias(f"refused_{name}") for name in REASONS]
    lacking = F.count_if(F.startswith(reason, F.lit("missing ")) & ~reason.isin(REASONS)).alias("refused_missing_required")
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(reason.isNull()).alias("kept"),
        F.count_if(reason.isNotNull()).alias("refused"),
        *refused,
        lacking,
    ]


def batch_counts(spark: SparkSession, root: str) -> DataFrame:
    """One row per writer and batch: lines in, kept, refused (also by reason) and delivered.

    Counted by the jobs that wrote the batches; the table's own files are not read. A batch that was
    written again has the counts of its last attempt.
    """
    return _read(spark, f"{root}/counts", _COUNTS)


def _put(df: DataFrame, path: str, keys: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def _days_of(spark: SparkSession, root: str, writer: str, batch_id: int) -> list[str]:
    """The days that a batch has rows of, from the names of its folders."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/downloads/event_date=*/writer={writer}/batch_id={batch_id}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [re.search("event_date=([^/]*)", status.getPath().toString()).group(1) for status in found]


def _lines(days: dict[str, list[dict]]) -> list[str]:
    return [json.dumps({"event_date": day, "fields": fields}) for day, fields in sorted(days.items())]


def note(spark: SparkSession, root: str, writer: str, batch_id: int, days: dict[str, list[dict]]) -> None:
    """Record the schemas that the rows of a batch are stored in, one line per day."""
    text = spark.createDataFrame([(line,) for line in _lines(days)], "value string").coalesce(1)
    text.write.mode("overwrite").text(f"{root}/written/writer={writer}/batch_id={batch_id}")


def stored_notes(spark: SparkSession, root: str) -> DataFrame:
    """``event_date, fields`` (JSON), ``writer, batch_id``: the schema of every folder of rows."""
    notes = spark.read.schema(_NOTE).text(f"{root}/written")
    of = lambda key: F.get_json_object("value", f"$.{key}").alias(key)
    return notes.select(of("event_date"), of("fields"), "writer", "batch_id")


def write_downloads(
    df: DataFrame, root: str, writer: str, batch_id: int = 0, fields: list[dict] | None = None
) -> None:
    """Write rows that are downloads already, in the given version of the schema."""
    fields = fields or current_fields(df.sparkSession, root) or DOWNLOADS
    for name, kind in (("source_file", "string"), ("position", "bigint")):
        if name not in df.columns:
            df = df.withColumn(name, F.monotonically_increasing_id() if name == "position" else F.lit(None).cast(kind))
    df = df.withColumn("event_date", event_date())
    rows = df.to(T.StructType([*to_struct(fields).fields, *_ORIGIN.fields, *_KEYS.fields[:1]]))
    blank = {name: F.lit(None).cast(_REJECT[name].dataType) for name in _REJECT.names}
    rows = rows.withColumns({"outcome": F.lit("kept"), **blank})
    write_rows(rows, root, writer, batch_id, fields=fields)


def _read(spark: SparkSession, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
    try:
        reader = spark.read.schema(schema)
        return (reader if base is None else reader.option("basePath", base)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_downloads(spark: SparkSession, root: str, fields: list[dict] | None = None, once: bool = False) -> DataFrame:
    """The table, in its current schema unless given; fields a file lacks are null.

    Filters on ``event_date`` and ``batch_id`` prune folders, others and the
    columns asked for reach the Parquet scan. While days are compacted their rows may be there
    twice for a moment; ``once`` takes each row id once, at the price of a shuffle.
    """
    fields = fields or current_fields(spark, root) or DOWNLOADS
    rows = _read(spark, f"{root}/downloads", T.StructType([*to_struct(fields).fields, _ROW_ID, *_KEYS.fields]))
    return rows.dropDuplicates(["event_date", "row_id"]) if once else rows


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Refused lines with their reason and where they stood."""
    return _read(
        spark, f"{root}/rejects", T.StructType([*_REJECT.fields, *_ORIGIN.fields, _ROW_ID, *_KEYS.fields[1:]])
    )


def deliveries(spark: SparkSession, root: str) -> DataFrame:
    """What has arrived: rows per writer, batch and day. Reads no column data."""
    return read_downloads(spark, root).groupBy(*_KEYS.names).agg(F.count("*").alias("rows"))


def delivery_report(spark: SparkSession, root: str, due: DataFrame) -> DataFrame:
    """Per day of ``event_date, downloads``: rows and deliveries that arrived, and rows that did not."""
    sent = deliveries(spark, root).groupBy("event_date").agg(
        F.sum("rows").alias("rows_delivered"), F.count("*").alias("deliveries")
    )
    arrived = F.coalesce("rows_delivered", F.lit(0))
    return due.join(sent, "event_date", "left").select(
        "event_date",
        arrived.alias("rows_delivered"),
        F.coalesce("deliveries", F.lit(0)).alias("deliveries"),
        (F.col("downloads") - arrived).alias("rows_dropped"),
    )


def compact_days(spark: SparkSession, root: str, days: list[str], writer: str) -> None:
    """Put the batches that a writer has finished for closed days into few files.

    The writer's last batch stays as it is, or where files are batches, those of its last trigger: only
    these can be replayed. Rows go to the folder
    of batch ``COMPACTED``, then the folders they came from are deleted, and with them their records:
    a batch that has no day left leaves nothing behind. A run that was cut off in between has left rows
    twice; the next one finds them by their id. Refused lines have no day; those of all finished
    batches are put together too, in a folder that the number of the last batch names.
    """
    mine = F.col("writer") == writer
    fields = current_fields(spark, root) or DOWNLOADS
    table = read_downloads(spark, root).where(mine)
    last = table.agg(F.max("batch_id")).first()[0]
    if last is None:
        return
    open_from = last if last < PER_TRIGGER else last // PER_TRIGGER * PER_TRIGGER
    old = table.where(F.col("event_date").isin(days) & (F.col("batch_id") < F.lit(open_from)))
    folders = {tuple(r) for r in old.select("event_date", "batch_id").distinct().collect()}
    copy = store(old.dropDuplicates(["event_date", "row_id"]), "compact")
    copy = copy.withColumn("batch_id", F.lit(COMPACTED)).hint("rebalance", "event_date")
    _put(copy, f"{root}/downloads", _KEYS.names)
    done = [(day, batch) for day, batch in folders if batch != COMPACTED]
    _delete_all(spark, [f"{root}/downloads/event_date={day}/writer={writer}/batch_id={batch}" for day, batch in done])

    notes: dict[int, dict[str, list[dict]]] = {}
    touched = {batch for _, batch in done} | {COMPACTED}
    # Of batches whose rows have moved, the other days; a stream has thousands of batches, most of them without any.
    among = F.broadcast(spark.createDataFrame([(batch,) for batch in sorted(touched)], "batch_id bigint"))
    stays = mine & ((F.col("batch_id") == COMPACTED) | ~F.col("event_date").isin(days))
    for row in stored_notes(spark, root).where(stays).join(among, "batch_id", "left_semi").collect():
        notes.setdefault(row.batch_id, {})[row.event_date] = json.loads(row.fields)
    notes.setdefault(COMPACTED, {}).update({day: fields for day, _ in folders})
    for batch in sorted(touched):
        if notes.get(batch):
            note(spark, root, writer, batch, notes[batch])
    _delete_all(spark, [f"{root}/written/writer={writer}/batch_id={b}" for b in touched if not notes.get(b)])

    refused = read_rejects(spark, root).where(mine & (F.col("batch_id") < F.lit(open_from)) & (F.col("batch_id") >= 0))
    finished = [r.batch_id for r in refused.select("batch_id").distinct().collect()]
    if len(finished) > 1:
        copy = store(refused.dropDuplicates(["row_id"]), "compact").withColumn("batch_id", F.lit(-1 - last))
        _put(copy.hint("rebalance"), f"{root}/rejects", _KEYS.names[1:])
        _delete_all(spark, [f"{root}/rejects/writer={writer}/batch_id={batch}" for batch in finished])


def _delete_all(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders, several at a time: a day of a stream may have some thousands."""
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda path: delete(spark, path), paths))


def current_fields(spark: SparkSession, root: str) -> list[dict] | None:
    """The fields last declared for the table, or None for a table not yet declared."""
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("version", T.IntegerType())])
    try:
        versions = spark.read.schema(schema).text(f"{root}/schema")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = versions.orderBy(F.desc("version")).first()
    return json.loads(last["value"]) if last else None


def declare_fields(spark: SparkSession, root: str, fields: list[dict]) -> None:
    """Make ``fields`` the table's schema, as one more version."""
    old = spark.read.text(f"{root}/schema").agg(F.max("version")).first()[0] if current_fields(spark, root) else 0
    text = spark.createDataFrame([(json.dumps(fields),)], "value string")
    text.coalesce(1).write.mode("errorifexists").text(f"{root}/schema/version={old + 1}")

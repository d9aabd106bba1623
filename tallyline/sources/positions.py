"""Where each line stands: its byte in its file, and its place in the order of arrival.

Spark cuts files into splits, and a split begins with the first line that starts after its first
byte, so where that line starts is known only from the lines of the splits before it. Within a split
lines are read in order, and a running sum over their sizes gives each one's place there, without an
exchange. Lines are stored with that place; the sums of the splits, one small row each, then tell where
every split begins. What comes out does not depend on how files were cut.

Files are in order of their modification time, then their path (or of their path alone, where names
carry the time). ``position`` is the number of bytes of all files before a line's, plus its own offset:
unique, and growing with arrival.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.session import store

#: Bytes of splits that share a task, about; splits of a usual size have one of their own.
TASK_BYTES = 32 << 20

#: Columns that :func:`locate` adds.
ADDED = ["offset", "position", "truncated"]


def _split_bytes(spark: SparkSession) -> int:
    """What a split holds at most, as the session has it set."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", text).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def read_origin(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as BINARY ``raw`` with what their file tells, bytes unaltered.

    Small splits share tasks: the number of tasks goes by the bytes, however finely files are cut.
    """
    df = spark.read.option("lineSep", "\n").text(path)
    splits, share = df.rdd.getNumPartitions(), TASK_BYTES // max(1, _split_bytes(spark))
    df = df.select(
        F.col("value").cast("binary").alias("raw"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    tasks = max(ceil(splits / max(1, share)), min(splits, spark.sparkContext.defaultParallelism))
    return df.coalesce(tasks) if tasks < splits else df


def _running():
    """Bytes before a line in its split; lines of a split come one after the other."""

    @F.arrow_udf("bigint")
    def within(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, carried = None, 0
        for file, block, size in batches:
            file, block, size = (x.to_numpy(zero_copy_only=False) for x in (file, block, size))
            if not len(size):
                yield pa.array([], pa.int64())
                continue
            before = np.cumsum(size) - size
            first = np.concatenate([[True], (file[1:] != file[:-1]) | (block[1:] != block[:-1])])
            base = before[np.maximum.accumulate(np.where(first, np.arange(len(size)), 0))]
            out = before - base
            if (int(file[0]), int(block[0])) == last:
                out[: len(size) if first.sum() == 1 else np.flatnonzero(first)[1]] += carried
            last, carried = (int(file[-1]), int(block[-1])), int(out[-1] + size[-1])
            yield pa.array(out.astype(np.int64))

    return within.asNondeterministic()  # so that no filter is moved below it


def split_places(lines: DataFrame) -> DataFrame:
    """Adds ``within``: the bytes between the first line of a line's split and the line itself. No exchange."""
    size = (F.octet_length("raw") + 1).cast("long")
    return lines.withColumn("within", _running()(F.xxhash64("source_file"), F.col("block_start"), size))


def locate(lines: DataFrame, by: str = "modified", max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Adds ``offset``, ``position`` and ``truncated`` to lines of :func:`read_origin`.

    The lines are stored once: sums and rows have to come from the same splits, and a later scan may
    cut the files in another way. ``truncated`` marks a last line without its line feed: only that
    one ends where the file does. Compressed files are refused with an error, their size says nothing
    about their lines. The sums of splits are broadcast up to a measured size, joined by shuffle beyond it.
    """
    if by not in ("modified", "name"):
        raise ValueError("files are ordered by 'modified' or by 'name'")
    held = store(split_places(lines), "lines")
    end = F.col("within") + F.octet_length("raw") + 1
    splits = held.groupBy("source_file", "block_start").agg(
        F.max(end).alias("bytes"), F.max("file_size").alias("size"), F.max("modified").alias("modified")
    )
    splits = store(splits, "splits")
    files = splits.groupBy("source_file").agg(
        F.sum("bytes").alias("bytes"), F.max("size").alias("size"), F.max("modified").alias("modified")
    )
    odd = files.where(~F.col("bytes").isin(F.col("size"), F.col("size") + 1)).count()
    if odd:
        raise ValueError(f"{odd} files are compressed or changed while they were read")
    before = lambda w: F.coalesce(F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    in_file = splits.select(
        "source_file", "block_start", before(Window.partitionBy("source_file").orderBy("block_start")).alias("_split")
    )
    places = in_file.join(_file_bases(files, by), "source_file")
    row_bytes = F.octet_length("source_file") + 48
    size = places.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()["bytes"]
    places = F.broadcast(places) if size <= max_broadcast_bytes else places
    offset = F.col("_split") + F.col("within")
    return (
        held.join(places, ["source_file", "block_start"])
        .withColumns(
            {
                "offset": offset,
                "position": F.col("_file") + offset,
                "truncated": offset + F.octet_length("raw") == F.col("file_size"),
            }
        )
        .select(*[c for c in held.columns if c not in ("within", "block_start")], *ADDED)
    )


def _file_bases(files: DataFrame, by: str) -> DataFrame:
    """``source_file, _file``: the bytes of all files before a file.

    Files are summed up within groups, then the groups: days for times, and for names ranges of
    them, which are as many as there are partitions. So no task has all files.
    """
    if by == "modified":
        files = files.withColumn("_group", F.floor(F.unix_micros("modified") / 86_400_000_000))
        order = ["modified", "source_file"]
    else:
        ranged = files.repartitionByRange("source_file").withColumn("_group", F.spark_partition_id().cast("long"))
        files, order = store(ranged, "files"), ["source_file"]
    before = lambda column, w: F.coalesce(F.sum(column).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = files.withColumn("_inner", before("bytes", Window.partitionBy("_group").orderBy(*order)))
    groups = files.groupBy("_group").agg(F.sum("bytes").alias("_bytes"))
    groups = groups.select("_group", before("_bytes", Window.orderBy("_group")).alias("_outer"))
    return inner.join(groups, "_group").select("source_file", (F.col("_inner") + F.col("_outer")).alias("_file"))


def read_in_order(spark: SparkSession, path: str | list[str], by: str = "modified") -> DataFrame:
    """Lines of files with their place in the order of arrival, see :func:`locate`."""
    return locate(read_origin(spark, path), by)

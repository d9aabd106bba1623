"""Newline-framed lines from files, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import store


def _origin() -> list:
    return [
        F.col("value").cast("binary").alias("raw"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
    ]


def read_lines(spark: SparkSession, path: str | list[str], check_tail: bool = False) -> DataFrame:
    """Lines as BINARY ``raw``, split at line feeds only, bytes unaltered.

    ``position`` grows in order of the lines within a file and is unique, but it depends on how
    files are cut into splits: use it within one evaluation only. ``check_tail`` also
    finds last lines without a line feed, see :func:`mark_truncated`.
    """
    df = spark.read.option("lineSep", "\n").text(path)
    df = df.select(*_origin(), F.monotonically_increasing_id().alias("position"))
    return mark_truncated(df) if check_tail else df


def mark_truncated(df: DataFrame, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Add ``truncated``: the line is a file's last one and lacks its line feed.

    Each line but a truncated one takes its bytes plus one. So the sum over a file, combined per
    task before the shuffle, tells whether its last line is whole: that scan yields names of files
    and no positions. The cut files are then read by their names, their lines stored, and the last of each
    is found among the stored ones, so that marking and reading see the same split of the files. Files
    that are whole pass through. Names are broadcast up to a measured size, joined by shuffle beyond it.

    Compressed files are refused with an error: their size says nothing about their lines.
    """
    per_file = df.groupBy("source_file").agg(
        F.sum(F.octet_length("raw") + 1).alias("bytes"), F.max("file_size").alias("size")
    )
    per_file = store(per_file, "files")
    cut = per_file.where(F.col("bytes") == F.col("size") + 1).select("source_file")
    odd, names = per_file.agg(
        F.count_if((F.col("bytes") != F.col("size")) & (F.col("bytes") != F.col("size") + 1)),
        F.coalesce(F.sum(F.octet_length("source_file") + 32), F.lit(0)),
    ).first()
    if odd:
        raise ValueError(f"{odd} files are compressed or changed while they were read")
    small = names <= max_broadcast_bytes
    cut = F.broadcast(cut) if small else cut
    whole = df.join(cut, "source_file", "left_anti").select(*df.columns, F.lit(False).alias("truncated"))
    held = store(_lines_of(df, cut), "cut")
    last = held.groupBy("source_file").agg(
        F.max_by("position", F.struct("block_start", "position")).alias("_last")
    )
    held = held.join(F.broadcast(last) if small else last, "source_file").withColumn(
        "truncated", F.col("position") == F.col("_last")
    )
    return whole.unionByName(held.select(*df.columns, "truncated"))


def _lines_of(df: DataFrame, files: DataFrame, most: int = 10_000) -> DataFrame:
    """The lines of some files of ``df``, read by name; filtered from ``df`` if there are too many of them,
    a name has signs that a path would not take literally, or ``df`` has columns of its own."""
    names = [row.source_file for row in files.limit(most + 1).collect()]
    known = {"raw", "source_file", "file_size", "block_start", "position"}
    if len(names) > most or any(set(name) & set("%*?[]{}\\,") for name in names) or set(df.columns) - known:
        return df.join(files, "source_file", "left_semi").select(*df.columns)
    if not names:
        return df.limit(0)
    lines = df.sparkSession.read.option("lineSep", "\n").text(names).select(*_origin())
    return lines.withColumn("position", F.monotonically_increasing_id()).select(*df.columns)


def stream_lines(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Files that arrive in a folder, as a stream of lines.

    The limits bound a micro-batch, and with it what is in flight. Each line comes
    with its file, so that a refused one can be traced.
    """
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(path).select(*_origin())


def kafka_lines(spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int = 1_000_000) -> DataFrame:
    """Lines from a Kafka topic; needs Spark's Kafka package on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .load()
        .select(F.col("value").alias("raw"))
    )

"""Deliveries of a fixed number of rows, in order of arrival, split by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH_SIZE = 500
# Positions per bucket: bounds the rows one task ranks.
_BUCKET_BITS = 16
_GROUP_BITS = 12
#: For positions in bytes: 16 MiB of lines are a bucket.
BYTE_BUCKET_BITS = 24


def number_batches(
    df: DataFrame, position: str = "line_id", batch_size: int = BATCH_SIZE, bucket_bits: int = _BUCKET_BITS
) -> DataFrame:
    """Add ``batch_no``: the running number of a row's delivery.

    ``position`` is a unique whole number that grows with arrival; gaps are fine.
    Where it counts bytes, ``BYTE_BUCKET_BITS`` gives buckets of as many rows.
    Ranks come from three parts: the row's rank within its bucket of 65,536
    positions, the rows of earlier buckets within a group of 4,096 buckets, and
    the rows of earlier groups. Only the last part, one row per group, is summed
    in one place. The rows are shuffled once, by bucket, and since positions are
    unique no bucket can be large.
    """
    bucket = F.shiftright(F.col(position), bucket_bits)
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    counts = counts.withColumn("_group", F.shiftright("_bucket", _GROUP_BITS))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within_group = counts.withColumn(
        "_before", F.coalesce(F.sum("_rows").over(earlier(Window.partitionBy("_group").orderBy("_bucket"))), F.lit(0))
    )
    groups = counts.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    groups = groups.select(
        "_group",
        # One row per 268 million positions: small enough for one task at any scale.
        F.coalesce(F.sum("_rows").over(earlier(Window.orderBy("_group"))), F.lit(0)).alias("_before_group"),
    )
    offsets = within_group.join(groups, "_group").select(
        "_bucket", (F.col("_before") + F.col("_before_group")).alias("_offset")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(position)) - 1
    ranked = rows.withColumn("_rank", rank).join(offsets, "_bucket")
    return ranked.withColumn(
        "batch_no", F.floor((F.col("_offset") + F.col("_rank")) / batch_size)
    ).drop("_bucket", "_rank", "_offset")


def deliveries(df: DataFrame) -> DataFrame:
    """One row per delivery: a batch goes out once for every day it holds."""
    return df.groupBy("batch_no", "event_date").agg(F.count("*").alias("rows"))

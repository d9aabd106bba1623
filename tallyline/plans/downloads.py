"""Lines to downloads: the one transformation batch and streaming share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators import agents, events, lines
from tallyline.operators.pin import pin

# Reasons in the order they are tested; the first one that holds is given.
REASONS = [
    "oversize",
    "truncated",
    "bad_token",
    "unparseable_syslog",
    "bad_facility",
    "bad_syslog_timestamp",
    "unparseable_event",
    "bad_event_timestamp",
    "missing_file_field",
    "malformed_details",
    "ignored_agent",
]


def _frame_reason() -> Column:
    return F.when(F.col("oversize"), "oversize").when(F.col("truncated"), "truncated")


def parse_lines(
    df: DataFrame,
    token: str | bytes | None = None,
    max_line_size: int = lines.MAX_LINE_SIZE,
    classify: Callable[..., DataFrame] = agents.classify,
    fields: list[dict] | None = None,
) -> DataFrame:
    """Add everything a line holds, and ``reject_reason``, to a DataFrame with ``raw``.

    Rows stay rows, in place: a chain of projections without an exchange. Later
    steps see null for lines an earlier one has refused, so they cost nothing.
    ``truncated`` is taken from the input if there. ``fields`` is the table's schema,
    if it has moved on from the first one; agents are read into its ``details``.
    """
    if "truncated" not in df.columns:
        df = df.withColumn("truncated", F.lit(False))
    df = lines.mark_oversize(df, max_line_size)
    df = lines.strip_token(df, token)
    df = df.withColumn("body", F.when(_frame_reason().isNull(), F.col("body")))
    # As text the same bytes pass through the steps without a copy of them being made at each, as for BINARY.
    df = df.withColumn("raw", F.col("raw").cast("string"))
    df = lines.syslog_envelope(lines.decode(df))
    line_reason = (
        _frame_reason()
        .when(F.col("line").isNull(), "bad_token")
        .when(F.col("message").isNull(), "unparseable_syslog")
        .when(F.col("facility") >= len(lines.FACILITIES), "bad_facility")
        .when(F.col("syslog_time").isNull(), "bad_syslog_timestamp")
    )
    df = df.withColumn("reject_reason", line_reason)
    df = df.withColumn("message", F.when(F.col("reject_reason").isNull(), F.col("message")))
    df = events.event_fields(df)
    event_reason = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(~F.col("event_ok"), "unparseable_event")
        .when(F.col("timestamp").isNull(), "bad_event_timestamp")
        .when(~events.has_file_fields(), "missing_file_field")
    )
    df = df.withColumn("reject_reason", event_reason)
    df = pin(df, "ua", F.when(F.col("reject_reason").isNull(), F.col("ua")))
    df = classify(df) if fields is None else classify(df, details_type=agents.details_type(fields))
    agent_reason = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(F.col("ua_status") == agents.MALFORMED, "malformed_details")
        .when(F.col("ua_status") == agents.IGNORED, "ignored_agent")
    )
    df = pin(df, "reject_reason", agent_reason).withColumn("raw", F.col("raw").cast("binary"))
    return df.drop("body", "line", "oversize", "truncated", "event_ok")


def kept(parsed: DataFrame) -> DataFrame:
    """The rows that are downloads."""
    return parsed.where(F.col("reject_reason").isNull())


def rejected(parsed: DataFrame) -> DataFrame:
    """The rows that are not, with their reason."""
    return parsed.where(F.col("reject_reason").isNotNull())


def assemble(df: DataFrame) -> DataFrame:
    """Nest the fields of a file; every other column stays."""
    parts = ["filename", "project", "version", "type"]
    return df.withColumn("file", F.struct(*parts)).drop(*parts)


def reason_counts(parsed: DataFrame) -> DataFrame:
    """Lines per outcome; ``kept`` stands for no reason."""
    return parsed.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("lines"))


def event_date(timestamp: str = "timestamp") -> Column:
    """The UTC day of the event as ``yyyyMMdd``, whatever the session's time zone.

    Late events go to their own day.
    """
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col(timestamp)) / 86400).cast("int"))
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def downloads_per_day(parsed: DataFrame) -> DataFrame:
    """Downloads per UTC day and installer."""
    return (
        kept(parsed)
        .groupBy(event_date().alias("event_date"), F.col("details.installer.name").alias("installer"))
        .agg(F.count("*").alias("downloads"))
    )

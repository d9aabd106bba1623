"""Fit rows to the table: unknown fields out, invalid rows aside."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.schema import DOWNLOADS, required_paths, to_struct


def drop_unknown(df: DataFrame, fields: list[dict] = DOWNLOADS) -> DataFrame:
    """Columns of the table by name, at any depth; others go, missing ones are null."""
    return df.to(to_struct(fields))


def missing_path(fields: list[dict] = DOWNLOADS) -> Column:
    """The first REQUIRED path that is null, or null for a valid row.

    A field below an optional record counts only where the record is there.
    """
    branches = []
    for path, optional in required_paths(fields):
        missing = F.col(path).isNull()
        if optional is not None:
            missing = missing & F.col(optional).isNotNull()
        branches.append((missing, path))
    if not branches:
        return F.lit(None).cast("string")
    return functools.reduce(lambda chain, b: chain.when(*b), branches[1:], F.when(*branches[0]))


def skip_invalid(df: DataFrame, fields: list[dict] = DOWNLOADS) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with the path at fault in ``missing``."""
    checked = df.withColumn("missing", missing_path(fields))
    return checked.where(F.col("missing").isNull()).drop("missing"), checked.where(F.col("missing").isNotNull())


def audit(df: DataFrame, fields: list[dict] = DOWNLOADS) -> DataFrame:
    """Rows and nulls per REQUIRED path, in one aggregation over the table."""
    checks = []
    for path, optional in required_paths(fields):
        null = F.col(path).isNull()
        if optional is not None:
            null = null & F.col(optional).isNotNull()
        checks.append((path, F.count_if(null)))
    total = F.count("*")
    one_row = df.agg(
        F.array(*[F.struct(F.lit(p).alias("path"), total.alias("rows"), n.alias("nulls")) for p, n in checks]).alias("a")
    )
    return one_row.select(F.inline("a"))


def json_row(columns: list[str]) -> Column:
    """Columns as a JSON document, the time as epoch seconds with fraction."""
    return F.to_json(F.struct(*[F.col(c).cast("double").alias(c) if c == "timestamp" else F.col(c) for c in columns]))


def epoch_rows(df: DataFrame) -> DataFrame:
    """Rows as JSON documents, times as epoch seconds with fraction."""
    return df.select(F.col("timestamp").cast("double").alias("timestamp"), json_row(df.columns).alias("json"))

"""Schema changes: find what a change would break, then make it.

Fields are compared by position, records field by field. Columns can be added at
the end if they are NULLABLE or REPEATED, and REQUIRED can become NULLABLE;
everything else is refused. The comparison is a job over rows of fields, so the
schemas of all stored batches are checked the way two single schemas are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.plans.table import note, current_fields, declare_fields, read_downloads, stored_notes
from tallyline.schema import DOWNLOADS, NULLABLE, REPEATED, REQUIRED, field_rows
from tallyline.session import store

_FIELD_ROW = "position array<int>, parent string, name string, type string, mode string"


class SchemaChangeError(ValueError):
    """A change the table cannot take."""


def _with_part(fields: list[dict], part: str) -> list[tuple]:
    return [(part, *row) for row in field_rows(fields)]


def declared(spark: SparkSession, fields: list[dict], part: str = "table") -> DataFrame:
    """The fields of one schema as rows."""
    return spark.createDataFrame(_with_part(fields, part), f"part string, {_FIELD_ROW}")


def stored_fields(spark: SparkSession, root: str) -> DataFrame:
    """The fields of every stored schema as rows, one ``part`` (writer, batch, day) per folder of rows.

    Writers record the schema of each folder beside the data, and compacting and rewriting keep
    the records up to date; no data file is opened.
    """
    part = F.concat_ws("/", "writer", F.col("batch_id").cast("string"), "event_date").alias("part")
    notes = stored_notes(spark, root).select(part, F.col("fields").alias("value"))
    return notes.mapInPandas(_flatten, f"part string, {_FIELD_ROW}")


def drift_report(spark: SparkSession, root: str) -> DataFrame:
    """``event_date, writer, batch_id, path, rule``: where stored rows do not fit the table's schema."""
    delta = schema_delta(stored_fields(spark, root), current_fields(spark, root) or DOWNLOADS)
    at = F.split("part", "/")
    return delta.select(
        F.get(at, F.lit(2)).alias("event_date"), F.get(at, F.lit(0)).alias("writer"), F.get(at, F.lit(1)).cast("bigint").alias("batch_id"), "path", "rule"
    )


def _flatten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["part", "position", "parent", "name", "type", "mode"]
    for notes in batches:
        rows = [row for part, text in zip(notes["part"], notes["value"]) for row in _with_part(json.loads(text), part)]
        yield pd.DataFrame(rows, columns=columns)


def schema_delta(existing: DataFrame, desired: list[dict]) -> DataFrame:
    """What stands against the change, per part: ``path``, ``position``, ``rule``.

    ``existing`` has one row per field and part. The desired fields, a list as
    long as the schema, are attached to every part by a generator. Below a field
    that is itself refused, added or removed nothing is compared.
    """
    wanted = F.array(
        *[
            F.struct(
                F.array(*map(F.lit, position)).cast("array<int>").alias("position"),
                F.lit(parent).alias("new_parent"),
                F.lit(name).alias("new_name"),
                F.lit(type_).alias("new_type"),
                F.lit(mode).alias("new_mode"),
            )
            for position, parent, name, type_, mode in field_rows(desired)
        ]
    )
    parts = existing.select("part").distinct().select("part", F.inline(wanted))
    pairs = existing.join(parts, ["part", "position"], "full")
    in_place = F.col("name").isNotNull() & F.col("new_name").isNotNull()
    relaxed = (F.col("mode") == REQUIRED) & (F.col("new_mode") == NULLABLE)
    rule = (
        F.when(F.col("new_name").isNull(), "removed")
        .when(F.col("name").isNull(), F.when(~F.col("new_mode").isin(NULLABLE, REPEATED), "added_required"))
        .when(F.col("name") != F.col("new_name"), "renamed")
        .when(F.col("type") != F.col("new_type"), "type_changed")
        .when((F.col("mode") != F.col("new_mode")) & ~relaxed, "mode_changed")
    )
    pairs = pairs.withColumn("rule", rule).withColumn(
        "path", F.concat(F.coalesce("parent", "new_parent"), F.coalesce("name", "new_name"))
    )
    closed = pairs.where(~in_place | F.col("rule").isin("renamed", "type_changed")).select(
        "part", F.col("position").alias("above")
    )
    faults = pairs.where(F.col("rule").isNotNull()).select("part", "path", "position", "rule")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size("position") - 1), lambda n: F.slice("position", 1, n)
    )
    below = (
        faults.select("part", "position", F.explode(prefixes).alias("above"))
        .join(closed, ["part", "above"], "left_semi")
        .select("part", "position")
        .distinct()
    )
    return faults.join(below, ["part", "position"], "left_anti")


def check_change(spark: SparkSession, existing: list[dict], desired: list[dict]) -> None:
    """Raise for the first thing that stands against the change."""
    fault = schema_delta(declared(spark, existing), desired).orderBy("position").first()
    if fault is not None:
        raise SchemaChangeError(f"column {fault['path']!r}: {fault['rule']}")


def evolve(spark: SparkSession, root: str, desired: list[dict]) -> None:
    """Check the change against the declared schema, then declare the new one.

    Stored files stay as they are: reading in the new schema yields null for what
    they lack, at any depth. That makes a change as quick on a large table as on
    a small one. An undeclared table simply gets the schema.
    """
    existing = current_fields(spark, root)
    if existing is not None:
        check_change(spark, existing, desired)
    if existing != desired:
        declare_fields(spark, root, desired)


def rewrite_days(spark: SparkSession, root: str, days: list[str], writer: str, batch_id: int) -> None:
    """Write stored days of one batch out again in the current schema, and record it.

    For files that other readers must find in the current form. The days are
    replaced folder by folder; run it while that batch is not written.
    """
    mine = (F.col("writer") == writer) & (F.col("batch_id") == batch_id) & F.col("event_date").isin(days)
    copy = store(read_downloads(spark, root).where(mine), "rewrite")
    copy.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "event_date", "writer", "batch_id"
    ).parquet(f"{root}/downloads")
    notes = stored_notes(spark, root).where((F.col("writer") == writer) & (F.col("batch_id") == batch_id)).collect()
    fields = current_fields(spark, root) or DOWNLOADS
    known = {row.event_date: json.loads(row.fields) for row in notes}
    note(spark, root, writer, batch_id, {day: fields if day in days else old for day, old in known.items()})

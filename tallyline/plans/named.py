"""The table by name: registered in the session's catalog, with the modes of its fields as comments."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tallyline.plans.evolve import check_change
from tallyline.plans.table import current_fields, declare_fields
from tallyline.schema import DOWNLOADS, NULLABLE, from_struct, to_struct

_BESIDE = ["row_id", "event_date", "writer", "batch_id"]


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _with_modes(struct: T.StructType) -> str:
    """Columns as DDL; a catalog's columns are all nullable, so the mode of a field is its comment."""

    def kind(type_: T.DataType) -> str:
        if isinstance(type_, T.StructType):
            return "STRUCT<" + ", ".join(f"`{f.name}`: {kind(f.dataType)} COMMENT '{f.metadata['mode']}'" for f in type_.fields) + ">"
        if isinstance(type_, T.ArrayType):
            return f"ARRAY<{kind(type_.elementType)}>"
        return type_.simpleString()

    return ", ".join(f"`{f.name}` {kind(f.dataType)} COMMENT '{f.metadata['mode']}'" for f in struct.fields)


def registered_fields(spark: SparkSession, name: str) -> list[dict]:
    """The fields of a registered table, their modes read back from the comments."""

    def moded(type_: T.DataType) -> T.DataType:
        if isinstance(type_, T.StructType):
            fields = [(f.name, moded(f.dataType), (f.metadata or {}).get("comment", NULLABLE)) for f in type_.fields]
            return T.StructType([T.StructField(field, kind, True, {"mode": mode}) for field, kind, mode in fields])
        return T.ArrayType(moded(type_.elementType)) if isinstance(type_, T.ArrayType) else type_

    columns = [f for f in spark.table(name).schema.fields if f.name not in _BESIDE]
    return from_struct(moded(T.StructType(columns)))


def register(spark: SparkSession, name: str, root: str, fields: list[dict] | None = None) -> None:
    """Create the table of a name over a root, or load it; SQL then sees the rows and prunes days.

    An absent table is created in the wanted schema (what is declared for the root, unless given),
    which is declared for a root that has none. One that is there takes new columns at its end; any
    other difference is refused with an error, as is another root.
    """
    fields = fields or current_fields(spark, root) or DOWNLOADS
    declared = current_fields(spark, root)
    if declared is None:
        declare_fields(spark, root, fields)
    elif declared != fields:
        check_change(spark, declared, fields)
        declare_fields(spark, root, fields)
    location = f"{root}/downloads"
    folder = spark._jvm.org.apache.hadoop.fs.Path(location)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    if not spark.catalog.tableExists(name):
        columns = _with_modes(to_struct(fields))
        spark.sql(
            f"CREATE TABLE {_quoted(name)} ({columns}, `row_id` STRING, `event_date` STRING, `writer` STRING, `batch_id` BIGINT) "
            f"USING parquet PARTITIONED BY (event_date, writer, batch_id) LOCATION '{location}'"
        )
    else:
        about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").collect()}
        here = folder.toUri().getPath()
        if spark._jvm.org.apache.hadoop.fs.Path(about["Location"]).toUri().getPath() != here:
            raise ValueError(f"table {name!r} is at {about['Location']}")
        known = registered_fields(spark, name)
        check_change(spark, known, fields)
        if known != fields:
            spark.sql(f"DROP TABLE {_quoted(name)}")  # of a table with a location the catalog forgets the name only
            return register(spark, name, root, fields)
    refresh(spark, name)


def refresh(spark: SparkSession, name: str) -> None:
    """Make the catalog see the folders that were written or deleted since."""
    if _keeps_partitions(spark, name):
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def _keeps_partitions(spark: SparkSession, name: str) -> bool:
    return any(r.col_name == "Partition Provider" for r in spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").collect())

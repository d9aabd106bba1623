"""The downloads table: its fields, and their Spark form.

A field is a dict with ``name``, ``type``, ``mode`` and, for records, ``fields``.
In Spark every column is nullable, since the rows of a batch are checked before
they are stored; the mode travels as column metadata and so ends up in the footer
of every stored file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import types as T

REQUIRED, NULLABLE, REPEATED = "REQUIRED", "NULLABLE", "REPEATED"


def _field(name: str, type_: str = "STRING", mode: str = NULLABLE, fields: list | None = None) -> dict:
    made = {"name": name, "type": type_, "mode": mode}
    if fields is not None:
        made["fields"] = fields
    return made


def _record(name: str, *fields: dict, mode: str = NULLABLE) -> dict:
    return _field(name, "RECORD", mode, list(fields))


# Names, order, types and modes of the target table.
DOWNLOADS = [
    _field("timestamp", "TIMESTAMP", REQUIRED),
    _field("country_code"),
    _field("url", mode=REQUIRED),
    _record(
        "file",
        _field("filename", mode=REQUIRED),
        _field("project", mode=REQUIRED),
        _field("version", mode=REQUIRED),
        _field("type", mode=REQUIRED),
        mode=REQUIRED,
    ),
    _record(
        "details",
        _record("installer", _field("name"), _field("version")),
        _field("python"),
        _record("implementation", _field("name"), _field("version")),
        _record(
            "distro",
            _field("name"),
            _field("version"),
            _field("id"),
            _record("libc", _field("lib"), _field("version")),
        ),
        _record("system", _field("name"), _field("release")),
        _field("cpu"),
        _field("openssl_version"),
        _field("setuptools_version"),
    ),
    _field("tls_protocol"),
    _field("tls_cipher"),
]

_SPARK_TYPES = {
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATETIME": T.TimestampNTZType(),
    "DATE": T.DateType(),
    "NUMERIC": T.DecimalType(38, 9),
}
_FIELD_TYPES = {spark_type.simpleString(): name for name, spark_type in _SPARK_TYPES.items()}


def fields_from_json(text: str) -> list[dict]:
    """Fields from a JSON schema file."""
    return json.loads(text)


def to_struct(fields: list[dict]) -> T.StructType:
    """Fields as a Spark struct, all nullable, with the mode as metadata."""

    def column(field: dict) -> T.StructField:
        kind = to_struct(field["fields"]) if field["type"] == "RECORD" else _SPARK_TYPES[field["type"]]
        if field["mode"] == REPEATED:
            kind = T.ArrayType(kind)
        return T.StructField(field["name"], kind, True, {"mode": field["mode"]})

    return T.StructType([column(field) for field in fields])


def from_struct(struct: T.StructType) -> list[dict]:
    """The reverse of :func:`to_struct`; a column without a mode is NULLABLE."""

    def field(column: T.StructField) -> dict:
        kind, mode = column.dataType, column.metadata.get("mode", NULLABLE)
        if isinstance(kind, T.ArrayType):
            kind, mode = kind.elementType, REPEATED
        if isinstance(kind, T.StructType):
            return _field(column.name, "RECORD", mode, from_struct(kind))
        return _field(column.name, _FIELD_TYPES.get(kind.simpleString(), kind.simpleString().upper()), mode)

    return [field(column) for column in struct.fields]


def field_rows(fields: list[dict], at: tuple[int, ...] = (), parent: str = "") -> Iterator[tuple]:
    """One row ``(position, parent, name, type, mode)`` per field, at any depth.

    ``position`` is the path of ordinals from the top, so rows sort as declared.
    """
    for ordinal, field in enumerate(fields):
        here = (*at, ordinal)
        yield list(here), parent, field["name"], field["type"], field["mode"]
        if field["type"] == "RECORD":
            yield from field_rows(field["fields"], here, f"{parent}{field['name']}.")


def required_paths(fields: list[dict]) -> list[tuple[str, str | None]]:
    """REQUIRED paths, each with the nearest optional record above it, if any."""
    found: list[tuple[str, str | None]] = []

    def visit(level: list[dict], prefix: str, optional: str | None) -> None:
        for field in level:
            path = prefix + field["name"]
            if field["mode"] == REQUIRED:
                found.append((path, optional))
            if field["type"] == "RECORD" and field["mode"] != REPEATED:
                visit(field["fields"], path + ".", optional if field["mode"] == REQUIRED else path)

    visit(fields, "", None)
    return found

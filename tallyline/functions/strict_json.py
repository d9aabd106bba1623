"""Strict JSON on top of Spark's lenient parser.

``from_json`` stops at the end of the first value, so text behind it goes
unnoticed. Two devices close that gap without Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}
_EMPTY_OBJECT = r"^\{[ \t\r\n]*\}\z"


def is_strict_json(text: Column) -> Column:
    """True where the text is exactly one JSON value.

    The text has to fit both as the only member of an object and as the only
    element of an array; text that closes one bracket early breaks the other.
    """
    as_member = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), "x string, _bad string", _OPTIONS)
    as_element = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _OPTIONS)
    return as_member["_bad"].isNull() & F.coalesce(F.size(as_element) == 1, F.lit(False))


def seal(text: Column) -> Column:
    """A value that the text itself cannot contain in advance."""
    return F.xxhash64(text).cast("string")


def parse_sealed_object(text: Column, schema: T.StructType) -> Column:
    """Parse an object once, checking strictness in the same pass.

    The closing brace is replaced by one more member that carries the seal. If
    the seal comes back, the parser has reached the very end of the text inside
    the one object, hence nothing stands behind it. The result has the fields of
    ``schema`` plus ``_seal`` and ``_bad``; see :func:`object_is_intact`.
    """
    member = F.concat(F.lit('"_seal":"'), seal(text), F.lit('"}'))
    sealed = F.when(text.rlike(_EMPTY_OBJECT), F.concat(F.lit("{"), member)).when(
        F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}")),
        F.concat(F.left(text, F.length(text) - 1), F.lit(","), member),
    )
    wide = T.StructType([*schema.fields, T.StructField("_seal", T.StringType()), T.StructField("_bad", T.StringType())])
    return F.from_json(sealed, wide, _OPTIONS)


def object_is_intact(parsed: Column, text: Column) -> Column:
    """Whether :func:`parse_sealed_object` read a strict object of the right shape."""
    return F.coalesce((parsed["_seal"] == seal(text)) & parsed["_bad"].isNull(), F.lit(False))

"""The download event inside a syslog message.

Two pipe-separated layouts exist. One regular expression checks a whole event,
one split takes it apart; the user agent comes last and may hold any character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import BLANKS
from tallyline.operators.pin import pin

# The package types.
PACKAGE_TYPES = [
    "sdist",
    "bdist_wheel",
    "bdist_dmg",
    "bdist_dumb",
    "bdist_egg",
    "bdist_msi",
    "bdist_rpm",
    "bdist_wininst",
]
NULL_TOKEN = "(null)"

# Printable ASCII, blank and tab, without "@" and "|".
_FIELD = r"[ -?A-{}~\t]+"
_OPTIONAL = r"[ -?A-{}~\t]*"
# The null token is taken first and never given back, so "(null)x" fits neither.
_OR_NULL = rf"(?>\(null\)|{_FIELD})"
_TYPE = rf"(?:\(null\)|{'|'.join(PACKAGE_TYPES)})"

_LAYOUT_1 = "^(?:1@)?" + r"\|".join([_FIELD, _OPTIONAL, _FIELD, _OR_NULL, _OR_NULL, _TYPE]) + r"\|"
_LAYOUT_2 = (
    "^2@" + r"\|".join([_FIELD, _OPTIONAL, _FIELD, _OR_NULL, _OR_NULL, _OR_NULL, _OR_NULL, _TYPE]) + r"\|"
)

_DAY_MONTH_TIME = (
    r"(?i)^[0-9]{2} (?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec) [0-9]{4} "
    r"[0-9]{2}:[0-9]{2}:[0-9]{2}\z"
)
_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"


def event_time(text: Column) -> Column:
    """``Fri, 20 Jul 2018 02:19:19 GMT`` to a timestamp; null if there is none.

    Weekday and zone are cut off unseen. The rest is put into ISO order, because
    a cast reads that several times faster than a pattern does.
    """
    middle = F.substr(text, F.lit(6), F.greatest(F.length(text) - 9, F.lit(0)))
    part = lambda start, size: F.substring(middle, start, size)
    month = F.floor((F.position(F.upper(part(4, 3)), F.lit(_MONTHS)) + 2) / 3).cast("string")
    iso = F.concat(
        part(8, 4), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), part(1, 2), F.lit("T"), part(13, 8), F.lit("Z")
    )
    return F.when(middle.rlike(_DAY_MONTH_TIME), iso).try_cast("timestamp")


def split_event(df: DataFrame) -> DataFrame:
    """Add ``event_ok`` and ``_parts``: which layout fits, and its fields.

    Blanks before the event do not count. A text that starts like layout 2 can
    never fit layout 1, whose alphabet has no ``@``.
    """
    event = F.ltrim("message", F.lit(BLANKS))
    return (
        pin(df, "_event", event)
        .withColumn("_is_2", F.startswith("_event", F.lit("2@")))
        .withColumn(
            "event_ok",
            F.coalesce(
                F.when(F.col("_is_2"), F.col("_event").rlike(_LAYOUT_2)).otherwise(
                    F.col("_event").rlike(_LAYOUT_1)
                ),
                F.lit(False),
            ),
        )
        .withColumn(
            "_parts",
            F.when(
                F.col("event_ok"),
                F.when(F.col("_is_2"), F.split("_event", r"\|", 9)).otherwise(F.split("_event", r"\|", 7)),
            ),
        )
        .drop("_event")
    )


def event_fields(df: DataFrame) -> DataFrame:
    """Add the event's columns from ``message``; null where it does not parse."""
    part = lambda n: F.get("_parts", F.lit(n))
    or_null = lambda text: F.nullif(text, F.lit(NULL_TOKEN))
    # Layout 2 has two more fields before the project.
    behind_tls = lambda n: F.when(F.col("_is_2"), part(n + 2)).otherwise(part(n))
    tls = lambda n: or_null(F.when(F.col("_is_2"), part(n)))
    headless = F.when(
        F.startswith(part(0), F.lit("2@")) | F.startswith(part(0), F.lit("1@")), F.substring(part(0), 3, 2**31 - 1)
    ).otherwise(part(0))
    return (
        split_event(df)
        .withColumns(
            {
                "event_version": F.when(F.col("event_ok"), F.when(F.col("_is_2"), 2).otherwise(1)),
                "timestamp": event_time(headless),
                "country_code": F.nullif(part(1), F.lit("")),
                "url": part(2),
                "filename": F.substring_index(part(2), "/", -1),
                "tls_protocol": tls(3),
                "tls_cipher": tls(4),
                "project": or_null(behind_tls(3)),
                "version": or_null(behind_tls(4)),
                "type": or_null(behind_tls(5)),
                "ua": behind_tls(6),
            }
        )
        .drop("_parts", "_is_2")
    )


def has_file_fields() -> Column:
    """Project, version and a known package type are all there."""
    known = F.coalesce(F.col("type").isin(PACKAGE_TYPES), F.lit(False))
    return F.col("project").isNotNull() & F.col("version").isNotNull() & known

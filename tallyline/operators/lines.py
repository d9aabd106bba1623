"""Raw lines: size, token, decoding and the syslog envelope.

Input is a DataFrame with a BINARY column ``raw``, one line without its line end
per row. Every operator adds columns and keeps all rows; a line that fails a
step has null from there on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import BLANKS, expand_tabs, utf8_repair
from tallyline.operators.pin import pin

MAX_LINE_SIZE = 16384

# Code names of the syslog protocol, by code.
FACILITIES = [
    "kernel", "user", "mail", "daemon", "auth", "syslog", "lpr", "news",
    "uucp", "clock", "authpriv", "ftp", "ntp", "audit", "alert", "cron",
    "local0", "local1", "local2", "local3", "local4", "local5", "local6", "local7",
]
SEVERITIES = [
    "emergency", "alert", "critical", "error", "warning", "notice", "informational", "debug",
]

_PRIORITY_AND_TIME = r"^<[0-9]{1,3}>[!-~]+\z"
_HOSTNAME = r"^[!-~]+\z"
# Printable ASCII without "[", then without "]".
_APP_AND_PROCESS = r"^[!-Z\\-~]+\[[!-\\^-~]+\]:\z"
_ISO_TIME = (
    r"^<[0-9]{1,3}>([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?)[0-9]*"
    r"(?:Z|[+-][0-9]{2}:[0-9]{2})?\z"
)


def mark_oversize(df: DataFrame, max_line_size: int = MAX_LINE_SIZE) -> DataFrame:
    """Add ``oversize``: the line, its line end counted, is over the limit."""
    return df.withColumn("oversize", F.octet_length("raw") + 1 > max_line_size)


def strip_token(df: DataFrame, token: str | bytes | None = None) -> DataFrame:
    """Add ``body``: the bytes behind the token, null where the token is wrong.

    Works on bytes, before decoding can change any of them.
    """
    if not token:
        return df.withColumn("body", F.col("raw"))
    token = token.encode() if isinstance(token, str) else bytes(token)
    return df.withColumn(
        "body",
        F.when(
            F.startswith("raw", F.lit(token)),
            F.substring("raw", len(token) + 1, 2**31 - 1),
        ),
    )


def decode(df: DataFrame) -> DataFrame:
    """Add ``line``: ``body`` as valid text with tabs expanded."""
    df = df.withColumn("_text", utf8_repair(F.col("body")))
    return pin(df, "line", expand_tabs(F.col("_text"))).drop("_text")


def syslog_envelope(df: DataFrame) -> DataFrame:
    """Add ``priority``, ``facility``, ``severity``, ``syslog_time``, ``hostname``,
    ``appname``, ``procid`` and ``message`` from ``line``.

    No token of the header holds a blank, so one split at the first three blanks
    yields all of them; the checks then run on short texts.
    """
    token = lambda n: F.get("_tokens", F.lit(n))
    after = F.substring_index("_rest", "\n", 1)
    return (
        df.withColumn("_tokens", F.split("line", " ", 4))
        .withColumn(
            "_rest",
            F.when(
                token(0).rlike(_PRIORITY_AND_TIME)
                & token(1).rlike(_HOSTNAME)
                & token(2).rlike(_APP_AND_PROCESS),
                token(3),
            ),
        )
        # Only blanks may follow a line end.
        .withColumn(
            "message",
            F.when(~F.contains("_rest", F.lit("\n")), F.col("_rest")).when(
                F.rtrim("_rest", F.lit(BLANKS)) == F.rtrim(after, F.lit(BLANKS)), after
            ),
        )
        .withColumn(
            "priority",
            F.when(
                F.col("message").isNotNull(),
                F.substring_index(F.substring(token(0), 2, 4), ">", 1).try_cast("int"),
            ),
        )
        .withColumns(
            {
                "facility": F.shiftright("priority", 3),
                "severity": F.col("priority").bitwiseAND(7),
                "syslog_time": _syslog_time(token(0)),
                "hostname": F.when(F.col("message").isNotNull(), F.nullif(token(1), F.lit("-"))),
                "appname": F.when(F.col("message").isNotNull(), F.substring_index(token(2), "[", 1)),
                # From the first "[", which the application cannot hold, to the "]:" at the end.
                "procid": F.when(
                    F.col("message").isNotNull(),
                    F.substr(token(2), F.instr(token(2), "[") + 1, F.length(token(2)) - F.instr(token(2), "[") - 2),
                ),
            }
        )
        .drop("_tokens", "_rest")
    )


def _syslog_time(priority_and_time: Column) -> Column:
    """Wall clock of an ISO 8601 time; the offset is dropped."""
    iso = F.regexp_extract(priority_and_time, _ISO_TIME, 1)
    return F.when(F.col("message").isNotNull(), iso).try_cast("timestamp_ntz")


def label_codes(df: DataFrame) -> DataFrame:
    """Add ``facility_name`` and ``severity_name`` for the codes."""
    name = lambda names, code: F.get(F.array(*map(F.lit, names)), F.col(code))
    return df.withColumns(
        {
            "facility_name": name(FACILITIES, "facility"),
            "severity_name": name(SEVERITIES, "severity"),
        }
    )

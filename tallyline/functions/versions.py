"""Version ranges after PEP 440, as regular expressions over a version column.

Only two ranges are needed, each with pre-releases admitted but without the
pre-releases of its lower bound, so membership is a matter of text: no numbers
are parsed, and digits of any length work.
"""

from __future__ import annotations

from pyspark.sql import Column

# Fixed value: the version grammar of PEP 440 (appendix B), ASCII digits only.
PEP440 = (
    r"(?i)^\s*v?(?:[0-9]+!)?[0-9]+(?:\.[0-9]+)*"
    r"(?:[-_.]?(?:alpha|a|beta|b|preview|pre|c|rc)[-_.]?[0-9]*)?"
    r"(?:-[0-9]+|[-_.]?(?:post|rev|r)[-_.]?[0-9]*)?"
    r"(?:[-_.]?dev[-_.]?[0-9]*)?"
    r"(?:\+[a-z0-9]+(?:[-_.][a-z0-9]+)*)?\s*\z"
)
_START = r"(?i)^\s*v?"
_EPOCH_0 = r"(?:0+!)?"
_BEFORE_FINAL = r"[-_.]?(?:a|b|c|rc|pre|dev)"

# Most versions seen in practice are plain releases of 6 and up.
_PLAIN_6_UP = r"^(?:[6-9]|[1-9][0-9])(?:\.[0-9]{1,9}){0,4}\z"
_MAJOR_6_UP = _START + r"(?:0*[1-9][0-9]*!|" + _EPOCH_0 + r"0*(?:[6-9]|[1-9][0-9]+)(?![0-9!]))"
_BEFORE_6 = _START + _EPOCH_0 + r"0*6(?:\.0+)*" + _BEFORE_FINAL

_FROM_1_4_TO_5 = (
    _START + _EPOCH_0 + r"0*(?:[2-5](?![0-9!])|1\.0*(?:[4-9]|[1-9][0-9]+)(?![0-9]))"
)
_BEFORE_1_4 = _START + _EPOCH_0 + r"0*1\.0*4(?:\.0+)*" + _BEFORE_FINAL


def at_least_6(version: Column) -> Column:
    """``>=6``, pre-releases of later versions included."""
    return version.rlike(_PLAIN_6_UP) | (
        version.rlike(PEP440) & version.rlike(_MAJOR_6_UP) & ~version.rlike(_BEFORE_6)
    )


def from_1_4_below_6(version: Column) -> Column:
    """``>=1.4,<6``, pre-releases included but for those of 1.4 and 6."""
    return (
        version.rlike(PEP440)
        & version.rlike(_FROM_1_4_TO_5)
        & ~version.rlike(_BEFORE_1_4)
    )

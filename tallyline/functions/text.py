"""Text functions over columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TAB_WIDTH = 8
# What counts as blank between and after messages.
BLANKS = " \t\r\n"
# Fixed value: all characters that count as white space in Unicode text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


def utf8_repair(raw: Column) -> Column:
    """Bytes to text; every invalid sequence becomes U+FFFD."""
    return F.make_valid_utf8(raw.cast("string"))


def _fill_to_stops(segment: Column) -> Column:
    pieces = F.split(segment, "\t")
    stop = lambda done: (F.floor(F.length(done) / TAB_WIDTH) + 1).cast("int") * TAB_WIDTH
    return F.aggregate(
        F.slice(pieces, 2, F.size(pieces)),
        F.get(pieces, F.lit(0)),
        lambda done, piece: F.concat(F.rpad(done, stop(done), " "), piece),
    )


def expand_tabs(text: Column) -> Column:
    """Replace tabs by blanks up to 8-column stops; a line end restarts the column."""
    segments = F.split(text, "(?<=[\r\n])")
    return F.when(
        F.contains(text, F.lit("\t")),
        F.array_join(F.transform(segments, _fill_to_stops), ""),
    ).otherwise(text)


def regex(pattern: str, ignore_case: bool = False) -> str:
    r"""A pattern meant for Unicode text, in Spark's (Java's) dialect.

    ``(?d)`` leaves ``\n`` as the only line end, ``(?U)`` makes ``\s``, ``\d``
    cover Unicode; the four separators U+001C-U+001F count as blanks as well.
    Named groups become plain ones, with the same numbers.
    """
    flags = "(?diuU)" if ignore_case else "(?dU)"
    blanks = {r"\s": r"[\s\x1c-\x1f]", r"\S": r"[^\s\x1c-\x1f]"}
    body = re.sub(r"\\[sS]", lambda found: blanks[found[0]], pattern)
    return flags + re.sub(r"\(\?P<\w+>", "(", body)

"""Repetition inside documents, by suffix arrays over words.

The suffixes of a document are sorted by prefix doubling, many documents at once (the document
is part of a suffix's first rank, so suffixes of two documents never compare equal). Ranks of
each doubling are kept, and give the longest common prefix of neighbours without a second pass.

Every maximal repeated substring is an interval of that array whose neighbours share so many
words. The deepest interval that holds a suffix has the larger of its two neighbouring common
prefixes, so the spans of all maximal repeats of ``MIN_WORDS`` words or more together cover, for
every suffix, as many words as that. The share of covered words and the longest repeat are
limited (``MAX_COVERED``, ``MAX_LONGEST``).

Null and empty texts have no words, and fail the base rules as all texts under 50 words do.
Texts are taken whole, of any length. Rows that repeat are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of a repeat that counts, at least; as a power of two above or equal, ranks are compared.
MIN_WORDS = 10
MAX_COVERED, MAX_LONGEST = 0.2, 100
#: Words whose suffixes are sorted together, about.
TOGETHER = 60_000

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
KIND = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "covered_words:bigint,longest_repeat:bigint>"
)


def repeats(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: words in repeated windows of three, words in long repeats, the longest repeat.

    ``words`` are the numbers of the words of all documents in a row, ``sizes`` their counts.
    """
    n, docs = len(words), len(sizes)
    zero = np.zeros(docs, np.int64)
    if not n:
        return zero, zero, zero
    doc = np.repeat(np.arange(docs), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(n)
    key = doc * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = _firsts(key[order])
    levels, k = [rank], 1
    # A rank is the place of the group's first suffix; only groups of two or more are sorted on.
    while True:
        size = np.bincount(rank, minlength=n)
        active = at[size[rank] > 1]
        if not len(active):
            break
        after = active + k
        second = np.where(after < end[active], rank[np.minimum(after, n - 1)], -1)
        order = np.lexsort((second, rank[active]))
        active, second = active[order], second[order]
        group = rank[active]
        start = np.concatenate([[True], group[1:] != group[:-1]])
        place = np.arange(len(active))
        base = np.maximum.accumulate(np.where(start, place, 0))
        fresh = np.maximum.accumulate(np.where(start | np.concatenate([[True], second[1:] != second[:-1]]), place, 0))
        rank = rank.copy()
        rank[active] = group + (fresh - base)
        levels.append(rank)
        k *= 2

    # Words in windows of three that occur twice: two overlapping pairs have the same ranks.
    pair = levels[1] if len(levels) > 1 else levels[0]
    window = at[at + 2 < end]
    repeated = np.zeros(n + 1, np.int64)
    if len(levels) > 1 and len(window):
        _, inverse, count = np.unique(pair[window] * n + pair[window + 1], return_inverse=True, return_counts=True)
        twice = window[count[inverse] > 1]
        np.add.at(repeated, twice, 1)
        np.add.at(repeated, twice + 3, -1)
    in_windows = np.add.reduceat((np.cumsum(repeated[:-1]) > 0).astype(np.int64), _starts(sizes)) if n else zero

    # Common prefixes of neighbours in the suffix array, where they are long enough to matter.
    least = (MIN_WORDS).bit_length() - 1
    longest = np.zeros(n, np.int64)
    if len(levels) > least:
        array = np.argsort(rank, kind="stable")
        floor = levels[least]
        left, right = array[:-1], array[1:]
        same = floor[left] == floor[right]
        left, right = left[same], right[same]
        a, b, common = left.copy(), right.copy(), np.zeros(len(left), np.int64)
        for j in range(len(levels) - 1, -1, -1):
            ok = (a < end[left]) & (b < end[right])
            ok &= levels[j][np.minimum(a, n - 1)] == levels[j][np.minimum(b, n - 1)]
            step = np.where(ok, 1 << j, 0)
            a, b, common = a + step, b + step, common + step
        np.maximum.at(longest, left, common)
        np.maximum.at(longest, right, common)
        longest[longest < MIN_WORDS] = 0
    spans = np.zeros(n + 1, np.int64)
    long_at = np.flatnonzero(longest)
    np.add.at(spans, long_at, 1)
    np.add.at(spans, long_at + longest[long_at], -1)
    covered = (np.cumsum(spans[:-1]) > 0).astype(np.int64)
    starts, some = _starts(sizes), sizes > 0
    total, most, windows = zero.copy(), zero.copy(), zero.copy()
    total[some] = np.add.reduceat(covered, starts)
    most[some] = np.maximum.reduceat(longest, starts)
    windows[some] = in_windows
    return windows, total, most


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """For sorted keys, the place of the first of each run."""
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where the documents with words begin."""
    return (np.cumsum(sizes) - sizes)[sizes > 0]


def measure(texts: list[str | None]) -> list[np.ndarray]:
    """The columns of ``KIND`` for a list of texts."""
    numbers: dict[bytes, int] = {}
    words, sizes, chars, symbols, lines = [], [], [], [], []
    for t in texts:
        t = t or ""
        data = t.encode()
        found = data.split()  # of bytes: exactly the six white spaces
        sizes.append(len(found))
        words += [numbers.setdefault(w, len(numbers)) for w in found]
        chars.append(len(t) - sum(map(t.count, SPACES)))
        symbols.append(sum(map(t.count, SYMBOLS)))
        with_word = [x for x in data.split(b"\n") if x.strip()]
        lines.append(len(with_word) - len(set(with_word)))
    sizes = np.array(sizes, np.int64)
    return [sizes, np.array(chars), np.array(symbols), np.array(lines), *repeats(np.array(words, np.int64), sizes)]


def _parts(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts in groups of about ``TOGETHER`` words."""
    group, held = [], 0
    for t in texts:
        group.append(t.as_py())
        held += len(group[-1] or "")
        if held > TOGETHER * 6:
            yield group
            group, held = [], 0
    yield group


def measures(text: Column | str) -> Column:
    """The counts of a text, as a struct."""
    names = [part.split(":")[0] for part in KIND[7:-1].split(",")]

    @F.arrow_udf(KIND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*map(measure, _parts(texts)))]
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns], names=names)

    return run(text)


def verdict(m: str, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> tuple[Column, Column]:
    """``base_failed`` and ``kept`` from a column of measures."""
    words = F.col(f"{m}.n_words")
    failed = (words < 50) | (100 * F.col(f"{m}.n_repeat_words") > 50 * words)
    limited = (F.col(f"{m}.covered_words") <= max_covered * words) & (F.col(f"{m}.longest_repeat") <= max_longest)
    return failed, ~failed & limited

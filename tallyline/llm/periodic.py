"""Runs of words that repeat with a period, by seeds extended along diagonals.

A run is a stretch of words with smallest period q, of at least ``LEAST_WORDS`` words and
``LEAST_TIMES`` periods, that cannot be made longer. Its words agree with those q further on at
``max(LEAST_WORDS - q, 3 * q)`` places in a row at least, 5 for q = 1. Periods are taken in steps of
three: those up to 5, then 6 to 15, 16 to 45 and so on. All runs of a step have a k-gram, k being
the step's largest period, at two places one period apart. These k-grams are indexed, and pairs of
neighbouring occurrences in a document are the seeds. Neighbours are enough, so a word that fills a
text costs one pair a place and not all pairs: with k of at least the period, an occurrence less than
a period away would make the period of the run smaller. For the same reason a seed's lag is the
smallest period of its run.

Seeds are taken from left to right; a table holds for each lag how far its diagonal is covered, and
only a seed beyond that is extended, both ways, so no stretch is walked twice.

K-grams are named exactly, by pairs of the names of their halves (no hashes); a k-gram that occurs
once loses its name, so the longer steps cost little. Many documents are worked on together: words
are numbered per document, so no k-gram is shared by two. Null and empty texts have no words and no
runs. Texts are taken whole, of any length; repeated rows get the same result; only the text is read,
so the names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST_WORDS, LEAST_TIMES = 6, 4
#: Length of the first k-grams: what a run of period 1 guarantees.
SEED = LEAST_WORDS - 1
#: Words that are worked on together, about.
TOGETHER = 100_000

KIND = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names for the pairs of two names at each place, -1 where a pair occurs once or lacks a name."""
    names = np.full(len(left), -1, np.int64)
    at = np.flatnonzero((left >= 0) & (right >= 0))
    if len(at):
        key = left[at] * (int(right.max()) + 1) + right[at]
        _, name, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[name] > 1
        names[at[again]] = name[again]
    return names


def _later(names: np.ndarray, by: int) -> np.ndarray:
    """The name that stands ``by`` places further on."""
    out = np.full(len(names), -1, np.int64)
    if by < len(names):
        out[: len(names) - by] = names[by:]
    return out


def _seeds(names: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of neighbouring occurrences whose lag is in a step, from left to right."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    lag = at[1:] - at[:-1]
    good = (names[at[1:]] == names[at[:-1]]) & (lag >= low) & (lag <= high)
    place, lag = at[:-1][good], lag[good]
    order = np.argsort(place)
    return place[order], lag[order]


def _reach(words: np.ndarray, end: int, lag: int) -> int:
    """The first place from ``end`` on where a word differs from the one ``lag`` further on."""
    last, step = len(words) - lag, 64
    while end < last:
        stop = min(last, end + step)
        different = words[end:stop] != words[end + lag : stop + lag]
        if different.any():
            return end + int(different.argmax())
        end, step = stop, 2 * step
    return max(end, 0)


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, length, period`` of all runs, by start, then period; ``words`` are numbers."""
    found: list[tuple[int, int, int]] = []
    pairs = _joined(words, _later(words, 1))
    fours = _joined(pairs, _later(pairs, 2))
    names, low, k = _joined(fours, _later(fours, 1)), 1, SEED
    while (names >= 0).any():
        covered: dict[int, int] = {}
        for place, lag in zip(*(x.tolist() for x in _seeds(names, low, k))):
            if place < covered.get(lag, 0):
                continue
            start = place
            while start > 0 and words[start - 1] == words[start - 1 + lag]:
                start -= 1
            end = covered[lag] = _reach(words, place + k, lag)
            if (length := end - start + lag) >= max(LEAST_WORDS, LEAST_TIMES * lag):
                found.append((start, length, lag))
        twice = _joined(names, _later(names, k))
        names, low, k = _joined(twice, _later(names, 2 * k)), k + 1, 3 * k
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """For each text its number of words, its runs, and the words left without what they repeat."""
    words, ids = [], []
    held = 0
    for text in texts:
        found = (text or "").encode().split()  # of bytes: exactly the six white spaces
        known: dict[bytes, int] = {}
        ids.append(np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, len(found)) + held)
        words.append(found)
        held += len(known)
    sizes = np.array([len(x) for x in words], np.int64)
    ends = np.cumsum(sizes)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    if held:
        found_runs = find_runs(np.concatenate(ids))
        owners = np.searchsorted(ends, [run[0] for run in found_runs], side="right").tolist()
        for (start, length, period), doc in zip(found_runs, owners):
            runs[doc].append((start - int(ends[doc] - sizes[doc]), length, period))
    for found, own in zip(words, runs):
        gone = np.zeros(len(found) + 1, np.int64)
        for start, length, period in own:
            gone[start + period] += 1
            gone[start + length] -= 1
        kept = found if not own else [w for w, over in zip(found, np.cumsum(gone).tolist()) if not over]
        yield len(found), own, b" ".join(kept).decode()


def _parts(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts in groups of about ``TOGETHER`` words."""
    group, held = [], 0
    for text in texts:
        group.append(text.as_py())
        held += len(group[-1] or "")
        if held > TOGETHER * 6:
            yield group
            group, held = [], 0
    yield group


def periodic(text: Column | str) -> Column:
    """The runs of a text and the text without their repeats, as a struct."""
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    @F.arrow_udf(KIND)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            counts, texts_left, flat, sizes = [], [], [], []
            for part in _parts(texts):
                for n, runs, left in collapse(part):
                    counts.append(n)
                    texts_left.append(left)
                    flat += runs
                    sizes.append(len(runs))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            columns = np.array(flat, np.int64).reshape(-1, 3).T
            items = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(run_type))
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), items), pa.array(texts_left, pa.string())],
                names=["n_words", "runs", "collapsed"],
            )

    return run(text)


def longest(runs: Column) -> Column:
    """The run of the greatest length, then of the smallest start and period; null without a run."""
    ranked = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    )
    first = F.array_min(ranked)
    return F.when(
        F.size(runs) > 0,
        F.struct(first["start"].alias("start"), (-first["less"]).alias("length"), first["period"].alias("period")),
    )


def listed(runs: Column) -> Column:
    """All runs as lines of ``start,length,period``, each with its line feed."""
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    return F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")

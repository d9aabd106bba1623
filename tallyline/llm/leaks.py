"""Benchmark decontamination: a BM25 index of test items, queried with every training passage.

The index holds the postings of the test items. The impact of a term on an item is its BM25
weight divided by what the whole item scores against itself, so 1 is an item quoted in full and
one threshold serves all items. Postings are ordered by item and cut into blocks with the
largest impact of each; retrieval is block-max WAND and returns every item at or above the
threshold. Passages are windows of twice the longest item of a length class, one such length
apart, so that a quotation lies whole in one of them; they cover the whole text.

Before its passages are searched, a document is bounded as a whole: each item lists its rarest
terms, what the rest of the item could add at most, and an item is a candidate only if the two
can reach the threshold. Passages are bounded in the same way by their own terms. The bound is
never below a passage's score, so nothing is lost by it.

Retrieved items are verified by word shingles of five. The question is the item up to its last
sentence (the last quarter of an item of one sentence), the answer the rest. An item leaks if
at least 0.8 of all its shingles are in the passage, and at least half of those of the question
and half of those that touch the answer.

Words are lower case, without ASCII punctuation. Items come in blocks of at most
``ITEMS_PER_BLOCK``, each broadcast in turn, while document frequencies count all items. Null,
empty and unmatched texts have no leaks; items without a word match nothing; items that repeat
are reported each; a null item id is reported as null.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items of an index: it is broadcast, so it needs a bound; further items go into further indexes.
ITEMS_PER_BLOCK = 20_000
THRESHOLD = 0.5
SHINGLE, OVERLAP, PART = 5, 0.8, 0.5
K1, B = 1.2, 0.75
POSTINGS_PER_BLOCK = 16
#: Share of an item's own score that its listed rare terms hold at least.
RARE = 0.8

LOWER = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(LOWER).split()


def _answer_at(text: str, count: int) -> int:
    """Words before the answer."""
    body = text.rstrip()
    cut = max(body.rfind(mark, 0, max(0, len(body) - 1)) for mark in (". ", "? ", "! ", ".\n", "?\n", "!\n", "\n"))
    before = len(words_of(body[: cut + 1])) if cut >= 0 else 0
    return before if 0 < before < count else count - max(1, count // 4)


@dataclass
class Postings:
    """One term's items in order, their impacts, and the largest impact of each block."""

    items: list[int] = field(default_factory=list)
    impacts: list[float] = field(default_factory=list)
    block_max: list[float] = field(default_factory=list)
    most: float = 0.0

    def close(self) -> None:
        step = POSTINGS_PER_BLOCK
        self.block_max = [max(self.impacts[i : i + step]) for i in range(0, len(self.items), step)]
        self.most = max(self.block_max)


@dataclass
class Item:
    item_id: object
    words: list[bytes]
    answer_at: int

    def shingles(self) -> tuple[set, set]:
        """Shingles within the question, and those that touch the answer."""
        width = min(SHINGLE, len(self.words))
        question, answer = set(), set()
        for i in range(len(self.words) - width + 1):
            (question if i + width <= self.answer_at else answer).add(tuple(self.words[i : i + width]))
        return question, answer


class Index:
    """The items of one block, by length class."""

    def __init__(
        self, rows: list[tuple], df: dict[bytes, int], n_items: int, mean_length: float, threshold: float = THRESHOLD
    ):
        self.threshold = threshold
        self.items = [Item(i, w, _answer_at(text, len(w))) for i, text in rows if (w := words_of(text))]
        self.items.sort(key=lambda x: len(x.words))
        self.terms: dict[bytes, int] = {}
        self.postings: list[Postings] = []
        rare: dict[int, list[tuple[int, float]]] = {}
        self.rest = np.zeros(len(self.items))
        for k, item in enumerate(self.items):
            length = len(item.words)
            tf: dict[bytes, int] = {}
            for w in item.words:
                tf[w] = tf.get(w, 0) + 1
            weight = {
                w: float(np.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)))
                * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean_length))
                for w, n in tf.items()
            }
            own = sum(weight.values())
            held = 0.0
            for w in sorted(weight, key=lambda w: (-weight[w], w)):
                impact = weight[w] / own
                t = self.terms.setdefault(w, len(self.terms))
                if t == len(self.postings):
                    self.postings.append(Postings())
                self.postings[t].items.append(k)
                self.postings[t].impacts.append(impact)
                if held < RARE:
                    rare.setdefault(t, []).append((k, impact))
                    held += impact
            self.rest[k] = 1 - held
        for p in self.postings:
            p.close()
        self.rare_at = np.zeros(len(self.terms) + 1, np.int64)
        for t, found in rare.items():
            self.rare_at[t + 1] = len(found)
        self.rare_at = np.cumsum(self.rare_at)
        flat = [x for t in sorted(rare) for x in rare[t]]
        self.rare_items = np.array([k for k, _ in flat], np.int64)
        self.rare_impacts = np.array([x for _, x in flat])
        self.classes = []  # (first item, last item + 1, window)
        first = 0
        while first < len(self.items):
            longest = 16
            while longest < len(self.items[first].words):
                longest *= 2
            last = first
            while last < len(self.items) and len(self.items[last].words) <= longest:
                last += 1
            self.classes.append((first, last, longest))
            first = last

    def candidates(self, ids: np.ndarray) -> np.ndarray:
        """Items that the terms of a whole document might bring to the threshold."""
        t = np.unique(ids)
        lo, n = self.rare_at[t], self.rare_at[t + 1] - self.rare_at[t]
        t, lo, n = t[n > 0], lo[n > 0], n[n > 0]
        if not len(t):
            return np.empty(0, np.int64)
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        bound = np.bincount(self.rare_items[at], self.rare_impacts[at], minlength=len(self.items))
        return np.flatnonzero((bound > 0) & (bound + self.rest >= self.threshold - 1e-9))

    def windows(self, ids: np.ndarray, maybe: np.ndarray, first: int, last: int, longest: int) -> np.ndarray:
        """Windows in which an item of a class, one of ``maybe``, might reach the threshold.

        The same bound as for a whole document, with the terms of the window only.
        """
        count = len(range(0, max(1, len(ids) - longest), longest))
        pos = np.flatnonzero(ids >= 0)
        t = ids[pos]
        lo, n = self.rare_at[t], self.rare_at[t + 1] - self.rare_at[t]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        pos, t, item = np.repeat(pos, n), np.repeat(t, n), self.rare_items[at]
        chosen = np.zeros(len(self.items), bool)
        chosen[maybe[(maybe >= first) & (maybe < last)]] = True
        mine = chosen[item]
        pos, t, item, impact = pos[mine], t[mine], item[mine], self.rare_impacts[at[mine]]
        window = np.concatenate([pos // longest, pos // longest - 1])
        t, item, impact = np.tile(t, 2), np.tile(item, 2), np.tile(impact, 2)
        inside = (window >= 0) & (window < count)
        key = (window * len(self.items) + item)[inside]
        _, once = np.unique(key * len(self.postings) + t[inside], return_index=True)
        pairs, place = np.unique(key[once], return_inverse=True)
        bound = np.bincount(place, impact[inside][once], minlength=len(pairs))
        return np.unique(pairs[bound + self.rest[pairs % len(self.items)] >= self.threshold - 1e-9] // len(self.items))

    def search(self, terms: list[int], first: int, last: int, threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: items of ``first`` up to ``last`` that score the threshold or more."""
        out = []
        cursors = []  # [item, place, postings]
        for t in terms:
            p = self.postings[t]
            place = bisect_left(p.items, first)
            if place < len(p.items) and p.items[place] < last:
                cursors.append([p.items[place], place, p])
        least = threshold - 1e-9

        def move(c: list, item: int) -> None:
            c[1] = bisect_left(c[2].items, item, c[1])
            c[0] = c[2].items[c[1]] if c[1] < len(c[2].items) else last

        while True:
            cursors = sorted((c for c in cursors if c[0] < last), key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[2].most
                if bound >= least:
                    pivot = i
                    break
            if pivot < 0:
                return out
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # The blocks where the pivot item would be, without moving to it.
            blocks, skip_to = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else last
            for c in cursors[: pivot + 1]:
                p = c[2]
                place = bisect_left(p.items, item, c[1])
                if place < len(p.items):
                    block = place // POSTINGS_PER_BLOCK
                    blocks += p.block_max[block]
                    end = min((block + 1) * POSTINGS_PER_BLOCK, len(p.items)) - 1
                    skip_to = min(skip_to, p.items[end] + 1)
            if blocks < least:
                for c in cursors[: pivot + 1]:
                    move(c, max(skip_to, item + 1))
            elif cursors[0][0] == item:
                score = sum(c[2].impacts[c[1]] for c in cursors[: pivot + 1])
                if score >= least:
                    out.append((item, score))
                for c in cursors[: pivot + 1]:
                    move(c, item + 1)
            else:
                for c in cursors[: pivot + 1]:
                    if c[0] < item:
                        move(c, item)

    def leaks(self, text: str | None) -> list[tuple]:
        """``(item_id, score, question share, answer share)`` of every item that leaks into a text."""
        found = words_of(text)
        get = self.terms.get
        ids = np.array([get(w, -1) for w in found], dtype=np.int64)
        known = ids[ids >= 0]
        if not len(known) or not len(maybe := self.candidates(known)):
            return []
        best: dict[int, tuple] = {}
        for first, last, longest in self.classes:
            if not np.any((maybe >= first) & (maybe < last)):
                continue
            for start in (self.windows(ids, maybe, first, last, longest) * longest).tolist():
                stop = start + 2 * longest
                window = ids[start:stop]
                hits = self.search(np.unique(window[window >= 0]).tolist(), first, last, self.threshold)
                if not hits:
                    continue
                words = found[start:stop]
                have: dict[int, set] = {}
                for k, score in hits:
                    item = self.items[k]
                    width = min(SHINGLE, len(item.words))
                    if width not in have:
                        have[width] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
                    question, answer = item.shingles()
                    q, a = len(question & have[width]), len(answer & have[width])
                    share_q = q / len(question) if question else 1.0
                    share_a = a / len(answer) if answer else 1.0
                    whole = (q + a) / (len(question) + len(answer))
                    if whole >= OVERLAP and share_q >= PART and share_a >= PART and score > best.get(k, (0, 0.0))[1]:
                        best[k] = (item.item_id, score, share_q, share_a)
        return [best[k] for k in sorted(best)]


def _indexes(items: DataFrame, item_id: str, text: str, threshold: float) -> Iterator[Index]:
    """One index per block of items; document frequencies are of all items."""

    @F.arrow_udf("array<binary>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([words_of(t.as_py()) for t in texts], pa.list_(pa.binary()))

    items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"), split(text).alias("words"))
    items = items.where(F.size("words") > 0)
    n, words = items.agg(F.count("*"), F.sum(F.size("words"))).first()
    blocks = -(-n // ITEMS_PER_BLOCK)
    df = items.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        used = part.select(F.explode("words").alias("word")).distinct().join(df, "word")
        counts = {bytes(r.word): r.df for r in used.collect()}
        rows = [(r.item_id, r.text) for r in part.select("item_id", "text").collect()]
        yield Index(sorted(rows, key=lambda r: (str(r[0]), r[1])), counts, n, words / n, threshold)


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``id, item_id, score, question, answer``: a row for every item that leaks into a document."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, item_id {item_kind.simpleString()}, score double, question double, answer double"
    arrow = pa.string() if item_kind.simpleString() == "string" else pa.int64()
    out = spark.createDataFrame([], schema)
    for index in _indexes(items, "item_id", "text", threshold):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows, at = [], []
                for i, t in enumerate(batch.column(1)):
                    found = index.leaks(t.as_py())
                    rows += found
                    at += [i] * len(found)
                columns = list(zip(*rows)) if rows else [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(columns[0], arrow)]
                    + [pa.array(c, pa.float64()) for c in columns[1:]],
                    names=["id", "item_id", "score", "question", "answer"],
                )

        out = out.union(docs.mapInArrow(run, schema))
    return out

"""Collocations: phrases of up to five words whose parts stand together more often than by chance.

Phrases are counted in a HAT-trie. Words get numbers; the trie branches by them in its first levels
only, and below that a hash container holds the rests of the phrases. A container of over ``BURST``
entries bursts into one for each next word. When the trie holds ``HELD`` entries, its largest
subtrees are spilled whole, each as a run sorted by phrase, until half of it is left. Only the longest
phrase from each place is put in; the counts of its beginnings are sums over subtrees, made as they are
spilled. Runs are merged by an exchange that adds up the counts; it deals by the whole phrase, because
its first word alone, like "the", may hold a good part of all.

Each part of a frequent phrase is as frequent at least, so phrases are counted in three passes: words;
pairs of frequent words, only by a hash of ``BUCKETS_A_WORD`` buckets for each word of the corpus; and two
to five words in a row where the buckets of all pairs are frequent. Frequent words and buckets reach
the tasks as Bloom filters of at most ``FILTER_BITS`` bits. What a bucket or a filter lets through
wrongly is counted like all else and found to be rare, so counts are exact whatever their sizes.

Null languages count as ``und``, null texts as empty. Words and phrases of one language know nothing
of another's. Texts are taken whole; long ones are cut up at piece marks, where no phrase crosses.
Repeated rows count each time. Ties in the score go to the phrase with more occurrences, then by bytes.
Only two columns are read, so the names of others cannot clash. An empty table has no phrases.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import Stored, mix

LEAST, LONGEST, TOP = 100, 5, 2000
#: Entries of a container before it bursts, levels that branch, entries held before a spill.
BURST, LEVELS, HELD = 4096, 3, 400_000
#: Words put in together, words numbered before all is spilled, rows of a spilled batch.
TOGETHER, NUMBERED, ROWS = 200_000, 500_000, 50_000
FILTER_BITS = 1 << 28
BUCKETS_A_WORD = 64
#: Rows of totals that are broadcast; there is one for each language.
MAX_BROADCAST_ROWS = 100_000

_KIND = "lang string, k int, phrase string, f bigint"
_NAMES = ["lang", "k", "phrase", "f"]
#: A-Z to lower case, marks that end a piece to a full stop, tab stops to blanks.
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"........." + b" "
)
_SLICE = 1 << 20


class Inner:
    """A level that branches: how many phrases end here, and what is below each next word."""

    __slots__ = ("here", "below")

    def __init__(self):
        self.here, self.below = 0, {}


class HatTrie:
    """Counts of sequences of word numbers, each number four bytes of a key."""

    def __init__(self, burst: int = BURST, levels: int = LEVELS):
        self.burst, self.levels = burst, levels
        self.root = Inner()
        self.size = 0

    def add(self, paths: list[bytes], counts: list[int]) -> None:
        root = self.root
        for path, count in zip(paths, counts):
            parent, node, at = root, root, 0
            while type(node) is Inner:
                if at == len(path):
                    node.here += count
                    break
                parent, step = node, path[at : at + 4]
                at += 4
                node = parent.below.get(step)
                if node is None:
                    node = parent.below[step] = {}
            else:
                rest = path[at:]
                old = node.get(rest)
                if old is not None:
                    node[rest] = old + count
                    continue
                node[rest] = count
                self.size += 1
                if len(node) > self.burst and at < 4 * self.levels:
                    parent.below[step] = self._split(node)

    def _split(self, container: dict[bytes, int]) -> Inner:
        """A container as a level with one container for each next word."""
        level = Inner()
        for rest, count in container.items():
            if not rest:
                level.here = count
                self.size -= 1
            else:
                level.below.setdefault(rest[:4], {})[rest[4:]] = count
        return level

    @staticmethod
    def entries(node: Inner | dict, prefix: bytes = b"") -> Iterator[tuple[bytes, int]]:
        """All sequences below a node with their counts."""
        if type(node) is not Inner:
            for rest, count in node.items():
                yield prefix + rest, count
            return
        if node.here:
            yield prefix, node.here
        for step, child in node.below.items():
            yield from HatTrie.entries(child, prefix + step)

    def take(self, left: int) -> Iterator[tuple[bytes, list[tuple[bytes, int]]]]:
        """Takes out whole subtrees, the largest first, until at most ``left`` entries are held."""
        sizes = {step: self._size(child) for step, child in self.root.below.items()}
        for step in sorted(sizes, key=sizes.get, reverse=True):
            if self.size <= left and left:
                return
            found = list(self.entries(self.root.below.pop(step), step))
            self.size -= sizes[step]
            yield step, found

    @staticmethod
    def _size(node: Inner | dict) -> int:
        return sum(map(HatTrie._size, node.below.values())) if type(node) is Inner else len(node)


class Numbers(dict):
    """Numbers of the words of one language; the full stop that ends a piece has 0."""

    def __init__(self, lang: str, names: list[tuple[str, bytes]]):
        super().__init__({b".": 0})
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.names)
        self.names.append((self.lang, word))
        return number


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Lists of words, with a full stop where a piece ends; together all of the text."""
    data = (text or "").encode().translate(_PLAIN)
    start = 0
    while start < len(data):
        end = len(data) if len(data) - start <= 2 * _SLICE else data.find(b".", start + _SLICE)
        end = len(data) if end < 0 else end
        yield data[start:end].replace(b".", b" . ").split()
        start = end


class Counter:
    """Counts the phrases of ``low`` to ``high`` words of a task's texts; yields sorted runs.

    Words alone are counted by their number, without a trie. ``words`` and ``pairs`` are the filters,
    ``mask`` cuts the hash of a pair to its bucket.
    """

    def __init__(self, low: int, high: int, words: np.ndarray | None = None, pairs: np.ndarray | None = None, mask: int = (1 << 62) - 1, held: int = HELD):
        self.low, self.high, self.words, self.pairs, self.mask, self.held = low, high, words, pairs, mask, held
        self.totals: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.names: list[tuple[str, bytes]] = [("", b".")]
        self.numbers: dict[str, Numbers] = {}
        self.hashed, self.passed = np.empty(0, np.uint64), np.empty(0, bool)
        self.trie, self.singles = HatTrie(), np.zeros(0, np.int64)
        self.waiting, self.count = [], 0

    def read(self, lang: str, text: str | None) -> Iterator[pa.RecordBatch]:
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = Numbers(lang, self.names)
        for words in words_of(text):
            ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            if self.low == 1:
                self.totals[lang] = self.totals.get(lang, 0) + int(np.count_nonzero(ids))
            self.waiting += [ids, np.zeros(1, np.int64)] if words and words[-1] != b"." else [ids]
            self.count += len(words)
            if self.count > TOGETHER:
                yield from self.put(self.held)
                numbers = self.numbers.setdefault(lang, Numbers(lang, self.names))

    def put(self, limit: int) -> Iterator[pa.RecordBatch]:
        """Puts what waits into the trie, and spills down to half of a limit, or all."""
        if self.waiting:
            ids = np.concatenate([*self.waiting, np.zeros(self.high, np.int64)])
            if self.high == 1:
                found = np.bincount(ids[ids > 0], minlength=len(self.names))
                found[: len(self.singles)] += self.singles
                self.singles = found
            else:
                self.trie.add(*self._paths(ids))
        self.waiting, self.count = [], 0
        if len(self.names) > NUMBERED:
            limit = 0
        if not limit and len(self.singles):
            rows = [(*self.names[i], int(self.singles[i])) for i in np.flatnonzero(self.singles).tolist()]
            rows.sort()
            for i in range(0, len(rows), ROWS):
                yield _batch([(lang, 1, word, count) for lang, word, count in rows[i : i + ROWS]])
        if self.trie.size >= limit:
            yield from self._spill(limit // 2)
        if not limit:
            self._reset()

    def _pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which places have a word that passes, and the pairs of these: their places and buckets."""
        new = _hashes(self.names[len(self.hashed) :])
        self.hashed = np.concatenate([self.hashed, new])
        good = np.ones(len(new), bool) if self.words is None else _holds(self.words, new)
        self.passed = np.concatenate([self.passed, good])
        word = (ids > 0) & self.passed[ids]
        at = np.flatnonzero(word[:-1] & word[1:])
        return word, at, mix(self.hashed[ids[at]] * np.uint64(3) + mix(self.hashed[ids[at + 1]])) & np.uint64(self.mask)

    def _paths(self, ids: np.ndarray) -> tuple[list[bytes], list[int]]:
        """The longest phrase from each place, distinct, with counts."""
        n = len(ids) - self.high
        word, at, buckets = self._pairs(ids)
        joined = np.zeros(len(ids) - 1, bool)
        joined[at] = True if self.pairs is None else _holds(self.pairs, buckets)
        length = word[:n].astype(np.int64)
        on = word[:n].copy()
        for step in range(self.high - 1):
            on &= joined[step : step + n]
            length += on
        paths, counts = [], []
        for size in range(self.low, self.high + 1):
            at = np.flatnonzero(length == size)
            if not len(at):
                continue
            rows, width = ids[at[:, None] + np.arange(size)], 4 * size
            if size == 2:
                both, number = np.unique(rows[:, 0] << 32 | rows[:, 1], return_counts=True)
                data = both.astype(">u8").tobytes()
            else:
                kept, number = np.unique(np.ascontiguousarray(rows.astype(">u4")).view(f"V{width}").ravel(), return_counts=True)
                data = kept.tobytes()
            paths += [data[i : i + width] for i in range(0, len(data), width)]
            counts += number.tolist()
        return paths, counts

    def _spill(self, left: int) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int, bytes, int]] = []
        names, low, high = self.names, self.low, self.high
        for step, entries in self.trie.take(left):
            if low < high:
                sums: dict[bytes, int] = {}
                for path, count in entries:
                    for end in range(4 * low, len(path) + 1, 4):
                        sums[path[:end]] = sums.get(path[:end], 0) + count
                entries = list(sums.items())
            lang, first = names[int.from_bytes(step)]
            run = []
            for path, count in entries:
                words = [first, *[names[i][1] for i in struct.unpack(f">{len(path) // 4 - 1}I", path[4:])]]
                run.append((b" ".join(words), len(words), count))
            run.sort()
            rows += [(lang, k, phrase, count) for phrase, k, count in run]
            if len(rows) >= ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def finish(self) -> Iterator[pa.RecordBatch]:
        """What is left, and the number of all words of each language as the phrase of no words."""
        yield from self.put(0)
        if self.totals:
            yield _batch([(lang, 0, b"", total) for lang, total in self.totals.items()])


def _batch(rows: list[tuple[str, int, bytes, int]]) -> pa.RecordBatch:
    lang, k, phrase, f = zip(*rows)
    columns = [pa.array(lang, pa.string()), pa.array(k, pa.int32()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(f, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _hashes(names: list[tuple[str, bytes]]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.array([xxh3_64_intdigest(lang.encode() + b"\n" + word) for lang, word in names], np.uint64)


def _bits(hashed: np.ndarray, bits: int) -> list[np.ndarray]:
    """The three bits of each hash."""
    h = mix(hashed)
    step = mix(h) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(3)]


def _holds(words: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashes a Bloom filter, as 64-bit words, may hold."""
    out = np.ones(len(hashed), bool)
    for bit in _bits(hashed, 64 * len(words)):
        out &= (words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def _filter(hashes: DataFrame) -> np.ndarray:
    """The Bloom filter of a column ``h``; at most ``FILTER_BITS`` bits reach the driver."""
    bits = min(FILTER_BITS, 1 << max(10, (16 * hashes.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_bits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(at & 63)], names=["slot", "bit"])

    set_bits = hashes.select("h").mapInArrow(run, "slot bigint, bit bigint")
    slots = set_bits.groupBy("slot").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit AS int))")).alias("word")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[slots.column("slot").to_numpy()] = slots.column("word").to_numpy()
    return words.view(np.uint64)


def _word_hashes(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [(lang, w.encode()) for lang, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(names).view(np.int64))], names=["h"])

    return words.select("lang", "phrase").mapInArrow(run, "h bigint")


def _added(buckets: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets in order, with the sums of their counts."""
    bucket, count = np.concatenate(buckets), np.concatenate(counts)
    order = np.argsort(bucket, kind="stable")
    bucket, count = bucket[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return bucket[first], np.add.reduceat(count, first)


class PairCounter(Counter):
    """Counts the buckets of a task's pairs, ``h, f`` in order of the buckets."""

    def __init__(self, words: np.ndarray, mask: int):
        self.buckets, self.counts, self.kept = [], [], 0
        super().__init__(2, 2, words, mask=mask)

    def put(self, limit: int) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            _, _, found = self._pairs(np.concatenate([*self.waiting, np.zeros(2, np.int64)]))
            bucket, count = np.unique(found, return_counts=True)
            self.buckets.append(bucket)
            self.counts.append(count)
            self.kept += len(bucket)
        self.waiting, self.count = [], 0
        if len(self.names) > NUMBERED:
            self._reset()
        if self.buckets and (not limit or self.kept > 5 * HELD):
            bucket, count = _added(self.buckets, self.counts)
            self.buckets, self.counts, self.kept = [bucket], [count], len(bucket)
            if not limit or len(bucket) > 4 * HELD:
                self.buckets, self.counts, self.kept = [], [], 0
                for i in range(0, len(bucket), ROWS):
                    part = slice(i, i + ROWS)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket[part].view(np.int64)), pa.array(count[part])], names=["h", "f"])


def _pair_buckets(docs: DataFrame, words: np.ndarray, mask: int) -> DataFrame:
    """``h, f``: how many pairs of frequent words each bucket has."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PairCounter(shared.value, mask)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                yield from counter.read(lang.as_py(), text.as_py())
        yield from counter.put(0)

    return docs.mapInArrow(run, "h bigint, f bigint").groupBy("h").agg(F.sum("f").alias("f"))


def _counted(docs: DataFrame, low: int, high: int, filters: tuple[np.ndarray, ...] = (), mask: int = 0) -> DataFrame:
    """``lang, k, phrase, f``: exact counts of phrases of ``low`` to ``high`` words."""
    shared = [docs.sparkSession.sparkContext.broadcast(words) for words in filters]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(low, high, *[words.value for words in shared], mask=mask)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                yield from counter.read(lang.as_py(), text.as_py())
        yield from counter.finish()

    return docs.mapInArrow(run, _KIND).groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))


def frequent(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, k, phrase, f`` of all phrases found at least so often; ``k`` 0 has the number of all words."""
    store = Stored(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    often = (F.col("f") >= least) | (F.col("k") == 0)
    words = store.put(_counted(docs, 1, 1).where(often), "words")
    of_words = _filter(_word_hashes(words.where("k = 1")))
    n = words.where("k = 0").agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n")).first()["n"]
    mask = (1 << min(62, max(20, (BUCKETS_A_WORD * n).bit_length()))) - 1
    buckets = store.put(_pair_buckets(docs, of_words, mask).where(F.col("f") >= least).select("h"), "buckets")
    longer = store.put(_counted(docs, 2, longest, (of_words, _filter(buckets)), mask).where(often), "longer")
    return words.unionByName(longer)


def _words():
    return F.split("phrase", " ")


def _part(start, length):
    return F.array_join(F.slice(_words(), start, length), " ")


def collocations(found: DataFrame) -> DataFrame:
    """``lang, phrase, k, a, l, r, n, score`` of the candidates that no longer one stands for, from :func:`frequent`."""
    totals = found.where("k = 0").select("lang", F.col("f").alias("n"))
    totals = F.broadcast(totals) if totals.count() <= MAX_BROADCAST_ROWS else totals
    parts = found.where("k > 0").select("lang", "phrase", "f")
    candidates = found.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    # Counts never grow with a phrase, so whatever holds it as often also holds one word more of it as often.
    longer = candidates.where("k > 2").select(
        "lang", F.explode(F.array(_part(F.lit(1), F.col("k") - 1), _part(F.lit(2), F.col("k") - 1))).alias("phrase"), "a"
    )
    left = candidates.join(longer, ["lang", "phrase", "a"], "left_anti")
    cuts = left.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "*", _part(F.lit(1), F.col("cut")).alias("head"), _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail")
    )
    heads = parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    wide = lambda c: f"cast({c} AS decimal(19,0))"
    # Products of up to 38 digits are exact: counts of 10^16 words and more.
    score = F.expr(f"cast(1000 AS decimal(4,0)) * {wide('a')} * {wide('n')} div ({wide('l')} * {wide('r')})")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
    best = scored.groupBy("lang", "phrase", "k", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "k", "a", "best.l", "best.r", "n", "best.score")


def top(scored: DataFrame, limit: int = TOP) -> DataFrame:
    """The first of each language with their ``rank``: first among shares of a language, then among what is left."""
    best_first = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    place = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best_first))
    left = share.withColumn("place", place).where(F.col("place") <= limit).drop("share", "place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best_first)).cast("long")
    return left.withColumn("rank", rank).where(F.col("rank") <= limit)

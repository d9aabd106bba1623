"""Byte-level BPE with a two-tier lookup.

A pre-token that is a vocabulary entry as a whole is resolved by one probe of a minimal
perfect hash. Any other is merged by rank: its bytes form a linked list, a heap holds the
adjacent pairs that the vocabulary knows, and the lowest rank (leftmost first) is merged
until none is left. Pre-tokens are cut by the pattern in the JVM; a batch resolves each distinct one once.

Null texts count as empty. An id list that is null, or holds an id outside the vocabulary,
decodes to null. Texts of any length are encoded whole: the heap keeps a pre-token of n
bytes at O(n log n).
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

#: Most entries of a vocabulary: the table is broadcast, so it needs a bound.
MAX_ENTRIES = 1_000_000
ID_BITS = 20
#: Resolved pre-tokens that a task remembers.
REMEMBERED = 250_000
#: Rows of a batch that are worked on together.
ROWS = 500


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one ``base64 rank`` pair per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class PerfectHash:
    """A minimal perfect hash of byte strings: hash, displace, compare the stored key."""

    def __init__(self, keys: list[bytes], values: list[int]):
        n = self.n = len(keys)
        self.buckets = max(1, n // 2)
        hashed = [self._parts(k) for k in keys]
        grouped: dict[int, list[int]] = {}
        for i, (bucket, _, _) in enumerate(hashed):
            grouped.setdefault(bucket, []).append(i)
        self.shift = [0] * self.buckets
        slots = [-1] * n
        free = n - 1
        for bucket, members in sorted(grouped.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:
                while slots[free] >= 0:
                    free -= 1
                _, h1, _ = hashed[members[0]]
                self.shift[bucket] = (free - h1) % n
                slots[free] = members[0]
                continue
            d = 0
            while True:
                at = [(hashed[i][1] + d // n * hashed[i][2] + d) % n for i in members]
                if len(set(at)) == len(at) and all(slots[s] < 0 for s in at):
                    break
                d += 1
            self.shift[bucket] = d
            for s, i in zip(at, members):
                slots[s] = i
        self.keys = [keys[i] for i in slots]
        self.values = [values[i] for i in slots]

    def _parts(self, key: bytes) -> tuple[int, int, int]:
        h = xxh3_128_intdigest(key)
        return (h & 0xFFFFFFFF) % self.buckets, ((h >> 32) & 0xFFFFFFFF) % self.n, ((h >> 64) & 0xFFFFFFFF) % self.n

    def get(self, key: bytes) -> int:
        """The value of a key, -1 for anything that is not a key."""
        if not self.n:
            return -1
        bucket, h1, h2 = self._parts(key)
        d = self.shift[bucket]
        slot = (h1 + d // self.n * h2 + d) % self.n
        return self.values[slot] if self.keys[slot] == key else -1


class Merges:
    """What a merge yields, by the ids of its two parts: every split of an entry into two entries."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << ID_BITS | right] = rank


def merge(piece: bytes, merges: Merges) -> list[int]:
    """Ids of a pre-token: lowest rank first, over a linked list of its bytes.

    The heap holds ``rank * n + start``; an entry is stale unless the pair that starts there
    still has this rank.
    """
    n, get, pop, push = len(piece), merges.pairs.get, heapq.heappop, heapq.heappush
    ids = list(map(merges.byte_ids.__getitem__, piece))
    pair = [get(a << ID_BITS | b) for a, b in zip(ids, ids[1:])]
    heap = [rank * n + i for i, rank in enumerate(pair) if rank is not None]
    if not heap:
        return ids
    heapq.heapify(heap)
    pair.append(None)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        rank, i = divmod(pop(heap), n)
        if pair[i] != rank:
            continue
        j = after[i]
        k = after[i] = after[j]
        ids[i], ids[j], pair[j] = rank, None, None
        if k < n:
            before[k] = i
            pair[i] = new = get(rank << ID_BITS | ids[k])
            if new is not None:
                push(heap, new * n + i)
        else:
            pair[i] = None
        h = before[i]
        if h >= 0:
            pair[h] = new = get(ids[h] << ID_BITS | rank)
            if new is not None:
                push(heap, new * n + h)
    return [x for x in ids if x is not None]


class Encoder:
    """Ids by pre-token, resolved on first sight; two generations are remembered, each bounded."""

    def __init__(self, ranks: PerfectHash, merges: Merges):
        self.ranks, self.merges = ranks, merges
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, piece: str) -> bytes:
        """The ids as packed 32-bit integers."""
        found = self.young.get(piece)
        if found is None:
            found = self.old.get(piece)
            if found is None:
                data = piece.encode()
                whole = self.ranks.get(data)
                found = array("i", [whole] if whole >= 0 else merge(data, self.merges)).tobytes()
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[piece] = found
        return found

    def resolve(self, lists: pa.Array) -> pa.Array:
        """Id lists of lists of pre-tokens; each distinct pre-token is looked up once."""
        pieces = lists.flatten().dictionary_encode()
        known = [self.ids(p) for p in pieces.dictionary.to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(k) // 4 for k in known], dtype=np.int64)]).astype(np.int32)
        values = np.frombuffer(b"".join(known), np.int32)
        each = pa.ListArray.from_arrays(pa.array(ends), pa.array(values)).take(pieces.indices)
        counts = np.concatenate([[0], np.cumsum(each.value_lengths().to_numpy(zero_copy_only=False))])
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(counts[ends].astype(np.int32)), each.flatten())


#: White space as the pattern means it; Java's own class is ASCII only. A fixed value.
SPACES = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def java_pattern(pattern: str) -> str:
    """The same pattern for Java: white space is spelt out, inside and outside of brackets."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
        i += len(c)
        if c == "\\s":
            out.append(SPACES if inside else f"[{SPACES}]")
        elif c == "\\S":
            out.append(f"[^{SPACES}]")
        else:
            inside = c == "[" or inside and c != "]"
            out.append(c)
    return "".join(out)


def spell(lists: pa.Array, tokens: pa.Array) -> pa.Array:
    """The bytes of id lists."""
    flat = lists.flatten()
    bad = pc.or_kleene(pc.or_kleene(pc.less(flat, 0), pc.greater_equal(flat, len(tokens))), flat.is_null())
    safe = pc.if_else(pc.fill_null(bad, True), pa.scalar(None, flat.type), flat)
    sizes = pc.fill_null(pc.list_value_length(lists), 0)
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))]).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(ends, tokens.take(safe)), pa.scalar(b""))
    return pc.if_else(lists.is_valid(), joined, pa.scalar(None, pa.binary()))


class Tokenizer:
    """Column functions for one vocabulary; its table is broadcast once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ranks = read_ranks(path)
        if len(ranks) > MAX_ENTRIES:
            raise ValueError(f"the vocabulary has more than {MAX_ENTRIES} entries")
        table = PerfectHash(list(ranks), list(ranks.values()))
        by_id: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        lookup = spark.sparkContext.broadcast((table, Merges(ranks)))
        spelling = spark.sparkContext.broadcast(by_id)
        self._pattern = java_pattern(pattern)

        @F.arrow_udf("array<int>")
        def resolve(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = Encoder(*lookup.value)
            for lists in batches:
                parts = [encoder.resolve(lists[i : i + ROWS]) for i in range(0, max(1, len(lists)), ROWS)]
                yield pa.concat_arrays(parts)

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokens = pa.array(spelling.value, pa.binary())
            for lists in batches:
                parts = [spell(lists[i : i + ROWS], tokens) for i in range(0, max(1, len(lists)), ROWS)]
                yield pa.concat_arrays(parts)

        self._resolve, self._decode = resolve, decode

    def encode(self, text: Column | str) -> Column:
        """``array<int>``: the ids of a text."""
        whole = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
        return self._resolve(F.regexp_extract_all(whole, F.lit(self._pattern), F.lit(0)))

    def decode(self, ids: Column | str) -> Column:
        """``binary``: the bytes of an id list."""
        return self._decode(ids)

"""N-gram Jaccard join in metric space.

Jaccard distance is a metric, and two documents link when theirs is at most ``eps``. Between
sets that share nothing it is 1, however they lie to any pivot, so no triangle inequality can
tell them apart: over documents that are mostly unrelated, pivots alone separate nothing. Regions
are therefore made from pieces of the sets first, which is not the method of pivots; pivots, windows
and recursion work on what is large after that.

The space of shingles is cut into classes by hash, more classes than two linked sets of a size can
differ in shingles. ``d`` shingles of difference touch ``d`` classes at most, so with ``d + 1 + spare``
classes a linked pair agrees on ``1 + spare``, and documents that agree on a class form a region.
``spare`` is taken so large that a set hardly ever has more empty classes, which therefore are no keys;
what a pair has to agree on besides them is its ``need``.

* Of a set's regions of over ``SMALL`` members it leaves its ``need - 1`` largest. A linked pair still
  meets: of all regions that it shares, neither of the two leaves the smallest one.
* Pairs within small regions are counted, and only pairs that agree as often as linked ones must
  are compared at all. So sets that share a passage, and thus a few pieces, cost a count.
* In each larger region the most central member (the one that shares most regions with others) is a
  pivot. Its distance to all members is computed, and members within ``eps`` link to it, so a
  group of n near copies costs n pairs, not n * n. A region whose members are all connected then is done.
* One that is not, and is too large for a task (``BLOCK`` members), gets several pivots. Every member
  goes to the nearest (its Voronoi region), and is replicated to each other whose distance is at most
  2 * ``eps`` larger, as the triangle inequality demands; the regions are treated in the same way
  again. Where that would double a region it stays whole, without its pivots, which were compared with all of it.
* What is left is joined block by block, a pair of blocks to a task. A set goes to many of these, so sketches go
  there first: the parity of the shingles at each of some bits. Two sets differ in at least as many shingles as
  their sketches do in bits, which parts most pairs for certain. Only the contents of sets with a pair that may be
  linked follow; a task returns no more links than it takes to connect what it found connected.

So no link between two different sets is lost: each is found, or its ends are connected by
others. Equal sets are one node throughout. Links are returned as components; their number is not.

Sets are held as 64-bit hashes of shingles, nodes as a 64-bit hash of the set. Null and empty
texts have an empty set and no links. Ties are broken by the hash of the set, ids by value.
Rows that repeat an id keep their own set; the component of a null id counts it as unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm.common import Stored, WordHashes, mix

#: Members up to which the pairs of a region are listed, members of a block that a task joins,
#: pivots of a region over that size, and times that such regions are split by pivots.
SMALL, BLOCK, PIVOTS, ROUNDS = 16, 1500, 8, 3
#: Rows of 24 bytes that are broadcast.
MAX_BROADCAST_ROWS = 1_000_000
#: Sets that a task remembers as already sent.
SEEN = 200_000
#: Keys that a task holds before it passes them on.
HELD = 100_000
#: Bits of the smallest and of the largest sketch; in between it has two bits a shingle at least.
SKETCH_BITS = 64, 131_072


def shingles(text: str | None, n: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text; fewer than n words are one shingle."""
    found = (text or "").encode().lower().split()  # of bytes: A-Z only, and exactly the six white spaces
    if not found:
        return np.empty(0, np.uint64)
    h = words.of(found)
    width = min(n, len(found))
    out = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        out = mix(out + h[k : len(h) - width + 1 + k] + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(out)


def node_of(found: np.ndarray) -> int:
    """The 64-bit name of a set, signed as Spark's longs are."""
    total = mix(found).sum(dtype=np.uint64) + np.uint64(len(found))
    return int(mix(np.array([total]))[0].astype(np.int64))


def sketch_of(found: np.ndarray) -> bytes:
    """The parity of the number of hashes at each bit; half as many bits are the halves' exclusive or."""
    least, most = SKETCH_BITS
    bits = max(least, min(most, 1 << (2 * len(found) - 1).bit_length()))
    at = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((at & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(sketches: list[bytes], sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Of which pairs of sets the sketches and sizes leave open that they are linked, as a matrix."""
    width = min(map(len, sketches))
    rows = np.empty((len(sketches), width // 8), np.uint64)
    for i, sketch in enumerate(sketches):
        x = np.frombuffer(sketch, np.uint64)
        while len(x) > width // 8:
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        rows[i] = x
    out = np.zeros((len(rows), len(rows)), bool)
    step = max(1, 4_000_000 // rows.size)
    for i in range(0, len(rows), step):
        differ = np.bitwise_count(rows[i : i + step, None, :] ^ rows[None, :, :]).sum(axis=2, dtype=np.int64)
        differ = np.maximum(differ, np.abs(sizes[i : i + step, None] - sizes[None, :]))
        # |x & y| / |x u y| = (s - d) / (s + d), with the sum of the sizes and the size of the difference.
        out[i : i + step] = (sizes[i : i + step, None] + sizes[None, :]) * (den - num) >= differ * (den + num)
    return out


class Signatures:
    """Keys of which each linked pair of sets shares as many as both need.

    Sizes fall into levels, a factor of ``1 / t`` wide. A pair meets on the level of its larger
    set, so each set speaks for its own level and the next. Empty classes are keys only for a set
    with more than ``spare`` of them.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.width = log(den / num) * 1.001  # a little more, so that rounding cannot part two levels
        self.tops: dict[int, int] = {}
        self.known: dict[int, tuple[int, int]] = {}

    def top(self, level: int) -> int:
        """The largest size of a level."""
        if level not in self.tops:
            s = int(np.exp(self.width * (level + 1))) + 2
            while floor(log(s) / self.width) > level:
                s -= 1
            self.tops[level] = s
        return self.tops[level]

    def classes(self, level: int) -> tuple[int, int]:
        """The classes of a level, and how many of them a set may leave empty."""
        if level not in self.known:
            # |x ^ y| <= (1 - t) |x u y|, and |x u y| <= min(|x|, |y|) / t.
            d = self.top(level) * (self.den - self.num) // self.num
            spare = 0 if d == 0 else 1 if d < 4 else 2
            least = max(1, self.top(level - 2)) if level > 1 else 1  # sets of the level below speak here, too
            while spare < 4 * d:
                m = d + 1 + spare
                empty = m * exp(-least / m)
                if spare >= empty + 3 * empty**0.5 or d < 4:
                    break
                spare += 1
            self.known[level] = d + 1 + spare, spare
        return self.known[level]

    def of(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``sig, level, need`` of a set; a need below 0 says that its empty classes are keys."""
        own = floor(log(len(found)) / self.width)
        h = mix(found + np.uint64(0x5851F42D4C957F2D))
        out, levels, needs = [], [], []
        for level in (own, own + 1):
            m, spare = self.classes(level)
            cls = ((h >> np.uint64(33)) % np.uint64(m)).astype(np.int64)
            order = np.argsort(cls, kind="stable")
            cls = cls[order]
            starts = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
            sums, at = np.add.reduceat(h[order], starts), cls[starts]
            empty = m - len(at)
            if empty > spare:
                void = np.setdiff1d(np.arange(m), at)
                sums, at = np.concatenate([sums, np.zeros(len(void), np.uint64)]), np.concatenate([at, void])
            out.append(mix(sums + mix(at.astype(np.uint64) * np.uint64(65536) + np.uint64(level))))
            levels.append(np.full(len(at), level, np.int32))
            needs.append(np.full(len(at), 1 + spare - empty if empty <= spare else -1 - spare, np.int32))
        return np.concatenate(out), np.concatenate(levels), np.concatenate(needs)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """``id, n_shingles, node`` of every row; the node of an empty set is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            sizes, nodes = [], []
            for t in batch.column(1):
                found = shingles(t.as_py(), n, words)
                sizes.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())],
                names=["id", "n_shingles", "node"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_shingles bigint, node bigint")


def _signatures(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``sig, level, need, node`` of every set, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, keys, seen = WordHashes(), Signatures(num, den), set()
        for batch in batches:
            made, nodes, held = [], [], 0
            for t in batch.column(0):
                found = shingles(t.as_py(), n, words)
                if not len(found) or (node := node_of(found)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                made.append(keys.of(found))
                nodes.append(np.full(len(made[-1][0]), node, np.int64))
                held += len(nodes[-1])
                if held > HELD:
                    yield _rows(made, nodes)
                    made, nodes, held = [], [], 0
            if made:
                yield _rows(made, nodes)

    return docs.select("text").mapInArrow(run, "sig bigint, level int, need int, node bigint")


def _rows(made: list[tuple[np.ndarray, ...]], nodes: list[np.ndarray]) -> pa.RecordBatch:
    sig, level, need = (np.concatenate(column) for column in zip(*made))
    columns = [pa.array(sig.astype(np.int64)), pa.array(level), pa.array(need), pa.array(np.concatenate(nodes))]
    return pa.RecordBatch.from_arrays(columns, names=["sig", "level", "need", "node"])


def _contents(docs: DataFrame, n: int) -> DataFrame:
    """``node, found, sketch``: the hashes of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                rows = batch.column(0).slice(i, 1000)
                part = [x for t in rows if len(x := shingles(t.as_py(), n, words))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node_of(x) for x in part], pa.int64()),
                        pa.array([x.astype(np.int64) for x in part], pa.list_(pa.int64())),
                        pa.array([sketch_of(x) for x in part], pa.binary()),
                    ],
                    names=["node", "found", "sketch"],
                )

    return docs.select("text").mapInArrow(run, "node bigint, found array<bigint>, sketch binary")


def components(store: Stored, edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the edges ``a, b``: the smallest node it can reach.

    Each round takes the smallest root among the neighbours, then the root of the root; paths
    shrink by half. Roots are written between rounds; only a count reaches the driver.
    """
    both = store.put(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    roots = store.put(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
    while True:
        near = (
            both.join(roots.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        step = roots.join(near, "node").select(
            "node", F.least("root", "near").alias("next"), F.col("root").alias("was")
        )
        up = roots.select(F.col("node").alias("next"), F.col("root").alias("over"))
        new = store.put(
            step.join(up, "next").select("node", F.least("next", "over").alias("root"), "was"), "roots"
        )
        changed = new.where(F.col("root") != F.col("was")).limit(1).count()
        store.drop(roots)
        roots = new.select("node", "root")
        roots._stored_at = new._stored_at
        if not changed:
            store.drop(both)
            return roots


def _measure(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, inter, total`` (sizes of intersection and union) of distinct pairs of nodes."""
    one = sets.select(F.col("node").alias("a"), F.col("found").alias("fa"))
    two = sets.select(F.col("node").alias("b"), F.col("found").alias("fb"))
    inter = F.size(F.array_intersect("fa", "fb")).cast("long")
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .select("a", "b", inter.alias("inter"), (F.size("fa") + F.size("fb") - inter).alias("total"))
    )


def _cells(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``sig, level, size, members`` of all regions of two sets or more, ``SMALL`` members to a row at most.

    The keys are shuffled once; all that follows keeps their partitioning.
    """
    region = Window.partitionBy("sig")
    shared = (
        _signatures(docs, n, num, den)
        .withColumn("first", F.min("node").over(region))
        .withColumn("last", F.max("node").over(region))
        .where("first <> last")
        .groupBy("sig", "level", "node")
        .agg(F.max("need").alias("need"))
    )
    placed = shared.withColumn("size", F.count("*").over(region)).withColumn(
        "part", F.floor((F.row_number().over(region.orderBy("node")) - 1) / SMALL)
    )
    member = F.struct("node", "need")
    return placed.groupBy("sig", "level", "size", "part").agg(F.collect_list(member).alias("members")).drop("part")


def _pair_need(one: Column, two: Column) -> Column:
    """On how many keys a linked pair agrees at least, from the needs of its sets."""
    return F.when((one < 0) & (two < 0), F.greatest(-one, -two)).otherwise(F.greatest(one, two))


def _left(large: DataFrame) -> DataFrame:
    """Members of large regions, ranked: those that a set leaves have ``stays`` false."""
    line = Window.partitionBy("node", "level").orderBy(F.desc("size"), "sig")
    # A set whose empty classes are keys leaves nothing: its need depends on its partner.
    may = F.when(F.col("need") > 0, F.col("need") - 1).otherwise(F.lit(0))
    return large.withColumn("stays", F.row_number().over(line) > may)


def _counted_pairs(small: DataFrame, left: DataFrame) -> DataFrame:
    """``a, b`` of small regions that agree as often as a linked pair must, but for regions that were left."""
    pairs = F.flatten(
        F.transform(
            "members",
            lambda x: F.transform(
                F.filter("members", lambda y: x["node"] < y["node"]),
                lambda y: F.struct(
                    x["node"].alias("a"), y["node"].alias("b"), _pair_need(x["need"], y["need"]).alias("need")
                ),
            ),
        )
    )
    found = small.select("level", F.explode(pairs).alias("pair")).select("level", "pair.*")
    # At least one of the regions of a linked pair stays; a pair that shares a large one is found there.
    counted = found.groupBy("a", "b", "level").agg(F.count("*").alias("agree"), F.max("need").alias("need"))
    enough = counted.where("agree >= need").select("a", "b")
    less = counted.where("agree < need")
    gone = left.where("not stays").groupBy("node", "level").agg(F.count("*").alias("gone"))
    # Up to a counted size it goes to the pairs, most of which end here; beyond it they are shuffled.
    gone = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_ROWS else gone
    for side in ("a", "b"):
        mine = gone.select(F.col("node").alias(side), "level", F.col("gone").alias(f"gone_{side}"))
        less = less.join(mine, [side, "level"], "left")
    excused = F.coalesce("gone_a", F.lit(0)) + F.coalesce("gone_b", F.lit(0))
    return enough.union(less.where(F.col("agree") >= F.col("need") - excused).select("a", "b")).distinct()


def similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, num: int = 90, den: int = 100
) -> DataFrame:
    """``id, n_shingles, node, component_id`` of every row, linked at ``den * inter >= num * union``.

    ``component_id`` is the smallest id that links lead to, the row's own included.
    """
    spark = docs.sparkSession
    store = Stored(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    members = store.put(_sets(docs, n), "members")

    cells = store.put(_cells(docs, n, num, den), "cells")
    large = cells.where(F.col("size") > SMALL).select("sig", "level", "size", F.inline("members"))
    left = store.put(_left(large), "left")
    pairs = store.put(_counted_pairs(cells.where(F.col("size") <= SMALL), left), "pairs")
    store.drop(cells)
    in_region = Window.partitionBy("sig")
    cells = left.where("stays").select("sig", "node")
    sizes = cells.withColumn("size", F.count("*").over(in_region)).where("size > 1")
    central = store.put(sizes.groupBy("node").agg(F.sum("size").alias("rank")), "central")
    ranked = cells.join(central, "node").withColumn(
        "pivot", F.max(F.struct("rank", "node")).over(in_region)["node"]
    )
    ranked = store.put(ranked.where("node <> pivot").select("sig", "node", "pivot"), "ranked")
    stars = store.put(ranked.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    wanted = central.select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    first = members.where("node is not null").join(wanted, "node").groupBy("node").agg(F.min("id").alias("rep"))
    texts = docs.join(first.select("rep").distinct(), F.col("id").eqNullSafe(F.col("rep")), "left_semi")
    sets = _contents(texts, n).join(wanted, "node", "left_semi").dropDuplicates(["node"])
    sets = store.put(sets, "sets")

    linked = (F.col("inter") * den) >= (F.col("total") * num)
    measured = store.put(_measure(stars, sets), "measured")
    links = measured.where(linked).select("a", "b")
    links = store.put(links.union(_measure(pairs, sets).where(linked).select("a", "b")), "near")
    store.drop(pairs, stars)
    roots = components(store, links)

    # What is left of each region: members with the distance to its pivot, without the pivot.
    away = 1 - F.col("inter") / F.col("total")
    rest = ranked.join(
        measured.select(F.col("a").alias("pivot"), F.col("b").alias("node"), away.alias("d")), ["pivot", "node"]
    ).select("sig", "node", "d")
    rest = store.put(_open_regions(rest, roots), "rest")
    store.drop(ranked, measured)
    eps = 1 - num / den + 1e-9
    ready = rest.where(F.col("members") <= BLOCK)
    for _ in range(ROUNDS):
        large = rest.where(F.col("members") > BLOCK)
        if large.limit(1).count() == 0:
            break
        at, found = _around_pivots(store, large.join(central, "node"), sets)
        links = links.union(found.where(linked).select("a", "b"))
        roots = components(store, links)
        gap = found.select("a", "b", away.alias("d"))
        gap = gap.union(gap.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
        at = at.join(gap.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "d"), ["pivot", "node"])
        rest = store.put(_open_regions(_voronoi(at, eps), roots), "rest")
        ready = ready.union(rest.where(F.col("members") <= BLOCK))
    ready = ready.union(rest.where(F.col("members") > BLOCK))

    small = ready.where(F.col("members") <= SMALL)
    other = small.select("sig", F.col("node").alias("b"), F.col("d").alias("e"), F.col("root").alias("far"))
    near = (
        small.withColumnRenamed("node", "a")
        .join(other, "sig")
        .where((F.col("a") < F.col("b")) & (F.col("root") != F.col("far")) & (F.abs(F.col("d") - F.col("e")) <= eps))
        .select("a", "b")
        .distinct()
    )
    links = links.union(_measure(near, sets).where(linked).select("a", "b"))
    links = links.union(_join_blocks(ready.where(F.col("members") > SMALL), sets, num, den))
    roots = components(store, store.put(links, "links"))

    by_node = members.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    named = by_node.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "root").select("node", "component_id")
    return members.join(named, "node", "left").select(
        "id", "n_shingles", "node", F.coalesce("component_id", "id").alias("component_id")
    )


def _open_regions(rest: DataFrame, roots: DataFrame) -> DataFrame:
    """Regions with members that are not connected yet: ``sig, node, d, root, members``."""
    region = Window.partitionBy("sig")
    return (
        rest.join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("low", F.min("root").over(region))
        .withColumn("high", F.max("root").over(region))
        .where("low <> high")
        .withColumn("members", F.count("*").over(region))
        .select("sig", "node", "d", "root", "members")
    )


def _around_pivots(store: Stored, large: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The central members of large regions as pivots: ``sig, node, pivot``, and the measured pairs."""
    order = Window.partitionBy("sig").orderBy(F.desc("rank"), "node")
    placed = large.withColumn("place", F.row_number().over(order))
    pivots = store.put(placed.where(F.col("place") <= PIVOTS).select("sig", F.col("node").alias("pivot")), "pivots")
    others = large.join(pivots.withColumnRenamed("pivot", "node"), ["sig", "node"], "left_anti")
    at = store.put(large.join(pivots, "sig").where("node <> pivot").select("sig", "node", "pivot"), "at")
    pairs = at.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    found = store.put(_measure(pairs, sets), "tested")
    return at.join(others.select("sig", "node"), ["sig", "node"]), found


def _join_blocks(regions: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links ``a, b`` within regions, found by pairs of blocks.

    A region of one block is one group; a larger one gives a group for each pair of its blocks,
    so no task holds more than two blocks. A group falls into parts by the pairs that sketches leave
    open, and only these parts get the contents of their sets.
    """
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = (
        regions.withColumn("blocks", blocks)
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("sig", F.least("mine", "other"), F.greatest("mine", "other")).alias("sig"), "node", "root"
        )
    )

    def run(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        roots = group.column("root").to_numpy()
        found = [x.values.to_numpy() for x in group.column("found")]
        a, b = connect(nodes, roots, found, num, den)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # Regions of the same members are joined once, and so are parts.
    spread = _open_parts(_named_by_members(spread.distinct()).distinct(), sets, num, den)
    spread = _named_by_members(spread).distinct()
    return spread.join(sets.select("node", "found"), "node").groupBy("sig").applyInArrow(run, "a bigint, b bigint")


def _open_parts(groups: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``sig, node, root`` of the parts of groups that pairs connect which their sketches leave open."""
    kept = ["sig", "part", "node", "root"]

    def open_parts(group: pa.Table) -> pa.Table:
        nodes, roots, size = (group.column(c).to_numpy() for c in ("node", "root", "size"))
        pairs = may_link(group.column("sketch").to_pylist(), size, num, den) & (roots[:, None] != roots[None, :])
        part = parts(pairs)
        some = np.flatnonzero(pairs.any(axis=1))
        # A part is named by its first member, whatever the order of rows.
        first = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(first, part, nodes)
        columns = [group.column("sig").take(some), first[part[some]], nodes[some], roots[some]]
        return pa.table({c: pa.array(x) if isinstance(x, np.ndarray) else x for c, x in zip(kept, columns)})

    sketches = sets.select("node", "sketch", F.size("found").cast("long").alias("size"))
    found = groups.join(sketches, "node").groupBy("sig").applyInArrow(open_parts, ", ".join(f"{c} bigint" for c in kept))
    return found.select(F.xxhash64("sig", "part").alias("sig"), "node", "root")


def parts(pairs: np.ndarray) -> np.ndarray:
    """The connected part of each row of a symmetric matrix of pairs, as a number."""
    part, left = np.full(len(pairs), -1), np.ones(len(pairs), bool)
    for start in range(len(pairs)):
        if not left[start]:
            continue
        reached, left[start] = [start], False
        while reached:
            at = reached.pop()
            part[at] = start
            new = pairs[at] & left
            left &= ~new
            reached.extend(np.flatnonzero(new).tolist())
    return part


def _named_by_members(groups: DataFrame) -> DataFrame:
    """``sig, node, root`` with each group renamed by its members: equal groups get one name.

    The name does not depend on the order of rows, so a task that is computed again after a lost
    executor gives the same one; sums of doubles would not.
    """
    same = Window.partitionBy("sig")
    members = F.struct(
        F.bit_xor("node").over(same),
        F.bit_xor(F.xxhash64("node")).over(same),
        F.sum(F.col("node").cast("decimal(20,0)")).over(same),
        F.count("*").over(same),
    )
    return groups.withColumn("group", members).select(F.xxhash64("group").alias("sig"), "node", "root")


def connect(
    nodes: np.ndarray, roots: np.ndarray, found: list[np.ndarray], num: int, den: int
) -> tuple[list[int], list[int]]:
    """Links that connect what links connect among some sets, no more of them than needed.

    Sizes of intersections are products of the incidence matrix, by slices of its columns.
    """
    sizes = np.array([len(x) for x in found])
    tokens, column, count = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(found)), sizes)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    inter = np.zeros((len(found), len(found)), np.float32)
    for start in range(0, int(shared.sum()), 2048):
        lo, hi = np.searchsorted(column, [start, start + 2048])
        x = np.zeros((len(found), min(2048, int(shared.sum()) - start)), np.float32)
        x[row[lo:hi], column[lo:hi] - start] = 1
        inter += x @ x.T
    inter = inter.astype(np.int64)
    ok = inter * den >= (sizes[:, None] + sizes[None, :] - inter) * num
    i, j = np.nonzero(np.triu(ok & (roots[:, None] != roots[None, :]), 1))
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := parent.get(x, x)) != x:
            parent[x] = parent.get(y, y)
            x = y
        return x

    a, b = [], []
    for p, q in zip(i.tolist(), j.tolist()):
        x, y = top(int(roots[p])), top(int(roots[q]))
        if x != y:
            parent[x] = y
            a.append(int(nodes[p]))
            b.append(int(nodes[q]))
    return a, b


def _voronoi(at: DataFrame, eps: float) -> DataFrame:
    """Regions by nearest pivot with their windows, from ``sig, node, pivot, d``.

    A region whose windows would take in more than half as many members again stays whole;
    its first pivot then measures it.
    """
    member, region = Window.partitionBy("sig", "node"), Window.partitionBy("sig")
    seen = (
        at.withColumn("nearest", F.min("d").over(member))
        .withColumn("first", F.min("pivot").over(member))
        .withColumn("inside", F.col("d") <= F.col("nearest") + 2 * eps)
        .withColumn("copies", F.sum(F.col("inside").cast("long")).over(region))
        .withColumn("plain", F.sum((F.col("pivot") == F.col("first")).cast("long")).over(region))
    )
    whole = F.col("copies") > 1.5 * F.col("plain")
    return seen.where(F.when(whole, F.col("pivot") == F.col("first")).otherwise(F.col("inside"))).select(
        F.when(whole, F.col("sig")).otherwise(F.xxhash64("sig", "pivot")).alias("sig"), "node", "d"
    )

"""The Jaccard join against all pairs of a small corpus."""

import random

import numpy as np
import pytest

from tallyline.llm import jaccard

WORDS = [f"w{i}" for i in range(300)]


def _brute(docs, n, num, den):
    sets = []
    for _, text in docs:
        words = (text or "").encode().lower().split()
        width = min(n, len(words))
        sets.append(frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset())
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted((docs[i][0], len(sets[i]), least[top(i)]) for i in range(len(docs)))


def _corpus(seed):
    r = random.Random(seed)
    texts = [None, "", " \n\t", "One", "one", "one two", "ONE  two\tthree", "É é", "é é"]
    for group in range(6):
        base = [r.choice(WORDS) for _ in range(r.choice([8, 30, 120, 260]))]
        for _ in range(30 if group else 90):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 5, 9, 20])):
                copy[r.randrange(len(copy))] = r.choice(WORDS)
            texts.append(" ".join(copy))
    texts += [" ".join(r.choice(WORDS) for _ in range(r.randint(1, 90))) for _ in range(60)]
    # Passages that many texts share, so that unrelated sets meet in large regions.
    passage = [r.choice(WORDS) for _ in range(40)]
    for _ in range(60):
        own = [r.choice(WORDS) for _ in range(r.choice([10, 20, 60, 100]))]
        texts += [" ".join(passage + own), " ".join(passage + own[:-1] + ["x"])][: r.randint(1, 2)]
    texts += texts[20:30]
    r.shuffle(texts)
    return list(enumerate(texts, start=5))


@pytest.mark.parametrize(
    "n, num, den, small, block, seed", [(3, 90, 100, 16, 1500, 1), (5, 80, 100, 4, 20, 2), (3, 90, 100, 2, 12, 3)]
)
def test_components_equal_brute_force(spark, monkeypatch, n, num, den, small, block, seed):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "MAX_BROADCAST_ROWS", 0 if seed == 3 else jaccard.MAX_BROADCAST_ROWS)
    docs = _corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, node int, sig string")
    found = jaccard.similar(df, n=n, num=num, den=den).select("id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, found)) == _brute(docs, n, num, den)


def test_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [(1, "a b c d"), (1, "e f g h"), (None, "a b c d"), (2, "e f g h"), (3, long), (4, long + " v"), (None, None)]
    found = jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.id or 0, r.n_shingles, r.component_id or 0) for r in found) == [
        (0, 0, 0), (0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 59_998, 3), (4, 59_999, 3),
    ]
    assert jaccard.similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_meet_for_every_linked_pair():
    r = random.Random(4)
    for num, den in ((90, 100), (80, 100)):
        keys = jaccard.Signatures(num, den)
        for _ in range(3000):
            a = set(r.sample(range(10**6), r.choice([r.randint(1, 60), r.randint(60, 400)])))
            b = set(a)
            for _ in range(r.randint(0, max(1, len(a) // 6))):
                if r.random() < 0.5 and len(b) > 1:
                    b.discard(r.choice(sorted(b)))
                else:
                    b.add(r.randrange(10**6))
            if den * len(a & b) >= num * len(a | b):
                x, y = (keys.of(jaccard.mix(np.array(sorted(s), np.uint64))) for s in (a, b))
                level = max(x[1].min(), y[1].min())
                one, two = (int(need[levels == level][0]) for _, levels, need in (x, y))
                need = max(-one, -two) if one < 0 and two < 0 else max(one, two)
                assert need > 0 and len(np.intersect1d(x[0], y[0])) >= need, (a, b)


def test_names_of_groups_do_not_depend_on_the_order_of_rows(spark):
    r = random.Random(5)
    nodes = [r.randrange(-(2**63), 2**63) for _ in range(300)]
    names = set()
    for sig in (1, 2, 3, 4):
        rows = [(sig, x, x) for x in r.sample(nodes, len(nodes))]
        df = spark.createDataFrame(rows, "sig long, node long, root long").coalesce(1)
        names |= {x.sig for x in jaccard._named_by_members(df).collect()}
    assert len(names) == 1
    other = spark.createDataFrame([(1, x, x) for x in nodes[1:]], "sig long, node long, root long")
    assert not names & {x.sig for x in jaccard._named_by_members(other).collect()}


def _hashes(r, size):
    return {r.randrange(2**64) for _ in range(size)}


def test_sketches_lose_no_link():
    r = random.Random(6)
    for num, den in ((90, 100), (80, 100)):
        for _ in range(400):
            a = _hashes(r, r.choice([1, 2, 9, 40, 300, 5000]))
            b = set(sorted(a)[r.randint(0, len(a) // 8) :]) | _hashes(r, r.randint(0, len(a) // 8))
            sets = [np.array(sorted(x), np.uint64) for x in (a, b, _hashes(r, 1))]
            open_pairs = jaccard.may_link([jaccard.sketch_of(x) for x in sets], np.array([len(x) for x in sets]), num, den)
            assert open_pairs[0, 1] == open_pairs[1, 0] and (open_pairs[0, 1] or den * len(a & b) < num * len(a | b))


def test_contents_go_only_where_sketches_leave_a_pair_open(spark):
    """Sets that share a passage fill many large regions; before, each region got all their contents."""
    r = random.Random(7)
    passage = _hashes(r, 60)
    found = [passage | _hashes(r, 240) for _ in range(80)]
    found.append(set(sorted(found[0])[:-10]))  # linked with the first, and only with it
    arrays = [np.array(sorted(x), np.uint64) for x in found]
    nodes = [jaccard.node_of(x) for x in arrays]
    rows = [(n, x.astype(np.int64).tolist(), bytearray(jaccard.sketch_of(x))) for n, x in zip(nodes, arrays)]
    sets = spark.createDataFrame(rows, "node long, found array<long>, sketch binary")
    regions = [(sig, n, n, len(nodes) - sig) for sig in range(5) for n in nodes[: len(nodes) - sig]]
    regions += [(5, n, n, len(nodes)) for n in nodes]
    df = spark.createDataFrame(regions, "sig long, node long, root long, members long")
    opened = jaccard._open_parts(df.select("sig", "node", "root"), sets, 80, 100).collect()
    assert {x.node for x in opened} == {nodes[0], nodes[-1]} and len(opened) == 4
    links = {frozenset(x) for x in jaccard._join_blocks(df, sets, 80, 100).collect()}
    assert links == {frozenset((nodes[0], nodes[-1]))}

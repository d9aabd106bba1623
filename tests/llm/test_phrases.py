"""Collocations against brute force."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tallyline.llm import phrases
from tallyline.llm.queries import ORACLES, op13_phrase_collocations


def _pieces(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def _counts(rows, longest=5):
    out, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in _pieces(text):
            totals[lang or "und"] += len(piece)
            for k in range(1, longest + 1):
                for i in range(len(piece) - k + 1):
                    out[lang or "und", tuple(piece[i : i + k])] += 1
    return out, totals


def _brute(rows, least, top):
    f, totals = _counts(rows)
    candidates = {key: n for key, n in f.items() if len(key[1]) > 1 and n >= least}
    out = []
    for lang in totals:
        mine = {words: a for (name, words), a in candidates.items() if name == lang}
        found = []
        for words, a in mine.items():
            k = len(words)
            holds = lambda other: any(other[i : i + k] == words for i in range(len(other) - k + 1))
            if any(len(o) > k and 100 * b >= 100 * a and holds(o) for o, b in mine.items()):
                continue
            cuts = [(f[lang, words[:j]], f[lang, words[j:]]) for j in range(1, k)]
            score, _, (x, y) = min((1000 * a * totals[lang] // (x * y), j, (x, y)) for j, (x, y) in enumerate(cuts))
            found.append((score, a, " ".join(words), x, y))
        found.sort(key=lambda t: (-t[0], -t[1], t[2].encode()))
        out += [(lang, i + 1, p, a, x, y, totals[lang], s) for i, (s, a, p, x, y) in enumerate(found[:top])]
    return sorted(out)


def _rows(r, n):
    words = ["the", "The", "of", "new", "YORK", "times", "é", "Ünder", "a\x1cb", "x\xa0y", "\x00", "ça"]
    marks = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\x0b", "\r\n", "!?", ";"]
    made = lambda: "".join(r.choice(words[: r.choice([3, 6, 12])]) + r.choice(marks) for _ in range(r.randint(0, 40)))
    rows = [(r.choice(["en", "de", None, "und"]), r.choice([made, made, lambda: "of the new york times"])()) for _ in range(n)]
    return rows + [("en", None), ("en", ""), (None, None), ("fr", " . "), ("en", "the the the the the the the")] * 2


@pytest.mark.parametrize("held, burst", [(phrases.HELD, phrases.BURST), (40, 3)])
def test_counts_equal_brute_force(monkeypatch, held, burst):
    """Also where containers burst at once, the trie spills all the time, and numbers are given anew."""
    monkeypatch.setattr(phrases, "TOGETHER", 300 if held == 40 else phrases.TOGETHER)
    monkeypatch.setattr(phrases, "NUMBERED", 9 if held == 40 else phrases.NUMBERED)
    monkeypatch.setattr(phrases.HatTrie.__init__, "__defaults__", (burst, phrases.LEVELS))
    rows = _rows(random.Random(1), 150)
    batches = []
    for low, high in ((1, 1), (2, 5)):
        counter = phrases.Counter(low, high, held=held)
        batches += [b for lang, text in rows for b in counter.read(lang or "und", text)]
        batches += list(counter.finish())
    assert held != 40 or len(batches) > 20
    got = Counter()
    for row in pa.Table.from_batches(batches).to_pylist():
        assert row["k"] == (len(row["phrase"].split(" ")) if row["k"] else 0)
        got[row["lang"], row["k"], row["phrase"]] += row["f"]
    counts, totals = _counts(rows)
    expected = {(lang, len(words), " ".join(words)): n for (lang, words), n in counts.items()}
    expected |= {(lang, 0, ""): totals[lang] for lang in {lang or "und" for lang, _ in rows} if lang in totals}
    assert dict(got) == expected


def test_containers_burst_and_subtrees_leave_whole():
    trie = phrases.HatTrie(burst=2, levels=3)
    paths = [bytes([0, 0, 0, a, 0, 0, 0, b, 0, 0, 0, c]) for a in range(3) for b in range(4) for c in range(4)]
    trie.add(paths, [1] * 48)
    trie.add([paths[0][:4], paths[0][:8], paths[5]], [7, 8, 9])
    assert type(trie.root.below[paths[0][:4]]) is phrases.Inner
    taken = list(trie.take(20))
    assert len(taken) == 2 and trie.size <= 20
    assert all(path.startswith(step) for step, run in taken for path, _ in run)
    left = list(trie.take(0))
    assert trie.size == 0
    found = Counter(dict(e for _, run in taken + left for e in run))
    assert found == Counter(paths) + Counter({paths[0][:4]: 7, paths[0][:8]: 8, paths[5]: 9})


def test_long_texts_are_cut_at_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "_SLICE", 50)
    r = random.Random(2)
    text = "".join(r.choice(["a", "b c", "é"]) + r.choice([" ", " ", "."]) for _ in range(3_000)) + " z" * 500
    slices = list(phrases.words_of(text))
    assert len(slices) > 10
    flat = [w for s in slices for w in s if w != b"."]
    assert flat == [w.encode() for p in _pieces(text) for w in p]


def test_pairs_are_counted_by_bucket(monkeypatch):
    monkeypatch.setattr(phrases, "TOGETHER", 100)
    rows, every = _rows(random.Random(4), 100), np.full(1, -1, np.int64).view(np.uint64)
    counts, _ = _counts(rows, 2)
    pairs = sum(n for (_, words), n in counts.items() if len(words) == 2)
    for held, mask in ((400_000, 2**62 - 1), (3, 2**62 - 1), (400_000, 7)):
        monkeypatch.setattr(phrases, "HELD", held)
        counter = phrases.PairCounter(every, mask)
        batches = [b for lang, text in rows for b in counter.read(lang or "und", text)] + list(counter.put(0))
        got = Counter()
        for row in pa.Table.from_batches(batches).to_pylist():
            got[row["h"]] += row["f"]
        assert sum(got.values()) == pairs
        wanted = sorted(n for (_, words), n in counts.items() if len(words) == 2)
        assert sorted(got.values()) == wanted if mask > 7 else set(got) == set(range(8))


def test_collocations_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 10)  # lets many wrong pairs through
    monkeypatch.setattr(phrases, "HELD", 5)  # pairs are given out all the time
    rows = _rows(random.Random(3), 400)
    df = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, f int, phrase string")
    for least, top in ((3, 10_000), (20, 7)):
        found = phrases.top(phrases.collocations(phrases.frequent(df.repartition(5), least=least)), top)
        got = found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
        assert sorted(map(tuple, got)) == _brute(rows, least, top)


def test_products_over_64_bits_are_exact(spark):
    a, n = 3 * 10**15 + 7, 9 * 10**15 + 1
    rows = [("en", 0, "", n), ("en", 1, "x", a + 5), ("en", 1, "y", a + 11), ("en", 2, "x y", a)]
    row = phrases.collocations(spark.createDataFrame(rows, "lang string, k int, phrase string, f bigint")).first()
    assert (row.l, row.r, row.score) == (a + 5, a + 11, 1000 * a * n // ((a + 5) * (a + 11)))


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert phrases.top(phrases.collocations(phrases.frequent(df))).count() == 0


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    expected = connection.execute(ORACLES["op13_phrase_collocations"])
    columns = [c[0] for c in expected.description]
    got = op13_phrase_collocations(spark, "/root/testdata/sf0.01").select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected.fetchall()) and got

"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import periodic
from tallyline.llm.queries import op11_periodic_runs


def _brute(words):
    """All runs: for each period the maximal stretches, kept where no smaller period fits."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            stretch = words[i : i + length]
            smaller = any(all(stretch[x] == stretch[x + p] for x in range(length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _random_text(r):
    words = [r.choice("ab" if r.random() < 0.5 else "abcde") for _ in range(r.randint(0, 30))]
    for _ in range(r.randint(0, 3)):
        block = [r.choice("abxyz") for _ in range(r.choice([1, 1, 2, 3, 5, 6, 7, 15, 16, 17, 30]))]
        words += (block * r.randint(2, 7))[: r.randint(1, 150)] + [r.choice("abc") for _ in range(r.randint(0, 5))]
    return r.choice([" ", "\n", " \t"]).join(words)


def test_runs_equal_brute_force():
    r = random.Random(1)
    texts = [None, "", " \n ", "a", "a " * 5, "a " * 6, "a b " * 4, "a b c " * 3 + "a b", "a b c " * 4, "é\x85 " * 9]
    texts += [_random_text(r) for _ in range(400)] + ["a b a b a b a b b b b b b b"] * 2
    for part in (texts, *([t] for t in texts[:60])):
        for text, (n, runs, left) in zip(part, periodic.collapse(part)):
            words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
            assert (n, runs) == (len(words), _brute(words)), text
            assert left == _collapsed(words, runs)


@pytest.mark.parametrize("word", ["aab", "thue"])
def test_words_without_and_with_many_squares(word):
    """Fibonacci words hold many runs of exponent under four; Thue-Morse words none over two."""
    a, b = ("a", "ab") if word == "aab" else ("ab", "ba")
    for _ in range(9):
        a, b = (b, b + a) if word == "aab" else (a + b, b + a)
    text = list(b[:700])
    ids = np.array([ord(c) for c in text], np.int64)
    assert periodic.find_runs(ids) == _brute(text)


def test_long_text_of_one_word_and_of_a_long_period():
    r = random.Random(2)
    ((n, runs, left),) = periodic.collapse(["a " * 300_000])
    assert (n, runs, left) == (300_000, [(0, 300_000, 1)], "a")
    block = [str(r.random()) for _ in range(4_000)]
    ((n, runs, left),) = periodic.collapse([" ".join(["x", *block * 5, "y"])])
    assert runs == [(1, 20_000, 4_000)] and left == " ".join(["x", *block, "y"])


def _expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _brute(words)
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)), digest(_collapsed(words, runs)),
    )


def test_query_equals_brute_force(spark, tmp_path):
    """Ties, repeated rows, nulls, empty texts, and columns whose names clash."""
    r = random.Random(3)
    planted = [i for i in range(4_000) if zlib.crc32(str(i).encode()) % 10 == 0][:150]
    prose = lambda n: " ".join(r.choice("abcdefghijklm") * 2 + str(r.randint(0, 40)) for _ in range(n))
    rows = [(i, prose(r.randint(0, 90)), "x", 1) for i in planted]
    rows += [(i, _random_text(r), None, None) for i in range(100_000, 100_060)]
    rows += [(planted[0], None, "x", 1), (planted[1], "", "x", 1), (None, "a " * 8, None, 2), (None, None, None, None)]
    rows += [(7, "a a a a a a b c c c c c c", "tie", 3)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, collapsed int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    out = op11_periodic_runs(spark, str(tmp_path)).select(columns)
    assert dict(out.dtypes)["n_runs"] == "bigint" and dict(out.dtypes)["exponent_milli"] == "bigint"
    key = lambda row: str(tuple(row))
    assert sorted(map(tuple, out.collect()), key=key) == sorted((_expected(i, t) for i, t, _, _ in rows), key=key)


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string")
    assert df.select(periodic.periodic("text").alias("m")).select("m.*", F.size("m.runs")).count() == 0

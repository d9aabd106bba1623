"""Repetition counts against brute force."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import repetition


def _brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    repeated = {i + k for i in range(n - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    covered, longest = set(), 0
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        if best >= repetition.MIN_WORDS:
            covered |= set(range(i, i + best))
            longest = max(longest, best)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return [n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), len(covered), longest]


def test_counts_equal_brute_force():
    r = random.Random(1)
    texts = [None, "", "  \n", "a", " ".join(["a"] * 40), "x\x85y\xa0z　 é\x1cb", "# *\n#\t*\n\n# *"]
    texts += [
        " ".join(r.choice("abc") for _ in range(r.randint(1, 50))) + r.choice(["", "\nx y\nx y\n", "\n"]) for _ in range(80)
    ]
    base = " ".join(r.choice("abcdefgh") for _ in range(25))
    texts += [f"{base} z {base} q {base[:30]}", base, base]
    got = np.stack(repetition.measure(texts), 1).tolist()
    for text, row in zip(texts, got):
        assert row == _brute(text), text


def test_verdict(spark, monkeypatch):
    r = random.Random(2)
    prose = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    block = prose(40)
    rows = {
        "short": prose(49), "prose": prose(400), "line twice": prose(300) + "\n" + block[:80] + "\n" + block[:80],
        "third repeated": prose(80) + " " + block + " " + block, "looped": " ".join([prose(4)] * 100),
        "long repeat": (long := prose(150)) + " " + prose(2000) + " " + long, "none": None, "huge": prose(30_000),
    }
    df = spark.createDataFrame([(k, v, 1) for k, v in rows.items()] * 2, "name string, text string, m int")
    df = df.select("name", repetition.measures("text").alias("m"))
    failed, kept = repetition.verdict("m")
    got = {r.name: (r.f, r.k) for r in df.select("name", failed.alias("f"), kept.alias("k")).collect()}
    assert got == {
        "short": (True, False), "prose": (False, True), "line twice": (False, True), "third repeated": (False, False),
        "looped": (True, False), "long repeat": (False, False), "none": (True, False), "huge": (False, True),
    }
    assert df.where(F.lit(False)).count() == 0

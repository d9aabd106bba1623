"""Leaks against a brute-force search."""

import random

from tallyline.llm import leaks

VOCABULARY = ["the", "of", "and", "in", "a"] * 8 + [f"w{i}" for i in range(400)]


def _items(r):
    texts = []
    for _ in range(60):
        sentences = [" ".join(r.choice(VOCABULARY) for _ in range(r.randint(4, 14))) for _ in range(r.randint(1, 4))]
        texts.append(". ".join(s.capitalize() for s in sentences) + ".")
    return list(enumerate(texts, start=100))


def _corpus(r, items):
    docs = [(1, None), (2, ""), (3, "the of and in a " * 50), (4, "?!")]
    for n in range(150):
        words = [r.choice(VOCABULARY) for _ in range(r.choice([5, 60, 300, 2000]))]
        if n % 3 == 0:
            part = r.choice(items)[1]
            if n % 2:
                part = part.upper().replace(".", " !")
            if n % 5 == 0:
                part = part[: len(part) // 2]
            if n % 7 == 0:
                split = part.split()
                split[r.randrange(len(split))] = "zzz"
                part = " ".join(split)
            at = r.randrange(len(words))
            words[at:at] = part.split(" ")
        docs.append((10 + n, " ".join(words)))
    return docs + docs[-3:]


def _brute(docs, items):
    out = []
    for doc, text in docs:
        words = leaks.words_of(text)
        for item_id, item_text in items:
            item = leaks.Item(item_id, w := leaks.words_of(item_text), leaks._answer_at(item_text, len(w)))
            question, answer = item.shingles()
            width = min(5, len(w))
            have = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
            q, a = len(question & have), len(answer & have)
            if q + a >= 0.8 * (len(question) + len(answer)) and 2 * q >= len(question) and 2 * a >= len(answer):
                out.append((doc, item_id))
    return sorted(out)


def test_leaks_equal_brute_force(spark, monkeypatch):
    r = random.Random(5)
    items = _items(r)
    docs = _corpus(r, items)
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    expected = _brute(docs, items)
    assert len(expected) > 20
    assert sorted((r.id, r.item_id) for r in leaks.leaks(df, benchmark).collect()) == expected
    monkeypatch.setattr(leaks, "ITEMS_PER_BLOCK", 25)
    assert sorted((r.id, r.item_id) for r in leaks.leaks(df, benchmark).collect()) == expected


def test_search_finds_all_above_the_threshold():
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(VOCABULARY) for _ in range(r.randint(3, 16)))) for i in range(200)]
    df = {}
    for _, text in rows:
        for w in set(leaks.words_of(text)):
            df[w] = df.get(w, 0) + 1
    index = leaks.Index(rows, df, len(rows), 10.0)
    for _ in range(200):
        words = {r.choice(VOCABULARY).encode() for _ in range(r.randint(1, 60))}
        terms = [index.terms[w] for w in words if w in index.terms]
        scores = {}
        for t in terms:
            p = index.postings[t]
            for k, impact in zip(p.items, p.impacts):
                scores[k] = scores.get(k, 0) + impact
        for threshold in (0.2, 0.5):
            wanted = {k for k, s in scores.items() if s >= threshold}
            assert {k for k, _ in index.search(terms, 0, len(index.items), threshold)} == wanted


def test_empty_tables_and_odd_items(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (2, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks.leaks(docs, none).count() == 0
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "..."), (4, "x"), (4, "x"), (None, "Beta gamma, delta epsilon zeta")], "item_id long, text string"
    )
    assert leaks.leaks(docs.limit(0), odd).count() == 0
    got = sorted((r.id, r.item_id or 0) for r in leaks.leaks(docs, odd).collect())
    assert got == [(1, 0), (2, 4), (2, 4)]

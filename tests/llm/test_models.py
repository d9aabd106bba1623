"""Learned operators: accuracy on rows held out, and odd rows."""

import random

import numpy as np
import pytest

from tallyline.llm import html_crf, knn_quality, langmix, url_lm
from tallyline.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    got = QUERIES["op7_language_mixture"](spark, SF).toPandas()
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "n_chars").toPandas()
    held = got.merge(lang, on="doc_id").query("held_out and n_chars > 20")
    assert len(got) == len(lang) and (held.lang == held.lang_pred).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_mixtures_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langmix.fit(docs, "text", "lang", "doc_id")
    by = {r.lang: r.text for r in docs.where("n_chars between 1500 and 3000").collect()}
    odd = [(7, "🎉🎉🎉"), (8, "😀 12"), (9, "𝐀𝐁"), (10, "𐐀𐐁𐐂")]  # signs, and letters outside the first plane
    rows = [*odd, (1, None), (2, ""), (3, "123 !?"), (4, by["en"] + " " + by["de"]), (5, by["fr"]), (6, by["es"] * 60)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: r.f for r in df.select("id", langmix.predict(model, spark, "text").alias("f")).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 5, 6, 7, 8)] == ["und"] * 3 + ["fr", "es"] + ["und"] * 2
    assert all(got[i].lang_pred != "und" for i in (9, 10))
    assert set(got[4].langs) == {"de", "en"} and abs(sum(got[4].shares) - 1) < 1e-3 and got[5].langs == ["fr"]
    nothing = langmix.fit(docs.limit(0), "text", "lang", "doc_id")
    assert df.select(langmix.predict(nothing, spark, "text").alias("f")).where("f.lang_pred <> 'und'").count() == 0


def test_em_raises_the_likelihood():
    r = np.random.default_rng(1)
    p, n = r.random((3, 40)) + 0.01, r.integers(1, 9, 40).astype(float)
    reached = [langmix.shares(p, n, k)[1] for k in (1, 3, 10, 50)]
    assert reached == sorted(reached)


def test_quality_of_held_out_rows(spark):
    got = QUERIES["op6_neighbour_votes"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    held = got.merge(labels, on="doc_id").query("held_out")
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (held.predicted == held.quality).mean() > 0.95 and got.score.between(0, 1).all()


def test_votes_equal_brute_force(spark):
    r = np.random.default_rng(2)
    vectors = knn_quality.unit(r.normal(size=(80, 6))).astype(np.float32)
    labels = (r.random(80) < 0.5).astype(float)
    basis = np.eye(knn_quality.WIDTH, 6, dtype=np.float32)
    model = knn_quality.Model(np.ones(knn_quality.WIDTH, np.float32), basis, vectors, labels, 0.5)
    found = [(np.arange(6), np.exp(r.random(6)) - 1) for _ in range(20)]
    for (at, n), got in zip(found, model.score(found)):
        q = np.log1p(n) / np.linalg.norm(np.log1p(n))
        cos = vectors @ q
        near = np.argsort(-cos)[: knn_quality.NEIGHBOURS]
        weight = np.maximum(cos[near], 0) ** knn_quality.SHARPNESS
        assert got == pytest.approx((weight * labels[near]).sum() / weight.sum(), abs=1e-4)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good words here"), (2, "BAD!! BAD!!"), (3, None), (4, ""), (1, "good words here")], "doc_id long, text string"
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (9, 1), (2, None), (2, 0)], "doc_id long, quality int")
    model = knn_quality.fit(docs, labels, "doc_id", "text", "quality")
    got = docs.select("doc_id", knn_quality.scores(model, spark, "text").alias("s")).collect()
    by = {r.doc_id: r.s for r in got}
    assert by[1] > 0.5 > by[2] and by[3] == by[4] == pytest.approx(model.prior)
    nothing = knn_quality.fit(docs, labels.limit(0), "doc_id", "text", "quality")
    assert {r.s for r in docs.select(knn_quality.scores(nothing, spark, "text").alias("s")).collect()} == {0.5}
    assert docs.limit(0).select(knn_quality.scores(model, spark, "text")).count() == 0


def test_urls(spark):
    got = {r.page_id: r for r in QUERIES["op5_url_ratio"](spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/pages.parquet").count()
    rules = [("org/", "allow"), ("example.org/es/", "block"), ("com/fr/", "allow")]
    rows = [
        (1, "HTTP://www.Example.ORG/es/1?x#y"), (2, "http://example.org"), (3, "https://a.com/fr/"), (4, "https://a.com/FR/"),
        (5, None), (6, "no scheme/x"), (7, ""), (8, "http://notorg/x"), (9, "x://h/p://q?u"), (10, "http://x.org/" + "p" * 20_000),
        (11, "http://spam-farm.net/a"), (12, "http://quiet.net/a"), (12, "http://quiet.net/a"),
    ]
    df = spark.createDataFrame([(i, u, "h") for i, u in rows], "page_id long, url string, host string")
    out = {r.page_id: r for r in url_lm.judge(df, rules).collect()}
    assert [(out[i].rule, out[i].verdict) for i in (1, 3, 10)] == [
        ("example.org/es/", "block"), ("com/fr/", "allow"), ("org/", "allow"),
    ]
    assert out[2].rule is None  # an empty path does not start with the rule's "/"
    assert (out[1].host, out[1].path, out[2].path, out[9].host, out[9].path) == ("www.example.org", "/es/1", "", "h", "/p://q")
    assert all((out[i].host, out[i].path, out[i].rule, out[i].verdict) == ("", "", None, "allow") for i in (5, 6, 7))
    assert out[4].rule is None and out[8].rule is None
    assert {r.verdict for r in url_lm.judge(df.where("page_id = 2"), rules).collect()} == {"allow"}
    assert url_lm.judge(df.limit(0), rules).count() == 0


def test_url_models_tell_hosts_apart():
    r = random.Random(3)
    model = {}
    for side, stem in ((True, ["green", "meadow", "river"]), (False, ["pills", "casino", "bets"])):
        m = model[side] = url_lm.CharModel({}, {}, {})
        for _ in range(200):
            padded = url_lm.START * url_lm.ORDER + r.choice(stem) + r.choice(stem) + f"/{r.randint(1, 99)}" + url_lm.END
            for i in range(url_lm.ORDER, len(padded)):
                for k in range(url_lm.ORDER + 1):
                    gram = padded[i - k : i + 1]
                    m.kinds[gram[:-1]] = m.kinds.get(gram[:-1], 0) + (gram not in m.after)
                    m.after[gram] = m.after.get(gram, 0) + 1
                    m.total[gram[:-1]] = m.total.get(gram[:-1], 0) + 1
    ratio = url_lm.Ratio(model[True], model[False], 0.0)
    assert ratio.score("meadowgreen/7") > 0.3 and ratio.score("casinopills/7") < -0.3 and ratio.score("") == 0
    assert url_lm.calibrate(np.array([2.0, 3.0]), np.array([0.0, 1.0])) == 1.5
    many = np.concatenate([[-1.0], np.arange(10.0, 30.0)])
    assert url_lm.calibrate(many, np.array([0.0, 1.0]), 0.1) == 5.5 and url_lm.calibrate(many, np.array([0.0, 1.0]), 0.0) < -1


def test_url_models_count_every_labelled_address(spark):
    """Scores equal those of models made in one place of all examples; more than a sample of 4,000 a class was, before."""
    import zlib

    r = random.Random(8)
    stems = {True: ["green", "meadow", "rivér", "hill"], False: ["pills", "casino", "bets", "𝐀win"]}
    rows = {}
    for side in (True, False):
        while sum(x is side for x in rows.values()) < 4500:
            rows[f"{r.choice(stems[side])}{r.choice(stems[side])}{r.randint(1, 99)}/{r.randint(1, 9999)}"] = side
    rows |= {"unlabelled/1": None, "greencasino/zzz": None, "": True}
    model = {side: url_lm.CharModel({}, {}, {}) for side in (True, False)}
    for address, side in rows.items():
        if side is None or not address or zlib.crc32(address.encode()) % 5 == 0:
            continue
        m, padded = model[side], url_lm.START * url_lm.ORDER + address + url_lm.END
        for i in range(url_lm.ORDER, len(padded)):
            for k in range(url_lm.ORDER + 1):
                gram = padded[i - k : i + 1]
                m.kinds[gram[:-1]] = m.kinds.get(gram[:-1], 0) + (gram not in m.after)
                m.after[gram] = m.after.get(gram, 0) + 1
                m.total[gram[:-1]] = m.total.get(gram[:-1], 0) + 1
    ratio = url_lm.Ratio(model[True], model[False], 0.0)
    scores, threshold = url_lm.fit(spark.createDataFrame(list(rows.items()), "address string, accepted boolean"))
    got = {x.address: x.score for x in scores.collect()}
    assert got.keys() == rows.keys() - {""}
    some = [*r.sample(sorted(got), 500), "unlabelled/1", "greencasino/zzz"]
    assert all(got[a] == pytest.approx(ratio.score(a), abs=1e-6) for a in some)
    kept = {s: np.array([got[a] for a in got if rows[a] is s and zlib.crc32(a.encode()) % 5 == 0]) for s in (True, False)}
    assert (kept[True] >= threshold).mean() >= 0.99 and (kept[False] < threshold).mean() > 0.99


def test_url_verdicts_on_hosts_without_a_rule(spark):
    """Ordinary hosts pass in every language, hosts with a listed word do not."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    rows = url_lm.judge(pages, URL_RULES).where("rule is null").select("host", "path", "verdict").collect()
    clean = [r for r in rows if not any(s in r.host for s in url_lm.SEEDS)]
    unwanted = [r.verdict for r in rows if any(s in r.host for s in url_lm.SEEDS)]
    assert sum(r.verdict == "allow" for r in clean) >= 0.95 * len(clean) > 100
    for lang in ("en", "de", "es", "fr"):
        mine = [r.verdict for r in clean if r.path.startswith(f"/{lang}/")]
        assert mine.count("allow") >= 0.95 * len(mine)
    assert unwanted.count("block") >= 0.95 * len(unwanted) > 10


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>"</script></head><body>
<header class="site-header"><p>Site name</p></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">About</a></ul></nav>
<div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div>
<article><h1>The  title &amp; more</h1><p>First <b>bold</b> &eacute;t&eacute;.<br>Second line,\u00a0here.<p>An unclosed one, long enough to be prose.
<div class="ad">Buy it now.</div><p>Last paragraph.</p></article>
<aside><h3>Related</h3><p>Other things.</p></aside><section class="comments"><h3>Comments</h3><p>Nice, I liked it.</p></section>
<form><label>Mail</label><input></form><footer>&copy; Someone. All rights reserved.</footer></body></html>"""


@pytest.fixture(scope="module")
def crf():
    return html_crf.train(html_crf.layouts(300))


def test_main_text(crf):
    assert crf.text(PAGE) == (
        "The title & more\n\nFirst bold été. Second line, here.\n\nAn unclosed one, long enough to be prose.\n\nLast paragraph."
    )
    cut = PAGE[: PAGE.index("Last paragraph") + 8]
    assert "An unclosed one, long enough to be prose." in crf.text(cut) and crf.text(PAGE.upper()).startswith("THE TITLE")
    for odd in (None, "", "   ", "<", "<!-- <p>x</p>", "<script>alert(1)", "&#0;", "</p></div>", "<p" * 500):
        assert isinstance(crf.text(odd), str)


def test_layouts_that_were_not_drawn_for_training(crf):
    pages = html_crf.layouts(150, seed=99)
    wrong = sum(crf.decode(blocks) != labels for blocks, labels in pages)
    assert wrong <= 5


def test_viterbi_and_marginals_equal_enumeration():
    from itertools import product

    r = np.random.default_rng(4)
    for n in (1, 2, 5):
        e, pairs = r.normal(size=n), r.normal(size=(2, 2))
        score = lambda y: sum(x for x, k in zip(e, y) if k) + sum(pairs[a, b] for a, b in zip(y, y[1:]))
        all_y = list(product((0, 1), repeat=n))
        weight = np.exp([score(y) for y in all_y])
        on, expected = html_crf.marginals(e, pairs)
        assert np.allclose(on, [sum(w for w, y in zip(weight, all_y) if y[i]) / weight.sum() for i in range(n)])
        assert expected.sum() == pytest.approx(n - 1)
        field = html_crf.Field({}, np.zeros(0), pairs)
        field.emissions = lambda blocks, e=e: e
        assert [int(x) for x in field.decode([0] * n)] == list(max(all_y, key=score))


def test_pages_of_the_table(spark):
    got = QUERIES["op1_crf_blocks"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 50 and all(r.n_chars == len(r.text) and r.text for r in got)
    assert not any(bad in r.text for r in got for bad in ("track(", "margin:0", "©", "<p>"))
    pages = spark.createDataFrame([(1, "u", None, "t"), (1, "u", "", "t"), (2, None, "<p>x</p>", "t")], "page_id long, url string, html string, text string")
    model = html_crf.fit(pages, "html", "page_id", drawn=20)
    assert pages.select(html_crf.main_text(model, spark, "html").alias("m")).where("m is null").count() == 0
    assert pages.limit(0).select(html_crf.main_text(model, spark, "html")).count() == 0

"""The pipeline's stages, each against what it has to do, and the whole run."""

import pytest

import corpus_pipeline
from tallyline.llm import jaccard, leaks, pii
from tallyline.llm.common import Stored

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    store, docs, out = Stored(spark), spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        done = store.put(stage(spark, docs, SF), name)
        out.append((name, docs, done))
        docs = done
    return out


def test_columns(stages):
    for _, before, after in stages[:-1]:
        assert after.schema.names == before.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]


def test_decisions(stages):
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    (_, raw, known), (_, _, single), (_, _, clean), (_, _, private), (_, _, tokens) = stages
    assert len(ids(raw) - ids(known)) < 0.01 * raw.count()
    groups = jaccard.similar(known, n=5, num=80, den=100).toPandas()
    assert ids(single) == set(groups.component_id)
    found = {r.id for r in leaks.leaks(single, single.sparkSession.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert found and ids(clean) == ids(single) - found and ids(private) == ids(clean) == ids(tokens)
    before, after = ({r.doc_id: r for r in df.collect()} for df in (clean, private))
    changed = [i for i in before if before[i].text != after[i].text]
    hits = {r.doc_id for r in clean.where(clean.text.rlike(pii.ANY)).collect()}
    assert set(changed) == hits and all(r.n_chars == len(r.text) for r in after.values())
    rows = tokens.collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)


def test_run_gives_the_last_stage(spark, stages):
    got = {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {(r.doc_id, r.n_tokens) for r in stages[-1][2].collect()}


def test_odd_rows(spark):
    rows = [
        (1, "The and of the in that.", "en", "s", 1, "x"), (1, "The and of the in that.", "en", "s", 1, "x"), (2, None, "en", "s", None, "x"),
        (3, "", None, None, 0, "x"), (4, "12 34", "en", "s", 5, "x"), (None, "the of and with", "en", "s", 3, "x"),
        (5, "der die das und nicht " * 4000, "de", "t", 7, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string"
    docs = spark.createDataFrame(rows, schema)
    for frame in (docs, docs.limit(0)):
        n = None
        for _, stage in corpus_pipeline.STAGES:
            frame = Stored(spark).put(stage(spark, frame, SF), "odd")
            n = frame.count()
        assert n in (0, 3)


def test_null_and_repeated_ids_are_decided_by_text(spark):
    copy = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    near = [t + " end" for t in copy]
    rows = [
        (None, copy[0]), (None, near[0]), (3, near[0]),  # the row with an id stays
        (None, copy[1]), (None, near[1]),  # one of them stays
        (5, copy[2]), (4, near[2]), (5, "quite another text of the same id"), (5, "quite another text of the same id"),
        (None, None), (6, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()]
    unnamed = [r for r in kept if r[1] in (copy[1], near[1])]
    assert len(unnamed) == 1
    want = [(3, near[0]), (4, near[2]), (5, rows[7][1]), (None, None), (6, "")]
    assert sorted(map(str, kept)) == sorted(map(str, want + unnamed))

    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, item), (None, "clean text"), (1, item), (1, "another clean text"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in corpus_pipeline.leak_stage(spark, docs, SF).collect()]
    assert sorted(map(str, left)) == sorted(map(str, [rows[1], rows[3], rows[4]]))

"""The stored table: writes, replays, the stream, schema changes, batches."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import batches, conform
from tallyline.plans import evolve, table
from tallyline.plans.downloads import kept, parse_lines
from tallyline.schema import DOWNLOADS, NULLABLE, REPEATED, REQUIRED, fields_from_json, from_struct, to_struct
from tallyline.session import work_folder
from tallyline.sources.synth import TOKEN, lines_of
from tallyline.sources.text import read_lines, stream_lines
from tallyline.streaming.ingest import ingest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark):
    path = work_folder(spark, "lines")
    df = lines_of(spark, SF_DIR).repartitionByRange(3, "line_id")
    df.select(F.col("raw").cast("string").alias("value")).write.text(path)
    return path


@pytest.fixture(scope="module")
def expected(spark):
    parsed = parse_lines(lines_of(spark, SF_DIR), TOKEN)
    return {row.outcome: row.n for row in parsed.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("outcome")).agg(F.count("*").alias("n")).collect()}


def _stored(spark, root):
    rejects = table.read_rejects(spark, root).groupBy("reject_reason").count().collect()
    return {"kept": table.read_downloads(spark, root).count()} | {r.reject_reason: r["count"] for r in rejects}


def test_one_batch_written_twice(spark, files, expected):
    root = work_folder(spark, "table")
    assert table.read_downloads(spark, root).count() == 0
    rows = table.to_rows(parse_lines(read_lines(spark, files), TOKEN))
    for _ in range(2):
        table.write_rows(rows, root, "job", batch_id=7)
        assert _stored(spark, root) == expected
    assert [f.dataType for f in table.read_downloads(spark, root).schema][: len(DOWNLOADS)] == [
        f.dataType for f in to_struct(DOWNLOADS)
    ]


def test_plan_has_no_exchange_and_no_second_parse(spark, files):
    df = kept(parse_lines(read_lines(spark, files), TOKEN)).select("url", "details")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("from_json(StructField(installer") == 1


def test_day_filter_prunes_folders(spark, files):
    root = work_folder(spark, "table")
    table.write_rows(table.to_rows(parse_lines(read_lines(spark, files), TOKEN)), root, "job")
    one_day = table.read_downloads(spark, root).where("event_date = '20240115'").select("details.installer.name")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "ReadSchema: struct<details:struct<installer:struct<name:string>>>" in plan


def test_stream_equals_batch_and_replays(spark, files, expected):
    root, checkpoint = work_folder(spark, "table"), work_folder(spark, "checkpoint")
    for _ in range(2):
        query = ingest(stream_lines(spark, files, max_files_per_trigger=2), root, checkpoint, TOKEN, once=True)
        query.awaitTermination()
        assert _stored(spark, root) == expected
    assert {row.batch_id for row in table.deliveries(spark, root).collect()} == {0, 1}


def test_rows_without_required_fields_are_set_aside(spark):
    row = ("2024-01-01 00:00:00", "/p/a", ("a", "b", None, "sdist"), True)
    df = spark.createDataFrame([row, (None, *row[1:]), (row[0], "/p/a", ("a", "b", "1", "sdist"), False)],
                               "timestamp string, url string, file struct<filename:string,project:string,version:string,type:string>, ci boolean")
    rows = conform.drop_unknown(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    valid, invalid = conform.skip_invalid(rows)
    assert "ci" not in rows.columns
    assert valid.count() == 1
    assert sorted(r.missing for r in invalid.collect()) == ["file.version", "timestamp"]
    assert {r.path: r.nulls for r in conform.audit(rows).collect()}["file.version"] == 2


def _field(name, type_="STRING", mode=NULLABLE, **more):
    return {"name": name, "type": type_, "mode": mode, **more}


A, B = _field("a", mode=REQUIRED), _field("b")
CHANGES = [
    ([A, B], [A, B], None),
    ([A, B], [A, B, _field("c")], None),
    ([A, B], [A, B, _field("c", mode=REPEATED)], None),
    ([A, B], [A, B, _field("c", mode=REQUIRED)], "added_required"),
    ([A, B], [A], "removed"),
    ([A, B], [A, _field("x")], "renamed"),
    ([A, B], [B, A], "renamed"),
    ([A, B], [A, _field("b", "INTEGER")], "type_changed"),
    ([A, B], [_field("a"), B], None),
    ([A, B], [A, _field("b", mode=REQUIRED)], "mode_changed"),
    ([A, B], [A, _field("b", mode=REPEATED)], "mode_changed"),
]


@pytest.mark.parametrize("nested", [False, True])
def test_schema_changes(spark, nested):
    wrap = (lambda fields: [B, _field("r", "RECORD", fields=fields)]) if nested else (lambda fields: fields)
    rows, wanted = None, []
    for number, (old, new, fault) in enumerate(CHANGES):
        delta = evolve.schema_delta(evolve.declared(spark, wrap(old), str(number)), wrap(new))
        wanted.append((str(number), fault))
        rows = delta if rows is None else rows.union(delta)
    first = {}
    for row in sorted(rows.collect(), key=lambda row: (row.part, row.position)):
        first.setdefault(row.part, (row.rule, row.path))
    assert [(part, first.get(part, (None,))[0]) for part, _ in wanted] == wanted
    if nested:
        assert first["5"][1] == "r.b"


def test_evolve(spark):
    root = work_folder(spark, "table")
    evolve.evolve(spark, root, DOWNLOADS[:-2])
    evolve.evolve(spark, root, DOWNLOADS)
    assert table.current_fields(spark, root) == DOWNLOADS
    for bad in (DOWNLOADS[:-1], [*DOWNLOADS, _field("x", mode=REQUIRED)]):
        with pytest.raises(evolve.SchemaChangeError):
            evolve.evolve(spark, root, bad)
    assert table.current_fields(spark, root) == DOWNLOADS


def test_nested_addition_reads_null(spark, files):
    root = work_folder(spark, "table")
    rows = kept(parse_lines(read_lines(spark, files), TOKEN))
    table.declare_fields(spark, root, DOWNLOADS)
    table.write_downloads(table.assemble(rows), root, "job")
    wide = [dict(f) for f in DOWNLOADS]
    details = next(f for f in wide if f["name"] == "details")
    details["fields"] = [*details["fields"], _field("rustc_version")]
    evolve.evolve(spark, root, wide)
    read = table.read_downloads(spark, root)
    assert read.where("details.rustc_version is not null").count() == 0
    days = [r.event_date for r in read.select("event_date").distinct().limit(2).collect()]
    before = read.groupBy("event_date").count().collect()
    evolve.rewrite_days(spark, root, days, "job", 0)
    assert sorted(table.read_downloads(spark, root).groupBy("event_date").count().collect()) == sorted(before)
    parts = evolve.stored_fields(spark, root).select("part").distinct().collect()
    assert [r.part for r in parts] == ["job/0"]


def test_schema_round_trip():
    assert from_struct(to_struct(DOWNLOADS)) == DOWNLOADS
    assert fields_from_json('[{"name": "a", "type": "STRING", "mode": "NULLABLE"}]') == [_field("a")]


def test_writers_do_not_touch_each_other(spark, files, expected):
    root, rows = work_folder(spark, "table"), table.to_rows(parse_lines(read_lines(spark, files), TOKEN))
    for writer in ("a", "b", "a"):
        table.write_rows(rows, root, writer)
    read = table.read_downloads(spark, root)
    assert read.count() == 2 * expected["kept"] == read.select("row_id").distinct().count()
    assert table.read_rejects(spark, root).where("source_file is null").count() == 0
    for bad in (None, "", "a/b", "x=1"):
        with pytest.raises(ValueError):
            table.write_rows(rows, root, bad)


def test_stored_files_have_the_columns_of_the_table(spark, files):
    root = work_folder(spark, "table")
    table.write_rows(table.to_rows(parse_lines(read_lines(spark, files), TOKEN)), root, "job")
    names = [f["name"] for f in DOWNLOADS]
    assert spark.read.parquet(f"{root}/downloads").columns == [*names, "row_id", "event_date", "writer", "batch_id"]


def test_schema_is_guarded_before_a_write(spark, files):
    root = work_folder(spark, "table")
    rows = table.assemble(kept(parse_lines(read_lines(spark, files), TOKEN)))
    evolve.evolve(spark, root, DOWNLOADS)
    wrong = [*DOWNLOADS[:-1], DOWNLOADS[-1] | {"name": "other"}]
    with pytest.raises(evolve.SchemaChangeError):
        table.write_downloads(rows, root, "job", fields=wrong)
    assert table.read_downloads(spark, root).count() == 0


def test_compaction(spark, files, expected):
    root, checkpoint = work_folder(spark, "table"), work_folder(spark, "checkpoint")
    ingest(stream_lines(spark, files, max_files_per_trigger=1), root, checkpoint, TOKEN, once=True).awaitTermination()
    sent = table.deliveries(spark, root).collect()
    last = max(r.batch_id for r in sent)
    for _ in range(2):
        table.compact_days(spark, root, sorted({r.event_date for r in sent}), sent[0].writer)
        assert table.read_downloads(spark, root).count() == expected["kept"]
        assert {r.batch_id for r in table.deliveries(spark, root).collect()} == {table.COMPACTED, last}


def test_two_triggers_two_batches(spark, files):
    import time

    arriving, root, checkpoint = (work_folder(spark, name) for name in ("arriving", "table", "checkpoint"))
    part = lambda n: spark.read.text(files).where(F.col("value").rlike(rf"\[\d*{n}\]")).coalesce(1)
    part(1).write.mode("append").text(arriving)
    query = ingest(stream_lines(spark, arriving), root, checkpoint, TOKEN, flush_seconds=1)
    try:
        query.processAllAvailable()
        first = {r.batch_id for r in table.deliveries(spark, root).collect()}
        time.sleep(2.5)  # triggers without a file write nothing
        part(2).write.mode("append").text(arriving)
        query.processAllAvailable()
    finally:
        query.stop()
    assert first == {0}
    assert {r.batch_id for r in table.deliveries(spark, root).collect()} == {0, 1}


def test_compressed_input_is_refused(spark):
    path = work_folder(spark, "packed")
    spark.createDataFrame([("a",), ("bb" * 50,)], "value string").coalesce(1).write.option("compression", "gzip").text(path)
    with pytest.raises(ValueError):
        read_lines(spark, path, check_tail=True)


def test_truncated_tail(spark):
    path = work_folder(spark, "cut")
    spark.createDataFrame([("a\nb",), ("",), ("c",)], "value string").repartition(3).write.text(path)
    for name, texts in {"x": ["\na", "\nbc"], "y": ["\n"]}.items():
        df = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
        df.write.option("lineSep", "|").text(f"{path}/f={name}")
    df = read_lines(spark, f"{path}/f=*", check_tail=True)
    assert sorted(bytes(r.raw) for r in df.where("truncated").collect()) == [b"bc|", b"|"]
    whole = read_lines(spark, path.rstrip("/") + "/*.txt", check_tail=True)
    assert whole.where("truncated").count() == 0
    reasons = [r.reject_reason for r in parse_lines(df).collect()]
    assert reasons.count("truncated") == 2


def test_batches_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(batches, "_BUCKET_BITS", 3)
    monkeypatch.setattr(batches, "_GROUP_BITS", 2)
    ids = random.Random(6).sample(range(5000), 700)
    df = spark.createDataFrame([(i,) for i in ids], "line_id long")
    got = batches.number_batches(df, batch_size=37).collect()
    assert {r.line_id: r.batch_no for r in got} == {i: n // 37 for n, i in enumerate(sorted(ids))}

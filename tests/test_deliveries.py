"""Deliveries: the sink's commits and replays, state and timers of lanes, counts, records of schemas."""

import glob
import json
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyline.plans import catalog, evolve, table
from tallyline.plans.downloads import kept, parse_lines
from tallyline.schema import DOWNLOADS, NULLABLE
from tallyline.session import work_folder
from tallyline.sources import deliveries
from tallyline.sources.synth import TOKEN, lines_of
from tallyline.sources.text import stream_lines
from tallyline.streaming.deliver import Lane
from tallyline.streaming.ingest import ingest

SF_DIR = "/root/testdata/sf0.001"


def _due(spark, n, size=10):
    return spark.range(n).select(
        F.lit(0).cast("long").alias("lane"),
        F.floor(F.col("id") / size).alias("batch_no"),
        F.format_string("2024010%d", 1 + F.col("id") % 3).alias("event_date"),
        F.col("id").cast("string").alias("row_id"),
        F.to_json(F.struct("id", F.lit('q"\n').alias("text"))).alias("json"),
    )


def test_sink_commits_once(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    assert deliveries.read_deliveries(spark, path).count() == 0
    for batch, n in ((0, 57), (0, 40), (1, 9)):
        deliveries.write_deliveries(_due(spark, n), path, "one", batch, size=10)
    listed = deliveries.read_deliveries(spark, path)
    assert {(r.writer, r.batch) for r in listed.collect()} == {("one", "0"), ("one", "1")}
    assert listed.agg(F.sum("rows"), F.max("rows")).first() == (57 + 9, 4)
    rows = deliveries.read_delivered(spark, path).collect()
    assert sorted(int(r.row_id) for r in rows) == sorted([*range(57), *range(9)])
    assert all(json.loads(r.json) == {"id": int(r.row_id), "text": 'q"\n'} for r in rows)
    # The second attempt at batch 0 has left no file.
    assert len(glob.glob(f"{tmp_path}/out/data/*/*.ndjson")) == listed.count()
    with pytest.raises(Exception, match="over 2 rows"):
        deliveries.write_deliveries(_due(spark, 30), path, "one", 2, size=2)
    deliveries.write_deliveries(_due(spark, 9), path, "two", 0, size=10)
    assert deliveries.read_deliveries(spark, path).agg(F.sum("rows")).first()[0] == 75
    # What an attempt has written without a commit is not read.
    sink = deliveries.StreamWriter({"path": path, "writer": "three"})
    made = sink.write(iter(_due(spark, 9).collect()))
    assert deliveries.read_delivered(spark, path).count() == 75
    sink.abort([made, None], 0)
    assert len(glob.glob(f"{tmp_path}/out/data/*/*.ndjson")) == deliveries.read_deliveries(spark, path).count()


class _State:
    """A lane's state and timers, kept in memory."""

    def __init__(self):
        self.value, self.rows, self.timers = None, [], set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getValueState(self, *_):
        return self

    def getListState(self, *_):
        return _Rows(self)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Rows:
    def __init__(self, state):
        self.state = state

    def exists(self):
        return bool(self.state.rows)

    def get(self):
        return iter(self.state.rows)

    def put(self, rows):
        self.state.rows = list(rows)

    def clear(self):
        self.state.rows = []


class _Clock:
    def __init__(self, now):
        self.getCurrentProcessingTimeInMs = lambda: now
        self.getExpiryTimeInMs = lambda: now


def _rows(first, n):
    ids = list(range(first, first + n))[::-1]
    return pd.DataFrame({"source_file": "f", "position": ids, "event_date": "20240101", "row_id": [f"{i:04}" for i in ids], "json": "{}"})


def test_lane_sends_by_count_and_by_time():
    lane, state = Lane(size=5, flush_ms=30), _State()
    lane.init(state)

    def sent(frames):
        return [(int(f.batch_no.iloc[0]), list(f.row_id.astype(int))) for f in frames]

    feed = lambda first, n, now: sent(lane.handleInputRows((1,), iter([_rows(first, n)]), _Clock(now)))
    ring = lambda now: sent(lane.handleExpiredTimer((1,), _Clock(now), _Clock(now)))
    assert feed(0, 3, 0) == [] and state.timers == {30}
    assert feed(3, 1, 10) == [] and state.timers == {30}  # counted from the first row that waits
    assert feed(4, 8, 20) == [(0, [0, 1, 2, 3, 4]), (1, [5, 6, 7, 8, 9])] and state.timers == {50}
    state.timers.clear()
    assert ring(50) == [(2, [10, 11])] and not state.timers and state.rows == []
    assert feed(12, 5, 60) == [(3, [12, 13, 14, 15, 16])] and not state.timers
    assert ring(50) == []  # a timer that was overtaken
    assert feed(17, 1, 70) == [] and state.timers == {100}
    assert feed(18, 4, 80) == [(4, [17, 18, 19, 20, 21])] and not state.timers


@pytest.fixture(scope="module")
def stream_table(spark):
    path, root, checkpoint = (work_folder(spark, n) for n in ("lines", "table", "checkpoint"))
    df = lines_of(spark, SF_DIR).repartitionByRange(4, "line_id")
    df.select(F.col("raw").cast("string").alias("value")).write.text(path)
    ingest(stream_lines(spark, path, max_files_per_trigger=1), root, checkpoint, TOKEN, once=True).awaitTermination()
    return root


def test_files_are_batches_however_many_a_trigger_takes(spark, tmp_path):
    path, root, checkpoint = (f"file://{tmp_path}/{n}" for n in ("lines", "table", "checkpoint"))
    made = lines_of(spark, SF_DIR).withColumn("part", F.floor(F.col("line_id") / 250))

    def run():
        source = stream_lines(spark, f"{path}/*", max_files_per_trigger=100)
        ingest(source, root, checkpoint, TOKEN, once=True, by_file=True).awaitTermination()
        counts = sorted((r.batch_id, r.rows_in, r.kept, r.delivered) for r in table.batch_counts(spark, root).collect())
        held = {tuple(r) for r in table.read_downloads(spark, root).groupBy("batch_id").count().collect()}
        noted = {(r.event_date, r.batch_id) for r in table.stored_notes(spark, root).collect()}
        assert held == {(batch, n) for batch, _, n, _ in counts}
        assert noted == {(r.event_date, r.batch_id) for r in table.deliveries(spark, root).collect()}
        return counts

    for parts in ((0, 1, 2), (3,)):
        made.where(F.col("part").isin(*parts)).select("part", F.col("raw").cast("string").alias("value")).repartition(
            "part"
        ).write.mode("append").partitionBy("part").text(path)
        counts = run()
    # Two triggers, four batches, none of them empty.
    assert [batch for batch, *_ in counts] == [1_000_000, 1_000_001, 1_000_002, 2_000_000]
    assert all((rows_in, kept) == (250, delivered) for _, rows_in, kept, delivered in counts)
    ids = table.read_downloads(spark, root).agg(F.count("*"), F.countDistinct("row_id"))
    before = ids.first()
    # The last trigger runs again, as after a failure.
    for name in ("1", ".1.crc"):
        (tmp_path / "checkpoint/commits" / name).unlink()
    assert run() == counts
    ids = table.read_downloads(spark, root).agg(F.count("*"), F.countDistinct("row_id"))
    assert ids.first() == before and before[0] == before[1]
    # All batches of the last trigger may run again, so compaction leaves them.
    writer = table.deliveries(spark, root).first().writer
    days = [r.event_date for r in table.read_downloads(spark, root).select("event_date").distinct().collect()]
    table.compact_days(spark, root, days, writer)
    assert {r.batch_id for r in table.deliveries(spark, root).select("batch_id").distinct().collect()} == {table.COMPACTED, 2_000_000}
    assert table.read_downloads(spark, root).count() == before[0]
    assert {(r.event_date, r.batch_id) for r in table.stored_notes(spark, root).collect()} == {
        (r.event_date, r.batch_id) for r in table.deliveries(spark, root).collect()
    }


@pytest.fixture
def many_files(monkeypatch, tmp_path):
    """Ten files where a query writes files; the folders of its streams."""
    monkeypatch.setattr(catalog, "CHUNK", 100)
    monkeypatch.setattr(catalog, "work_folder", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    return lambda inside: len(glob.glob(f"{tmp_path}/checkpoint-*/{inside}"))


def test_triggers_of_counts_do_not_grow_with_files(spark, many_files):
    catalog._counted(spark, SF_DIR)
    assert many_files("commits/[0-9]*") == 3  # one for each start


def test_triggers_and_tasks_of_deliveries_do_not_grow_with_files(spark, many_files):
    catalog._delivered(spark, SF_DIR, 86_400, lambda _: True)
    assert many_files("sources/0/[0-9]*") == 2  # one for each start
    assert many_files("state/0/[0-9]*") == 2 * catalog.LANES


def test_counts_need_no_second_look(spark, stream_table):
    counts = table.batch_counts(spark, stream_table)
    total = counts.agg(*[F.sum(c).alias(c) for c in counts.columns[:-2]]).first().asDict()
    assert counts.count() == 4 and total["rows_in"] == 1000
    assert total["kept"] == total["delivered"] == table.read_downloads(spark, stream_table).count()
    refused = {r.reject_reason: r["count"] for r in table.read_rejects(spark, stream_table).groupBy("reject_reason").count().collect()}
    assert total["refused"] == sum(refused.values())
    assert {k[8:]: n for k, n in total.items() if k.startswith("refused_") and n} == refused


def test_days_that_were_not_delivered(spark, stream_table):
    due = kept(parse_lines(lines_of(spark, SF_DIR), TOKEN)).groupBy(F.date_format("ts", "yyyyMMdd").alias("event_date"))
    due = due.agg(F.count("*").alias("downloads")).union(spark.createDataFrame([("20250101", 7)], "event_date string, downloads bigint"))
    report = {r.event_date: r for r in table.delivery_report(spark, stream_table, due).collect()}
    assert (report["20250101"].rows_delivered, report["20250101"].deliveries, report["20250101"].rows_dropped) == (0, 0, 7)
    assert all(r.rows_dropped == 0 for day, r in report.items() if day != "20250101")


def test_compaction_leaves_no_record_behind(spark, stream_table):
    rows, refused = table.read_downloads(spark, stream_table), table.read_rejects(spark, stream_table)
    before = (rows.count(), refused.count())
    writer = rows.select("writer").first().writer
    days = [r.event_date for r in rows.select("event_date").distinct().collect()]
    for _ in range(2):
        table.compact_days(spark, stream_table, days, writer)
        rows, refused = table.read_downloads(spark, stream_table), table.read_rejects(spark, stream_table)
        assert (rows.count(), refused.count()) == before
        held = {tuple(r) for r in rows.select("event_date", "batch_id").distinct().collect()}
        assert {b for _, b in held} == {table.COMPACTED, 3}
        noted = {(r.event_date, r.batch_id) for r in table.stored_notes(spark, stream_table).collect()}
        assert noted == held
        assert {r.batch_id for r in refused.select("batch_id").distinct().collect()} == {3, -4}
    assert len(glob.glob(f"{stream_table.removeprefix('file://')}/written/*/batch_id=*")) == 2


def test_rows_are_read_once_while_days_are_compacted(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    rows = kept(parse_lines(lines_of(spark, SF_DIR), TOKEN))
    for batch in (0, 1):
        table.write_downloads(table.assemble(rows.where(F.col("line_id") % 2 == batch)), root, "job", batch)
    n = table.read_downloads(spark, root).count()
    copy = table.read_downloads(spark, root).withColumn("batch_id", F.lit(table.COMPACTED))
    table._put(copy, f"{root}/downloads", ["event_date", "writer", "batch_id"])  # as if it was cut off here
    assert table.read_downloads(spark, root).count() == 2 * n
    assert table.read_downloads(spark, root, once=True).count() == n


def test_rewriting_corrects_the_report(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    rows = table.assemble(kept(parse_lines(lines_of(spark, SF_DIR), TOKEN)))
    loose = [f | {"mode": NULLABLE} if f["name"] == "url" else f for f in DOWNLOADS]
    table.write_downloads(rows, root, "job", 0, loose)
    table.declare_fields(spark, root, DOWNLOADS)
    days = sorted(r.event_date for r in evolve.drift_report(spark, root).collect())
    assert len(days) == table.read_downloads(spark, root).select("event_date").distinct().count()
    evolve.rewrite_days(spark, root, days[:-1], "job", 0)
    assert [tuple(r) for r in evolve.drift_report(spark, root).collect()] == [(days[-1], "job", 0, "url", "mode_changed")]
    evolve.rewrite_days(spark, root, days, "job", 0)
    assert evolve.drift_report(spark, root).count() == 0

"""Lines, envelopes and events, case by case."""

import datetime as dt
import random
import re
from glob import glob

import pytest
from pyspark.sql import functions as F

from tallyline.plans.catalog import CHUNK, _write_files
from tallyline.plans.downloads import assemble, event_date, kept, parse_lines, reason_counts
from tallyline.plans.table import to_rows
from tallyline.session import configure
from tallyline.sources.synth import TASK_LINES, lines_of
from tallyline.sources.text import read_lines

EVENT = (
    "2@Tue, 05 Mar 2024 23:58:07 GMT|BR|/packages/q7/meadow_kit-4.11.tar.gz|TLSv1.3|AES256-GCM-SHA384|"
    "meadow-kit|4.11|sdist|devpi-server/6.2.0 (py3.11.4; linux)"
)
HEAD = "<37>2024-03-05T23:58:09Z edge-gru7 relay[2206]: "
AGENT = EVENT.rpartition("|")[2]


def _parse(spark, texts, **options):
    rows = [(n, t if isinstance(t, bytes) else t.encode()) for n, t in enumerate(texts)]
    parsed = parse_lines(spark.createDataFrame(rows, "n int, raw binary"), **options)
    return sorted(parsed.collect(), key=lambda row: row.n)


def _reasons(spark, texts, **options):
    return [row.reject_reason for row in _parse(spark, texts, **options)]


def test_one_good_line(spark):
    df = spark.createDataFrame([((HEAD + EVENT).encode(),)], "raw binary")
    row = assemble(kept(parse_lines(df))).select(
        "url", "file", "tls_protocol", "tls_cipher", "country_code", "details.installer", F.col("timestamp").cast("double").alias("t")
    ).first()
    assert row.url == "/packages/q7/meadow_kit-4.11.tar.gz"
    assert tuple(row.file) == ("meadow_kit-4.11.tar.gz", "meadow-kit", "4.11", "sdist")
    assert (row.tls_protocol, row.tls_cipher) == ("TLSv1.3", "AES256-GCM-SHA384")
    assert (row.country_code, tuple(row.installer)) == ("BR", ("devpi", "6.2.0"))
    assert row.t == dt.datetime(2024, 3, 5, 23, 58, 7, tzinfo=dt.UTC).timestamp()


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo", "UTC"])
def test_day_is_utc_in_any_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = parse_lines(spark.createDataFrame([((HEAD + EVENT).encode(),)], "raw binary"))
        assert df.select(event_date().alias("day")).first().day == "20240305"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


ENVELOPES = {
    "<0>{t} h a[p]: ": None,
    "<191>{t} h a[p]: ": None,
    "<192>{t} h a[p]: ": "bad_facility",
    "<999>{t} h a[p]: ": "bad_facility",
    "<1340>{t} h a[p]: ": "unparseable_syslog",
    "<>{t} h a[p]: ": "unparseable_syslog",
    " <134>{t} h a[p]: ": "unparseable_syslog",
    "<134> {t} h a[p]: ": "unparseable_syslog",
    "<134>{t}  h a[p]: ": "unparseable_syslog",
    "<134>{t} h a[p]:": "unparseable_syslog",
    "<134>{t} h a [p]: ": "unparseable_syslog",
    "<134>{t} h a[]: ": "unparseable_syslog",
    "<134>{t} h [p]: ": "unparseable_syslog",
    "<134>{t} h a[p[q]: ": None,
    "<134>{t} h a]b[p]: ": None,
    "<134>{t} hé a[p]: ": "unparseable_syslog",
    "<134>2018-07-20T02:19:20.123456789+02:00 h a[p]: ": None,
    "<134>2018-07-20T25:19:20Z h a[p]: ": "bad_syslog_timestamp",
    "<134>2018-02-30T02:19:20Z h a[p]: ": "bad_syslog_timestamp",
    "<134>now h a[p]: ": "bad_syslog_timestamp",
    "": "unparseable_syslog",
}


def test_envelopes(spark):
    texts = [envelope.format(t="2018-07-20T02:19:20Z") + EVENT for envelope in list(ENVELOPES)[:-1]] + [""]
    assert _reasons(spark, texts) == list(ENVELOPES.values())


def test_envelope_fields(spark):
    rows = _parse(
        spark,
        [
            "<165>2018-07-20T02:19:20.5+02:00 - a[p[q]: m",
            "<13>2018-07-20T02:19:20Z -0 a]b[7]: ",
            "<13>2018-07-20T02:19:20Z h a[7]: m \n \r\n",
            "<13>2018-07-20T02:19:20Z h a[7]: m\nx",
        ],
    )
    got = [(r.facility, r.severity, r.syslog_time, r.hostname, r.appname, r.procid) for r in rows]
    second = dt.datetime(2018, 7, 20, 2, 19, 20)
    assert got[0] == (20, 5, second.replace(microsecond=500000), None, "a", "p[q")
    assert got[1] == (1, 5, second, "-0", "a]b", "7")
    assert [r.reject_reason for r in rows] == ["unparseable_event"] * 3 + ["unparseable_syslog"]


def _with(**change):
    names = ["time", "country", "url", "protocol", "cipher", "project", "version", "type", "agent"]
    parts = dict(zip(names, EVENT.removeprefix("2@").split("|"), strict=True)) | change
    return "2@" + "|".join(parts.values())


EVENTS = [
    (EVENT, None),
    (_with(country=""), None),
    (_with(project="(null)"), "missing_file_field"),
    (_with(version="(null)"), "missing_file_field"),
    (_with(type="(null)"), "missing_file_field"),
    (_with(project="(null)", version="(null)", type="(null)"), "missing_file_field"),
    (_with(agent="(null)"), "ignored_agent"),
    (_with(agent="Something else altogether, without a name."), None),
    (_with(agent=""), None),
    (_with(agent="a|b|@|é"), None),
    (_with(protocol="(null)", cipher="(null)"), None),
    (_with(protocol=""), "unparseable_event"),
    (_with(project=""), "unparseable_event"),
    (_with(project="(null)x"), "unparseable_event"),
    (_with(project="x(null)"), None),
    (_with(url="/a@b"), "unparseable_event"),
    (_with(url="/é"), "unparseable_event"),
    (_with(url="/packages/"), None),
    (_with(type="bdist_wheels"), "unparseable_event"),
    (_with(type=" sdist"), "unparseable_event"),
    (_with(type="bdist_wininst"), None),
    (_with(time="Fri, 31 Feb 2018 02:19:19 GMT"), "bad_event_timestamp"),
    (_with(time="xxxx 20 jul 2018 02:19:19yyyy"), None),
    (_with(time="Fri, 20 Jul 2018 24:19:19 GMT"), "bad_event_timestamp"),
    (_with(time="Fri, 20 Anf 2018 02:19:19 GMT"), "bad_event_timestamp"),
    (_with(time="x"), "bad_event_timestamp"),
    ("  " + EVENT, None),
    ("\t" + EVENT, None),
    ("2 @" + EVENT[2:], "unparseable_event"),
    ("3@" + EVENT[2:], "unparseable_event"),
    (EVENT.rpartition("|")[0], "unparseable_event"),
    ("Fri, 20 Jul 2018 02:19:19 GMT|JP|/p/a-1.tar.gz|a|1|sdist|pex/1.0", None),
    ("1@Fri, 20 Jul 2018 02:19:19 GMT||/p/a-1.tar.gz|a|1|sdist|pex/1.0", None),
    ("1@1@Fri, 20 Jul 2018 02:19:19 GMT||/p/a-1.tar.gz|a|1|sdist|pex/1.0", "unparseable_event"),
    ("", "unparseable_event"),
]


def test_events(spark):
    rows = _parse(spark, [HEAD + event for event, _ in EVENTS])
    assert [row.reject_reason for row in rows] == [reason for _, reason in EVENTS]
    by_event = {event: row for (event, _), row in zip(EVENTS, rows, strict=True)}
    assert by_event[_with(url="/packages/")].filename == ""
    assert by_event[_with(agent="a|b|@|é")].ua == "a|b|@|é"
    assert by_event[_with(protocol="(null)", cipher="(null)")].tls_cipher is None
    layout_1 = by_event[EVENTS[-4][0]]
    assert (layout_1.project, layout_1.version, layout_1.type, layout_1.tls_protocol) == ("a", "1", "sdist", None)
    assert by_event[EVENTS[-3][0]].country_code is None


def test_token_and_size(spark):
    line = HEAD + EVENT
    size = len(line) + 1
    texts = ["tök" + line, line, "tö" + line, "tök" + line + "x" * 20]
    limit = size + len("tök".encode())
    assert _reasons(spark, texts, token="tök", max_line_size=limit) == [None, "bad_token", "bad_token", "oversize"]


@pytest.mark.parametrize("head", ["", HEAD])
def test_noise_is_refused(spark, head):
    rng = random.Random(4)
    noise = [bytes(rng.choices(range(256), k=rng.randint(0, 60))).replace(b"\n", b"") for _ in range(300)]
    reasons = set(_reasons(spark, [head.encode() + line for line in noise]))
    assert reasons == {"unparseable_event" if head else "unparseable_syslog"}


def test_reasons_add_up(spark):
    df = spark.createDataFrame([((HEAD + event).encode(),) for event, _ in EVENTS], "raw binary")
    counts = {row.outcome: row.lines for row in reason_counts(parse_lines(df)).collect()}
    assert sum(counts.values()) == len(EVENTS)
    assert counts["kept"] == sum(reason is None for _, reason in EVENTS)


def test_lines_are_made_by_many_tasks(spark):
    """Whatever the row groups of the events: those of sf0.1 are one."""
    made = lines_of(spark, "/root/testdata/sf0.1").select("line_id", F.spark_partition_id().alias("task"))
    tasks = made.groupBy("task").agg(F.count("*").alias("n"), F.min("line_id").alias("a"), F.max("line_id").alias("b")).collect()
    assert len(tasks) == 5 and max(t.n for t in tasks) < 2 * TASK_LINES
    assert all(t.b - t.a + 1 == t.n for t in tasks), "each has lines that follow each other"
    assert sum(t.n for t in tasks) == 100_000


def test_no_two_tasks_share_a_file(spark, tmp_path):
    """So files are written where their lines are made, without a shuffle of lines; also of events in many small files."""
    sf = str(tmp_path)
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet").where("event_id % 7 > 0 AND event_id < 18000")
    events.repartition(6).write.parquet(f"{sf}/events.parquet")
    for folder in (sf, "/root/testdata/sf0.1"):
        task = F.spark_partition_id().alias("task")
        made = lines_of(spark, folder).select(F.floor(F.col("line_id") / CHUNK).alias("chunk"), task)
        assert made.groupBy("chunk").agg(F.countDistinct("task").alias("n")).where("n > 1").count() == 0
    _write_files(lines_of(spark, sf), f"{sf}/lines")
    names = sorted(glob(f"{sf}/lines/*/*.txt"))
    assert len(names) == 8, "one per 2,500 numbers"
    found = [int(re.search(r"collector\[(\d+)\]", line)[1]) for name in names for line in open(name, errors="replace")]
    assert found == sorted(found) and found == [n for n in range(18000) if n % 7]


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    """A backlog has a folder per file; a task for each of them costs far more than the listing."""
    for number in range(150):
        (tmp_path / f"chunk={number}").mkdir()
        (tmp_path / f"chunk={number}" / "a.txt").write_text("x\n")
    spark.sparkContext.setJobGroup("listing", "")
    try:
        df = read_lines(configure(spark), f"{tmp_path}/*")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 64
    assert df.count() == 150


def _steps_with_binary(df):
    """How many of the plan's one-row generators, each of which copies its rows, pass a BINARY column."""
    nodes, found = [df._jdf.queryExecution().optimizedPlan()], 0
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(n) for n in range(node.children().size())]
        columns = [node.output().apply(n).dataType().simpleString() for n in range(node.output().size())]
        found += node.nodeName() == "Generate" and "binary" in columns
    return found


def test_raw_lines_pass_as_text(spark, tmp_path):
    """A BINARY column is copied twice at every step; the bytes themselves stay as they are."""
    noise = [b"\xff\xfe tail\xc3", HEAD.encode() + b"\xf0\x28\x8c\x28", b"x" * 20_000, b"", HEAD.encode() + EVENT.encode()]
    spark.createDataFrame([(line,) for line in noise], "raw binary").coalesce(1).write.parquet(f"{tmp_path}/lines")
    df = spark.read.parquet(f"{tmp_path}/lines").withColumn("source_file", F.lit("a"))
    parsed = parse_lines(df)
    rows = to_rows(parsed)
    assert parsed.schema["raw"].dataType.simpleString() == rows.schema["raw"].dataType.simpleString() == "binary"
    assert [bytes(row.raw) for row in parsed.collect()] == noise
    refused = rows.where("outcome = 'rejected'").select("raw", "reject_reason").collect()
    assert sorted(bytes(row.raw) for row in refused) == sorted(noise[:4])
    assert rows.where("outcome = 'kept' AND raw IS NOT NULL").count() == 0
    assert _steps_with_binary(rows) == 0

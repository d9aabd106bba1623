"""One query per operator, over the lines made from the ``events`` table."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.text import expand_tabs, utf8_repair
from tallyline.functions.versions import at_least_6, from_1_4_below_6
from tallyline.operators import agent_table, agents, batches, conform, events, lines, rule_table
from tallyline.plans import downloads, evolve, named, table
from tallyline.schema import DOWNLOADS, NULLABLE, REQUIRED
from tallyline.session import configure, delete, store, work_folder
from tallyline.sources.synth import BLOCK, TOKEN, lines_of
from tallyline.sources import deliveries
from tallyline.sources.positions import ADDED, read_in_order
from tallyline.sources.text import mark_truncated, read_lines, stream_lines
from tallyline.streaming import counters
from tallyline.streaming.deliver import deliver
from tallyline.streaming.ingest import ingest

CHUNK = BLOCK  # lines per file where a query needs files; one task makes all of them
FILES = 200  # files that a trigger of a stream takes at most, whatever the number of files

DETAILS = {
    "installer_name": "details.installer.name",
    "installer_version": "details.installer.version",
    "python": "details.python",
    "implementation_name": "details.implementation.name",
    "implementation_version": "details.implementation.version",
    "distro_name": "details.distro.name",
    "distro_version": "details.distro.version",
    "distro_id": "details.distro.id",
    "libc_lib": "details.distro.libc.lib",
    "libc_version": "details.distro.libc.version",
    "system_name": "details.system.name",
    "system_release": "details.system.release",
    "cpu": "details.cpu",
    "openssl_version": "details.openssl_version",
    "setuptools_version": "details.setuptools_version",
}


def _details() -> list[Column]:
    return [F.col(path).alias(name) for name, path in DETAILS.items()]


def _download() -> list[Column]:
    return [
        F.col("timestamp").cast("timestamp_ntz").alias("event_time"),
        F.col("country_code"),
        F.col("url"),
        *[F.col(f"file.{name}").alias(name) for name in ("filename", "project", "version", "type")],
        *_details(),
        F.col("tls_protocol"),
        F.col("tls_cipher"),
    ]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(configure(spark), sf_dir)


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the right size and token, as text."""
    df = lines.mark_oversize(_lines(spark, sf_dir)).where(~F.col("oversize"))
    return lines.decode(lines.strip_token(df, TOKEN).where(F.col("body").isNotNull()))


def _syslog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.syslog_envelope(_decoded(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of all lines whose envelope is good."""
    df = _syslog(spark, sf_dir)
    good = (F.col("facility") <= 23) & F.col("syslog_time").isNotNull()
    return events.event_fields(df.where(good))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downloads.parse_lines(_lines(spark, sf_dir), TOKEN)


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downloads.assemble(downloads.kept(_parsed(spark, sf_dir)))


def _with_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are good up to the agent."""
    return _parsed(spark, sf_dir).where(F.col("ua").isNotNull())


def _agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct agents with their lines, not yet classified."""
    parsed = downloads.parse_lines(_lines(spark, sf_dir), TOKEN, classify=agents.leave_open)
    return agents.distinct_agents(parsed)


def _write_files(df: DataFrame, path: str) -> None:
    """One text file per chunk of lines, in order of the lines; ``df`` is what ``lines_of`` gives, or some of it.

    A chunk is in one task there, so nothing but events is shuffled.
    """
    # Numbers of the same width, so that names are in the order of the lines.
    chunk = F.format_string("%08d", F.floor(F.col("line_id") / CHUNK))
    (
        df.select(chunk.alias("chunk"), "line_id", F.col("raw").cast("string").alias("value"))
        .sortWithinPartitions("chunk", "line_id")
        .select("chunk", "value")
        .write.partitionBy("chunk")
        .text(path)
    )


def _line_id(raw: str = "raw") -> Column:
    return F.regexp_extract(F.col(raw).cast("string"), r"collector\[([0-9]+)\]", 1).cast("bigint").alias("line_id")


# Sources and framing


def scan_raw_lines(spark, sf_dir):
    path = work_folder(spark, "lines")
    _write_files(_lines(spark, sf_dir), path)
    return read_lines(spark, path).select(_line_id(), F.octet_length("raw").alias("line_bytes"))


def stream_raw_lines(spark, sf_dir):
    path, out, checkpoint = (work_folder(spark, name) for name in ("lines", "out", "checkpoint"))
    _write_files(_lines(spark, sf_dir), path)
    stream = stream_lines(spark, path, max_files_per_trigger=50).select(
        _line_id(), F.octet_length("raw").alias("line_bytes")
    )
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def reject_oversize_lines(spark, sf_dir):
    df = lines.mark_oversize(_lines(spark, sf_dir))
    return df.where("oversize").select("line_id", F.octet_length("raw").alias("line_bytes"))


def _cut_files(spark: SparkSession, sf_dir: str) -> str:
    """Every other chunk is written so that its last line has no line feed."""
    df = _lines(spark, sf_dir)
    path = work_folder(spark, "lines")
    chunk = F.floor(F.col("line_id") / CHUNK)
    _write_files(df.where(chunk % 2 == 0), f"{path}/kind=whole")
    # A line feed in front of each line, and a blank behind it as "separator".
    (
        df.where(chunk % 2 == 1)
        .select(chunk.alias("chunk"), "line_id", F.concat(F.lit("\n"), F.col("raw").cast("string")).alias("value"))
        .sortWithinPartitions("chunk", "line_id")
        .select("chunk", "value")
        .write.partitionBy("chunk")
        .option("lineSep", " ")
        .text(f"{path}/kind=cut")
    )
    return f"{path}/*/*"


def reject_truncated_tail(spark, sf_dir):
    path = _cut_files(spark, sf_dir)
    # How files are split changes between the scan for cut files and the one for their lines.
    setting = "spark.sql.files.minPartitionNum"
    spark.conf.set(setting, "4")
    marked = mark_truncated(read_lines(spark, path))
    spark.conf.set(setting, "16")
    found = store(marked.where("truncated").select(_line_id()), "found")
    spark.conf.unset(setting)
    return found


def _in_splits(spark: SparkSession, size: str, read: Callable[[], DataFrame]) -> DataFrame:
    """What a read gives where files are cut into splits of a size; it stores what it has read."""
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, size)
    try:
        return read()
    finally:
        spark.conf.set(setting, before)


def file_positions(spark, sf_dir):
    """The byte at which each line starts, and its place among all lines, from files cut in two ways."""
    path = _cut_files(spark, sf_dir)
    cut = [_in_splits(spark, size, lambda: read_in_order(spark, path, by="name")) for size in ("64k", "1m")]
    one, two = (df.where(F.octet_length("raw") > 0).select(_line_id(), *ADDED) for df in cut)
    two = two.select("line_id", F.struct(*ADDED).alias("other"))
    same = F.struct(*ADDED) == F.col("other")
    return one.join(two, "line_id").select("line_id", "offset", "truncated", same.alias("same"))


def file_size_batches(spark, sf_dir):
    """Deliveries numbered in the order in which lines stand in files, over many splits."""
    path = work_folder(spark, "lines")
    _write_files(_lines(spark, sf_dir), path)
    read = _in_splits(spark, "64k", lambda: read_in_order(spark, path, by="name"))
    kept = downloads.assemble(downloads.kept(downloads.parse_lines(read, TOKEN)))
    rows = store(kept.select(_line_id(), "position", downloads.event_date().alias("event_date")), "kept")
    numbered = batches.number_batches(rows, "position", bucket_bits=batches.BYTE_BUCKET_BITS)
    return numbered.select("line_id", "batch_no", "event_date")


def stream_truncated_tail(spark, sf_dir):
    path, root, checkpoint = _cut_files(spark, sf_dir), *(work_folder(spark, n) for n in ("table", "checkpoint"))
    ingest(stream_lines(spark, path), root, checkpoint, TOKEN, once=True, check_tail=True).awaitTermination()
    return table.read_rejects(spark, root).where("reject_reason = 'truncated'").select(_line_id())


def token_filter(spark, sf_dir):
    df = lines.strip_token(_lines(spark, sf_dir), TOKEN)
    return df.where(F.col("body").isNotNull()).select("line_id", F.octet_length("body").alias("body_bytes"))


def utf8_repair_text(spark, sf_dir):
    text = utf8_repair(F.col("raw"))
    df = _lines(spark, sf_dir).withColumn("text", text)
    return df.select(
        "line_id",
        F.length("text").alias("chars"),
        (F.length("text") - F.length(F.replace("text", F.lit("�"), F.lit("")))).alias("replaced"),
    )


# Envelope


def expand_tab_stops(spark, sf_dir):
    df = lines.strip_token(_lines(spark, sf_dir), TOKEN).where(F.col("body").isNotNull())
    return df.select("line_id", F.length(expand_tabs(utf8_repair(F.col("body")))).alias("chars"))


def syslog_extract(spark, sf_dir):
    return (
        _syslog(spark, sf_dir)
        .where(F.col("message").isNotNull())
        .select("line_id", "hostname", "appname", "procid", F.length("message").alias("message_chars"))
    )


def syslog_priority(spark, sf_dir):
    df = _syslog(spark, sf_dir).where(F.col("message").isNotNull())
    return df.select("line_id", "priority", "facility", "severity", (F.col("facility") <= 23).alias("valid"))


def syslog_labels(spark, sf_dir):
    """Names of the codes in the lines, counted."""
    df = _syslog(spark, sf_dir).where(F.col("message").isNotNull() & (F.col("facility") <= 23))
    named = lines.label_codes(df)
    return named.groupBy("facility_name", "severity_name").agg(F.count("*").alias("lines"))


def syslog_timestamp(spark, sf_dir):
    df = _syslog(spark, sf_dir).where(F.col("message").isNotNull())
    return df.select("line_id", "syslog_time")


def syslog_nil_hostname(spark, sf_dir):
    df = _syslog(spark, sf_dir).where(F.col("message").isNotNull())
    return df.groupBy("hostname").agg(F.count("*").alias("lines"))


# Event

_EVENT = ["line_id", "country_code", "url", "tls_protocol", "tls_cipher", "project", "version", "type", "ua"]


def event_extract_v2(spark, sf_dir):
    return _events(spark, sf_dir).where("event_version = 2").select(_EVENT)


def event_extract_v1(spark, sf_dir):
    return _events(spark, sf_dir).where("event_version = 1").select(_EVENT)


def event_dispatch(spark, sf_dir):
    return _events(spark, sf_dir).select("line_id", "event_version")


def event_null_tokens(spark, sf_dir):
    names = ["country_code", "tls_protocol", "tls_cipher", "project", "version", "type"]
    nulls = [F.count_if(F.col("event_ok") & F.col(name).isNull()).alias(f"null_{name}") for name in names]
    unparseable = F.count_if(~F.col("event_ok")).alias("unparseable")
    day = F.date_format("ts", "yyyyMMdd").alias("day")
    return _events(spark, sf_dir).groupBy(day).agg(unparseable, *nulls)


def event_timestamp(spark, sf_dir):
    df = _events(spark, sf_dir).where("event_ok")
    return df.select("line_id", F.col("timestamp").cast("timestamp_ntz").alias("event_time"))


def file_basename(spark, sf_dir):
    df = _events(spark, sf_dir).where("event_ok")
    return df.groupBy("url", "filename").agg(F.count("*").alias("lines"))


def package_type_domain(spark, sf_dir):
    df = _events(spark, sf_dir).where("event_ok")
    return df.groupBy("type", F.col("type").isin(events.PACKAGE_TYPES).alias("known")).agg(F.count("*").alias("lines"))


def required_fields(spark, sf_dir):
    df = _events(spark, sf_dir).where("event_ok").where(~events.has_file_fields())
    return df.select("line_id", *[F.col(c).isNull().alias(f"no_{c}") for c in ("project", "version", "type")])


def download_assemble(spark, sf_dir):
    return _kept(spark, sf_dir).select("line_id", *_download())


def reject_classify(spark, sf_dir):
    return _parsed(spark, sf_dir).select("line_id", F.coalesce("reject_reason", F.lit("kept")).alias("outcome"))


def reject_counts(spark, sf_dir):
    return downloads.reason_counts(_parsed(spark, sf_dir))


# Agents


def ua_dimension(spark, sf_dir):
    done = agents.classify(_agents(spark, sf_dir))
    return done.select("ua", "lines", "ua_status", "ua_rule", *_details())


def ua_dimension_join(spark, sf_dir):
    parsed = downloads.parse_lines(_lines(spark, sf_dir), TOKEN, classify=agents.classify_by_dimension)
    return parsed.where(F.col("ua").isNotNull()).select(
        "line_id", "ua_status", "ua_rule", F.col("details.installer.version").alias("installer_version")
    )


def ua_rule_dispatch(spark, sf_dir):
    return _with_agent(spark, sf_dir).select("line_id", "ua_status", "ua_rule")


def ua_ambiguity_report(spark, sf_dir):
    report = agents.ambiguous_agents(_agents(spark, sf_dir))
    return report.select("ua", "lines", F.array_join("accepted_by", ",").alias("accepted_by"))


def ua_pip_version_range(spark, sf_dir):
    """Ranges over versions of every kind, put together from the line number."""
    n = F.col("line_id")
    suffixes = ["", "rc1", ".dev1", ".post1", "a2", "+local.1", ".post2.dev3", "-x-y"]
    suffix = F.get(F.array(*map(F.lit, suffixes)), (F.floor(n / 54) % 8).cast("int"))
    version = F.concat((n % 9).cast("string"), F.lit("."), (F.floor(n / 9) % 6).cast("string"), suffix)
    df = _lines(spark, sf_dir).select(version.alias("pip_version"))
    counted = df.groupBy("pip_version").agg(F.count("*").alias("lines"))
    return counted.select(
        "pip_version",
        "lines",
        at_least_6(F.col("pip_version")).alias("new_form"),
        from_1_4_below_6(F.col("pip_version")).alias("old_form"),
    )


def ua_json_details(spark, sf_dir):
    done = agents.classify(_agents(spark, sf_dir).where(F.startswith("ua", F.lit("pip/"))))
    accepted = F.coalesce(F.col("ua_rule") == agents.PIP_JSON, F.lit(False))
    return done.select("ua", "lines", accepted.alias("is_json"))


def ua_details_coercion(spark, sf_dir):
    done = agents.classify(_agents(spark, sf_dir)).where(F.col("ua_rule") == agents.PIP_JSON)
    return done.select("ua", "ua_status", "ci", *_details())


def ua_ignore_filter(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    ignored = parsed.where(F.col("reject_reason") == "ignored_agent")
    return ignored.select("line_id", "ua")


def ua_unknown_keep(spark, sf_dir):
    return _kept(spark, sf_dir).where(F.col("details").isNull()).select("line_id", "ua", "url")


def ua_unknown_report(spark, sf_dir):
    return agents.unknown_agents(_agents(spark, sf_dir))


def ua_rule_hits(spark, sf_dir):
    return agents.rule_hits(_agents(spark, sf_dir))


def _read_firefox(agent: pd.Series) -> pd.Series:
    found = agent.str.extract(r"^Firefox/(\d+)", expand=False)
    return found.map(lambda major: {"installer": {"name": "Firefox", "version": major}} if isinstance(major, str) else None)


def _read_picky(agent: pd.Series) -> pd.Series:
    """A rule that cannot read one agent."""
    for text in agent:
        if text.startswith("Firefox/"):
            raise ValueError(text)
    return agent.map(lambda _: None)


CUSTOM_RULES = [
    *agents.RULES,
    agents.Rule(
        "urllib3",
        (r"^Python-urllib/(?P<python>\d\.\d\d)$", r"^(?P<python>An) agent nobody"),
        {"installer.name": "urllib", "python": "{python}"},
    ),
    agents.PandasRule("picky", _read_picky),
    agents.PandasRule("firefox", _read_firefox),
]


def ua_custom_rules(spark, sf_dir):
    done = agents.classify(_agents(spark, sf_dir), rules=CUSTOM_RULES).where(
        F.col("ua_rule").isin("urllib3", "firefox")
    )
    return done.select(
        "ua", "lines", "ua_rule", "ua_status", *[c for c in _details()[:3]]
    )


def ua_rule_errors(spark, sf_dir):
    return agents.rule_errors(_agents(spark, sf_dir), rules=CUSTOM_RULES)


def ua_agent_table(spark, sf_dir):
    """Agents that two batches bring, each with the batch that brought it first; one of the batches comes twice."""
    known = agent_table.AgentTable(configure(spark), work_folder(spark, "agents"))
    for batch in (0, 1, 1):
        known.learn(agents.distinct_agents(_half(spark, sf_dir, batch)), batch)
    return known.known().select("ua", "ua_status", "ua_rule", "batch_id")


def _half(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    """The lines of one of two batches, parsed, with the agent left open."""
    lines = _lines(spark, sf_dir).where(F.col("line_id") % 3 < 2 if batch == 0 else F.col("line_id") % 3 == 2)
    return downloads.parse_lines(lines, TOKEN, classify=agents.leave_open)


def ua_kept_dimension(spark, sf_dir):
    """Rows of two batches, each parsed once, with agents from a table that is kept between them."""
    known = agent_table.AgentTable(configure(spark), work_folder(spark, "agents"))
    done = [known.classify(_half(spark, sf_dir, batch).where(F.col("ua").isNotNull()), batch) for batch in (0, 1)]
    rows = done[0].unionByName(done[1])
    return rows.select("line_id", "ua_status", "ua_rule", F.col("details.installer.version").alias("installer_version"))


#: Rules as rows: position, name, patterns, template, starts, holds, ignore_case.
RULE_ROWS = [
    (30, "urllib3", [r"^Python-urllib/(\d)\.(\d\d)$"], {"installer.name": "urllib", "python": "{1}.{2}"}, ["Python-urllib/"], None, None),
    (10, "wget", [r"^wget/(\d+)\.(?P<minor>\d+)"], {"installer.name": "Wget", "installer.version": "{1}-{minor}"}, None, None, True),
    (20, "both", [r"^python-requests/(\S+) (pex)/(\S+)$"], {"installer.name": "{2}", "installer.version": "{3} on {1}"}, None, ["pex/"], False),
    (15, "broken", ["(", "x"], {}, None, None, None),
    (16, "astray", [r"^Firefox/(?P<v>\d+)"], {"installer.release": "{v}"}, None, None, None),
    (17, "lost", [r"^Firefox/(?P<v>\d+)", "^Opera"], {"installer.version": "{v}"}, None, None, None),
]


def ua_rules_from_table(spark, sf_dir):
    """Agents by rules that a table holds, tried before the others; three of its rows are refused."""
    path = work_folder(spark, "rules")
    spark.createDataFrame(RULE_ROWS, rule_table.RULE_ROW).write.parquet(path)
    rules, faults = rule_table.rules_from_table(spark.read.parquet(path))
    done = agents.classify(_agents(spark, sf_dir), rules=[*rules, *agents.RULES])
    mine = done.where(F.col("ua_rule").isin([rule.name for rule in rules]))
    return mine.select("ua", "lines", "ua_rule", *_details()[:3], F.lit(len(faults)).alias("refused"))


def _read_groups(word: pd.Series, major: pd.Series, minor: pd.Series) -> pd.Series:
    """Details from a group without a name and two with one."""
    rows = zip(word, major, minor)
    made = [{"installer": {"name": w.lower(), "version": f"{a}.{b or 0}"}} if w != "Opera" else None for w, a, b in rows]
    return pd.Series(made, index=word.index, dtype=object)


def ua_handlers(spark, sf_dir):
    """Agents by a handler over groups; those that other rules take are not its own."""
    patterns = [r"^(Firefox)/(?P<major>\d+)(?:\.(?P<minor>\d+))?$", r"^(An) (?P<major>agent) (?P<minor>nobody)"]
    rules = [*agents.RULES, rule_table.handler_rule("browsers", patterns, _read_groups)]
    done = agents.classify(_agents(spark, sf_dir), rules=rules).where("ua_rule = 'browsers'")
    return done.select("ua", "lines", *_details()[:2])


def _counted(spark: SparkSession, sf_dir: str) -> str:
    """Counts of a stream that is stopped, started again with more files, and runs a batch twice."""
    path, out, checkpoint = (work_folder(spark, name) for name in ("lines", "counts", "checkpoint"))
    for part in (0, 1, 2):
        _write_files(_lines(spark, sf_dir).where(F.floor(F.col("line_id") / CHUNK) % 3 == part), f"{path}/part={part}")
        source = stream_lines(spark, f"{path}/*/*", max_files_per_trigger=FILES)
        counters.count_agents(source, out, checkpoint, TOKEN, once=True).awaitTermination()
    counters.compact_counts(spark, out)
    return out


def running_rule_hits(spark, sf_dir):
    counts = counters.running_counts(spark, _counted(spark, sf_dir)).where(F.col("what") == counters.HIT)
    return counts.select(F.col("key").alias("ua_rule"), "lines")


def running_unknown_agents(spark, sf_dir):
    counts = counters.running_counts(spark, _counted(spark, sf_dir)).where(F.col("what") == counters.UNKNOWN)
    return counts.select(F.col("key").alias("ua"), "lines")


# Batches, routing, sink


def event_date_key(spark, sf_dir):
    return _kept(spark, sf_dir).select("line_id", downloads.event_date().alias("event_date"))


def daily_route(spark, sf_dir):
    df = _kept(spark, sf_dir)
    return df.groupBy(downloads.event_date().alias("event_date")).agg(F.count("*").alias("downloads"))


def downloads_per_day(spark, sf_dir):
    return downloads.downloads_per_day(_parsed(spark, sf_dir))


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _kept(spark, sf_dir).select("line_id", downloads.event_date().alias("event_date"))
    return batches.number_batches(store(rows, "kept"))


def size_batches(spark, sf_dir):
    return _batched(spark, sf_dir).select("line_id", "batch_no", "event_date")


def size_batch_deliveries(spark, sf_dir):
    return batches.deliveries(_batched(spark, sf_dir))


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """The table a stream has written, one file of lines per batch: a backlog of files, then the last one alone."""
    path, root, checkpoint = (work_folder(spark, name) for name in ("lines", "table", "checkpoint"))
    made, chunk = _lines(spark, sf_dir), F.floor(F.col("line_id") / CHUNK)
    last = made.agg(F.max(chunk)).first()[0]
    for part, mine in enumerate((chunk < F.lit(last), chunk == F.lit(last))):
        _write_files(made.where(mine), f"{path}/part={part}")
        source = stream_lines(spark, f"{path}/*/*", max_files_per_trigger=FILES)
        ingest(source, root, checkpoint, TOKEN, once=True, by_file=True).awaitTermination()
    return root


def timed_flush(spark, sf_dir):
    df = table.read_downloads(spark, _streamed(spark, sf_dir))
    return df.groupBy("event_date").agg(F.count("*").alias("rows"))


def delivery_accounting(spark, sf_dir):
    """Rows and deliveries per day, and what of the kept lines is not in the table."""
    return table.delivery_report(spark, _streamed(spark, sf_dir), daily_route(spark, sf_dir))


def delivery_metrics(spark, sf_dir):
    """What each batch of a stream took in, kept, refused and stored, as counted while it was written."""
    counts = table.batch_counts(spark, _streamed(spark, sf_dir))
    return counts.drop("writer", "batch_id")


def _due_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept rows with the number of their delivery, ready for the sink."""
    kept = _kept(spark, sf_dir).withColumn("event_date", downloads.event_date())
    place = F.concat(F.lit("line/"), F.col("line_id").cast("string"))
    row = conform.json_row([field["name"] for field in DOWNLOADS])
    rows = kept.select("line_id", "event_date", F.sha2(place, 256).alias("row_id"), row.alias("json"))
    return batches.number_batches(store(rows, "kept")).withColumn("lane", F.lit(0).cast("long"))


def delivery_sink(spark, sf_dir):
    """Deliveries of 500 as files, written twice; rows, ids and deliveries of each day as they were committed."""
    path, due = work_folder(spark, "deliveries"), store(_due_deliveries(spark, sf_dir), "due")
    for _ in range(2):
        deliveries.write_deliveries(due, path, "catalog", batch=7)
    listed = deliveries.read_deliveries(spark, path).groupBy("event_date").agg(
        F.count("*").alias("deliveries"), F.sum("rows").alias("listed"), F.max("rows").alias("largest")
    )
    day = F.from_unixtime(F.get_json_object("json", "$.timestamp").cast("double").cast("bigint"), "yyyyMMdd")
    rows = deliveries.read_delivered(spark, path).groupBy("event_date").agg(
        F.count("*").alias("rows"), F.countDistinct("row_id").alias("ids"), F.count_if(day == F.col("event_date")).alias("of_that_day")
    )
    return listed.join(rows, "event_date")


LANES = 3


def _await(query: StreamingQuery, done: Callable[[], bool], seconds: int = 240) -> None:
    """Wait for a stream that never runs dry, as its timers keep it going; the limit is for a time without new rows."""
    limit, seen = time.monotonic() + seconds, -1
    while not done():
        if query.exception() is not None:
            raise query.exception()
        took_in = max((p.batchId for p in query.recentProgress if p.numInputRows), default=-1)
        if took_in > seen:
            limit, seen = time.monotonic() + seconds, took_in
        if time.monotonic() > limit or not query.isActive:
            raise TimeoutError(f"the stream got no further: {query.lastProgress}")
        time.sleep(0.3)


def _delivered(spark: SparkSession, sf_dir: str, flush_seconds: float, ends: Callable[[str], bool]) -> str:
    """The deliveries of a stream over two sets of files that is stopped and started again in between."""
    path, out, checkpoint = (work_folder(spark, name) for name in ("lines", "deliveries", "checkpoint"))
    lane = F.col("procid").cast("bigint") % LANES
    for part in (0, 1):
        mine = _lines(spark, sf_dir).where(F.floor(F.col("line_id") / CHUNK) % 2 == part)
        _write_files(mine, f"{path}/part={part}")
        due, read = mine.count(), {}
        source = stream_lines(spark, f"{path}/*/*", max_files_per_trigger=FILES)
        query = deliver(source, out, checkpoint, TOKEN, LANES, lane, flush_seconds=flush_seconds)

        def all_read() -> bool:
            read.update({p.batchId: p.numInputRows for p in query.recentProgress})
            return sum(read.values()) >= due

        try:
            if due:
                _await(query, all_read)
            if part:
                _await(query, lambda: ends(out))
        finally:
            query.stop()
    return out


def stream_deliveries(spark, sf_dir):
    """Full deliveries of every lane, numbered on after a restart; what does not fill one waits in the state."""
    out = _delivered(spark, sf_dir, 86_400, lambda _: True)
    listed = deliveries.read_deliveries(spark, out)
    return listed.groupBy("lane", "batch_no").agg(F.sum("rows").alias("rows"))


def stream_deliveries_timed(spark, sf_dir):
    """With a short time limit every row is delivered, once, in deliveries numbered without a gap."""
    due = _kept(spark, sf_dir).count()
    sent = lambda path: deliveries.read_deliveries(spark, path).agg(F.sum("rows")).first()[0] == due
    out = _delivered(spark, sf_dir, 2, sent)
    rows = deliveries.read_delivered(spark, out).groupBy("lane")
    done = rows.agg(F.count("*").alias("rows"), F.countDistinct("row_id").alias("ids"), F.countDistinct("batch_no").alias("n"))
    listed = deliveries.read_deliveries(spark, out).groupBy("lane", "batch_no").agg(F.sum("rows").alias("size"))
    sizes = listed.groupBy("lane").agg((F.max("batch_no") + 1).alias("next"), (F.max("size") <= 500).alias("at_most_500"))
    joined = done.join(sizes, "lane")
    return joined.select("lane", "rows", "ids", (F.col("n") == F.col("next")).alias("no_gap"), "at_most_500")


def _rows_and_ids(spark: SparkSession, root: str) -> DataFrame:
    rows = table.read_downloads(spark, root).groupBy("event_date")
    return rows.agg(F.count("*").alias("rows"), F.countDistinct("row_id").alias("ids"))


def row_id(spark, sf_dir):
    """The ids that are stored with the rows."""
    return _rows_and_ids(spark, _stored(spark, sf_dir))


def two_writers_one_table(spark, sf_dir):
    """A batch job and a stream write the same days to one table, and each of them a second time."""
    path, root, checkpoint = (work_folder(spark, name) for name in ("lines", "table", "checkpoint"))
    _write_files(_lines(spark, sf_dir), path)
    for _ in range(2):
        table.write_rows(table.to_rows(downloads.parse_lines(read_lines(spark, path), TOKEN)), root, "backlog")
        ingest(stream_lines(spark, path), root, checkpoint, TOKEN, once=True).awaitTermination()
    # As after a failure: the stream's only batch runs again.
    delete(spark, f"{checkpoint}/commits")
    ingest(stream_lines(spark, path), root, checkpoint, TOKEN, once=True).awaitTermination()
    return _rows_and_ids(spark, root)


def compact_table(spark, sf_dir):
    """A stream's batches of all days put together, but for the last one."""
    root = _streamed(spark, sf_dir)
    seen = table.deliveries(spark, root).select("event_date", "writer").distinct().collect()
    table.compact_days(spark, root, [r.event_date for r in seen], seen[0].writer)
    rows = table.read_downloads(spark, root).groupBy("event_date")
    return rows.agg(F.count("*").alias("rows"), F.countDistinct("batch_id").alias("batches"))


def stream_takes_new_column(spark, sf_dir):
    """The table has got a column of details; the stream fills it."""
    path, root, checkpoint = (work_folder(spark, name) for name in ("lines", "table", "checkpoint"))
    _write_files(_lines(spark, sf_dir), path)
    evolve.evolve(spark, root, DOWNLOADS)
    more = {"name": "rustc_version", "type": "STRING", "mode": NULLABLE}
    wide = [f | {"fields": [*f["fields"], more]} if f["name"] == "details" else f for f in DOWNLOADS]
    evolve.evolve(spark, root, wide)
    ingest(stream_lines(spark, path), root, checkpoint, TOKEN, once=True).awaitTermination()
    rows = table.read_downloads(spark, root).groupBy("event_date")
    return rows.agg(F.count("*").alias("rows"), F.count("details.rustc_version").alias("with_rustc"))


def epoch_seconds(spark, sf_dir):
    rows = conform.epoch_rows(conform.drop_unknown(_kept(spark, sf_dir)))
    stated = F.get_json_object("json", "$.timestamp").cast("double")
    return rows.select(
        F.col("timestamp").alias("epoch_seconds"),
        F.get_json_object("json", "$.file.type").alias("type"),
        F.get_json_object("json", "$.details.installer.name").alias("installer_name"),
        (stated == F.col("timestamp")).alias("same_in_json"),
    )


def conform_drop_unknown(spark, sf_dir):
    return conform.drop_unknown(_kept(spark, sf_dir)).select(_download())


def conform_skip_invalid(spark, sf_dir):
    """Events without the check of their fields, so that the table's own check has to act."""
    df = _events(spark, sf_dir).where("event_ok")
    rows = downloads.assemble(df.withColumn("details", F.lit(None).cast(agents.DETAILS_TYPE)))
    checked = conform.drop_unknown(rows).withColumn("missing", conform.missing_path())
    return checked.groupBy(F.coalesce("missing", F.lit("none")).alias("missing")).agg(F.count("*").alias("rows"))


def _stored(spark: SparkSession, sf_dir: str, by_day: bool = False) -> str:
    root = work_folder(spark, "table")
    table.declare_fields(spark, root, DOWNLOADS)
    table.write_rows(table.to_rows(_parsed(spark, sf_dir)), root, "catalog", by_day=by_day)
    return root


def daily_partition_sink(spark, sf_dir):
    return table.read_downloads(spark, _stored(spark, sf_dir)).select("event_date", *_download())


def reject_table(spark, sf_dir):
    rejects = table.read_rejects(spark, _stored(spark, sf_dir, by_day=True))
    return rejects.select(
        "reject_reason", F.octet_length("raw").alias("line_bytes"), _line_id()
    )


# Table schema


def target_table(spark, sf_dir):
    return conform.audit(table.read_downloads(spark, _stored(spark, sf_dir)))


def table_by_name(spark, sf_dir):
    """Days of the table as SQL sees them by its name, before and after it gets two columns."""
    root, name = work_folder(spark, "table"), f"downloads_{uuid.uuid4().hex[:12]}"
    rows = store(_kept(spark, sf_dir), "kept")
    early = F.dayofmonth("timestamp") <= 15
    named.register(spark, name, root, DOWNLOADS[:-2])
    table.write_downloads(rows.where(early), root, "early", 0)
    named.register(spark, name, root, DOWNLOADS)
    table.write_downloads(rows.where(~early), root, "late", 0)
    named.refresh(spark, name)
    return spark.sql(
        f"""SELECT event_date, writer, count(*) AS downloads, count(tls_cipher) AS with_tls, count(details.installer.name) AS named
            FROM {name} WHERE event_date BETWEEN '20240110' AND '20240120' GROUP BY event_date, writer"""
    )


def _stored_variants() -> list[list[dict]]:
    """What a day may have stored, each compared with the current schema later on."""
    *others, cipher = DOWNLOADS
    extra = {"name": "extra", "type": "STRING", "mode": NULLABLE}
    position = {field["name"]: n for n, field in enumerate(DOWNLOADS)}

    def change(column: str, **new) -> list[dict]:
        fields = list(DOWNLOADS)
        fields[position[column]] = fields[position[column]] | new
        return fields

    def change_file(**new) -> list[dict]:
        *first, last = DOWNLOADS[position["file"]]["fields"]
        return change("file", fields=[*first, last | new])

    reordered = [*DOWNLOADS[:-2], DOWNLOADS[-1], DOWNLOADS[-2]]
    return [
        DOWNLOADS,
        others,
        [*DOWNLOADS, extra],
        change("tls_cipher", name="cipher"),
        reordered,
        change("timestamp", type="STRING"),
        change("country_code", mode=REQUIRED),
        change("url", mode=NULLABLE),
        change_file(mode=NULLABLE),
        change_file(name="kind"),
        change("file", fields=DOWNLOADS[position["file"]]["fields"][:-1]),
    ]


def schema_delta_check(spark, sf_dir):
    """Days stored in eleven schemas, all compared with the current one."""
    root = work_folder(spark, "table")
    rows = store(_kept(spark, sf_dir).withColumn("day", F.dayofmonth("timestamp")), "kept")
    variants = _stored_variants()
    for number, fields in enumerate(variants):
        part = rows.where(F.col("day") % len(variants) == number)
        table.write_downloads(part, root, "catalog", number, fields)
    return evolve.drift_report(spark, root).select("event_date", "path", "rule")


def drift_after_compaction(spark, sf_dir):
    """Four batches in a schema that does not fit; days of one are rewritten, others of three compacted."""
    root = work_folder(spark, "table")
    rows = store(_kept(spark, sf_dir), "kept")
    loose = [field | {"mode": NULLABLE} if field["name"] == "url" else field for field in DOWNLOADS]
    for number in range(4):
        table.write_downloads(rows.where(F.col("line_id") % 4 == number), root, "old", number, loose)
    table.declare_fields(spark, root, DOWNLOADS)
    days = [f"202401{day:02}" for day in range(1, 32)]
    evolve.rewrite_days(spark, root, days[:10], "old", 0)
    table.compact_days(spark, root, days[10:20], "old")
    return evolve.drift_report(spark, root)


def table_evolve(spark, sf_dir):
    """Half the days are stored without the TLS columns, then the table gets them."""
    root = work_folder(spark, "table")
    rows = store(_kept(spark, sf_dir), "kept")
    early = F.dayofmonth("timestamp") <= 15
    evolve.evolve(spark, root, DOWNLOADS[:-2])
    table.write_downloads(rows.where(early), root, "early", 0, DOWNLOADS[:-2])
    evolve.evolve(spark, root, DOWNLOADS)
    table.write_downloads(rows.where(~early), root, "late", 0, DOWNLOADS)
    return table.read_downloads(spark, root).groupBy("event_date").agg(
        F.count("*").alias("rows"), F.count("tls_protocol").alias("with_tls")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_raw_lines": scan_raw_lines,
    "stream_raw_lines": stream_raw_lines,
    "reject_oversize_lines": reject_oversize_lines,
    "reject_truncated_tail": reject_truncated_tail,
    "stream_truncated_tail": stream_truncated_tail,
    "file_positions": file_positions,
    "file_size_batches": file_size_batches,
    "token_filter": token_filter,
    "utf8_repair": utf8_repair_text,
    "expand_tabs": expand_tab_stops,
    "syslog_extract": syslog_extract,
    "syslog_priority": syslog_priority,
    "syslog_labels": syslog_labels,
    "syslog_timestamp": syslog_timestamp,
    "syslog_nil_hostname": syslog_nil_hostname,
    "event_extract_v2": event_extract_v2,
    "event_extract_v1": event_extract_v1,
    "event_dispatch": event_dispatch,
    "event_null_tokens": event_null_tokens,
    "event_timestamp": event_timestamp,
    "file_basename": file_basename,
    "package_type_domain": package_type_domain,
    "required_fields": required_fields,
    "download_assemble": download_assemble,
    "reject_classify": reject_classify,
    "reject_counts": reject_counts,
    "ua_dimension": ua_dimension,
    "ua_dimension_join": ua_dimension_join,
    "ua_rule_dispatch": ua_rule_dispatch,
    "ua_ambiguity_report": ua_ambiguity_report,
    "ua_pip_version_range": ua_pip_version_range,
    "ua_json_details": ua_json_details,
    "ua_details_coercion": ua_details_coercion,
    "ua_ignore_filter": ua_ignore_filter,
    "ua_unknown_keep": ua_unknown_keep,
    "ua_unknown_report": ua_unknown_report,
    "ua_rule_hits": ua_rule_hits,
    "ua_custom_rules": ua_custom_rules,
    "ua_rule_errors": ua_rule_errors,
    "ua_agent_table": ua_agent_table,
    "ua_kept_dimension": ua_kept_dimension,
    "ua_rules_from_table": ua_rules_from_table,
    "ua_handlers": ua_handlers,
    "running_rule_hits": running_rule_hits,
    "running_unknown_agents": running_unknown_agents,
    "event_date_key": event_date_key,
    "daily_route": daily_route,
    "downloads_per_day": downloads_per_day,
    "size_batches": size_batches,
    "size_batch_deliveries": size_batch_deliveries,
    "timed_flush": timed_flush,
    "row_id": row_id,
    "two_writers_one_table": two_writers_one_table,
    "compact_table": compact_table,
    "stream_takes_new_column": stream_takes_new_column,
    "epoch_seconds": epoch_seconds,
    "conform_drop_unknown": conform_drop_unknown,
    "conform_skip_invalid": conform_skip_invalid,
    "daily_partition_sink": daily_partition_sink,
    "reject_table": reject_table,
    "delivery_accounting": delivery_accounting,
    "delivery_metrics": delivery_metrics,
    "delivery_sink": delivery_sink,
    "stream_deliveries": stream_deliveries,
    "stream_deliveries_timed": stream_deliveries_timed,
    "target_table": target_table,
    "table_by_name": table_by_name,
    "schema_delta_check": schema_delta_check,
    "drift_after_compaction": drift_after_compaction,
    "table_evolve": table_evolve,
}

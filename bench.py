"""Times the headline jobs over log lines made from ``events``; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the cores. The lines
(ten per event) are written to text files first, which is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from tallyline.operators import agents, batches, conform
from tallyline.plans import downloads, table
from tallyline.schema import DOWNLOADS
from tallyline.session import local_session, store, work_folder
from tallyline.sources.synth import TOKEN, lines_of
from tallyline.sources.text import mark_truncated, read_lines, stream_lines
from tallyline.streaming.ingest import ingest

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES, FILES = 10, 20


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=CPUS, memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    path, root, streamed, checkpoint = (work_folder(spark, n) for n in ("lines", "table", "streamed", "checkpoint"))
    made = lines_of(spark, SF_DIR, COPIES)
    # In order of arrival, as logs come: a file covers a day or two.
    made = made.repartitionByRange(FILES, "line_id").sortWithinPartitions("line_id")
    made.select(F.col("raw").cast("string").alias("value")).write.text(path)
    lines = read_lines(spark, path)
    rows = lines.count()
    columns = [field["name"] for field in DOWNLOADS]

    def parsed(source=lines, **options):
        return downloads.parse_lines(source, TOKEN, **options)

    def enriched(df):
        return downloads.assemble(downloads.kept(df)).select(columns)

    def stream():
        source = stream_lines(spark, path, max_files_per_trigger=FILES // 2)
        ingest(source, streamed, checkpoint, TOKEN, once=True).awaitTermination()

    def write():
        table.declare_fields(spark, root, DOWNLOADS)
        table.write_rows(table.to_rows(parsed()), root, "bench")

    def number():
        kept = downloads.kept(parsed()).select(F.col("position").alias("line_id"))
        noop(batches.number_batches(store(kept, "kept")))

    jobs = {
        "parse_enrich_inline": lambda: noop(enriched(parsed())),
        "parse_enrich_dimension": lambda: noop(enriched(parsed(classify=agents.classify_by_dimension))),
        "day_partition_write": write,
        "stream_available_now": stream,
        "downloads_per_day": lambda: noop(downloads.downloads_per_day(parsed())),
        "reject_counts": lambda: noop(downloads.reason_counts(parsed())),
        "ua_rule_hits": lambda: noop(
            agents.rule_hits(agents.distinct_agents(parsed(classify=agents.leave_open)))
        ),
        "truncated_tail": lambda: noop(mark_truncated(lines)),
        "size_batches": number,
        "required_audit": lambda: noop(conform.audit(table.read_downloads(spark, root))),
        "table_day_scan": lambda: noop(
            table.read_downloads(spark, root)
            .where("event_date = '20240115'")
            .groupBy("details.installer.name")
            .agg(F.count("*"))
        ),
    }
    # A tenth of the lines first, so that the first job is not charged for the JVM's warm-up.
    noop(enriched(parsed(lines.sample(0.1, seed=1))))
    seconds = {}
    for name, job in jobs.items():
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "download_log_jobs_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "lines": rows,
                "lines_per_sec_inline": round(rows / seconds["parse_enrich_inline"]),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Log lines made from the ``events`` table, for tests and the bench.

Every choice is integer arithmetic on the line number, so what a line must parse
to is known without parsing it.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.events import PACKAGE_TYPES

TOKEN = "tok-"
COUNTRIES = ["JP", "US", "DE", "BR", "IN", "FR"]

# Agents whose classification is known (0-23, this one among them), then variations.
_PIP_JSON = (
    '{"cpu":"x86_64","distro":{"name":"macOS","version":"10.13.6"},'
    '"implementation":{"name":"PyPy","version":"6.0.0"},"installer":{"name":"pip","version":"18.0"},'
    '"openssl_version":"LibreSSL 2.6.2","python":"3.5.3","setuptools_version":"40.0.0",'
    '"system":{"name":"Darwin","release":"17.7.0"}}'
)

AGENTS = [
    "Artifactory/1.7.4",
    "bandersnatch/2.2.1 (cpython 3.7.0-final0, Darwin x86_64)",
    "Bazel/1.0",
    "Bazel/release 1.0",
    "Bazel/1.0 dev",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_13_6) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/68.0.3440.75 Safari/537.36",
    "conda/4.3.16",
    "devpi-server/4.6.0 (py3.7.0; darwin)",
    "Python-urllib/3.6 distribute/0.6.21",
    "Homebrew/0.9.9 (Macintosh; Intel macOS 10.12.0) curl/7.43.0",
    "(null)",
    "Nexus/3.6.0-02 (OSS; Linux; 4.4.0-62-generic; amd64; 1.8.0_144)",
    "fetch libfetch/2.0",
    "pep381client/1.0.1",
    "pep381client-proxy/0.5.6",
    "pex/1.4.5",
    f"pip/18.0 {_PIP_JSON}",
    "pip/1.4.1 CPython/2.7.14 Darwin/17.7.0",
    "python-requests/2.19.1",
    "python-requests/2.7.0 CPython/3.7.0 Darwin/17.7.0",
    "setuptools/1.0 Python-urllib/3.6",
    "Python-urllib/3.6 setuptools/1.0",
    "Python-urllib/2.7",
    "z3c.pypimirror/1.5.6",
    'pip/19.0.1 {"ci":true,"cpu":"x86_64","distro":{"id":"bionic","libc":{"lib":"glibc","version":"2.27"},'
    '"name":"Ubuntu","version":"18.04"},"implementation":{"name":"CPython","version":"3.7.2"},'
    '"installer":{"name":"pip","version":"19.0.1"},"openssl_version":"OpenSSL 1.1.0g  2 Nov 2017",'
    '"python":"3.7.2","setuptools_version":"40.8.0","system":{"name":"Linux","release":"4.15.0-45-generic"}}',
    'pip/20.0.2 {"installer":{"name":"pip","version":"20.0.2"},"rustc_version":"1.40.0","python":"3.8.1"}',
    'pip/18.1 {"installer":{"name":"pip",}',
    'pip/18.1 {"installer":{"name":"pip","version":"18.1"}} and more',
    "pip/18.1 []",
    'pip/18.1 {"installer":"x","python":"3.7.0"}',
    'pip/6.0rc1 {"installer":{"name":"pip","version":"6.0rc1"}}',
    "pip/1.5 Unknown/Unknown unknown/UNKNOWN",
    "Python-urllib/3.10",
    "Firefox/60.0",
    "Wget/1.19",
    "Java/1.8.0",
    "x Nutch y",
    "python-requests/2.19.1 pex/1.4.5",
    "",
    "An agent nobody has heard of",
]

#: Lines that one task makes: an event takes 20 bytes where it is stored, and its line some hundreds.
TASK_LINES = 20_000
#: Numbers of events that no two tasks share.
BLOCK = 2_500

# Shapes of lines 20 to 31 are refused; 18 and 19 bring an agent of their own.
SHAPES = 32


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


def log_lines(events: DataFrame, copies: int = 1) -> DataFrame:
    """One line per event and copy: ``line_id``, ``ts`` and ``raw`` (BINARY)."""
    text = lambda value: value.cast("string")
    if copies > 1:
        events = events.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        line_id = F.col("event_id") * copies + F.col("_copy")
    else:
        line_id = F.col("event_id")
    df = events.select(
        line_id.alias("line_id"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"),
        "user_id",
    )
    d, u = F.col("line_id") % SHAPES, F.floor(F.col("line_id") / SHAPES) % len(AGENTS)
    df = df.withColumn("d", d).withColumn("u", u)
    d, u, user = F.col("d"), F.col("u"), F.col("user_id")
    null_version = (d == 27) & (F.floor(F.col("line_id") / SHAPES) % 2 == 0)
    null_type = (d == 27) & (F.floor(F.col("line_id") / SHAPES) % 2 == 1)

    project = F.concat(F.lit("pkg-"), text(user % 50))
    version = F.concat_ws(".", text(F.col("line_id") % 7), text(F.col("line_id") % 11), F.lit("0"))
    url = F.concat(
        F.lit("/packages/"), text(user % 16), F.when(d == 29, "@/").otherwise("/"), project, F.lit("-"), version,
        F.lit(".tar.gz"),
    )
    fields = [
        F.when(d == 31, "Xxx, 32 Jul 2018 02:19:19 GMT").otherwise(
            F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
        ),
        F.when(d == 14, "").otherwise(_pick(COUNTRIES, user % len(COUNTRIES))),
        url,
        F.when(d.isin(12, 13), None).when(d == 15, "(null)").otherwise("TLSv1.2"),
        F.when(d.isin(12, 13), None).when(d == 15, "(null)").otherwise("ECDHE-RSA-AES128-GCM-SHA256"),
        F.when(d == 26, "(null)").when(d == 28, "(null)x").otherwise(project),
        F.when(null_version, "(null)").otherwise(version),
        F.when(null_type, "(null)").when(d == 30, "bdist_foo").otherwise(_pick(PACKAGE_TYPES, F.col("line_id") % 8)),
        # The last agent comes in one form per user.
        F.when(d == 18, "conda/4.3.16\tlinux").when(d == 19, "Bad � agent").otherwise(
            F.concat(_pick(AGENTS, u), F.when(u == len(AGENTS) - 1, F.concat(F.lit(" "), text(user))).otherwise(""))
        ),
    ]
    # concat_ws leaves out the two fields layout 1 does not have.
    event = F.concat(
        F.when(d == 12, "").when(d == 13, "1@").when(d == 17, " 2@").otherwise("2@"), F.concat_ws("|", *fields)
    )
    header = F.concat(
        F.when(d == 20, "tik-").otherwise(TOKEN),
        F.when(d == 22, "<192>").when(d == 23, "<1134>").otherwise(
            F.concat(F.lit("<"), text(F.floor(F.col("line_id") / SHAPES) % 192), F.lit(">"))
        ),
        F.when(d == 25, "not-a-time").otherwise(
            F.date_format(F.expr("ts + interval 1 second"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ),
        F.when(d == 16, " - ").otherwise(F.concat(F.lit(" cache-"), text(user % 9), F.lit(" "))),
        F.lit("collector["), text(F.col("line_id")), F.when(d == 24, "] ").otherwise("]: "),
    )
    line = F.concat(header, event)
    line = F.when(d == 21, F.rpad(line, 17000, "x")).otherwise(line)
    # One invalid byte: the replacement character's three bytes become 0xFF.
    raw = F.when(
        d == 19,
        F.unhex(F.replace(F.hex(line.cast("binary")), F.lit("EFBFBD"), F.lit("FF"))),
    ).otherwise(line.cast("binary"))
    return df.select("line_id", "ts", raw.alias("raw"))


def lines_of(spark: SparkSession, sf_dir: str, copies: int = 1) -> DataFrame:
    """The lines for a folder of test tables, in order, by as many tasks as their number asks for.

    A file of events may be one row group, and a group of a million rows is read by one task, which would make
    and parse their lines too. So events are dealt by ranges of their number first, and a block of ``BLOCK`` numbers
    stays in one task: files of whole blocks need no shuffle of lines, which are many times the size of events.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")
    tasks = ceil(events.count() * copies / TASK_LINES)
    # What is made by one task may still be several files.
    dealt = events.repartitionByRange(tasks, F.floor(F.col("event_id") / BLOCK)) if tasks > 1 else events.coalesce(1)
    return log_lines(dealt.sortWithinPartitions("event_id"), copies)

"""What every query must return, as SQL for DuckDB over the ``events`` table.

Nothing is parsed here. The lines were made by arithmetic on the line number, so
the same arithmetic states what each of them has to become.
"""

from __future__ import annotations

from tallyline.operators.lines import FACILITIES, SEVERITIES
from tallyline.plans.catalog import CHUNK, DETAILS, LANES
from tallyline.plans.downloads import REASONS
from tallyline.sources.synth import AGENTS

_TOOL = "parsed"

# Status, rule and details expected for every agent of the generator, by number.
_EXPECTED: list[tuple[str, str | None, dict[str, str]]] = [
    (_TOOL, "artifactory", {"installer_name": "Artifactory", "installer_version": "1.7.4"}),
    (_TOOL, "bandersnatch", {"installer_name": "bandersnatch", "installer_version": "2.2.1"}),
    (_TOOL, "bazel", {"installer_name": "Bazel", "installer_version": "1.0"}),
    (_TOOL, "bazel", {"installer_name": "Bazel", "installer_version": "1.0"}),
    (_TOOL, "bazel", {"installer_name": "Bazel", "installer_version": "1.0 dev"}),
    (_TOOL, "browser", {"installer_name": "Browser"}),
    (_TOOL, "conda", {"installer_name": "conda", "installer_version": "4.3.16"}),
    (_TOOL, "devpi", {"installer_name": "devpi", "installer_version": "4.6.0"}),
    (_TOOL, "distribute", {"installer_name": "distribute", "installer_version": "0.6.21", "python": "3.6"}),
    (
        _TOOL,
        "homebrew",
        {"installer_name": "Homebrew", "installer_version": "0.9.9", "distro_name": "OS X", "distro_version": "10.12.0"},
    ),
    ("ignored", None, {}),
    (_TOOL, "nexus", {"installer_name": "Nexus", "installer_version": "3.6.0-02"}),
    (_TOOL, "os", {"installer_name": "OS"}),
    (_TOOL, "pep381client", {"installer_name": "pep381client", "installer_version": "1.0.1"}),
    (_TOOL, "pep381client", {"installer_name": "pep381client", "installer_version": "0.5.6"}),
    (_TOOL, "pex", {"installer_name": "pex", "installer_version": "1.4.5"}),
    (
        _TOOL,
        "pip_6",
        {
            "installer_name": "pip",
            "installer_version": "18.0",
            "python": "3.5.3",
            "implementation_name": "PyPy",
            "implementation_version": "6.0.0",
            "distro_name": "macOS",
            "distro_version": "10.13.6",
            "system_name": "Darwin",
            "system_release": "17.7.0",
            "cpu": "x86_64",
            "openssl_version": "LibreSSL 2.6.2",
            "setuptools_version": "40.0.0",
        },
    ),
    (
        _TOOL,
        "pip_1_4",
        {
            "installer_name": "pip",
            "installer_version": "1.4.1",
            "python": "2.7.14",
            "implementation_name": "CPython",
            "implementation_version": "2.7.14",
            "system_name": "Darwin",
            "system_release": "17.7.0",
        },
    ),
    (_TOOL, "requests", {"installer_name": "requests", "installer_version": "2.19.1"}),
    (_TOOL, "requests", {"installer_name": "requests", "installer_version": "2.7.0"}),
    (_TOOL, "setuptools", {"installer_name": "setuptools", "installer_version": "1.0", "python": "3.6"}),
    (_TOOL, "setuptools", {"installer_name": "setuptools", "installer_version": "1.0", "python": "3.6"}),
    (_TOOL, "urllib2", {"python": "2.7"}),
    (_TOOL, "z3c_pypimirror", {"installer_name": "z3c.pypimirror", "installer_version": "1.5.6"}),
    (
        _TOOL,
        "pip_6",
        {
            "installer_name": "pip",
            "installer_version": "19.0.1",
            "python": "3.7.2",
            "implementation_name": "CPython",
            "implementation_version": "3.7.2",
            "distro_name": "Ubuntu",
            "distro_version": "18.04",
            "distro_id": "bionic",
            "libc_lib": "glibc",
            "libc_version": "2.27",
            "system_name": "Linux",
            "system_release": "4.15.0-45-generic",
            "cpu": "x86_64",
            "openssl_version": "OpenSSL 1.1.0g  2 Nov 2017",
            "setuptools_version": "40.8.0",
        },
    ),
    (_TOOL, "pip_6", {"installer_name": "pip", "installer_version": "20.0.2", "python": "3.8.1"}),
    ("unknown", None, {}),
    ("unknown", None, {}),
    ("malformed", "pip_6", {}),
    ("malformed", "pip_6", {}),
    ("unknown", None, {}),
    (_TOOL, "pip_1_4", {"installer_name": "pip", "installer_version": "1.5"}),
    ("unknown", None, {}),
    ("unknown", None, {}),
    (_TOOL, "browser", {"installer_name": "Browser"}),
    ("ignored", None, {}),
    ("ignored", None, {}),
    (_TOOL, "pex", {"installer_name": "pex", "installer_version": "1.4.5"}),
    ("unknown", None, {}),
    ("unknown", None, {}),
]


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _agent_rows() -> str:
    rows = []
    for number, (agent, (status, rule, details)) in enumerate(zip(AGENTS, _EXPECTED, strict=True)):
        cells = [agent, status, rule, *[details.get(name) for name in DETAILS]]
        rows.append(f"({number}, {', '.join(map(_text, cells))})")
    # The two agents some shapes of lines bring along; the first one's text depends on the line.
    conda = {"installer_name": "conda", "installer_version": "4.3.16"}
    for number, status, rule, details in [(40, "parsed", "conda", conda), (41, "unknown", None, {})]:
        cells = ["Bad � agent", status, rule, *[details.get(name) for name in DETAILS]]
        rows.append(f"({number}, {', '.join(map(_text, cells))})")
    return ",\n".join(rows)


_D = ", ".join(DETAILS)

_BASE = f"""
WITH agents(agent_no, agent, ua_status, ua_rule, {_D}) AS (VALUES
{_agent_rows()}
),
numbered AS (
  SELECT event_id AS line_id, event_id % 32 AS d, (event_id // 32) % 2 AS half, user_id, event_id // 32 % 192 AS priority,
    CASE event_id % 32 WHEN 18 THEN 40 WHEN 19 THEN 41 ELSE (event_id // 32) % 40 END AS agent_no,
    date_trunc('second', ts) AS ts,
    'pkg-' || (user_id % 50) AS project0,
    (event_id % 7) || '.' || (event_id % 11) || '.0' AS version0,
    ['sdist', 'bdist_wheel', 'bdist_dmg', 'bdist_dumb', 'bdist_egg', 'bdist_msi', 'bdist_rpm', 'bdist_wininst']
      [event_id % 8 + 1] AS type0,
    ['JP', 'US', 'DE', 'BR', 'IN', 'FR'][user_id % 6 + 1] AS country0
  FROM events
),
fields AS (
  SELECT n.*, a.* EXCLUDE (agent_no, agent),
    CASE WHEN agent_no = 39 THEN a.agent || ' ' || user_id ELSE a.agent END AS agent,
    '/packages/' || (user_id % 16) || CASE WHEN d = 29 THEN '@/' ELSE '/' END
      || project0 || '-' || version0 || '.tar.gz' AS url,
    project0 || '-' || version0 || '.tar.gz' AS filename,
    CASE WHEN d = 14 THEN NULL ELSE country0 END AS country_code,
    CASE WHEN d IN (12, 13, 15) THEN NULL ELSE 'TLSv1.2' END AS tls_protocol,
    CASE WHEN d IN (12, 13, 15) THEN NULL ELSE 'ECDHE-RSA-AES128-GCM-SHA256' END AS tls_cipher,
    CASE WHEN d = 26 THEN NULL ELSE project0 END AS project,
    CASE WHEN d = 27 AND half = 0 THEN NULL ELSE version0 END AS version,
    CASE WHEN d = 27 AND half = 1 THEN NULL ELSE type0 END AS type,
    CASE WHEN d = 16 THEN NULL ELSE 'cache-' || (user_id % 9) END AS hostname,
    CASE WHEN d IN (12, 13) THEN 1 ELSE 2 END AS layout,
    d NOT IN (20, 21) AS decoded,
    d NOT IN (20, 21, 23, 24) AS has_message,
    d NOT IN (20, 21, 22, 23, 24, 25) AS good_envelope,
    d NOT IN (20, 21, 22, 23, 24, 25, 28, 29, 30) AS event_ok,
    d < 20 AS good_line,
    CASE WHEN d = 20 THEN 'bad_token' WHEN d = 21 THEN 'oversize' WHEN d = 22 THEN 'bad_facility'
      WHEN d IN (23, 24) THEN 'unparseable_syslog' WHEN d = 25 THEN 'bad_syslog_timestamp'
      WHEN d IN (26, 27) THEN 'missing_file_field' WHEN d IN (28, 29, 30) THEN 'unparseable_event'
      WHEN d = 31 THEN 'bad_event_timestamp' WHEN ua_status = 'malformed' THEN 'malformed_details'
      WHEN ua_status = 'ignored' THEN 'ignored_agent' ELSE 'kept' END AS outcome
  FROM numbered n JOIN agents a USING (agent_no)
),
texts AS (
  SELECT *,
    CASE WHEN d = 12 THEN '' WHEN d = 13 THEN '1@' WHEN d = 17 THEN ' 2@' ELSE '2@' END
      || CASE WHEN d = 31 THEN 'Xxx, 32 Jul 2018 02:19:19 GMT' ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') END
      || '|' || coalesce(country_code, '') || '|' || url || '|'
      || CASE WHEN d IN (12, 13) THEN '' WHEN d = 15 THEN '(null)|(null)|'
           ELSE 'TLSv1.2|ECDHE-RSA-AES128-GCM-SHA256|' END
      || CASE WHEN d = 26 THEN '(null)' WHEN d = 28 THEN '(null)x' ELSE project0 END || '|'
      || coalesce(version, '(null)') || '|'
      || CASE WHEN d = 30 THEN 'bdist_foo' ELSE coalesce(type, '(null)') END || '|' AS event_head,
    CASE WHEN d = 22 THEN '<192>' WHEN d = 23 THEN '<1134>' ELSE '<' || priority || '>' END
      || CASE WHEN d = 25 THEN 'not-a-time' ELSE strftime(ts + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%SZ') END
      || ' ' || coalesce(hostname, '-') || ' collector[' || line_id
      || CASE WHEN d = 24 THEN '] ' ELSE ']: ' END AS envelope
  FROM fields
),
lines AS (
  SELECT * EXCLUDE (agent),
    -- The tab behind "conda/4.3.16" fills up to the next multiple of eight.
    CASE WHEN d = 18 THEN 'conda/4.3.16'
      || repeat(' ', 8 - (length(envelope) + length(event_head) + 12) % 8) || 'linux' ELSE agent END AS ua,
    -- The bad agent is one byte or one character where its text has the replacement character.
    CASE WHEN d = 21 THEN 17000
      ELSE 4 + length(envelope) + length(event_head) + CASE WHEN d = 18 THEN 18 ELSE length(agent) END
    END AS line_bytes,
    length(event_head) AS head_chars, length(envelope) AS envelope_chars
  FROM texts
)
"""


def _query(body: str) -> str:
    return _BASE + body


_DOWNLOAD = f"""ts AS event_time, country_code, url, filename, project, version, type, {_D}, tls_protocol, tls_cipher"""
_EVENT = "line_id, country_code, url, tls_protocol, tls_cipher, project, version, type, ua"
_KEPT = "FROM lines WHERE outcome = 'kept'"


def _labels() -> str:
    pick = lambda names: "[" + ", ".join(_text(name) for name in names) + "]"
    return _query(
        f"""SELECT {pick(FACILITIES)}[priority // 8 + 1] AS facility_name,
        {pick(SEVERITIES)}[priority % 8 + 1] AS severity_name, count(*) AS lines
        FROM lines WHERE has_message AND d <> 22 GROUP BY ALL"""
    )


_VERSIONS = """
WITH parts AS (
  SELECT event_id % 9 AS major, event_id // 9 % 6 AS minor,
    ['', 'rc1', '.dev1', '.post1', 'a2', '+local.1', '.post2.dev3', '-x-y'][event_id // 54 % 8 + 1] AS suffix
  FROM events
), counted AS (
  SELECT major || '.' || minor || suffix AS pip_version, major, minor, suffix, count(*) AS lines FROM parts GROUP BY ALL
)
SELECT pip_version, lines,
  suffix <> '-x-y' AND major >= 6 AND NOT (major = 6 AND minor = 0 AND suffix IN ('rc1', '.dev1', 'a2')) AS new_form,
  suffix <> '-x-y' AND major < 6 AND (major > 1 OR (major = 1 AND minor >= 4))
    AND NOT (major = 1 AND minor = 4 AND suffix IN ('rc1', '.dev1', 'a2')) AS old_form
FROM counted
"""

_BATCHES = f"""ranked AS (
  SELECT line_id, strftime(ts, '%Y%m%d') AS event_date,
    CAST((row_number() OVER (ORDER BY line_id) - 1) // 500 AS BIGINT) AS batch_no {_KEPT}
)"""

_DELTA = """
, days AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS event_date, CAST(day(ts) AS INTEGER) % 11 AS variant
  FROM lines WHERE outcome = 'kept'),
faults(variant, path, rule) AS (VALUES
  (2, 'extra', 'removed'), (3, 'cipher', 'renamed'),
  (4, 'tls_cipher', 'renamed'), (4, 'tls_protocol', 'renamed'), (5, 'timestamp', 'type_changed'),
  (6, NULL, NULL), (7, 'url', 'mode_changed'), (8, 'file.type', 'mode_changed'), (9, 'file.kind', 'renamed'),
  (10, 'file.type', 'added_required'))
SELECT event_date, path, rule FROM days JOIN faults USING (variant) WHERE rule IS NOT NULL
"""

ORACLES: dict[str, str] = {
    "scan_raw_lines": _query("SELECT line_id, line_bytes FROM lines"),
    "stream_raw_lines": _query("SELECT line_id, line_bytes FROM lines"),
    "reject_oversize_lines": _query("SELECT line_id, line_bytes FROM lines WHERE d = 21"),
    "reject_truncated_tail": f"""SELECT max(event_id) AS line_id FROM events
      WHERE event_id // {CHUNK} % 2 = 1 GROUP BY event_id // {CHUNK}""",
    # Files of odd chunks begin with a line feed, have a blank behind each line, and no line feed at the end.
    "file_positions": _query(
        f"""SELECT line_id, CAST(sum(line_bytes + 1 + odd) OVER chunk - line_bytes - 1 AS BIGINT) AS "offset",
            odd = 1 AND line_id = max(line_id) OVER (PARTITION BY line_id // {CHUNK}) AS truncated, true AS same
            FROM (SELECT *, line_id // {CHUNK} % 2 AS odd FROM lines) WINDOW chunk AS (PARTITION BY line_id // {CHUNK} ORDER BY line_id)"""
    ),
    "file_size_batches": _query(f", {_BATCHES} SELECT line_id, batch_no, event_date FROM ranked"),
    "token_filter": _query("SELECT line_id, line_bytes - 4 AS body_bytes FROM lines WHERE d <> 20"),
    "utf8_repair": _query(
        "SELECT line_id, line_bytes AS chars, CASE WHEN d = 19 THEN 1 ELSE 0 END AS replaced FROM lines"
    ),
    "expand_tabs": _query(
        """SELECT line_id, CASE WHEN d = 18 THEN envelope_chars + head_chars + length(ua) ELSE line_bytes - 4 END AS chars
           FROM lines WHERE d <> 20"""
    ),
    "syslog_extract": _query(
        """SELECT line_id, hostname, 'collector' AS appname, CAST(line_id AS VARCHAR) AS procid,
           head_chars + length(ua) AS message_chars FROM lines WHERE has_message"""
    ),
    "syslog_priority": _query(
        """SELECT line_id, CAST(CASE WHEN d = 22 THEN 192 ELSE priority END AS INTEGER) AS priority,
           CAST(CASE WHEN d = 22 THEN 24 ELSE priority // 8 END AS INTEGER) AS facility,
           CAST(CASE WHEN d = 22 THEN 0 ELSE priority % 8 END AS INTEGER) AS severity,
           d <> 22 AS valid FROM lines WHERE has_message"""
    ),
    "syslog_labels": _labels(),
    "syslog_timestamp": _query(
        """SELECT line_id, CASE WHEN d = 25 THEN NULL ELSE ts + INTERVAL 1 SECOND END AS syslog_time
           FROM lines WHERE has_message"""
    ),
    "syslog_nil_hostname": _query("SELECT hostname, count(*) AS lines FROM lines WHERE has_message GROUP BY ALL"),
    "event_extract_v2": _query(f"SELECT {_EVENT} FROM lines WHERE event_ok AND layout = 2"),
    "event_extract_v1": _query(f"SELECT {_EVENT} FROM lines WHERE event_ok AND layout = 1"),
    "event_dispatch": _query(
        "SELECT line_id, CASE WHEN event_ok THEN layout END AS event_version FROM lines WHERE good_envelope"
    ),
    "event_null_tokens": _query(
        "SELECT strftime(ts, '%Y%m%d') AS day, count(*) FILTER (NOT event_ok) AS unparseable, "
        + ", ".join(
            f"count(*) FILTER (event_ok AND {name} IS NULL) AS null_{name}"
            for name in ("country_code", "tls_protocol", "tls_cipher", "project", "version", "type")
        )
        + " FROM lines WHERE good_envelope GROUP BY ALL"
    ),
    "event_timestamp": _query(
        "SELECT line_id, CASE WHEN d = 31 THEN NULL ELSE ts END AS event_time FROM lines WHERE event_ok"
    ),
    "file_basename": _query("SELECT url, filename, count(*) AS lines FROM lines WHERE event_ok GROUP BY ALL"),
    "package_type_domain": _query(
        """SELECT type, CASE WHEN type IS NOT NULL THEN true END AS known, count(*) AS lines
           FROM lines WHERE event_ok GROUP BY ALL"""
    ),
    "required_fields": _query(
        """SELECT line_id, project IS NULL AS no_project, version IS NULL AS no_version, type IS NULL AS no_type
           FROM lines WHERE d IN (26, 27)"""
    ),
    "download_assemble": _query(f"SELECT line_id, {_DOWNLOAD} {_KEPT}"),
    "reject_classify": _query("SELECT line_id, outcome FROM lines"),
    "reject_counts": _query("SELECT outcome, count(*) AS lines FROM lines GROUP BY ALL"),
    "ua_dimension": _query(
        f"SELECT ua, count(*) AS lines, ua_status, ua_rule, {_D} FROM lines WHERE good_line GROUP BY ALL"
    ),
    "ua_dimension_join": _query(
        "SELECT line_id, ua_status, ua_rule, installer_version FROM lines WHERE good_line"
    ),
    "ua_rule_dispatch": _query("SELECT line_id, ua_status, ua_rule FROM lines WHERE good_line"),
    "ua_ambiguity_report": _query(
        "SELECT ua, count(*) AS lines, 'pex,requests' AS accepted_by FROM lines WHERE good_line AND agent_no = 37 GROUP BY ALL"
    ),
    "ua_pip_version_range": _VERSIONS,
    "ua_json_details": _query(
        """SELECT ua, count(*) AS lines, agent_no IN (16, 24, 25, 28, 29) AS is_json FROM lines
           WHERE good_line AND agent_no IN (16, 17, 24, 25, 26, 27, 28, 29, 30, 31) GROUP BY ALL"""
    ),
    "ua_details_coercion": _query(
        f"""SELECT DISTINCT ua, ua_status, CASE WHEN agent_no = 24 THEN true END AS ci, {_D} FROM lines
            WHERE good_line AND agent_no IN (16, 24, 25, 28, 29)"""
    ),
    "ua_ignore_filter": _query("SELECT line_id, ua FROM lines WHERE outcome = 'ignored_agent'"),
    "ua_unknown_keep": _query(f"SELECT line_id, ua, url {_KEPT} AND ua_status = 'unknown'"),
    "ua_unknown_report": _query(
        f"SELECT ua, count(*) AS lines {_KEPT} AND ua_status = 'unknown' GROUP BY ALL"
    ),
    "ua_rule_hits": _query(
        "SELECT ua_rule, count(*) AS lines FROM lines WHERE good_line AND ua_rule IS NOT NULL GROUP BY ALL"
    ),
    "ua_custom_rules": _query(
        """SELECT ua, count(*) AS lines, CASE WHEN agent_no = 33 THEN 'firefox' ELSE 'urllib3' END AS ua_rule,
           'parsed' AS ua_status, CASE WHEN agent_no = 33 THEN 'Firefox' ELSE 'urllib' END AS installer_name,
           CASE WHEN agent_no = 33 THEN '60' END AS installer_version,
           CASE agent_no WHEN 32 THEN '3.10' WHEN 39 THEN 'An' END AS python
           FROM lines WHERE good_line AND agent_no IN (32, 33, 39) GROUP BY ALL"""
    ),
    "ua_rule_errors": _query(
        """SELECT ua, count(*) AS lines, 'picky: ValueError: ' || ua AS ua_error
           FROM lines WHERE good_line AND agent_no = 33 GROUP BY ALL"""
    ),
    "ua_agent_table": _query(
        """SELECT ua, ua_status, ua_rule, CASE WHEN bool_or(line_id % 3 < 2) THEN 0 ELSE 1 END::BIGINT AS batch_id
           FROM lines WHERE good_line GROUP BY ALL"""
    ),
    "ua_kept_dimension": _query(
        "SELECT line_id, ua_status, ua_rule, installer_version FROM lines WHERE good_line"
    ),
    "ua_rules_from_table": _query(
        """SELECT ua, count(*) AS lines, CASE agent_no WHEN 32 THEN 'urllib3' WHEN 34 THEN 'wget' ELSE 'both' END AS ua_rule,
           CASE agent_no WHEN 32 THEN 'urllib' WHEN 34 THEN 'Wget' ELSE 'pex' END AS installer_name,
           CASE agent_no WHEN 34 THEN '1-19' WHEN 37 THEN '1.4.5 on 2.19.1' END AS installer_version,
           CASE WHEN agent_no = 32 THEN '3.10' END AS python, CAST(3 AS INTEGER) AS refused
           FROM lines WHERE good_line AND agent_no IN (32, 34, 37) GROUP BY ALL"""
    ),
    "ua_handlers": _query(
        """SELECT ua, count(*) AS lines, CASE WHEN agent_no = 33 THEN 'firefox' ELSE 'an' END AS installer_name,
           CASE WHEN agent_no = 33 THEN '60.0' ELSE 'agent.nobody' END AS installer_version
           FROM lines WHERE good_line AND agent_no IN (33, 39) GROUP BY ALL"""
    ),
    "running_rule_hits": _query(
        "SELECT ua_rule, count(*) AS lines FROM lines WHERE good_line AND ua_rule IS NOT NULL GROUP BY ALL"
    ),
    "running_unknown_agents": _query(
        f"SELECT ua, count(*) AS lines {_KEPT} AND ua_status = 'unknown' GROUP BY ALL"
    ),
    "event_date_key": _query(f"SELECT line_id, strftime(ts, '%Y%m%d') AS event_date {_KEPT}"),
    "daily_route": _query(f"SELECT strftime(ts, '%Y%m%d') AS event_date, count(*) AS downloads {_KEPT} GROUP BY ALL"),
    "downloads_per_day": _query(
        f"""SELECT strftime(ts, '%Y%m%d') AS event_date, installer_name AS installer, count(*) AS downloads
            {_KEPT} GROUP BY ALL"""
    ),
    "size_batches": _query(f", {_BATCHES} SELECT line_id, batch_no, event_date FROM ranked"),
    "size_batch_deliveries": _query(
        f', {_BATCHES} SELECT batch_no, event_date, count(*) AS "rows" FROM ranked GROUP BY ALL'
    ),
    "timed_flush": _query(f"""SELECT strftime(ts, '%Y%m%d') AS event_date, count(*) AS "rows" {_KEPT} GROUP BY ALL"""),
    "row_id": _query(
        f"""SELECT strftime(ts, '%Y%m%d') AS event_date, count(*) AS "rows", count(*) AS ids {_KEPT} GROUP BY ALL"""
    ),
    "two_writers_one_table": _query(
        f"""SELECT strftime(ts, '%Y%m%d') AS event_date, 2 * count(*) AS "rows", 2 * count(*) AS ids {_KEPT} GROUP BY ALL"""
    ),
    "compact_table": _query(
        f"""SELECT strftime(ts, '%Y%m%d') AS event_date, count(*) AS "rows",
            count(DISTINCT line_id // {CHUNK} = (SELECT max(event_id) // {CHUNK} FROM events)) AS batches {_KEPT} GROUP BY ALL"""
    ),
    "stream_truncated_tail": f"""SELECT max(event_id) AS line_id FROM events
      WHERE event_id // {CHUNK} % 2 = 1 GROUP BY event_id // {CHUNK}""",
    "stream_takes_new_column": _query(
        f"""SELECT strftime(ts, '%Y%m%d') AS event_date, count(*) AS "rows",
            count(*) FILTER (agent_no = 25) AS with_rustc {_KEPT} GROUP BY ALL"""
    ),
    "epoch_seconds": _query(
        f"""SELECT CAST(epoch(ts) AS DOUBLE) AS epoch_seconds, type, installer_name, true AS same_in_json {_KEPT}"""
    ),
    "conform_drop_unknown": _query(f"SELECT {_DOWNLOAD} {_KEPT}"),
    "conform_skip_invalid": _query(
        """SELECT CASE WHEN d = 31 THEN 'timestamp' WHEN project IS NULL THEN 'file.project'
           WHEN version IS NULL THEN 'file.version' WHEN type IS NULL THEN 'file.type' ELSE 'none' END AS missing,
           count(*) AS "rows" FROM lines WHERE event_ok GROUP BY ALL"""
    ),
    "daily_partition_sink": _query(f"SELECT strftime(ts, '%Y%m%d') AS event_date, {_DOWNLOAD} {_KEPT}"),
    "reject_table": _query(
        "SELECT outcome AS reject_reason, line_bytes, line_id FROM lines WHERE outcome <> 'kept'"
    ),
    "delivery_accounting": _query(
        f"""SELECT strftime(ts, '%Y%m%d') AS event_date, count(*) AS rows_delivered,
            count(DISTINCT line_id // {CHUNK}) AS deliveries, CAST(0 AS BIGINT) AS rows_dropped {_KEPT} GROUP BY ALL"""
    ),
    "delivery_metrics": _query(
        "SELECT count(*) AS rows_in, count(*) FILTER (outcome = 'kept') AS kept, count(*) FILTER (outcome <> 'kept') AS refused, "
        + ", ".join(f"count(*) FILTER (outcome = '{reason}') AS refused_{reason}" for reason in [*REASONS, "missing_required"])
        + f", count(*) FILTER (outcome = 'kept') AS delivered FROM lines GROUP BY line_id // {CHUNK}"
    ),
    "delivery_sink": _query(
        f""", {_BATCHES}, sent AS (SELECT event_date, batch_no, count(*) AS n FROM ranked GROUP BY ALL)
            SELECT event_date, count(*) AS deliveries, CAST(sum(n) AS BIGINT) AS listed, max(n) AS largest,
              CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(n) AS BIGINT) AS ids, CAST(sum(n) AS BIGINT) AS of_that_day
            FROM sent GROUP BY event_date"""
    ),
    "stream_deliveries": _query(
        f""", lanes AS (SELECT line_id % {LANES} AS lane, count(*) AS n {_KEPT} GROUP BY ALL)
            SELECT lane, unnest(range(n // 500)) AS batch_no, CAST(500 AS BIGINT) AS "rows" FROM lanes"""
    ),
    "stream_deliveries_timed": _query(
        f"""SELECT line_id % {LANES} AS lane, count(*) AS "rows", count(*) AS ids, true AS no_gap, true AS at_most_500
            {_KEPT} GROUP BY ALL"""
    ),
    "target_table": _query(
        f"""SELECT path, n AS "rows", CAST(0 AS BIGINT) AS nulls
            FROM (SELECT count(*) AS n {_KEPT}),
            (VALUES ('timestamp'), ('url'), ('file'), ('file.filename'), ('file.project'), ('file.version'), ('file.type')) p(path)"""
    ),
    "table_by_name": _query(
        f"""SELECT strftime(ts, '%Y%m%d') AS event_date, CASE WHEN day(ts) <= 15 THEN 'early' ELSE 'late' END AS writer,
            count(*) AS downloads, count(CASE WHEN day(ts) > 15 THEN tls_cipher END) AS with_tls,
            count(installer_name) AS named {_KEPT} AND day(ts) BETWEEN 10 AND 20 GROUP BY ALL"""
    ),
    "schema_delta_check": _query(_DELTA),
    "drift_after_compaction": _query(
        f"""SELECT DISTINCT strftime(ts, '%Y%m%d') AS event_date, 'old' AS writer, line_id % 4 AS batch_id, 'url' AS path,
              'mode_changed' AS rule {_KEPT}
            AND NOT (line_id % 4 = 0 AND day(ts) <= 20) AND NOT (line_id % 4 IN (1, 2) AND day(ts) BETWEEN 11 AND 20)"""
    ),
    "table_evolve": _query(
        f"""SELECT strftime(ts, '%Y%m%d') AS event_date, count(*) AS "rows",
            count(CASE WHEN day(ts) > 15 THEN tls_protocol END) AS with_tls {_KEPT} GROUP BY ALL"""
    ),
}

"""Registered queries: feeds, checks, dashboards, alerting, presentation and table upkeep."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authlane import schema
from authlane import settings as S
from authlane.operators import alerting as A
from authlane.operators import presentation as C
from authlane.operators import reports as R
from authlane.operators import tables as T
from authlane.operators import views as V
from authlane.operators.panes import replay_facts
from authlane.operators.pack import candidates
from authlane.plans import bindings as B
from authlane.plans import oracle as O
from authlane.plans.registry import query

N = "CAST(count(*) AS BIGINT)"
NEWEST_EVENT = "ORDER BY ts DESC, event_id"
NEWEST_ALERT = "ORDER BY ts DESC, alert_fingerprint, rule_id"
WEEK = 7 * B.DAY

FEED_SQL = f"""SELECT ts AS time, rule_name, severity,
  coalesce(nullif(entity_host, ''), endpoint_id) AS endpoint_id,
  coalesce(nullif(reason, ''), evidence_summary) AS summary, alert_type, rule_id, attempt_count, principal,
  entity_user, source_ip, entity_src_ip, source_kind, window_start, window_end, first_seen_ts, last_seen_ts,
  distinct_user_count, distinct_ip_count, reason, evidence_summary, details
FROM alerts {NEWEST_ALERT} LIMIT """


@query("alerts_feed", O.ALERTS_SQL + FEED_SQL + "50")
def q_alerts_feed(spark: SparkSession, sf: str) -> DataFrame:
    return R.alerts_feed(B.bound_alerts(spark, sf), "not a number")


EVENT_FEED_SQL = f"""SELECT ts AS time, ingest_source, "user", src_ip, host, status, source_kind, raw_event_id,
  logon_type, auth_method, message FROM auth {NEWEST_EVENT} LIMIT """


@query("events_feed", O.AUTH_SQL + EVENT_FEED_SQL + "200")
def q_events_feed(spark: SparkSession, sf: str) -> DataFrame:
    return R.events_feed(B.bound_auth(spark, sf), 1000)


_NOON = datetime(2024, 1, 30, 12)


@query(
    "health",
    O.AUTH_SQL
    + f"""SELECT coalesce({O.sec('max(ts)')}, '') AS last_event_ts,
  CAST(count(*) FILTER (ts > TIMESTAMP '2024-01-30 11:59:00') AS BIGINT) AS ingest_rate,
  CASE WHEN count(*) = 0 THEN 'unknown' ELSE 'connected' END AS collector_status FROM auth""",
)
def q_health(spark: SparkSession, sf: str) -> DataFrame:
    return R.health(B.bound_auth(spark, sf), _NOON)


@query(
    "health_empty",
    O.AUTH_SQL
    + "SELECT '' AS last_event_ts, CAST(count(*) AS BIGINT) AS ingest_rate, 'unknown' AS collector_status "
    "FROM auth WHERE host = 'no-such-host'",
)
def q_health_empty(spark: SparkSession, sf: str) -> DataFrame:
    return R.health(B.bound_auth(spark, sf).filter(F.col("host") == "no-such-host"), _NOON)


_SYNTH = f"ingest_source = 'synthetic-auth' AND ts > {O.AS_OF} - INTERVAL 30 DAY"


@query(
    "synthetic_raw_events",
    O.EVENTS_SQL
    + f"""SELECT ts, platform, f_scenario AS scenario, f_user AS "user", f_src_ip AS src_ip, f_status AS status,
  '' AS source_kind, message FROM env WHERE {_SYNTH} {NEWEST_EVENT} LIMIT 20""",
)
def q_synthetic_raw(spark: SparkSession, sf: str) -> DataFrame:
    return R.synthetic_raw(B.bound_events(spark, sf, B.MONTH), B.AS_OF, B.MONTH)


@query(
    "synthetic_auth_events",
    O.AUTH_SQL
    + f"""SELECT ts, platform, "user", src_ip, host, status, source_kind, raw_event_id, auth_method,
  collector_name, message FROM auth
WHERE {_SYNTH} AND source_kind = 'linux_ssh' AND src_ip = '10.0.0.3' {NEWEST_EVENT} LIMIT 20""",
)
def q_synthetic_auth(spark: SparkSession, sf: str) -> DataFrame:
    return R.synthetic_auth(
        B.bound_auth(spark, sf, B.MONTH), B.AS_OF, B.MONTH, source_kind="linux_ssh", src_ip="10.0.0.3"
    )


@query(
    "scenario_summary",
    O.EVENTS_SQL
    + f"""SELECT coalesce(nullif(f_scenario, ''), 'unspecified') AS scenario, f_status AS status, {N} AS events
FROM env WHERE {_SYNTH} GROUP BY ALL""",
)
def q_scenario_summary(spark: SparkSession, sf: str) -> DataFrame:
    return R.scenario_summary(B.bound_events(spark, sf, B.MONTH), B.AS_OF, B.MONTH)


@query(
    "alert_totals",
    O.ALERTS_SQL
    + f"""SELECT alert_type, {N} AS alerts,
  CAST(count(DISTINCT alert_fingerprint) AS BIGINT) AS unique_fingerprints
FROM alerts WHERE ts > {O.AS_OF} - INTERVAL 14 DAY GROUP BY 1""",
)
def q_alert_totals(spark: SparkSession, sf: str) -> DataFrame:
    return R.alert_totals(B.bound_alerts(spark, sf), B.AS_OF, 2 * WEEK)


def _every_tick(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of every tick without dedup, so that there are duplicates to find."""
    facts = replay_facts(
        B.bound_auth(spark, sf), [WEEK], B.HISTORY_SLIDE_SECONDS, B.START, B.AS_OF
    )
    return candidates(facts, B.history_pack(), None, per_tick=True)


_EVERY_TICK = O.ALERTS_SQL.replace(
    "QUALIFY row_number() OVER (PARTITION BY alert_fingerprint ORDER BY ts, rule_id) = 1", ""
)


@query(
    "duplicate_fingerprints",
    _EVERY_TICK
    + f"""SELECT alert_type, alert_fingerprint, {N} AS duplicates FROM alerts
GROUP BY 1, 2 HAVING count(*) > 1""",
)
def q_duplicate_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return R.duplicate_fingerprints(_every_tick(spark, sf), lookback_minutes=None)


@query(
    "duplicate_entity_buckets",
    _EVERY_TICK
    + f"""SELECT alert_type, window_bucket, entity_user, entity_src_ip, entity_host, source_kind,
  {N} AS duplicates FROM alerts WHERE ts > {O.AS_OF} - INTERVAL 14 DAY GROUP BY ALL HAVING count(*) > 1""",
)
def q_duplicate_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return R.duplicate_entity_buckets(_every_tick(spark, sf), B.AS_OF, 2 * WEEK)


@query(
    "stability_invariant",
    O.ALERTS_SQL
    + """SELECT CAST(count(*) AS BIGINT) AS alerts,
  CAST(count(DISTINCT alert_fingerprint) AS BIGINT) AS fingerprints FROM alerts""",
)
def q_stability(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded alerts have one row per fingerprint."""
    return B.bound_alerts(spark, sf).agg(
        F.count("*").alias("alerts"), F.count_distinct("alert_fingerprint").alias("fingerprints")
    )


@query(
    "recent_alert_windows",
    O.DETECTIONS_SQL
    + f"""SELECT ts, alert_type, window_bucket, entity_user, entity_src_ip, entity_host, attempt_count,
  distinct_user_count, distinct_ip_count, reason FROM detections
WHERE ts > {O.AS_OF} - INTERVAL 7 DAY {NEWEST_ALERT} LIMIT 20""",
)
def q_recent_windows(spark: SparkSession, sf: str) -> DataFrame:
    detections = V.recent_login_detections(B.bound_alerts(spark, sf))
    return R.recent_alert_windows(detections, B.AS_OF, WEEK)


@query(
    "recent_detections",
    O.DETECTIONS_SQL
    + f"""SELECT ts, alert_type, alert_fingerprint, rule_id, severity, attempt_count, entity_user,
  entity_src_ip, entity_host, window_bucket, distinct_user_count, distinct_ip_count, source_kind, reason,
  evidence_summary FROM detections
WHERE ts > {O.AS_OF} - INTERVAL 14 DAY AND rule_id = 'security_source_multi_user_burst'
{NEWEST_ALERT} LIMIT 20""",
)
def q_recent_detections(spark: SparkSession, sf: str) -> DataFrame:
    detections = V.recent_login_detections(B.bound_alerts(spark, sf))
    return R.recent_detections(
        detections, B.AS_OF, 2 * WEEK, rule_id="security_source_multi_user_burst"
    )


ACTIVITY_SQL = O.with_(O.SRC, O.ENV, O.ACTIVITY)


def _activity(spark: SparkSession, sf: str) -> DataFrame:
    return V.endpoint_activity(B.bound_events(spark, sf), B.AS_OF)


@query(
    "endpoint_count",
    ACTIVITY_SQL
    + f"SELECT {N} AS endpoints, count(*) >= 3 AS ok FROM activity WHERE lane = 'vector-syslog'",
)
def q_endpoint_count(spark: SparkSession, sf: str) -> DataFrame:
    return R.endpoint_count(_activity(spark, sf), lane=S.LANE_SYSLOG, min_endpoints=3)


@query(
    "endpoint_report",
    ACTIVITY_SQL
    + """SELECT endpoint_id, lane, status, minutes_since_last_seen, total_events, first_seen, last_seen
FROM activity ORDER BY last_seen DESC, endpoint_id, lane LIMIT 25""",
)
def q_endpoint_report(spark: SparkSession, sf: str) -> DataFrame:
    return R.endpoint_report(_activity(spark, sf))


@query(
    "endpoint_panel",
    ACTIVITY_SQL
    + """SELECT endpoint_id, lane, status, minutes_since_last_seen, total_events, last_seen
FROM activity ORDER BY last_seen DESC, endpoint_id, lane LIMIT 25""",
)
def q_endpoint_panel(spark: SparkSession, sf: str) -> DataFrame:
    return R.endpoint_panel(_activity(spark, sf))


@query(
    "windows_lane_count",
    O.EVENTS_SQL
    + f"""SELECT {N} AS events, count(*) >= 1 AS ok FROM env WHERE ingest_source = 'vector-windows-endpoint'
AND f_computer = 'host-2' AND ts >= {O.AS_OF} - INTERVAL 30 DAY""",
)
def q_windows_count(spark: SparkSession, sf: str) -> DataFrame:
    return R.windows_lane_count(
        B.bound_events(spark, sf, B.MONTH), B.AS_OF, B.MONTH, computer="HOST-2"
    )


@query(
    "windows_lane_latest",
    O.AUTH_SQL
    + f"""SELECT ts, ingest_source, host, "user", src_ip, status, raw_event_id, message FROM auth
WHERE ingest_source = 'vector-windows-endpoint' AND host = 'host-2' {NEWEST_EVENT} LIMIT 10""",
)
def q_windows_latest(spark: SparkSession, sf: str) -> DataFrame:
    return R.windows_lane_latest(B.bound_auth(spark, sf), computer="Host-2")


@query(
    "events_per_minute",
    O.EVENTS_SQL + f"SELECT date_trunc('minute', ts) AS time, {N} AS value FROM env GROUP BY 1",
)
def q_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    return R.events_per_minute(B.bound_anchors(spark, sf))


@query(
    "top_ingest_sources",
    O.EVENTS_SQL + f"SELECT ingest_source, {N} AS events FROM env GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def q_top_sources(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_ingest_sources(B.bound_anchors(spark, sf))


@query(
    "recent_events",
    O.EVENTS_SQL + f"SELECT ts, ingest_source, message FROM env {NEWEST_EVENT} LIMIT 100",
)
def q_recent_events(spark: SparkSession, sf: str) -> DataFrame:
    return R.recent_events(B.bound_events(spark, sf))


@query(
    "spray_sources",
    O.AUTH_SQL
    + f"""SELECT src_ip, CAST(count(DISTINCT "user") AS BIGINT) AS targeted_users, {N} AS failures FROM auth
WHERE ingest_source = 'synthetic-auth' AND status = 'failure' GROUP BY 1 HAVING count(DISTINCT "user") >= 3""",
)
def q_spray_sources(spark: SparkSession, sf: str) -> DataFrame:
    return R.spray_sources(B.bound_auth(spark, sf))


@query(
    "investigate",
    O.AUTH_SQL
    + f"""SELECT ts, ingest_source, "user", src_ip, host, status, message FROM auth
WHERE "user" = 'user-8' OR src_ip = '10.0.0.5' {NEWEST_EVENT} LIMIT 20""",
)
def q_investigate(spark: SparkSession, sf: str) -> DataFrame:
    return R.investigate(B.bound_auth(spark, sf), "user-8", "10.0.0.5")


def _latest_auth(name: str, columns: str, where: str, **equal: str) -> None:
    names = columns.split(", ")
    shown = ", ".join(f'"{c}"' for c in names)

    @query(name, O.AUTH_SQL + f"SELECT {shown} FROM auth WHERE {where} {NEWEST_EVENT} LIMIT 10")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return R.latest_auth(B.bound_auth(spark, sf), 10, **equal).select(*names)


_latest_auth(
    "latest_by_source_kind", "ts, user, src_ip, host, status, auth_method", "source_kind = 'linux_ssh'",
    source_kind="linux_ssh",
)
_latest_auth(
    "latest_by_lane", "ts, platform, user, src_ip, host, status, source_kind, raw_event_id, collector_name",
    "ingest_source = 'vector-windows-endpoint'", ingest_source="vector-windows-endpoint",
)
_latest_auth(
    "latest_by_collector", "ts, user, src_ip, host, status, raw_event_id",
    "collector_name = '' AND host = 'host-1'", collector_name="", host="host-1",
)


def _latest_alerts(name: str, columns: str, where: str, **equal: str) -> None:
    @query(name, O.ALERTS_SQL + f"SELECT {columns} FROM alerts WHERE {where} {NEWEST_ALERT} LIMIT 20")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return R.latest_alerts(B.bound_alerts(spark, sf), 20, **equal).select(*columns.split(", "))


_latest_alerts(
    "latest_alerts_by_host",
    "ts, rule_id, alert_type, attempt_count, entity_user, entity_src_ip, entity_host, reason",
    "entity_host = 'host-1'", entity_host="host-1",
)
_latest_alerts(
    "latest_alerts_by_rule", "ts, rule_id, severity, hits", "rule_id = 'windows_failed_logon_burst'",
    rule_id="windows_failed_logon_burst",
)


@query(
    "rule_check_latest",
    O.ALERTS_SQL
    + f"""SELECT ts, rule_id, severity, hits, principal, source_ip, endpoint_id, reason FROM alerts
WHERE rule_id = 'security_failed_login_burst' {NEWEST_ALERT} LIMIT 10""",
)
def q_rule_check(spark: SparkSession, sf: str) -> DataFrame:
    return R.rule_check_latest(B.bound_alerts(spark, sf), "security_failed_login_burst")


@query(
    "event_growth",
    O.EVENTS_SQL
    + f"""SELECT {N.replace('count(*)', "count(*) FILTER (ts <= TIMESTAMP '2024-01-16')")} AS events_before,
  {N} AS events_after, count(*) > count(*) FILTER (ts <= TIMESTAMP '2024-01-16') AS grew FROM env""",
)
def q_growth(spark: SparkSession, sf: str) -> DataFrame:
    events = B.bound_anchors(spark, sf)
    return R.event_growth(events.filter(F.col("ts") <= F.expr("TIMESTAMP '2024-01-16 00:00:00'")), events)


# Alerting.

_CONDITIONS = """cond AS (
  SELECT * FROM (VALUES ('security_failed_login_burst', 2, 'medium'), ('windows_failed_logon_burst', 5, 'medium'),
    ('security_source_multi_user_burst', 10, 'high'), ('security_user_multi_source_burst', 10, 'high'),
    ('security_failed_then_success', 15, 'high')) v(rule_id, lookback_minutes, severity))"""


@query(
    "alert_conditions",
    O.ALERTS_SQL.rstrip()
    + f""",
{_CONDITIONS}
SELECT rule_id, severity, lookback_minutes, value, value > 0 AS firing FROM (
  SELECT c.*, CAST((SELECT count(*) FROM alerts a WHERE a.rule_id = c.rule_id
    AND a.ts > TIMESTAMP '2024-01-25 00:03:00' - to_minutes(c.lookback_minutes)) AS DOUBLE) AS value FROM cond c)""",
)
def q_conditions(spark: SparkSession, sf: str) -> DataFrame:
    return A.alert_conditions(B.bound_alerts(spark, sf), datetime(2024, 1, 25, 0, 3))


@query(
    "alert_transitions",
    O.ALERTS_SQL.rstrip()
    + f""",
{_CONDITIONS},
marks AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-01', INTERVAL 1 MINUTE)) AS tick),
hot AS (
  SELECT DISTINCT rule_id, tick FROM (
    SELECT a.rule_id, a.ts, c.lookback_minutes, unnest(generate_series(
        date_trunc('minute', a.ts), a.ts + to_minutes(c.lookback_minutes), INTERVAL 1 MINUTE)) AS tick
    FROM alerts a JOIN cond c ON a.rule_id = c.rule_id)
  WHERE ts <= tick AND ts > tick - to_minutes(lookback_minutes)),
states AS (
  SELECT rule_id, tick, firing, lag(firing, 1, false) OVER (PARTITION BY rule_id ORDER BY tick) AS before
  FROM (SELECT c.rule_id, m.tick, h.tick IS NOT NULL AS firing
        FROM cond c CROSS JOIN marks m LEFT JOIN hot h ON h.rule_id = c.rule_id AND h.tick = m.tick))
SELECT rule_id, tick, CASE WHEN firing THEN 'firing' ELSE 'resolved' END AS state
FROM states WHERE firing <> before""",
)
def q_transitions(spark: SparkSession, sf: str) -> DataFrame:
    return A.alert_transitions(B.bound_alerts(spark, sf))


@query(
    "event_rate_transitions",
    O.AUTH_SQL.rstrip()
    + f""",
alerts AS (
  SELECT ts, CASE WHEN lane = 0 THEN 'windows_failed_logon_burst' WHEN lane = 2 THEN 'security_failed_then_success'
                  ELSE 'security_failed_login_burst' END AS rule_id FROM env),
{_CONDITIONS},
marks AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-01', INTERVAL 1 MINUTE)) AS tick),
hot AS (
  SELECT DISTINCT rule_id, tick FROM (
    SELECT a.rule_id, a.ts, c.lookback_minutes, unnest(generate_series(
        date_trunc('minute', a.ts), a.ts + to_minutes(c.lookback_minutes), INTERVAL 1 MINUTE)) AS tick
    FROM alerts a JOIN cond c ON a.rule_id = c.rule_id)
  WHERE ts <= tick AND ts > tick - to_minutes(lookback_minutes)),
states AS (
  SELECT rule_id, tick, firing, lag(firing, 1, false) OVER (PARTITION BY rule_id ORDER BY tick) AS before
  FROM (SELECT c.rule_id, m.tick, h.tick IS NOT NULL AS firing
        FROM cond c CROSS JOIN marks m LEFT JOIN hot h ON h.rule_id = c.rule_id AND h.tick = m.tick))
SELECT rule_id, CASE WHEN firing THEN 'firing' ELSE 'resolved' END AS state, {N} AS changes,
  min(tick) AS first_tick, max(tick) AS last_tick
FROM states WHERE firing <> before GROUP BY ALL""",
)
def q_rate_transitions(spark: SparkSession, sf: str) -> DataFrame:
    """Transitions with every event taken as an alert: instants of any millisecond, and
    spans that join and break all over the month."""
    rule = (
        F.when(F.col("ingest_source") == S.LANE_WINDOWS, "windows_failed_logon_burst")
        .when(F.col("ingest_source") == S.LANE_SYNTHETIC, "security_failed_then_success")
        .otherwise("security_failed_login_burst")
    )
    changes = A.alert_transitions(B.bound_anchors(spark, sf).select("ts", rule.alias("rule_id")))
    return changes.groupBy("rule_id", "state").agg(
        F.count("*").alias("changes"), F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick")
    )


@query(
    "notification_groups",
    O.ALERTS_SQL
    + f"""SELECT rule_id, severity, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS group_start,
  {N} AS alerts, min(ts) AS first_ts, max(ts) AS last_ts FROM alerts GROUP BY 1, 2, 3""",
)
def q_notifications(spark: SparkSession, sf: str) -> DataFrame:
    return A.notification_groups(B.bound_alerts(spark, sf))


# Presentation.


def _rounded(expr: str) -> str:
    return f"CAST(floor({expr} + 0.5) AS BIGINT)"


_CARDS = f"""cards AS (
  SELECT *, {_rounded('seconds / 60.0')} AS minutes, {_rounded(f"{_rounded('seconds / 60.0')} / 60.0")} AS hours
  FROM (SELECT ts, rule_id, alert_fingerprint,
    CASE WHEN regexp_matches(lower(rule_name), 'failed|logon|login') THEN 'Failed Login Burst Detected'
         WHEN contains(lower(rule_name), 'spray') THEN 'Password Spray Detected'
         WHEN contains(lower(rule_name), 'distributed') THEN 'Distributed Login Attack Detected'
         ELSE 'Suspicious Login Activity Detected' END AS title,
    coalesce(nullif(principal, ''), 'n/a') AS "user", coalesce(nullif(source_ip, ''), 'n/a') AS src_ip,
    CAST(hits AS VARCHAR) AS attempts,
    greatest(1, {_rounded('(epoch_us(window_end) - epoch_us(window_start)) / 1000000.0')}) AS seconds,
    coalesce(nullif(json_extract_string(details, '$.sample_logon_type'), ''), 'n/a') AS logon_type,
    endpoint_id AS host FROM alerts))"""


@query(
    "alert_presentation",
    O.ALERTS_SQL.rstrip()
    + f""",
{_CARDS}
SELECT *, "user" || ' saw ' || attempts || ' failed attempts from ' || src_ip || ' in ' || window_text
  || '. This pattern may indicate a brute-force attack.' AS sentence
FROM (SELECT ts, rule_id, alert_fingerprint, title, "user", src_ip, attempts, logon_type, host,
  CASE WHEN seconds <= 90 THEN seconds || ' seconds'
       WHEN minutes < 60 THEN minutes || CASE minutes WHEN 1 THEN ' minute' ELSE ' minutes' END
       ELSE hours || CASE hours WHEN 1 THEN ' hour' ELSE ' hours' END END AS window_text FROM cards)""",
)
def q_cards(spark: SparkSession, sf: str) -> DataFrame:
    return C.alert_cards(B.bound_alerts(spark, sf))


_AGE = f"""CASE WHEN seconds < 5 THEN 'just now' WHEN seconds < 60 THEN seconds || ' seconds ago'
  WHEN minutes < 60 THEN minutes || CASE minutes WHEN 1 THEN ' minute ago' ELSE ' minutes ago' END
  WHEN hours < 24 THEN hours || CASE hours WHEN 1 THEN ' hour ago' ELSE ' hours ago' END
  ELSE {O.sec('ts')} END"""


def _aged(source: str, as_of: str) -> str:
    return f"""(SELECT *, {_rounded('minutes / 60.0')} AS hours FROM (
  SELECT *, {_rounded('seconds / 60.0')} AS minutes FROM (
    SELECT *, greatest(0, {_rounded(f"(epoch_us({as_of}) - epoch_us(ts)) / 1000000.0")}) AS seconds
    FROM {source})))"""


_LATE = datetime(2024, 1, 30, 23, 50)
_LATE_SQL = "TIMESTAMP '2024-01-30 23:50:00'"


@query(
    "relative_age",
    O.EVENTS_SQL + f"SELECT event_id, {_AGE} AS age FROM {_aged('env', _LATE_SQL)}",
)
def q_age(spark: SparkSession, sf: str) -> DataFrame:
    events = B.bound_anchors(spark, sf)
    return events.select("event_id", C.relative_age(F.col("ts"), _LATE).alias("age"))


@query(
    "feed_row_keys",
    O.ALERTS_SQL
    + f"""SELECT {O.sec('time')} || '|' || rule_id || '|' || alert_type || '|' || endpoint_id || '|'
  || entity_user || '|' || entity_src_ip AS row_key FROM ({FEED_SQL} 200)""",
)
def q_row_keys(spark: SparkSession, sf: str) -> DataFrame:
    feed = R.alerts_feed(B.bound_alerts(spark, sf), 200)
    return feed.select(C.row_key().alias("row_key"))


@query(
    "event_lines",
    O.AUTH_SQL
    + f"""SELECT ts AS time, status || ' ' || "user" || ' from ' || src_ip AS headline,
  {_AGE} || ' · ' || host || ' · ' || source_kind || ' · logon ' || coalesce(nullif(logon_type, ''), '-')
    AS context
FROM {_aged('auth', O.AS_OF)} ORDER BY ts DESC, message LIMIT 10""",
)
def q_event_lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.event_lines(R.events_feed(B.bound_auth(spark, sf)), B.AS_OF)


# Tables.


@query(
    "contract_violations",
    O.EVENTS_SQL
    + f"""SELECT * FROM (
  SELECT 'platform' AS "column", 'missing' AS violation, CAST(0 AS BIGINT) AS rows
  UNION ALL SELECT 'event_id', 'wrong type', 0
  UNION ALL SELECT 'message', 'null anchor', {N} FROM env WHERE message LIKE 'heartbeat%'
  UNION ALL SELECT 'schema_version', 'unknown version', {N} FROM env WHERE lane = 3) WHERE true""",
)
def q_contract(spark: SparkSession, sf: str) -> DataFrame:
    """A table that breaks the contract: a lost anchor, a wrong type, NULLs, another version."""
    events = B.bound_events(spark, sf)
    broken = events.drop("platform").withColumns(
        {
            "event_id": F.expr("CAST(substring(event_id, 5) AS BIGINT)"),
            "message": F.expr("if(message LIKE 'heartbeat%', NULL, message)"),
            "schema_version": F.expr(
                f"if(ingest_source = '{S.LANE_SYSLOG}', 'other.v0', schema_version)"
            ),
        }
    )
    return T.contract_violations(broken)


@query(
    "contract_holds",
    O.EVENTS_SQL
    + f"""SELECT 'ts' AS "column", 'null anchor' AS violation, {N} AS rows FROM env WHERE ts IS NULL
HAVING count(*) > 0""",
)
def q_contract_holds(spark: SparkSession, sf: str) -> DataFrame:
    return T.contract_violations(B.bound_events(spark, sf))


_PARTIAL = ["rule_id", "rule_name", "severity", "hits", "threshold_op", "threshold_value", "query"]
_ADDED_SQL = f"""{O.AS_OF} AS window_start, {O.AS_OF} AS first_seen_ts, {O.AS_OF} AS last_seen_ts,
  {O.AS_OF} AS window_bucket, '' AS alert_type, '' AS alert_fingerprint, CAST(0 AS BIGINT) AS attempt_count,
  '' AS principal, '' AS entity_user, '' AS source_ip, '' AS entity_src_ip, '' AS endpoint_id,
  '' AS entity_host, CAST(0 AS BIGINT) AS distinct_user_count, CAST(0 AS BIGINT) AS distinct_ip_count,
  '' AS source_kind, '' AS reason, '' AS evidence_summary, 'new' AS workflow_state"""


@query(
    "column_defaults",
    O.AUTH_SQL
    + f"""SELECT {O.AS_OF} AS ts, 'host_count' AS rule_id, host AS rule_name, 'low' AS severity, {N} AS hits,
  'gte' AS threshold_op, CAST(1 AS BIGINT) AS threshold_value, 'count by host' AS query, '' AS details,
  {O.AS_OF} AS window_end, {_ADDED_SQL} FROM auth GROUP BY host""",
)
def q_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Alert rows that state only the columns without a default."""
    partial = (
        B.bound_auth(spark, sf)
        .groupBy(F.col("host").alias("rule_name"))
        .agg(F.count("*").alias("hits"))
        .withColumns(
            {
                "rule_id": F.lit("host_count"), "severity": F.lit("low"), "threshold_op": F.lit("gte"),
                "threshold_value": F.lit(1), "query": F.lit("count by host"),
            }
        )
    )
    return T.with_defaults(partial.select(*_PARTIAL), schema.ALERTS, as_of=B.AS_OF)


_OLD = ["ts", *_PARTIAL, "window_end", "details"]


@query(
    "schema_evolve",
    O.ALERTS_SQL + f"SELECT {', '.join(_OLD)}, {_ADDED_SQL} FROM alerts",
)
def q_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """An alert table from before most columns existed, brought to the current schema."""
    old = B.bound_alerts(spark, sf).select(*_OLD)
    return T.evolve(old, schema.ALERTS, schema.ALERT_DEFAULTS, B.AS_OF)


@query(
    "retention_events",
    O.EVENTS_SQL
    + f"SELECT event_id, ts, ingest_source FROM env WHERE ts + INTERVAL 7 DAY > {O.AS_OF}",
)
def q_retention_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.retained(B.bound_anchors(spark, sf), B.AS_OF, S.EVENT_RETENTION_DAYS)
    return rows.select("event_id", "ts", "ingest_source")


@query(
    "retention_alerts",
    O.ALERTS_SQL
    + """SELECT alert_fingerprint, ts FROM alerts WHERE ts + INTERVAL 30 DAY > TIMESTAMP '2024-02-12'""",
)
def q_retention_alerts(spark: SparkSession, sf: str) -> DataFrame:
    as_of = B.AS_OF + timedelta(days=12)
    rows = T.retained(B.bound_alerts(spark, sf), as_of, S.ALERT_RETENTION_DAYS)
    return rows.select("alert_fingerprint", "ts")


@query(
    "month_layout",
    O.EVENTS_SQL
    + f"SELECT strftime(ts, '%Y%m') AS month, platform, {N} AS events, min(ts) AS first_ts FROM env GROUP BY 1, 2",
)
def q_layout(spark: SparkSession, sf: str) -> DataFrame:
    return (
        T.by_month(B.bound_anchors(spark, sf))
        .groupBy("month", "platform")
        .agg(F.count("*").alias("events"), F.min("ts").alias("first_ts"))
    )

"""DuckDB SQL building blocks for the reference answers.

They restate the table binding and the semantics in plain SQL, independently of the
Spark operators. Each block is one common table expression.
"""

from __future__ import annotations

from authlane.operators.rules import RuleConfig
from authlane.plans.bindings import DAY, HISTORY_SLIDE_SECONDS, MONTH, history_pack

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
VERSION = "authlane.event.v1"

SRC = """src AS (
  SELECT id, ts, uid, et, value, k,
         'user-' || uid AS usr, '10.0.0.' || (k % 8) AS ip, 'host-' || (uid % 5) AS hst
  FROM (SELECT event_id AS id, date_trunc('millisecond', ts) AS ts, user_id AS uid,
               event_type AS et, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events))"""

ENV = f"""env AS (
  SELECT ts, 'evt-' || id AS event_id, lane, uid,
         ['windows', 'linux-host', 'linux', 'local-mvp'][lane + 1] AS platform,
         '{VERSION}' AS schema_version,
         ['vector-windows-endpoint', 'vector-linux-ssh', 'synthetic-auth', 'vector-syslog'][lane + 1]
           AS ingest_source,
         CASE WHEN verb IS NULL THEN 'heartbeat ' || et
              WHEN lane = 0 THEN 'Windows logon ' || CASE et WHEN 'error' THEN 'failure' ELSE 'success' END
                   || ' user=' || usr || ' host=' || hst
              ELSE 'sshd[' || id || ']: ' || verb || ' for '
                   || CASE WHEN et = 'error' AND k % 10 = 0 THEN 'invalid user ' ELSE '' END
                   || usr || ' from ' || ip || ' port 22 ssh2' END AS message,
         CASE WHEN told THEN 'login' ELSE '' END AS f_event_type,
         CASE WHEN told THEN usr ELSE '' END AS f_user,
         CASE WHEN told THEN ip ELSE '' END AS f_src_ip,
         CASE WHEN NOT told THEN '' WHEN et <> 'error' THEN 'Successful'
              WHEN k % 2 = 1 THEN 'FAILED' ELSE 'failure' END AS f_status,
         CASE WHEN lane = 0 THEN hst ELSE '' END AS f_computer,
         CASE WHEN lane = 2 THEN hst ELSE '' END AS f_host,
         CASE WHEN lane IN (1, 3) THEN hst ELSE '' END AS f_hostname,
         CASE WHEN told AND lane = 0 THEN '3' ELSE '' END AS f_logon_type,
         CASE WHEN told AND lane = 0 THEN CASE et WHEN 'error' THEN '4625' ELSE '4624' END ELSE '' END
           AS f_event_id,
         CASE WHEN told AND lane = 2 THEN 'replay-' || et ELSE '' END AS f_scenario
  FROM (SELECT *, verb IS NOT NULL AND lane IN (0, 2) AS told
        FROM (SELECT *, uid % 4 AS lane,
                     CASE et WHEN 'error' THEN 'Failed password' WHEN 'signup' THEN 'Accepted publickey'
                             WHEN 'purchase' THEN 'Accepted password' END AS verb
              FROM src)))"""

AUTH = r"""auth AS (
  SELECT * FROM (
    SELECT ts, event_id, platform, schema_version, ingest_source, message,
      coalesce(nullif(f_event_type, ''),
               CASE WHEN regexp_matches(message, '(?i)failed password|accepted (password|publickey)')
                    THEN 'login' ELSE '' END) AS event_type,
      coalesce(nullif(f_user, ''), nullif(regexp_extract(message, 'for invalid user ([^ ]+)', 1), ''),
               regexp_extract(message, 'for ([^ ]+) from', 1)) AS "user",
      coalesce(nullif(f_src_ip, ''), regexp_extract(message, 'from ([0-9A-Fa-f:\.]+)', 1)) AS src_ip,
      coalesce(nullif(f_host, ''), nullif(f_computer, ''), f_hostname) AS host,
      CASE WHEN lower(f_status) IN ('failed', 'failure') THEN 'failure'
           WHEN lower(f_status) IN ('successful', 'success') THEN 'success'
           WHEN f_status <> '' THEN f_status
           WHEN regexp_matches(message, '(?i)accepted (password|publickey)') THEN 'success'
           WHEN regexp_matches(message, '(?i)failed password') THEN 'failure' ELSE '' END AS status,
      CASE WHEN ingest_source = 'vector-windows-endpoint' THEN 'windows_auth'
           WHEN ingest_source = 'vector-linux-ssh' THEN 'linux_ssh'
           WHEN contains(lower(message), 'sshd') THEN 'linux_ssh' ELSE '' END AS source_kind,
      f_event_id AS raw_event_id, f_logon_type AS logon_type, '' AS domain,
      CASE WHEN regexp_matches(message, '(?i)accepted publickey') THEN 'publickey'
           WHEN regexp_matches(message, '(?i)(accepted|failed) password') THEN 'password' ELSE '' END
        AS auth_method,
      '' AS collector_name
    FROM env) WHERE event_type IN ('login', 'auth.login'))"""

ACTIVITY = f"""activity AS (
  SELECT endpoint_id, lane, first_seen, last_seen, total_events, minutes_since_last_seen,
         CASE WHEN minutes_since_last_seen <= 15 THEN 'active'
              WHEN minutes_since_last_seen <= 60 THEN 'idle' ELSE 'stale' END AS status
  FROM (SELECT *, CAST(date_diff('minute', last_seen, {AS_OF}) AS BIGINT) AS minutes_since_last_seen
        FROM (SELECT coalesce(nullif(f_computer, ''), nullif(f_hostname, ''), nullif(f_host, ''), 'unknown')
                       AS endpoint_id,
                     ingest_source AS lane, min(ts) AS first_seen, max(ts) AS last_seen,
                     CAST(count(*) AS BIGINT) AS total_events
              FROM env GROUP BY 1, 2)
        WHERE endpoint_id <> 'unknown'))"""


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n"


EVENTS_SQL = with_(SRC, ENV)
AUTH_SQL = with_(SRC, ENV, AUTH)


def bucket(expr: str, minutes: int) -> str:
    size = minutes * 60_000_000
    return f"make_timestamp(epoch_us({expr}) - epoch_us({expr}) % {size})"


def ms(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%g')"


def sec(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def single_range(minutes: int) -> str:
    """Login events of the window before AS_OF, as one tick."""
    return f"""ranged AS (
  SELECT {AS_OF} AS tick, a.* FROM auth a WHERE ts > {AS_OF} - INTERVAL {minutes} MINUTE)"""


def tick_range(minutes: int, slide_seconds: int) -> str:
    """Login events of every tick's window over the month."""
    return f"""ticks AS (
  SELECT unnest(generate_series(TIMESTAMP '2024-01-01', {AS_OF}, INTERVAL {slide_seconds} SECOND)) AS tick),
ranged AS (
  SELECT t.tick, a.* FROM ticks t JOIN auth a
    ON a.ts > t.tick - INTERVAL {minutes} MINUTE AND a.ts <= t.tick)"""


_OUTSIDE = "ingest_source <> 'vector-windows-endpoint' AND \"user\" <> '' AND src_ip <> ''"


def _failed_login_burst(c: RuleConfig, more: str) -> str:
    n = c.window_minutes
    return f"""SELECT tick, hits, principal, source_ip, endpoint_id, window_start, window_end,
    CAST(1 AS BIGINT) AS distinct_user_count, CAST(1 AS BIGINT) AS distinct_ip_count, source_kind,
    'Repeated failed logins for account ' || principal || ' from ' || source_ip || ' on ' || endpoint_id AS reason,
    hits || ' failed attempts within {n} minutes' AS evidence_summary,
    '{{"principal":"' || principal || '","source_ip":"' || source_ip || '","endpoint_id":"' || endpoint_id
      || '","failed_attempts":' || hits || ',"window_minutes":{n}}}' AS details,
    {bucket('window_end', n)} AS window_bucket
  FROM (SELECT tick, "user" AS principal, src_ip AS source_ip, host AS endpoint_id, source_kind,
          CAST(count(*) AS BIGINT) AS hits, min(ts) AS window_start, max(ts) AS window_end
        FROM ranged WHERE status = 'failure' AND source_kind = 'linux_ssh' AND {_OUTSIDE} {more}
        GROUP BY ALL) WHERE hits >= {c.threshold_value}"""


def _failed_then_success(c: RuleConfig, more: str) -> str:
    n = c.window_minutes
    return f"""SELECT tick, hits, principal, source_ip, endpoint_id, window_start, window_end,
    CAST(1 AS BIGINT) AS distinct_user_count, CAST(1 AS BIGINT) AS distinct_ip_count, source_kind,
    'Successful login followed repeated failures for ' || principal || ' from ' || source_ip || ' on '
      || endpoint_id AS reason,
    hits || ' failed attempts before success within {n} minutes' AS evidence_summary,
    '{{"principal":"' || principal || '","source_ip":"' || source_ip || '","endpoint_id":"' || endpoint_id
      || '","failed_attempts":' || hits || ',"first_failure":"' || {ms('window_start')}
      || '","first_success":"' || {ms('window_end')} || '"}}' AS details,
    {bucket('window_end', n)} AS window_bucket
  FROM (SELECT tick, "user" AS principal, src_ip AS source_ip, host AS endpoint_id, source_kind,
          CAST(count(*) FILTER (status = 'failure') AS BIGINT) AS hits,
          min(ts) FILTER (status = 'failure') AS window_start,
          max(ts) FILTER (status = 'failure') AS last_failure,
          min(ts) FILTER (status = 'success') AS window_end
        FROM ranged WHERE status IN ('failure', 'success') AND {_OUTSIDE} {more}
        GROUP BY tick, "user", src_ip, host, source_kind)
  WHERE hits >= {max(c.threshold_failures, c.threshold_value)} AND window_end >= last_failure"""


def _sample(column: str) -> str:
    return f"array_to_string(list_sort(list(DISTINCT {column}))[1:5], ', ')"


def _password_spray(c: RuleConfig, more: str) -> str:
    n = c.window_minutes
    return f"""SELECT tick, hits, '' AS principal, source_ip, endpoint_id, window_start, window_end,
    users AS distinct_user_count, CAST(1 AS BIGINT) AS distinct_ip_count, source_kind,
    'Source ' || source_ip || ' targeted multiple usernames on ' || endpoint_id AS reason,
    users || ' usernames targeted across ' || hits || ' failed attempts. Examples: ' || sample AS evidence_summary,
    '{{"source_ip":"' || source_ip || '","endpoint_id":"' || endpoint_id || '","targeted_users":' || users
      || ',"failed_attempts":' || hits || ',"sampled_users":"' || sample || '"}}' AS details,
    {bucket('window_end', n)} AS window_bucket
  FROM (SELECT tick, src_ip AS source_ip, host AS endpoint_id, source_kind,
          CAST(count(DISTINCT "user") AS BIGINT) AS users, CAST(count(*) AS BIGINT) AS hits,
          {_sample('"user"')} AS sample, min(ts) AS window_start, max(ts) AS window_end
        FROM ranged WHERE status = 'failure' AND {_OUTSIDE} {more}
        GROUP BY tick, src_ip, host, source_kind)
  WHERE users >= {c.threshold_distinct_users} AND hits >= {max(c.threshold_attempts, c.threshold_value)}"""


def _distributed_attack(c: RuleConfig, more: str) -> str:
    n = c.window_minutes
    return f"""SELECT tick, hits, principal, '' AS source_ip, endpoint_id, window_start, window_end,
    CAST(1 AS BIGINT) AS distinct_user_count, ips AS distinct_ip_count, source_kind,
    'Account ' || principal || ' saw failed logins from multiple source IPs on ' || endpoint_id AS reason,
    ips || ' source IPs across ' || hits || ' failed attempts. Examples: ' || sample AS evidence_summary,
    '{{"principal":"' || principal || '","endpoint_id":"' || endpoint_id || '","source_count":' || ips
      || ',"failed_attempts":' || hits || ',"sampled_sources":"' || sample || '"}}' AS details,
    {bucket('window_end', n)} AS window_bucket
  FROM (SELECT tick, "user" AS principal, host AS endpoint_id, source_kind,
          CAST(count(DISTINCT src_ip) AS BIGINT) AS ips, CAST(count(*) AS BIGINT) AS hits,
          {_sample('src_ip')} AS sample, min(ts) AS window_start, max(ts) AS window_end
        FROM ranged WHERE status = 'failure' AND {_OUTSIDE} {more}
        GROUP BY tick, "user", host, source_kind)
  WHERE ips >= {c.threshold_distinct_ips} AND hits >= {max(c.threshold_attempts, c.threshold_value)}"""


def _windows_failed_logon_burst(c: RuleConfig, more: str) -> str:
    n = c.window_minutes
    return f"""SELECT tick, hits, principal, source_ip, endpoint_id, window_start, window_end,
    distinct_user_count, distinct_ip_count, 'windows_auth' AS source_kind,
    'Repeated Windows failed logons detected on ' || endpoint_id AS reason,
    hits || ' failed logons within {n} minutes' AS evidence_summary,
    '{{"endpoint_id":"' || endpoint_id || '","sample_user":"' || principal || '","sample_source_ip":"'
      || source_ip || '","sample_logon_type":"' || logon || '","failed_attempts":' || hits
      || ',"window_minutes":{n}}}' AS details,
    {bucket('window_end', n)} AS window_bucket
  FROM (SELECT tick, CASE host WHEN '' THEN 'unknown' ELSE host END AS endpoint_id,
          CAST(count(*) AS BIGINT) AS hits,
          coalesce(min(nullif("user", '')), '') AS principal,
          coalesce(min(nullif(src_ip, '')), '') AS source_ip,
          coalesce(min(nullif(logon_type, '')), '') AS logon,
          CAST(count(DISTINCT nullif("user", '')) AS BIGINT) AS distinct_user_count,
          CAST(count(DISTINCT nullif(src_ip, '')) AS BIGINT) AS distinct_ip_count,
          min(ts) AS window_start, max(ts) AS window_end
        FROM ranged WHERE status = 'failure' AND ingest_source = 'vector-windows-endpoint' {more}
        GROUP BY ALL) WHERE hits >= {c.threshold_value}"""


RULE_SQL = {
    "security_failed_login_burst": _failed_login_burst,
    "security_failed_then_success": _failed_then_success,
    "security_source_multi_user_burst": _password_spray,
    "security_user_multi_source_burst": _distributed_attack,
    "windows_failed_logon_burst": _windows_failed_logon_burst,
}

RESULT = (
    "hits, principal, source_ip, endpoint_id, window_start, window_end, distinct_user_count, "
    "distinct_ip_count, source_kind, reason, evidence_summary, details, window_bucket"
)

RANK_SQL = {
    "security_source_multi_user_burst": "distinct_user_count DESC, hits DESC, window_end DESC",
    "security_user_multi_source_burst": "distinct_ip_count DESC, hits DESC, window_end DESC",
}


def rule_sql(c: RuleConfig, more: str = "") -> str:
    """All qualifying groups of one rule over ``ranged``."""
    return RULE_SQL[c.id](c, f"AND {more}" if more else "")


def rank_sql(rule_id: str) -> str:
    return RANK_SQL.get(rule_id, "hits DESC, window_end DESC") + (
        ", principal, source_ip, endpoint_id, source_kind"
    )


def alerts_block(configs: list[RuleConfig], top_n: int | None, name: str = "alerts") -> str:
    """Alert rows of a pack over ``ranged``: the earliest tick per fingerprint."""
    parts = []
    for c in configs:
        sql = rule_sql(c)
        if top_n is not None:
            sql = (
                f"SELECT * FROM ({sql}) QUALIFY row_number() OVER "
                f"(PARTITION BY tick ORDER BY {rank_sql(c.id)}) <= {top_n}"
            )
        parts.append(
            f"""SELECT tick AS ts, '{c.id}' AS rule_id, '{c.name}' AS rule_name,
  '{c.alert_type}' AS alert_type,
  concat_ws('|', '{c.alert_type}', principal, source_ip, endpoint_id, source_kind, {sec('window_bucket')})
    AS alert_fingerprint,
  '{c.severity}' AS severity, hits, hits AS attempt_count, principal, principal AS entity_user,
  source_ip, source_ip AS entity_src_ip, endpoint_id, endpoint_id AS entity_host,
  window_start, window_start AS first_seen_ts, window_end, window_end AS last_seen_ts, window_bucket,
  distinct_user_count, distinct_ip_count, source_kind, reason, evidence_summary,
  'new' AS workflow_state, '{c.threshold_op}' AS threshold_op,
  CAST({c.threshold_value} AS BIGINT) AS threshold_value,
  '{c.parameter_text}' AS query, details
FROM ({sql})"""
        )
    union = "\nUNION ALL\n".join(parts)
    return f"""{name} AS (
SELECT * FROM ({union})
QUALIFY row_number() OVER (PARTITION BY alert_fingerprint ORDER BY ts, rule_id) = 1)"""


ALERTS_SQL = with_(
    SRC, ENV, AUTH, tick_range(7 * DAY, HISTORY_SLIDE_SECONDS), alerts_block(history_pack(), None)
)

DETECTIONS = """detections AS (
  SELECT ts, rule_id, rule_name, coalesce(nullif(alert_type, ''), rule_id) AS alert_type,
    coalesce(nullif(alert_fingerprint, ''), 'n/a') AS alert_fingerprint, severity, hits, attempt_count,
    coalesce(nullif(entity_user, ''), nullif(principal, ''), 'n/a') AS entity_user,
    coalesce(nullif(entity_src_ip, ''), nullif(source_ip, ''), 'n/a') AS entity_src_ip,
    coalesce(nullif(entity_host, ''), nullif(endpoint_id, ''), 'n/a') AS entity_host,
    first_seen_ts, last_seen_ts, window_bucket, distinct_user_count, distinct_ip_count,
    coalesce(nullif(source_kind, ''), 'n/a') AS source_kind, reason, evidence_summary,
    coalesce(nullif(workflow_state, ''), 'new') AS workflow_state, details
  FROM alerts)"""

DETECTIONS_SQL = ALERTS_SQL.rstrip() + ",\n" + DETECTIONS + "\n"

MONTH_RANGE = single_range(MONTH)

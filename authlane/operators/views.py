"""The three derived views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane import settings as S
from authlane.functions.text import field, first_nonblank
from authlane.functions.times import AsOf, as_of_col, minute_boundaries
from authlane.schema import AUTH_EVENTS

# Patterns that read the login facts out of a message.
USER_PATTERNS = ("for invalid user ([^ ]+)", "for ([^ ]+) from")
SOURCE_PATTERN = "from ([0-9A-Fa-f:.]+)"

# Minutes without events up to which an endpoint is active, then idle.
ACTIVE_MINUTES = 15
IDLE_MINUTES = 60


def _key(name: str) -> str:
    """SQL for a map key, NULL when it is missing or blank."""
    return f"nullif(fields['{name}'], '')"


def _found(pattern: str) -> str:
    return f"nullif(regexp_extract(message, r'{pattern}', 1), '')"


# What the message says about a login, computed once for the columns that fall back to it.
_VERB = """CASE
    WHEN contains(lower(message), 'accepted publickey') THEN 'publickey'
    WHEN contains(lower(message), 'accepted password') THEN 'password'
    WHEN contains(lower(message), 'failed password') THEN 'failed'
    ELSE '' END"""

# One SQL expression per derived column: the map key first, then the message.
AUTH_COLUMNS = {
    "event_type": f"coalesce({_key('event_type')}, if(verb = '', '', 'login'))",
    "user": f"coalesce({_key('user')}, {', '.join(_found(p) for p in USER_PATTERNS)}, '')",
    "src_ip": f"coalesce({_key('src_ip')}, {_found(SOURCE_PATTERN)}, '')",
    "host": f"coalesce({_key('host')}, {_key('computer')}, {_key('hostname')}, '')",
    "status": f"""CASE
        WHEN lower(fields['status']) IN ('failed', 'failure') THEN '{S.STATUS_FAILURE}'
        WHEN lower(fields['status']) IN ('successful', 'success') THEN '{S.STATUS_SUCCESS}'
        WHEN fields['status'] <> '' THEN fields['status']
        WHEN verb IN ('publickey', 'password') THEN '{S.STATUS_SUCCESS}'
        WHEN verb = 'failed' THEN '{S.STATUS_FAILURE}'
        ELSE '' END""",
    "source_kind": f"""coalesce({_key('source_kind')}, CASE
        WHEN ingest_source = '{S.LANE_WINDOWS}' THEN '{S.KIND_WINDOWS}'
        WHEN ingest_source = '{S.LANE_LINUX_SSH}' OR contains(lower(message), 'sshd')
        THEN '{S.KIND_LINUX}' ELSE '' END)""",
    "raw_event_id": f"coalesce({_key('raw_event_id')}, {_key('event_id')}, '')",
    "logon_type": "ifnull(fields['logon_type'], '')",
    "domain": "ifnull(fields['domain'], '')",
    "auth_method": f"coalesce({_key('auth_method')}, if(verb = 'failed', 'password', verb))",
    "collector_name": "ifnull(fields['collector_name'], '')",
}


def auth_events(events: DataFrame) -> DataFrame:
    """Flatten login events. Each column prefers the map key and falls back to the message."""
    return (
        events.withColumn("verb", F.expr(_VERB))
        .selectExpr(
            *[
                f"{AUTH_COLUMNS[name]} AS `{name}`" if name in AUTH_COLUMNS else name
                for name in AUTH_EVENTS.names
            ]
        )
        .filter(F.col("event_type").isin(*S.LOGIN_EVENT_TYPES))
    )


def endpoint_id() -> Column:
    """Endpoint of an event. The precedence differs from the ``host`` of a login."""
    return first_nonblank(field("computer"), field("hostname"), field("host"), default="unknown")


def endpoint_activity(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """First and last event, count and freshness per endpoint and lane."""
    seen = (
        events.select(
            endpoint_id().alias("endpoint_id"), F.col("ingest_source").alias("lane"), "ts"
        )
        .filter(F.col("endpoint_id") != "unknown")
        .groupBy("endpoint_id", "lane")
        .agg(
            F.min("ts").alias("first_seen"),
            F.max("ts").alias("last_seen"),
            F.count("*").alias("total_events"),
        )
    )
    quiet = minute_boundaries(F.col("last_seen"), as_of_col(as_of))
    return seen.withColumn("minutes_since_last_seen", quiet).withColumn(
        "status",
        F.when(F.col("minutes_since_last_seen") <= ACTIVE_MINUTES, "active")
        .when(F.col("minutes_since_last_seen") <= IDLE_MINUTES, "idle")
        .otherwise("stale"),
    )


def recent_login_detections(alerts: DataFrame) -> DataFrame:
    """Operator-facing projection of the alerts: blanks replaced, raw twins dropped."""
    c = F.col
    return alerts.select(
        "ts",
        "rule_id",
        "rule_name",
        first_nonblank(c("alert_type"), default=c("rule_id")).alias("alert_type"),
        first_nonblank(c("alert_fingerprint"), default="n/a").alias("alert_fingerprint"),
        "severity",
        "hits",
        "attempt_count",
        first_nonblank(c("entity_user"), c("principal"), default="n/a").alias("entity_user"),
        first_nonblank(c("entity_src_ip"), c("source_ip"), default="n/a").alias("entity_src_ip"),
        first_nonblank(c("entity_host"), c("endpoint_id"), default="n/a").alias("entity_host"),
        "first_seen_ts",
        "last_seen_ts",
        "window_bucket",
        "distinct_user_count",
        "distinct_ip_count",
        first_nonblank(c("source_kind"), default="n/a").alias("source_kind"),
        "reason",
        "evidence_summary",
        first_nonblank(c("workflow_state"), default="new").alias("workflow_state"),
        "details",
    )

"""Read-side queries: feeds, health, checks and dashboards.

Every "latest n" is a top-k with a total order, which Spark runs as a per-partition
top-k and one merge of n rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane import settings as S
from authlane.functions.text import field, first_nonblank
from authlane.functions.times import AsOf, sec_text, within

# Row limits of the read API.
DEFAULT_LIMIT = 50
MAX_LIMIT = 200

# The columns whose presence a rule check asks for.
RULE_CHECK_COLUMNS = (
    "ts", "rule_id", "severity", "hits", "principal", "source_ip", "endpoint_id", "reason",
)

# Fixed value: an SSH auth line in a raw log.
SSH_AUTH_LINE = r"sshd.*(Failed password|Accepted (password|publickey))"


def clamp_limit(value: object, default: int = DEFAULT_LIMIT) -> int:
    """Requested row limit: not a number or below one gives the default, whole part, capped."""
    try:
        number = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return default
    if not math.isfinite(number) or number < 1:
        return default
    return min(math.floor(number), MAX_LIMIT)


def latest(
    df: DataFrame,
    n: int,
    tiebreak: tuple[str, ...],
    where: Column | None = None,
    columns: list[str] | None = None,
    by: str = "ts",
) -> DataFrame:
    """The newest ``n`` rows, ties in the order of ``tiebreak``."""
    rows = df if where is None else df.filter(where)
    top = rows.orderBy(F.col(by).desc(), *tiebreak).limit(n)
    return top if columns is None else top.select(*columns)


EVENT_TIEBREAK = ("event_id",)
ALERT_TIEBREAK = ("alert_fingerprint", "rule_id")


def matching(**equal: str | None) -> Column | None:
    """Conjunction of the given equalities; None leaves a column free."""
    where = None
    for name, value in equal.items():
        if value is not None:
            test = F.col(name) == value
            where = test if where is None else where & test
    return where


def _and(*tests: Column | None) -> Column | None:
    out = None
    for t in tests:
        if t is not None:
            out = t if out is None else out & t
    return out


# Feeds and health.


def alerts_feed(alerts: DataFrame, limit: object = None) -> DataFrame:
    c = F.col
    top = latest(alerts, clamp_limit(limit), ALERT_TIEBREAK)
    return top.select(
        c("ts").alias("time"), "rule_name", "severity",
        first_nonblank(c("entity_host"), c("endpoint_id")).alias("endpoint_id"),
        first_nonblank(c("reason"), c("evidence_summary")).alias("summary"),
        "alert_type", "rule_id", "attempt_count", "principal", "entity_user", "source_ip",
        "entity_src_ip", "source_kind", "window_start", "window_end", "first_seen_ts",
        "last_seen_ts", "distinct_user_count", "distinct_ip_count", "reason",
        "evidence_summary", "details",
    )


def events_feed(auth: DataFrame, limit: object = None) -> DataFrame:
    return latest(auth, clamp_limit(limit), EVENT_TIEBREAK).select(
        F.col("ts").alias("time"), "ingest_source", "user", "src_ip", "host", "status",
        "source_kind", "raw_event_id", "logon_type", "auth_method", "message",
    )


def health(auth: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Last login event as text, login events of the last minute, collector status."""
    recent = within(F.col("ts"), as_of, 1)
    counted = auth.agg(
        F.coalesce(sec_text(F.max("ts")), F.lit("")).alias("last_event_ts"),
        F.count_if(recent).alias("ingest_rate"),
    )
    return counted.withColumn(
        "collector_status",
        F.when(F.col("last_event_ts") == "", "unknown").otherwise("connected"),
    )


# Synthetic lane checks.


def _synthetic(ts_window: int, as_of: AsOf) -> Column:
    return (F.col("ingest_source") == S.LANE_SYNTHETIC) & within(F.col("ts"), as_of, ts_window)


def synthetic_raw(
    events: DataFrame, as_of: AsOf = None, lookback_minutes: int = 60, limit: int = 20,
    user: str | None = None, src_ip: str | None = None,
) -> DataFrame:
    where = _synthetic_events_filter(as_of, lookback_minutes, user, src_ip)
    keys = ["scenario", "user", "src_ip", "status", "source_kind"]
    return latest(events, limit, EVENT_TIEBREAK, where).select(
        "ts", "platform", *[field(k).alias(k) for k in keys], "message"
    )


def _synthetic_events_filter(
    as_of: AsOf, lookback_minutes: int, user: str | None, src_ip: str | None
) -> Column:
    where = _synthetic(lookback_minutes, as_of)
    if user is not None:
        where = where & (field("user") == user)
    if src_ip is not None:
        where = where & (field("src_ip") == src_ip)
    return where


def synthetic_auth(
    auth: DataFrame, as_of: AsOf = None, lookback_minutes: int = 60, limit: int = 20,
    source_kind: str | None = None, user: str | None = None, src_ip: str | None = None,
) -> DataFrame:
    where = _and(
        _synthetic(lookback_minutes, as_of),
        matching(source_kind=source_kind, user=user, src_ip=src_ip),
    )
    return latest(auth, limit, EVENT_TIEBREAK, where).select(
        "ts", "platform", "user", "src_ip", "host", "status", "source_kind", "raw_event_id",
        "auth_method", "collector_name", "message",
    )


def scenario_summary(
    events: DataFrame, as_of: AsOf = None, lookback_minutes: int = 60,
    user: str | None = None, src_ip: str | None = None,
) -> DataFrame:
    return (
        events.filter(_synthetic_events_filter(as_of, lookback_minutes, user, src_ip))
        .groupBy(
            first_nonblank(field("scenario"), default="unspecified").alias("scenario"),
            field("status").alias("status"),
        )
        .agg(F.count("*").alias("events"))
        .orderBy("scenario", "status")
    )


# Alert stability checks.

ENTITY_BUCKET = [
    "alert_type", "window_bucket", "entity_user", "entity_src_ip", "entity_host", "source_kind",
]


def _recent(df: DataFrame, as_of: AsOf, lookback_minutes: int | None) -> DataFrame:
    if lookback_minutes is None:
        return df
    return df.filter(within(F.col("ts"), as_of, lookback_minutes))


def alert_totals(
    alerts: DataFrame, as_of: AsOf = None, lookback_minutes: int | None = 60
) -> DataFrame:
    return (
        _recent(alerts, as_of, lookback_minutes)
        .groupBy("alert_type")
        .agg(
            F.count("*").alias("alerts"),
            F.count_distinct("alert_fingerprint").alias("unique_fingerprints"),
        )
        .orderBy("alert_type")
    )


def _duplicates(alerts: DataFrame, keys: list[str]) -> DataFrame:
    return alerts.groupBy(*keys).agg(F.count("*").alias("duplicates")).filter("duplicates > 1")


def duplicate_fingerprints(
    alerts: DataFrame, as_of: AsOf = None, lookback_minutes: int | None = 60
) -> DataFrame:
    found = _duplicates(
        _recent(alerts, as_of, lookback_minutes), ["alert_type", "alert_fingerprint"]
    )
    return found.orderBy(F.col("duplicates").desc(), "alert_type", "alert_fingerprint")


def duplicate_entity_buckets(
    alerts: DataFrame, as_of: AsOf = None, lookback_minutes: int | None = 60
) -> DataFrame:
    found = _duplicates(_recent(alerts, as_of, lookback_minutes), ENTITY_BUCKET)
    return found.orderBy(
        F.col("duplicates").desc(), "alert_type", F.col("window_bucket").desc(),
        "entity_user", "entity_src_ip", "entity_host", "source_kind",
    )


def recent_alert_windows(
    detections: DataFrame, as_of: AsOf = None, lookback_minutes: int | None = 60, limit: int = 20
) -> DataFrame:
    rows = _recent(detections, as_of, lookback_minutes)
    return latest(rows, limit, ALERT_TIEBREAK).select(
        "ts", "alert_type", "window_bucket", "entity_user", "entity_src_ip", "entity_host",
        "attempt_count", "distinct_user_count", "distinct_ip_count", "reason",
    )


def recent_detections(
    detections: DataFrame, as_of: AsOf = None, lookback_minutes: int | None = 60, limit: int = 20,
    rule_id: str | None = None,
) -> DataFrame:
    rows = _recent(detections, as_of, lookback_minutes)
    return latest(rows, limit, ALERT_TIEBREAK, matching(rule_id=rule_id)).select(
        "ts", "alert_type", "alert_fingerprint", "rule_id", "severity", "attempt_count",
        "entity_user", "entity_src_ip", "entity_host", "window_bucket", "distinct_user_count",
        "distinct_ip_count", "source_kind", "reason", "evidence_summary",
    )


# Endpoint checks.


def endpoint_count(
    activity: DataFrame, lane: str | None = None, min_endpoints: int = 0
) -> DataFrame:
    """Observed endpoints, and whether that reaches the expected minimum."""
    rows = activity if lane is None else activity.filter(F.col("lane") == lane)
    return rows.agg(F.count("*").alias("endpoints")).withColumn(
        "ok", F.col("endpoints") >= min_endpoints
    )


def endpoint_report(activity: DataFrame, lane: str | None = None, limit: int = 25) -> DataFrame:
    return latest(
        activity, limit, ("endpoint_id", "lane"), matching(lane=lane), by="last_seen",
        columns=[
            "endpoint_id", "lane", "status", "minutes_since_last_seen", "total_events",
            "first_seen", "last_seen",
        ],
    )


def endpoint_panel(activity: DataFrame, limit: int = 25) -> DataFrame:
    return endpoint_report(activity, None, limit).drop("first_seen")


def windows_lane_count(
    events: DataFrame, as_of: AsOf = None, lookback_minutes: int = 60, min_events: int = 1,
    computer: str | None = None, lane: str = S.LANE_WINDOWS,
) -> DataFrame:
    """Events of the Windows lane in the lookback, its lower end included."""
    where = (F.col("ingest_source") == lane) & within(
        F.col("ts"), as_of, lookback_minutes, inclusive=True
    )
    if computer is not None:
        where = where & (F.lower(field("computer")) == computer.lower())
    return events.filter(where).agg(F.count("*").alias("events")).withColumn(
        "ok", F.col("events") >= min_events
    )


def windows_lane_rows(computer: str | None = None, lane: str = S.LANE_WINDOWS) -> Column:
    where = F.col("ingest_source") == lane
    return where if computer is None else where & (F.lower("host") == computer.lower())


def windows_lane_latest(
    auth: DataFrame, computer: str | None = None, limit: int = 10, lane: str = S.LANE_WINDOWS
) -> DataFrame:
    return latest(auth, limit, EVENT_TIEBREAK, windows_lane_rows(computer, lane)).select(
        "ts", "ingest_source", "host", "user", "src_ip", "status", "raw_event_id", "message"
    )


# Dashboard panels.


def events_per_minute(events: DataFrame) -> DataFrame:
    """Events per minute; minutes without events are not filled in."""
    return (
        events.groupBy(F.date_trunc("MINUTE", "ts").alias("time"))
        .agg(F.count("*").alias("value"))
        .orderBy("time")
    )


def top_ingest_sources(events: DataFrame, limit: int = 10) -> DataFrame:
    return (
        events.groupBy("ingest_source")
        .agg(F.count("*").alias("events"))
        .orderBy(F.col("events").desc(), "ingest_source")
        .limit(limit)
    )


def recent_events(events: DataFrame, limit: int = 100) -> DataFrame:
    return latest(events, limit, EVENT_TIEBREAK).select("ts", "ingest_source", "message")


# Ad-hoc investigation.


def spray_sources(
    auth: DataFrame, lane: str = S.LANE_SYNTHETIC, min_users: int = 3
) -> DataFrame:
    """Sources that failed against several users, whatever the host."""
    return (
        auth.filter((F.col("ingest_source") == lane) & (F.col("status") == S.STATUS_FAILURE))
        .groupBy("src_ip")
        .agg(F.count_distinct("user").alias("targeted_users"), F.count("*").alias("failures"))
        .filter(F.col("targeted_users") >= min_users)
        .orderBy(F.col("failures").desc(), "src_ip")
    )


def investigated(user: str, src_ip: str) -> Column:
    return (F.col("user") == user) | (F.col("src_ip") == src_ip)


def investigate(auth: DataFrame, user: str, src_ip: str, limit: int = 20) -> DataFrame:
    return latest(auth, limit, EVENT_TIEBREAK, investigated(user, src_ip)).select(
        "ts", "ingest_source", "user", "src_ip", "host", "status", "message"
    )


def latest_auth(auth: DataFrame, limit: int = 10, **equal: str | None) -> DataFrame:
    """Latest login events, filtered on any columns (lane, kind, collector, ...)."""
    return latest(auth, limit, EVENT_TIEBREAK, matching(**equal))


def latest_alerts(alerts: DataFrame, limit: int = 20, **equal: str | None) -> DataFrame:
    return latest(alerts, limit, ALERT_TIEBREAK, matching(**equal))


def rule_check_latest(alerts: DataFrame, rule_id: str, limit: int = 10) -> DataFrame:
    return latest_alerts(alerts, limit, rule_id=rule_id).select(*RULE_CHECK_COLUMNS)


def rule_check_columns(alerts: DataFrame) -> DataFrame:
    """Which of the required alert columns exist, with their type."""
    have = dict(alerts.dtypes)
    rows = [(n, have[n]) for n in sorted(RULE_CHECK_COLUMNS) if n in have]
    return alerts.sparkSession.createDataFrame(rows, "name string, type string")


def event_growth(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts of a table before and after a load, and whether it grew."""
    marked = before.select(F.lit(False).alias("new")).unionAll(after.select(F.lit(True).alias("new")))
    counted = marked.agg(
        F.count_if(~F.col("new")).alias("events_before"),
        F.count_if(F.col("new")).alias("events_after"),
    )
    return counted.withColumn("grew", F.col("events_after") > F.col("events_before"))


def ssh_auth_lines(lines: DataFrame, order: str, limit: int) -> DataFrame:
    """The last SSH auth lines of a raw log, in file order."""
    found = lines.filter(F.rlike("value", F.lit(SSH_AUTH_LINE)))
    return found.orderBy(F.col(order).desc()).limit(limit).orderBy(order)



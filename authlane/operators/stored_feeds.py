"""The newest rows of a stored table, without reading its history.

Tables are laid out by day, and every row of a later day is newer than any of an earlier
one. So the newest ``n`` rows lie in the last days that hold ``n`` rows between them. The
walk starts at the newest day and doubles the stretch until it holds enough; a filter that
few rows meet ends with the whole table, as before. Each step counts no more than ``n`` rows,
and there are as many steps as the number of days has binary digits.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from authlane.operators import reports as R
from authlane.operators.views import auth_events
from authlane.sources.readers import scan_alerts, scan_events

Scan = Callable[[SparkSession, str, datetime | None], DataFrame]
Shape = Callable[[DataFrame], DataFrame]


def stored_days(spark: SparkSession, path: str) -> list[datetime]:
    """The days that a table has folders for, newest first; none for other layouts."""
    hadoop = spark._jvm.org.apache.hadoop.fs  # type: ignore[union-attr]
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # type: ignore[union-attr]
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    # Rows without a time are in a folder that is no day; they are the oldest of all.
    days = [n[len("day="):] for n in names if n.startswith("day=") and not n.startswith("day=__")]
    return sorted((datetime.fromisoformat(d).replace(tzinfo=timezone.utc) for d in days), reverse=True)


def newest_since(spark: SparkSession, path: str, scan: Scan, n: int, shaped: Shape) -> datetime | None:
    """The day from which on ``shaped`` keeps at least ``n`` rows; None for the whole table."""
    days, stretch = stored_days(spark, path), 1
    while stretch < len(days):
        since = days[stretch - 1]
        if shaped(scan(spark, path, since)).limit(n).count() >= n:
            return since
        stretch *= 2
    return None


def newest(spark: SparkSession, path: str, scan: Scan, n: int, shaped: Shape = lambda df: df) -> DataFrame:
    """Rows among which are the newest ``n`` that ``shaped``, a view and its filters, keeps."""
    return shaped(scan(spark, path, newest_since(spark, path, scan, n, shaped)))


def alerts_feed(spark: SparkSession, path: str, limit: object = None) -> DataFrame:
    return R.alerts_feed(newest(spark, path, scan_alerts, R.clamp_limit(limit)), limit)


def events_feed(spark: SparkSession, path: str, limit: object = None) -> DataFrame:
    return R.events_feed(newest(spark, path, scan_events, R.clamp_limit(limit), auth_events), limit)


def recent_events(spark: SparkSession, path: str, limit: int = 100) -> DataFrame:
    return R.recent_events(newest(spark, path, scan_events, limit), limit)


def health(spark: SparkSession, path: str, as_of: datetime | None = None) -> DataFrame:
    """``as_of`` without a zone is UTC."""
    since = newest_since(spark, path, scan_events, 1, auth_events)
    if since is not None:
        now = as_of or datetime.now(timezone.utc)
        now = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
        # The rate looks back a minute, which may be older than the newest event.
        since = min(since, now - timedelta(minutes=1))
    return R.health(auth_events(scan_events(spark, path, since)), as_of)


def windows_lane_latest(spark: SparkSession, path: str, computer: str | None = None, limit: int = 10) -> DataFrame:
    where = R.windows_lane_rows(computer)
    rows = newest(spark, path, scan_events, limit, lambda e: auth_events(e).filter(where))
    return R.windows_lane_latest(rows, computer, limit)


def investigate(spark: SparkSession, path: str, user: str, src_ip: str, limit: int = 20) -> DataFrame:
    where = R.investigated(user, src_ip)
    rows = newest(spark, path, scan_events, limit, lambda e: auth_events(e).filter(where))
    return R.investigate(rows, user, src_ip, limit)


def latest_auth(spark: SparkSession, path: str, limit: int = 10, **equal: str | None) -> DataFrame:
    where = R.matching(**equal)
    view = auth_events if where is None else lambda e: auth_events(e).filter(where)
    return R.latest_auth(newest(spark, path, scan_events, limit, view), limit)


def latest_alerts(spark: SparkSession, path: str, limit: int = 20, **equal: str | None) -> DataFrame:
    where = R.matching(**equal)
    kept = (lambda a: a) if where is None else lambda a: a.filter(where)
    return R.latest_alerts(newest(spark, path, scan_alerts, limit, kept), limit)

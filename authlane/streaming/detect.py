"""Streaming detection.

``detection_pass`` is what one poll does: the rule pack over the recent slice of the
events table, new alerts into the alert table. ``detect_on_arrival`` runs it once per
micro-batch of new events, and ``sliding_bursts`` evaluates the mergeable rules as a
windowed aggregation with a watermark.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from authlane.operators import detections as D
from authlane.operators.pack import (
    SqlRule,
    empty_alerts,
    first_per_fingerprint,
    run_pack,
    runnable,
)
from authlane.operators.rules import RuleConfig
from authlane.operators.tables import ALERT_SORT
from authlane.operators.views import auth_events
from authlane.schema import ALERTS
from authlane.sources.readers import scan_alerts, scan_events
from authlane.streaming.ingest import start, write_batch, writer_of


def recorded_alerts(
    spark: SparkSession, path: str, except_batch: int | None = None, writer: str = "direct",
    since: datetime | None = None,
) -> DataFrame:
    """Alerts written so far, or none before the first, in today's schema whatever the age
    and layout of the table. A batch that is run again must not be silenced by its own first
    attempt; batches of other writers count. ``since`` prunes days."""
    own = None if except_batch is None else (writer, except_batch)
    try:
        return scan_alerts(spark, path, since, own)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_alerts(spark)


def detection_pass(
    spark: SparkSession,
    events_path: str,
    alerts_path: str,
    configs: Iterable[RuleConfig],
    as_of: datetime,
    batch_id: int,
    top_n: int | None = 1,
    dedup: str = "ever",
    sql_rules: Iterable[SqlRule] = (),
) -> None:
    """One poll at ``as_of``: reads the days the widest window touches, and no more."""
    configs, sql_rules = runnable(configs), list(sql_rules)
    if not configs and not sql_rules:
        return
    widest = max(c.window_minutes for c in [*configs, *[r.config for r in sql_rules]])
    since = as_of - timedelta(minutes=widest)
    auth = auth_events(scan_events(spark, events_path, since))
    facts = None
    if configs:
        facts = D.login_facts(auth, as_of, [c.window_minutes for c in configs])
        facts = facts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # A cooldown looks back so far; a fingerprint of any age may be repeated otherwise.
        longest = max((c.cooldown_seconds for c in [*configs, *[r.config for r in sql_rules]]), default=0)
        back = as_of - timedelta(seconds=longest) if dedup == "cooldown" else None
        known = recorded_alerts(spark, alerts_path, batch_id, writer_of(auth), back)
        alerts = run_pack(auth, configs, as_of, known, top_n, dedup, sql_rules, facts)
        write_batch(alerts, alerts_path, batch_id, ALERT_SORT)
    finally:
        if facts is not None:
            facts.unpersist()


def detect_on_arrival(
    events: DataFrame,
    events_path: str,
    alerts_path: str,
    configs: Iterable[RuleConfig],
    checkpoint: str | None = None,
    as_of: datetime | None = None,
    top_n: int | None = 1,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run a detection pass per micro-batch of the events stream.

    The rules read the table, not the micro-batch, so an event that arrives late still
    counts while its time is inside the window. ``as_of`` fixes the clock for tests.
    """
    configs = list(configs)

    def run(batch: DataFrame, batch_id: int) -> None:
        now = as_of or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        detection_pass(
            batch.sparkSession, events_path, alerts_path, configs, now, batch_id, top_n
        )

    return start(events, run, "detect", checkpoint, trigger or {"processingTime": "30 seconds"})


def sliding_bursts(
    auth: DataFrame, window_minutes: int, slide_seconds: int, delay: str
) -> DataFrame:
    """Streaming login facts per entity and sliding window (T - window, T].

    The one-millisecond offset makes the windows open below and closed above at
    millisecond precision. State per entity and window is two counts and three times, so
    it does not grow with the entity's events. The burst and failed-then-success rules
    apply to these facts as they stand (``apply_rule``).
    """
    span = F.window(
        "ts", f"{window_minutes} minutes", f"{slide_seconds} seconds", "1 millisecond"
    )
    rows = D.login_rows(auth.withWatermark("ts", delay))
    return rows.groupBy(span.alias("span"), *D.ENTITY).agg(*D.fact_measures())


# The rules whose streamed facts need no further aggregation.
MERGEABLE = ("security_failed_login_burst", "security_failed_then_success")


def apply_rule(facts: DataFrame, config: RuleConfig) -> DataFrame:
    """Rule results of streamed facts, evaluated at each window's end."""
    if config.id not in MERGEABLE:
        raise ValueError(f"rule {config.id} cannot run on streamed facts")
    at = F.col("span.end") - F.expr("INTERVAL '0.001' SECOND")
    ready = facts.withColumn("evaluated_at", at).withColumn(
        "window_minutes", F.lit(config.window_minutes)
    )
    return D.evaluate(ready.select(*D.FACT_KEYS, *D.MEASURES), config)


def alert_stream(
    alerts: DataFrame, alerts_path: str, checkpoint: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Write streamed alert rows, leaving out fingerprints recorded before."""

    def store(batch: DataFrame, batch_id: int) -> None:
        known = recorded_alerts(batch.sparkSession, alerts_path, batch_id, writer_of(batch))
        fresh = first_per_fingerprint(batch).join(
            known.select("alert_fingerprint"), "alert_fingerprint", "left_anti"
        )
        write_batch(fresh.select(*ALERTS.names), alerts_path, batch_id, ALERT_SORT)

    return start(alerts, store, "alerts", checkpoint, trigger, mode="update")


def within_cooldown_once(alerts: DataFrame, cooldown_seconds: int) -> DataFrame:
    """Streamed alerts with repeats of a fingerprint dropped for at least the cooldown."""
    if cooldown_seconds <= 0:
        return alerts
    return alerts.withWatermark("ts", f"{cooldown_seconds} seconds").dropDuplicatesWithinWatermark(
        ["alert_fingerprint"]
    )



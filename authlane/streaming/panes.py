"""Continuous detection of every rule from a store of panes.

Micro-batches of login events are combined into panes, and each batch appends the panes it
has, as a share that adds up with others. That is the state of all rules: an entity's counts
and times, and with them every member of a source, an account or an endpoint. A late event
adds to an old pane; a batch that runs again replaces its own share. Detection reads panes
and never the events again, so a pass costs what the window holds in entities and panes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from authlane.functions.times import to_micros, utc_day
from authlane.operators.detections import ENTITY, MEASURES
from authlane.operators.pack import (
    candidates,
    empty_alerts,
    first_per_fingerprint,
    outside_cooldown,
    replayed,
    runnable,
    unrecorded,
)
from authlane.operators.panes import Ticks, login_panes, merged_panes, pane_facts
from authlane.operators.rules import RuleConfig
from authlane.operators.tables import ALERT_SORT
from authlane.streaming.detect import recorded_alerts
from authlane.streaming.ingest import start, write_batch, writer_of

PANES = T.StructType(
    [T.StructField("ts", T.TimestampType()), T.StructField("pane", T.LongType())]
    + [T.StructField(c, T.BooleanType() if c == "windows_lane" else T.StringType()) for c in ENTITY]
    + [T.StructField(c, T.LongType() if c == "failures" else T.TimestampType()) for c in MEASURES]
)
PROGRESS = "newest bigint, evaluated bigint"


@dataclass(frozen=True)
class PaneStore:
    """Panes of ``seconds`` below ``path``. Windows, slides and instants are multiples of it."""

    spark: SparkSession
    path: str
    seconds: int = 10

    @property
    def unit(self) -> int:
        return self.seconds * 1_000_000

    @property
    def table(self) -> str:
        return f"{self.path}/panes-{self.seconds}s"

    def add(self, auth: DataFrame, batch_id: int, writer: str = "direct") -> None:
        """Append a batch's share of the panes, or replace what an earlier attempt left of it."""
        panes = login_panes(auth, self.unit)
        placed = panes.withColumn("ts", F.timestamp_micros(F.col("pane") * F.lit(self.unit)))
        write_batch(placed.select(*PANES.names), self.table, batch_id, ("pane",), writer)

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(PANES).parquet(self.table)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def panes(self, lowest: int) -> DataFrame:
        """All panes from number ``lowest`` on, one row per pane and entity; whole days
        before it are not read."""
        stored = self._stored()
        if stored is None:
            return self.spark.createDataFrame([], PANES).drop("ts")
        if "day" in stored.columns:
            day = utc_day(datetime(1970, 1, 1) + timedelta(microseconds=lowest * self.unit))
            stored = stored.filter(F.col("day") >= F.lit(day).cast("date"))
        return merged_panes(stored.filter(F.col("pane") >= lowest))

    def reach(self, batch_id: int, writer: str) -> tuple[int, int] | None:
        """The first and last pane that a batch added to; None if it had no login events."""
        stored = self._stored()
        if stored is None or "writer" not in stored.columns:
            return None
        own = stored.filter((F.col("writer") == f"w-{writer}") & (F.col("batch_id") == batch_id))
        row = own.agg(F.min("pane").alias("low"), F.max("pane").alias("high")).first()
        return None if row.low is None else (row.low, row.high)

    def _progress(self, batch_id: int, writer: str) -> str:
        return f"{self.path}/progress-{self.seconds}s/w-{writer}/{batch_id}"

    def progress(self, batch_id: int, writer: str) -> tuple[int, int] | None:
        """(newest pane, last tick) as of a finished batch of the writer."""
        try:
            row = self.spark.read.schema(PROGRESS).parquet(self._progress(batch_id, writer)).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if row is None else (row.newest, row.evaluated)

    def finish(self, batch_id: int, writer: str, newest: int, evaluated: int) -> None:
        row = self.spark.createDataFrame([(newest, evaluated)], PROGRESS).coalesce(1)
        row.write.mode("overwrite").parquet(self._progress(batch_id, writer))


def pass_over_panes(
    store: PaneStore, alerts_path: str, configs: Iterable[RuleConfig], as_of: datetime, batch_id: int,
    top_n: int | None = 1, dedup: str = "ever", writer: str = "direct",
) -> None:
    """One poll at ``as_of``, a multiple of the store's unit: as ``detection_pass`` does over events."""
    configs = runnable(configs)
    if not configs:
        return
    if dedup not in ("ever", "cooldown"):
        raise ValueError("dedup must be 'ever' or 'cooldown'")
    facts = pane_facts(store_panes_at(store, configs, as_of), [c.window_minutes for c in configs], as_of, store.unit)
    alerts = first_per_fingerprint(candidates(facts, configs, top_n))
    known = recorded_alerts(store.spark, alerts_path, batch_id, writer)
    if dedup == "cooldown":
        fresh = outside_cooldown(alerts, known, {c.id: c.cooldown_seconds for c in configs}, as_of)
    else:
        fresh = unrecorded(alerts, known)
    write_batch(fresh, alerts_path, batch_id, ALERT_SORT, writer)


def store_panes_at(store: PaneStore, configs: Iterable[RuleConfig], as_of: datetime) -> DataFrame:
    """The panes that the widest window holds at an instant, and those after it."""
    at = to_micros(as_of)
    if at % store.unit:
        raise ValueError(f"{as_of} is not a multiple of {store.seconds} seconds")
    widest = max(c.window_minutes for c in configs) * 60_000_000
    return store.panes((at - widest) // store.unit + 1)


def detect_sliding(
    auth: DataFrame, store: PaneStore, alerts_path: str, configs: Iterable[RuleConfig], slide_seconds: int,
    checkpoint: str | None = None, delay_seconds: int = 0, top_n: int | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """All built-in rules at every tick of the event time of a stream of login events.

    A tick is evaluated when an event is ``delay_seconds`` beyond it, in the batch that
    brings that event. Events out of order by less give the alerts of a replay of all. An
    event that comes later adds to its old pane, and the ticks whose windows hold it are
    evaluated again: alerts that it completes are added, and recorded ones stay as they are.
    Several streams may add to one store; each evaluates its own ticks over all panes.
    """
    configs = runnable(configs)
    windows = [c.window_minutes for c in configs]
    step = Ticks.between(windows, slide_seconds, datetime(1970, 1, 1), datetime(1970, 1, 1), store.unit).step

    def run(batch: DataFrame, batch_id: int) -> None:
        writer = writer_of(batch)
        store.add(batch, batch_id, writer)
        before = store.progress(batch_id - 1, writer)
        reach = store.reach(batch_id, writer)
        if reach is None:
            alerts = empty_alerts(store.spark)
            newest, last = before or (None, None)
        else:
            newest = reach[1] if before is None else max(before[0], reach[1])
            last = (newest - delay_seconds * 1_000_000 // store.unit) // step * step
            first = -(-reach[0] // step) * step
            if before is not None:
                last, first = max(last, before[1]), min(first, before[1] + step)
            ticks = Ticks(store.unit, step, first, last)
            alerts = empty_alerts(store.spark)
            if first <= last:
                panes = store.panes(ticks.lowest(max(windows)))
                found = first_per_fingerprint(replayed(panes, configs, ticks, top_n))
                alerts = unrecorded(found, recorded_alerts(store.spark, alerts_path, batch_id, writer))
            last = max(last, first - step)
        write_batch(alerts, alerts_path, batch_id, ALERT_SORT, writer)
        if newest is not None:
            store.finish(batch_id, writer, newest, last)

    return start(auth, run, "sliding", checkpoint, trigger)

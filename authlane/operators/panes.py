"""Panes: login events combined per entity and unit of time, and facts of ticks from them.

Panes merge: those combined apart, or later, add up to the same as all events at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane.functions.times import as_of_col, to_micros
from authlane.operators.detections import (
    ENTITY,
    FACT_KEYS,
    MEASURES,
    MERGES,
    aggregates,
    fact_measures,
    login_rows,
    shared_plan,
)


@dataclass(frozen=True)
class Ticks:
    """The evaluation instants: multiples of ``step`` units from ``first`` to ``last``; a unit has ``unit`` microseconds."""

    unit: int
    step: int
    first: int
    last: int

    @classmethod
    def between(cls, windows: Iterable[int], slide_seconds: int, start: datetime, end: datetime, unit: int | None = None) -> Ticks:
        """Every multiple of the slide from ``start`` to ``end``, in the coarsest unit that
        divides slide and windows, or a given one that does."""
        slide = slide_seconds * 1_000_000
        lengths = [w * 60_000_000 for w in windows]
        unit = unit or gcd(slide, *lengths)
        if any(x % unit for x in (slide, *lengths)):
            raise ValueError(f"panes of {unit} microseconds do not divide the slide and the windows")
        step = slide // unit
        return cls(unit, step, -(-to_micros(start) // slide) * step, to_micros(end) // slide * step)

    def length(self, minutes: int) -> int:
        return minutes * 60_000_000 // self.unit

    def lowest(self, minutes: int) -> int:
        """The first pane that any tick's window holds."""
        return self.first - self.length(minutes) + 1


def login_panes(auth: DataFrame, unit: int) -> DataFrame:
    """(pane, entity, measures): login events per entity and unit of time. Pane n holds what
    is after n - 1 units and not after n."""
    micros = F.unix_micros("ts")
    pane = ((micros + F.pmod(-micros, F.lit(unit))) / F.lit(unit)).cast("bigint")
    return login_rows(auth).withColumn("pane", pane).groupBy("pane", *ENTITY).agg(*fact_measures())


def merged_panes(panes: DataFrame) -> DataFrame:
    """One row per pane and entity of panes that were combined apart."""
    return panes.groupBy("pane", *ENTITY).agg(*aggregates(MERGES))


def panes_between(auth: DataFrame, windows: Iterable[int], ticks: Ticks) -> DataFrame:
    """The panes of all events that a window of these lengths holds at some tick."""
    low = F.timestamp_micros(F.lit((ticks.lowest(max(windows)) - 1) * ticks.unit).cast("bigint"))
    high = F.timestamp_micros(F.lit(ticks.last * ticks.unit).cast("bigint"))
    return login_panes(auth.filter((F.col("ts") > low) & (F.col("ts") <= high)), ticks.unit)


def tick_facts(panes: DataFrame, windows: Iterable[int], ticks: Ticks) -> DataFrame:
    """Login facts at every tick, from panes copied to the ticks they serve, for windows of
    few ticks. A tick T covers (T - window, T]. Rules that read the facts share their exchange."""
    step = ticks.step

    def served(minutes: int) -> Column:
        pane = F.col("pane")
        first = F.greatest(pane + F.pmod(-pane, F.lit(step)), F.lit(ticks.first))
        last = F.least(pane + F.lit(ticks.length(minutes) - 1), F.lit(ticks.last))
        at = F.when(first <= last, F.sequence(first, last, F.lit(step).cast("bigint")))
        return F.transform(
            F.coalesce(at, F.array().cast("array<bigint>")),
            lambda t: F.struct(F.lit(minutes).alias("window_minutes"), t.alias("tick")),
        )

    copies = panes.withColumn("at", F.explode(F.concat(*[served(w) for w in sorted(set(windows))])))
    return shared_plan(
        copies.withColumn("window_minutes", F.col("at.window_minutes"))
        .withColumn("evaluated_at", F.timestamp_micros(F.col("at.tick") * F.lit(ticks.unit)))
        .groupBy(*FACT_KEYS)
        .agg(*aggregates(MERGES))
        .select(*FACT_KEYS, *MEASURES)
    )


def pane_facts(panes: DataFrame, windows: Iterable[int], as_of: datetime, unit: int) -> DataFrame:
    """Login facts at one instant, a multiple of ``unit``, as ``login_facts`` gives them from
    events: a window has no upper end."""
    now = to_micros(as_of) // unit
    held = [F.when(F.col("pane") > now - w * 60_000_000 // unit, F.lit(w)) for w in sorted(set(windows))]
    copies = panes.withColumn("window_minutes", F.explode(F.array_compact(F.array(*held))))
    facts = copies.withColumn("evaluated_at", as_of_col(as_of)).groupBy(*FACT_KEYS).agg(*aggregates(MERGES))
    return shared_plan(facts.select(*FACT_KEYS, *MEASURES))


def replay_facts(
    auth: DataFrame, windows: Iterable[int], slide_seconds: int, start: datetime, end: datetime
) -> DataFrame:
    """Login facts at every multiple of ``slide_seconds`` from ``start`` to ``end``."""
    windows = list(windows)
    ticks = Ticks.between(windows, slide_seconds, start, end)
    return tick_facts(panes_between(auth, windows, ticks), windows, ticks)

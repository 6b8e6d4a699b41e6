"""Sliding detection: every tick of a replay from changes alone.

Login events are combined into *panes*, units of time that divide the slide and the
windows. A pane is served by a run of ticks: it enters at the first and leaves after the
last. No pane is copied to the ticks between. What a window holds is a running sum over
those changes: counts enter with plus and leave with minus; the latest time is the largest
that entered, and the earliest time the least that has yet to leave, as panes leave in the
order they came. A member of a group counts from the first tick it is seen to the last, so
exact distinct counts are running sums as well, and a group's rows are its changes, not its
members times its ticks. Between two changes all stays as it is; only where the top groups
of each tick are asked for are the states that qualify repeated for their ticks.

Samples of names are looked up last, for the ticks that are reported; the Windows rule,
whose alerts go by a name, looks them up for the changes that qualify.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from authlane.operators import detections as D
from authlane.operators.intervals import points_in_intervals
from authlane.operators.panes import Ticks
from authlane.operators.rules import RuleConfig, meets_threshold, suppress
from authlane.settings import KIND_LINUX

def _served(panes: DataFrame, minutes: int, ticks: Ticks) -> DataFrame:
    """Panes with the tick at which they enter and the one at which they have left."""
    step, length = ticks.step, ticks.length(minutes)
    enters = f"greatest(pane + pmod(-pane, {step}L), {ticks.first}L)"
    last = f"pane + {length - 1}L"
    leaves = f"{last} - pmod({last}, {step}L) + {step}L"
    return panes.selectExpr("*", f"{enters} AS enters", f"{leaves} AS leaves").where(
        f"enters < leaves AND enters <= {ticks.last}"
    )


def _changes(served: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, tick, changes): what enters and leaves the window of each key."""
    enter = (
        "named_struct('tick', enters, 'members', 0L, 'failures', failures, 'successes', if(first_success IS NULL, 0L, 1L), "
        "'last_failure', last_failure, 'first_failure', CAST(NULL AS TIMESTAMP), 'first_success', CAST(NULL AS TIMESTAMP))"
    )
    leave = (
        "named_struct('tick', leaves, 'members', 0L, 'failures', -failures, 'successes', -if(first_success IS NULL, 0L, 1L), "
        "'last_failure', CAST(NULL AS TIMESTAMP), 'first_failure', first_failure, 'first_success', first_success)"
    )
    return served.selectExpr(*keys, f"inline(array({enter}, {leave}))")


def _member_changes(served: DataFrame, group: Sequence[str], member: str) -> DataFrame:
    """Changes of ``members``: +1 where a member comes into the window, -1 when it has left.

    ``served`` has one row per pane, group and member. Panes of a member follow each other,
    so it stays in the window while the next one enters before the last has left.
    """
    order = Window.partitionBy(*group, member).orderBy("enters", "pane")
    runs = served.withColumns({"before": F.lag("leaves").over(order), "after": F.lead("enters").over(order)})
    empty = "'failures', 0L, 'successes', 0L, 'last_failure', CAST(NULL AS TIMESTAMP), 'first_failure', CAST(NULL AS TIMESTAMP), 'first_success', CAST(NULL AS TIMESTAMP)"
    come = f"if(before IS NULL OR enters > before, named_struct('tick', enters, 'members', 1L, {empty}), NULL)"
    gone = f"if(after IS NULL OR after > leaves, named_struct('tick', leaves, 'members', -1L, {empty}), NULL)"
    return runs.selectExpr(*group, f"inline(array_compact(array({come}, {gone})))")


def _states(changes: DataFrame, keys: Sequence[str], ticks: Ticks) -> DataFrame:
    """(keys, tick, until, state): what the window holds at the ticks from ``tick`` to before ``until``."""
    each = changes.groupBy(*keys, "tick").agg(
        *[F.sum(c).alias(c) for c in ("members", "failures", "successes")],
        F.max("last_failure").alias("last_failure"),
        F.min("first_failure").alias("first_failure"),
        F.min("first_success").alias("first_success"),
    )
    past = Window.partitionBy(*keys).orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    # What comes after in time comes before in this order.
    future = Window.partitionBy(*keys).orderBy(F.desc("tick")).rowsBetween(Window.unboundedPreceding, -1)
    running = each.select(
        *keys, "tick",
        *[F.sum(c).over(past).alias(c) for c in ("members", "failures", "successes")],
        F.max("last_failure").over(past).alias("last_failure"),
        F.lead("tick").over(Window.partitionBy(*keys).orderBy("tick")).alias("until"),
        *[F.min(c).over(future).alias(c) for c in ("first_failure", "first_success")],
    )
    end = ticks.last + ticks.step
    holds = running.where(f"(failures > 0 OR successes > 0) AND tick <= {ticks.last}")
    return holds.selectExpr(
        *keys, "tick", f"least(ifnull(until, {end}L), {end}L) AS until", "members", "failures",
        "if(failures > 0, first_failure, NULL) AS first_failure", "if(failures > 0, last_failure, NULL) AS last_failure",
        "if(successes > 0, first_success, NULL) AS first_success",
    )


def _at_ticks(states: DataFrame, config: RuleConfig, ticks: Ticks, every: bool) -> DataFrame:
    """States as facts of instants: of every tick, or of the first that has the state."""
    if every:
        states = states.withColumn("tick", F.explode(F.expr(f"sequence(tick, until - {ticks.step}L, {ticks.step}L)")))
    return states.withColumns(
        {"window_minutes": F.lit(config.window_minutes), "evaluated_at": F.timestamp_micros(F.col("tick") * F.lit(ticks.unit))}
    )


def _reported(result: DataFrame, config: RuleConfig, top_n: int | None) -> DataFrame:
    """What a replay reports: the top groups of each tick that meet the threshold."""
    return D.top_groups(result, config.id, top_n, per_tick=True).filter(
        meets_threshold(F.col("hits"), config.threshold_op, config.threshold_value)
    )


def _first_of_bucket(rows: DataFrame, group: Sequence[str], config: RuleConfig) -> DataFrame:
    """Of each group and window bucket the first tick: later ones repeat its alert."""
    bucket = D.sql_bucket_start("last_failure", config.window_minutes)
    order = Window.partitionBy(*group, "_bucket").orderBy("tick")
    ranked = rows.withColumn("_bucket", F.expr(bucket)).withColumn("_nth", F.row_number().over(order))
    return ranked.where("_nth = 1").drop("_nth", "_bucket")


Shown = Callable[[DataFrame, RuleConfig], DataFrame]


def _winners(rows: DataFrame, group: Sequence[str], show: Shown, config: RuleConfig, top_n: int | None) -> DataFrame:
    """The rows to report, chosen before the sample is known: nothing ranks by it."""
    keyed = rows.withColumns({"_row": F.struct(*rows.columns), "sample": F.lit("")})
    shown = show(keyed, config, keep=("_row",))
    return _first_of_bucket(_reported(shown, config, top_n).select("_row.*"), group, config)


def _members_rule(panes: DataFrame, config: RuleConfig, ticks: Ticks, top_n: int | None, group: list[str], member: str, having: str, show: Shown) -> DataFrame:
    rows = suppress(D._failed_outside_windows(panes), config, "host", "user")
    served = _served(rows, config.window_minutes, ticks)
    changes = _changes(served, group).unionByName(_member_changes(served, group, member))
    states = _states(changes, group, ticks).where(having)
    won = _winners(_at_ticks(states, config, ticks, top_n is not None), group, show, config, top_n)
    seen = points_in_intervals(
        won.select(*group, "tick"), served.select(*group, member, "enters", "leaves"), group, "tick", "enters", "leaves",
        max(ticks.step, ticks.length(config.window_minutes)),
    )
    sample = D.first_members(seen.select(*group, "tick", member).distinct(), [*group, "tick"], member)
    return show(won.join(sample, [*group, "tick"]), config)


def _windows_rule(panes: DataFrame, config: RuleConfig, ticks: Ticks, top_n: int | None) -> DataFrame:
    group = ["endpoint"]
    rows = D.windows_rows(panes, config)
    served = _served(rows, config.window_minutes, ticks)
    base = _changes(served, group).withColumn("kind", F.lit(""))
    for member in ("user", "src_ip"):
        own = served.where(f"{member} <> ''").select(*group, member, "pane", "enters", "leaves").distinct()
        base = base.unionByName(_member_changes(own, group, member).withColumn("kind", F.lit(member)))
    marked = base.withColumns({"users": F.expr("if(kind = 'user', members, 0L)"), "sources": F.expr("if(kind = 'src_ip', members, 0L)")})
    # One running sum serves both counts: sources in the upper half of the number.
    packed = marked.withColumn("members", F.expr("users + sources * 4294967296L")).drop("kind", "users", "sources")
    states = _states(packed, group, ticks).where("failures > 0")
    states = states.withColumns({"users": F.expr("members % 4294967296L"), "sources": F.expr("members DIV 4294967296L")})
    if config.threshold_op in ("gte", "gt"):
        # More hits rank first, so what stays below is not reported either way.
        states = states.where(meets_threshold(F.col("failures"), config.threshold_op, config.threshold_value))
    names = ("sample_user", "sample_source_ip", "sample_logon_type")
    seen = points_in_intervals(
        states.select(*group, "tick"), served.select(*group, "user", "src_ip", "logon_type", "enters", "leaves"), group, "tick", "enters", "leaves",
        max(ticks.step, ticks.length(config.window_minutes)),
    )
    least = seen.groupBy(*group, "tick").agg(
        *[F.expr(f"ifnull(min(nullif({c}, '')), '') AS {name}") for c, name in zip(("user", "src_ip", "logon_type"), names)]
    )
    # Names are part of an alert's fingerprint and of the order among equals: they come first.
    found = _at_ticks(states.join(least, [*group, "tick"]), config, ticks, top_n is not None)
    return _reported(D.windows_result(found, config), config, top_n)


def _entity_rule(panes: DataFrame, config: RuleConfig, ticks: Ticks, top_n: int | None, where: str) -> DataFrame:
    """Rules on one entity: facts of the ticks at which its window changes, or of all."""
    served = _served(panes.where(where), config.window_minutes, ticks)
    # Dealt by entity once: changes, running sums and facts all stay there.
    dealt = served.repartition(*D.ENTITY)
    states = _states(_changes(dealt, D.ENTITY), D.ENTITY, ticks)
    facts = _at_ticks(states, config, ticks, top_n is not None).select(*D.FACT_KEYS, *D.MEASURES)
    return _reported(D.BUILTIN_RULES[config.id](facts, config), config, top_n)


NAMED = "NOT windows_lane AND user <> '' AND src_ip <> ''"


def slide(panes: DataFrame, config: RuleConfig, ticks: Ticks, top_n: int | None = None) -> DataFrame:
    """A built-in rule at every tick over panes (one row per pane and entity).

    With ``top_n`` the first groups of each tick; without, of each state of a group its
    first tick. Either way the first row of a fingerprint is that of evaluating all ticks.
    """
    if config.id == "security_failed_login_burst":
        return _entity_rule(panes, config, ticks, top_n, f"{NAMED} AND failures > 0 AND source_kind = '{KIND_LINUX}'")
    if config.id == "security_failed_then_success":
        return _entity_rule(panes, config, ticks, top_n, NAMED)
    if config.id == "security_source_multi_user_burst":
        return _members_rule(panes, config, ticks, top_n, D.SPRAY_GROUP, D.SPRAY_MEMBER, D.spray_having(config), D.spray_result)
    if config.id == "security_user_multi_source_burst":
        return _members_rule(
            panes, config, ticks, top_n, D.DISTRIBUTED_GROUP, D.DISTRIBUTED_MEMBER, D.distributed_having(config), D.distributed_result
        )
    return _windows_rule(panes, config, ticks, top_n)

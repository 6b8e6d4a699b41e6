"""Rule pack execution: results to alert rows, fingerprints, dedup and cooldown."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from authlane.functions.text import sql_text
from authlane.functions.times import AsOf, as_of_col, before, to_micros
from authlane.operators.detections import (
    BUILTIN_RULES,
    evaluate,
    login_facts,
    shared_plan,
    top_groups,
)
from authlane.operators.panes import Ticks, panes_between, tick_facts
from authlane.operators.rules import RuleConfig, meets_threshold, suppress
from authlane.operators.sliding import slide
from authlane.schema import ALERTS, RULE_RESULT
from authlane.settings import DEFAULT_SETTINGS, Settings

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# Stock text of a result that explains nothing.
NO_EVIDENCE_TEXT = "No additional evidence summary provided"


@dataclass(frozen=True)
class SqlRule:
    """A user-written rule: Spark SQL over ``{auth_events}`` that returns the 13 result
    columns by name. Parameters are bound as ``:as_of`` (the evaluation instant), ``:window_minutes``, ``:threshold_attempts``, ``:threshold_distinct_users``, ``:threshold_distinct_ips``
    and ``:threshold_failures``."""

    config: RuleConfig
    sql: str


def fingerprint_sql(alert_type: str) -> str:
    """Sameness of an alert: type, entities, kind and window bucket. ``alert_type`` is SQL."""
    parts = ["principal", "source_ip", "endpoint_id", "source_kind"]
    texts = [alert_type, *[f"ifnull({p}, '')" for p in parts]]
    return f"concat_ws('|', {', '.join(texts)}, date_format(window_bucket, 'yyyy-MM-dd HH:mm:ss'))"


def result_defaults(result: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """Fill what a rule left blank: times, counts and stock texts."""
    stock = sql_text(settings.trigger_text)
    filled = {name: f"ifnull({name}, '')" for name in RULE_RESULT.names} | {
        "hits": "hits",
        "window_start": "ifnull(window_start, evaluated_at)",
        "window_end": "ifnull(window_end, evaluated_at)",
        "window_bucket": "coalesce(window_bucket, window_end, evaluated_at)",
        "distinct_user_count": "ifnull(distinct_user_count, 0L)",
        "distinct_ip_count": "ifnull(distinct_ip_count, 0L)",
        "reason": f"ifnull(nullif(reason, ''), {stock})",
        "evidence_summary": f"ifnull(nullif(evidence_summary, ''), {sql_text(NO_EVIDENCE_TEXT)})",
        "details": f"ifnull(nullif(details, ''), {stock})",
    }
    return result.selectExpr(*[f"{sql} AS {name}" for name, sql in filled.items()], "evaluated_at")


def alert_rows(
    result: DataFrame, config: RuleConfig, query: str, settings: Settings = DEFAULT_SETTINGS
) -> DataFrame:
    """Rule results as alert rows; entity and seen columns repeat their twins."""
    out = {
        "ts": "evaluated_at",
        "rule_id": sql_text(config.id),
        "rule_name": sql_text(config.name),
        "alert_type": sql_text(config.alert_type),
        "alert_fingerprint": fingerprint_sql(sql_text(config.alert_type)),
        "severity": sql_text(config.severity),
        "attempt_count": "hits",
        "entity_user": "principal",
        "entity_src_ip": "source_ip",
        "entity_host": "endpoint_id",
        "first_seen_ts": "window_start",
        "last_seen_ts": "window_end",
        "workflow_state": "'new'",
        "threshold_op": sql_text(config.threshold_op),
        "threshold_value": f"{config.threshold_value}L",
        "query": sql_text(query),
    }
    return result_defaults(result, settings).selectExpr(
        *[f"{out.get(name, name)} AS {name}" for name in ALERTS.names]
    )


def bound_instant(spark: SparkSession, as_of: AsOf) -> datetime:
    """The instant as a parameter value. A Column must not depend on rows; it and the clock
    are read once, so that the rule's text and its result see the same instant."""
    if not isinstance(as_of, datetime):
        micros = F.unix_micros(as_of_col(as_of).cast("timestamp"))
        return EPOCH + timedelta(microseconds=spark.range(1).select(micros).first()[0])
    return EPOCH + timedelta(microseconds=to_micros(as_of))


def run_sql_rule(auth: DataFrame, rule: SqlRule, as_of: AsOf, top_n: int | None) -> DataFrame:
    """Evaluate a user rule. Suppression applies to its input, whatever the SQL says."""
    config = rule.config
    now = bound_instant(auth.sparkSession, as_of)
    result = auth.sparkSession.sql(
        rule.sql.strip().rstrip(";"),
        args={
            "as_of": now,
            "window_minutes": config.window_minutes,
            "threshold_attempts": config.threshold_attempts,
            "threshold_distinct_users": config.threshold_distinct_users,
            "threshold_distinct_ips": config.threshold_distinct_ips,
            "threshold_failures": config.threshold_failures,
        },
        auth_events=suppress(auth, config, "host", "user"),
    )
    missing = [n for n in RULE_RESULT.names if n not in result.columns]
    if missing:
        raise ValueError(f"rule {config.id} does not return: {', '.join(missing)}")
    named = result.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RULE_RESULT],
        as_of_col(now).alias("evaluated_at"),
    )
    return top_groups(named, config.id, top_n).filter(
        meets_threshold(F.col("hits"), config.threshold_op, config.threshold_value)
    )


def runnable(configs: Iterable[RuleConfig]) -> list[RuleConfig]:
    """Configs that belong to a built-in rule."""
    return [c for c in configs if c.id in BUILTIN_RULES]


def candidates(
    facts: DataFrame,
    configs: Iterable[RuleConfig],
    top_n: int | None = 1,
    per_tick: bool = False,
    settings: Settings = DEFAULT_SETTINGS,
) -> DataFrame:
    """Alert rows of every built-in rule over shared facts, before any dedup."""
    out: DataFrame | None = None
    for config in configs:
        found = evaluate(facts, config, top_n, per_tick)
        rows = alert_rows(found, config, config.parameter_text, settings)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no rule to run")
    return out


def first_per_fingerprint(alerts: DataFrame) -> DataFrame:
    """Keep the earliest alert of a fingerprint: later evaluations of the same bucket
    do not update it."""
    rank = F.row_number().over(
        Window.partitionBy("alert_fingerprint").orderBy("ts", "rule_id")
    )
    return alerts.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def unrecorded(alerts: DataFrame, recorded: DataFrame, since: Column | None = None) -> DataFrame:
    """Alerts whose fingerprint no recorded alert has, at any age.

    A fingerprint contains its window bucket, so recorded alerts of buckets before
    ``since`` cannot match anything newer and need not be read.
    """
    known = recorded if since is None else recorded.filter(F.col("window_bucket") >= since)
    return alerts.join(known.select("alert_fingerprint"), "alert_fingerprint", "left_anti").select(
        *ALERTS.names
    )


def outside_cooldown(
    alerts: DataFrame, recorded: DataFrame, cooldown_seconds: Mapping[str, int], as_of: AsOf
) -> DataFrame:
    """Alerts whose fingerprint was not recorded within the rule's cooldown. A rule with
    no cooldown, or zero, always passes."""
    longest = max(cooldown_seconds.values(), default=0)
    if longest <= 0:
        return alerts
    known = recorded.filter(F.col("ts") > before(as_of, seconds=longest)).select(
        F.col("alert_fingerprint").alias("_fingerprint"), F.col("ts").alias("_ts")
    )
    cooldown = F.lit(0)
    for rule_id, seconds in cooldown_seconds.items():
        cooldown = F.when(F.col("rule_id") == rule_id, seconds).otherwise(cooldown)
    recent = F.col("_ts") > as_of_col(as_of) - F.make_dt_interval(secs=cooldown)
    return alerts.join(
        known, (F.col("alert_fingerprint") == F.col("_fingerprint")) & (cooldown > 0) & recent,
        "left_anti",
    )


def run_pack(
    auth: DataFrame,
    configs: Iterable[RuleConfig],
    as_of: AsOf = None,
    recorded: DataFrame | None = None,
    top_n: int | None = 1,
    dedup: str = "ever",
    sql_rules: Iterable[SqlRule] = (),
    facts: DataFrame | None = None,
    settings: Settings = DEFAULT_SETTINGS,
) -> DataFrame:
    """One detection pass: every rule's new alerts in one DataFrame.

    ``dedup`` is 'ever' (never repeat a recorded fingerprint) or 'cooldown' (not within
    the rule's cooldown). A job passes persisted ``facts`` so that the rules share them.
    A config that no built-in rule goes by is left out; with no rule there is no alert.
    """
    configs, sql_rules = runnable(configs), list(sql_rules)
    parts: list[DataFrame] = []
    if configs:
        if facts is None:
            facts = login_facts(auth, as_of, [c.window_minutes for c in configs])
        parts.append(candidates(facts, configs, top_n, settings=settings))
    for rule in sql_rules:
        found = run_sql_rule(auth, rule, as_of, top_n)
        parts.append(alert_rows(found, rule.config, " ".join(rule.sql.split()), settings))
    if not parts:
        return empty_alerts(auth.sparkSession)
    alerts = parts[0]
    for more in parts[1:]:
        alerts = alerts.unionByName(more)
    alerts = first_per_fingerprint(alerts)
    if recorded is None:
        return alerts
    everyone = [*configs, *[r.config for r in sql_rules]]
    if dedup == "cooldown":
        return outside_cooldown(
            alerts, recorded, {c.id: c.cooldown_seconds for c in everyone}, as_of
        )
    if dedup != "ever":
        raise ValueError("dedup must be 'ever' or 'cooldown'")
    # A built-in window end lies inside the window, so its bucket starts at most one more
    # window before that. A user rule may return any bucket.
    reach = 2 * max(c.window_minutes for c in everyone)
    return unrecorded(alerts, recorded, None if sql_rules else before(as_of, minutes=reach))


def replay(
    auth: DataFrame,
    configs: Iterable[RuleConfig],
    slide_seconds: int,
    start: datetime,
    end: datetime,
    top_n: int | None = 1,
    settings: Settings = DEFAULT_SETTINGS,
) -> DataFrame:
    """The alerts that polling every ``slide_seconds`` over history would have recorded.

    A config that no built-in rule goes by is left out, as in a single pass.
    """
    configs = runnable(configs)
    if not configs:
        return empty_alerts(auth.sparkSession)
    windows = [c.window_minutes for c in configs]
    ticks = Ticks.between(windows, slide_seconds, start, end)
    return first_per_fingerprint(replayed(panes_between(auth, windows, ticks), configs, ticks, top_n, settings))


# A window of up to so many ticks copies its panes to them, which takes one aggregation.
# Beyond, the rules run on changes alone.
COPIES = 32


def replayed(
    panes: DataFrame, configs: Iterable[RuleConfig], ticks: Ticks, top_n: int | None = 1,
    settings: Settings = DEFAULT_SETTINGS,
) -> DataFrame:
    """Alert rows of every rule at every tick over panes, before any dedup."""
    configs = list(configs)
    few = [c for c in configs if ticks.length(c.window_minutes) <= COPIES * ticks.step]
    parts = []
    if few:
        facts = tick_facts(panes, [c.window_minutes for c in few], ticks)
        parts.append(candidates(facts, few, top_n, per_tick=True, settings=settings))
    shared = shared_plan(panes)
    for config in configs:
        if config not in few:
            parts.append(alert_rows(slide(shared, config, ticks, top_n), config, config.parameter_text, settings))
    if not parts:
        raise ValueError("no rule to run")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def empty_alerts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ALERTS)

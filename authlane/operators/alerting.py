"""Alert conditions, their transitions over time, and the notification outbox."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from authlane.functions.times import AsOf, as_of_col, before

# Minutes each rule's condition looks back, and the severity it notifies with.
# The look-backs differ from the rule windows on purpose.
CONDITIONS: dict[str, tuple[int, str]] = {
    "security_failed_login_burst": (2, "medium"),
    "windows_failed_logon_burst": (5, "medium"),
    "security_source_multi_user_burst": (10, "high"),
    "security_user_multi_source_burst": (10, "high"),
    "security_failed_then_success": (15, "high"),
}

# Fixed value: minutes before a still-firing group is notified again.
REPEAT_MINUTES = 15


def _lookback(conditions: Mapping[str, tuple[int, str]]) -> Column:
    """Look-back minutes of the row's rule, NULL for a rule without a condition."""
    out = F.lit(None).cast("int")
    for rule_id, (minutes, _) in conditions.items():
        out = F.when(F.col("rule_id") == rule_id, minutes).otherwise(out)
    return out


def condition_table(
    spark: SparkSession, conditions: Mapping[str, tuple[int, str]] = CONDITIONS
) -> DataFrame:
    rows = [(r, minutes, severity) for r, (minutes, severity) in conditions.items()]
    return spark.createDataFrame(rows, "rule_id string, lookback_minutes int, severity string")


def alert_conditions(
    alerts: DataFrame, as_of: AsOf = None, conditions: Mapping[str, tuple[int, str]] = CONDITIONS
) -> DataFrame:
    """Per rule the alerts in its look-back and whether it fires; quiet rules read 0.

    One pass over the longest look-back; the per-rule counts then meet the condition
    table, which has one row per configured rule.
    """
    longest = max(minutes for minutes, _ in conditions.values())
    recent = F.col("ts") > as_of_col(as_of) - F.make_dt_interval(mins=_lookback(conditions))
    counts = (
        alerts.filter(F.col("rule_id").isin(*conditions))
        .filter(F.col("ts") > before(as_of, minutes=longest))
        .filter(recent)
        .groupBy("rule_id")
        .agg(F.count("*").alias("n"))
    )
    value = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    return (
        condition_table(alerts.sparkSession, conditions)
        .join(counts, "rule_id", "left")
        .select("rule_id", "severity", "lookback_minutes", value.alias("value"),
                (value > 0).alias("firing"))
    )


def alert_transitions(
    alerts: DataFrame, conditions: Mapping[str, tuple[int, str]] = CONDITIONS
) -> DataFrame:
    """When each rule's condition starts and stops firing, evaluated every whole minute.

    An alert keeps a condition firing from the first minute mark at or after it for the
    look-back's number of marks, so alerts reduce to one row per rule and mark before
    anything is ordered: what is ordered per rule is bounded by minutes, not by alerts.
    Marks closer than the look-back form one firing span.
    """
    micros = F.unix_micros("ts")
    minute = F.lit(60_000_000)
    mark = ((micros + F.pmod(-micros, minute)) / minute).cast("bigint")
    marks = (
        alerts.withColumn("lookback", _lookback(conditions))
        .filter(F.col("lookback").isNotNull())
        .groupBy("rule_id", "lookback", mark.alias("mark"))
        .agg(F.count("*").alias("n"))
    )
    by_rule = Window.partitionBy("rule_id", "lookback").orderBy("mark")
    gap_before = F.col("mark") > F.lag("mark").over(by_rule) + F.col("lookback")
    gap_after = F.lead("mark").over(by_rule) > F.col("mark") + F.col("lookback")
    edges = marks.select(
        "rule_id",
        F.when(F.coalesce(gap_before, F.lit(True)), F.col("mark")).alias("starts"),
        F.when(F.coalesce(gap_after, F.lit(True)), F.col("mark") + F.col("lookback")).alias("ends"),
    )
    changes = F.array_compact(
        F.array(
            F.when(
                F.col("starts").isNotNull(),
                F.struct(F.col("starts").alias("at"), F.lit("firing").alias("state")),
            ),
            F.when(
                F.col("ends").isNotNull(),
                F.struct(F.col("ends").alias("at"), F.lit("resolved").alias("state")),
            ),
        )
    )
    return edges.select("rule_id", F.explode(changes).alias("change")).select(
        "rule_id",
        F.timestamp_seconds(F.col("change.at") * 60).alias("tick"),
        F.col("change.state").alias("state"),
    )


def notification_groups(alerts: DataFrame, repeat_minutes: int = REPEAT_MINUTES) -> DataFrame:
    """Outbox: alerts grouped by rule and severity per repeat interval."""
    span = F.window("ts", f"{repeat_minutes} minutes")
    return (
        alerts.groupBy("rule_id", "severity", span.alias("span"))
        .agg(
            F.count("*").alias("alerts"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        .select(
            "rule_id", "severity", F.col("span.start").alias("group_start"), "alerts",
            "first_ts", "last_ts",
        )
    )

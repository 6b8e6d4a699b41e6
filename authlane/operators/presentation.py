"""Text an operator reads: alert cards, relative ages, row keys, event lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane.functions.text import first_nonblank, mentions
from authlane.functions.times import AsOf, as_of_col, sec_text

# Card titles, by the first group of words found in the rule name.
TITLES = [
    (("failed", "logon", "login"), "Failed Login Burst Detected"),
    (("spray",), "Password Spray Detected"),
    (("distributed",), "Distributed Login Attack Detected"),
]
OTHER_TITLE = "Suspicious Login Activity Detected"
UNKNOWN = "n/a"


def _round(c: Column) -> Column:
    """Round half up, as integers."""
    return F.floor(c + F.lit(0.5)).cast("bigint")


def _counted(n: Column, unit: str) -> Column:
    return F.concat(
        n.cast("string"), F.lit(f" {unit}"), F.when(n == 1, "").otherwise("s")
    )


def _micros_between(started: Column, ended: Column) -> Column:
    return (F.unix_micros(ended) - F.unix_micros(started)) / F.lit(1_000_000.0)


def title(name: Column) -> Column:
    out: Column | None = None
    for words, text in TITLES:
        test = mentions(name, words[0])
        for word in words[1:]:
            test = test | mentions(name, word)
        out = F.when(test, text) if out is None else out.when(test, text)
    return out.otherwise(OTHER_TITLE)  # type: ignore[union-attr]


def window_text(started: Column, ended: Column) -> Column:
    """Length of a span in words: seconds up to 90, then minutes, then hours."""
    seconds = F.greatest(F.lit(1).cast("bigint"), _round(_micros_between(started, ended)))
    minutes = _round(seconds / F.lit(60.0))
    hours = _round(minutes / F.lit(60.0))
    return (
        F.when(started.isNull() | ended.isNull(), UNKNOWN)
        .when(seconds <= 90, F.concat(seconds.cast("string"), F.lit(" seconds")))
        .when(minutes < 60, _counted(minutes, "minute"))
        .otherwise(_counted(hours, "hour"))
    )


def alert_cards(alerts: DataFrame) -> DataFrame:
    """Alert feed rows as cards: facts come from the columns, then from ``details``."""
    c = F.col

    def detail(key: str) -> Column:
        return F.coalesce(F.get_json_object("details", f"$.{key}"), F.lit(""))

    attempts = F.when(c("attempt_count") > 0, c("attempt_count").cast("string"))
    facts = alerts.select(
        "ts",
        "rule_id",
        "alert_fingerprint",
        title(first_nonblank(c("rule_name"), c("alert_type"))).alias("title"),
        first_nonblank(
            c("entity_user"), c("principal"), detail("sample_user"), detail("principal"),
            default=UNKNOWN,
        ).alias("user"),
        first_nonblank(
            c("entity_src_ip"), c("source_ip"), detail("sample_source_ip"), detail("source_ip"),
            default=UNKNOWN,
        ).alias("src_ip"),
        first_nonblank(
            F.coalesce(attempts, F.lit("")), F.nullif(detail("failed_attempts"), F.lit("0")),
            default=UNKNOWN,
        ).alias("attempts"),
        window_text(
            F.coalesce("first_seen_ts", "window_start", "ts"),
            F.coalesce("last_seen_ts", "window_end", "ts"),
        ).alias("window_text"),
        first_nonblank(
            detail("sample_logon_type"), detail("logon_type"), default=UNKNOWN
        ).alias("logon_type"),
        first_nonblank(
            c("entity_host"), c("endpoint_id"), detail("endpoint_id"), default=UNKNOWN
        ).alias("host"),
    )
    sentence = F.concat(
        "user", F.lit(" saw "), "attempts", F.lit(" failed attempts from "), "src_ip",
        F.lit(" in "), "window_text",
        F.lit(". This pattern may indicate a brute-force attack."),
    )
    return facts.withColumn("sentence", sentence)


def relative_age(ts: Column, as_of: AsOf = None) -> Column:
    """Age of an instant in words; older than a day, the instant itself."""
    seconds = F.greatest(F.lit(0).cast("bigint"), _round(_micros_between(ts, as_of_col(as_of))))
    minutes = _round(seconds / F.lit(60.0))
    hours = _round(minutes / F.lit(60.0))
    return (
        F.when(ts.isNull(), "No recent activity")
        .when(seconds < 5, "just now")
        .when(seconds < 60, F.concat(seconds.cast("string"), F.lit(" seconds ago")))
        .when(minutes < 60, F.concat(_counted(minutes, "minute"), F.lit(" ago")))
        .when(hours < 24, F.concat(_counted(hours, "hour"), F.lit(" ago")))
        .otherwise(sec_text(ts))
    )


def row_key() -> Column:
    """Identity of an alert feed row, to tell new rows from shown ones."""
    parts = ["rule_id", "alert_type", "endpoint_id", "entity_user", "entity_src_ip"]
    return F.concat_ws(
        "|", sec_text(F.col("time")), *[F.coalesce(F.col(p), F.lit("")) for p in parts]
    )


def event_lines(feed: DataFrame, as_of: AsOf = None, limit: int = 10) -> DataFrame:
    """The first rows of the events feed as text lines."""
    c = F.col
    dash = "-"
    top = feed.orderBy(c("time").desc(), "message").limit(limit)
    return top.select(
        "time",
        F.concat(
            first_nonblank(c("status"), default="auth"), F.lit(" "),
            first_nonblank(c("user"), default=dash), F.lit(" from "),
            first_nonblank(c("src_ip"), default=dash),
        ).alias("headline"),
        F.concat_ws(
            " · ",
            relative_age(c("time"), as_of),
            first_nonblank(c("host"), default=dash),
            first_nonblank(c("source_kind"), c("ingest_source"), default=dash),
            F.concat(F.lit("logon "), first_nonblank(c("logon_type"), default=dash)),
        ).alias("context"),
    )

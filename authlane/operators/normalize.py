"""Raw lanes to the event envelope. Each function is a projection and a filter, so
it runs unchanged on batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane import settings as S
from authlane.functions.parse import parse_event_time, parse_rfc3339, parse_syslog_time
from authlane.functions.plan import computed_once
from authlane.functions.text import first_nonblank, null_if_blank, strip
from authlane.functions.times import AsOf, as_of_col, millis
from authlane.schema import ENVELOPE_COLUMNS
from authlane.settings import DEFAULT_SETTINGS, Settings

RECORD_TYPE = "map<string,string>"

# The fallback messages.
NO_MESSAGE_TEXT = "normalized event (no source message field)"
SYNTHETIC_MESSAGE_TEXT = "synthetic auth event"

# Map key of the envelope and the record keys it is read from, best first.
GENERIC_FIELD_SOURCES = {
    "hostname": ["hostname"],
    "appname": ["appname"],
    "severity": ["severity"],
    "facility": ["facility"],
    "procid": ["procid"],
    "msgid": ["msgid"],
    "tag": ["tag"],
    "collector": ["collector"],
    "host_collection": ["host_collection"],
    "host": ["host"],
    "channel": ["channel", "Channel"],
    "computer": ["computer", "Computer"],
    "event_id": ["event_id", "EventID"],
    "level": ["level", "Level"],
    "provider_name": ["provider_name", "ProviderName"],
}

# SSH line shapes.
SSH_LINE = (
    r"^([A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}) ([^\s]+) sshd(?:\[(\d+)\])?: (.*)$"
)
SSH_FAILED = r"^Failed (\w+) for (?:invalid user )?([^\s]+) from ([0-9A-Fa-f:\.]+)(?: port (\d+))?"
SSH_ACCEPTED = r"^Accepted (\w+) for ([^\s]+) from ([0-9A-Fa-f:\.]+)(?: port (\d+))?"

# Source addresses that stand for "none" in Windows logon records.
WINDOWS_NO_ADDRESS = ("-", "::1", "::ffff:127.0.0.1")


def decode_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON object lines to a ``record`` map with case-sensitive keys; other lines give NULL."""
    return computed_once(lines, record=F.from_json(F.col(column), RECORD_TYPE))


def _has(key: str) -> Column:
    return F.map_contains_key(F.col("record"), key)


def _text(key: str) -> Column:
    """Text of a key that is present; a JSON null reads as ''."""
    return F.when(_has(key), F.coalesce(F.col("record")[key], F.lit("")))


def _present(*keys: str, default: str | None = None) -> Column:
    """Value of the first key that exists, so that a present '' wins over a later key."""
    values = [_text(k) for k in keys]
    return F.coalesce(*values, F.lit(default)) if default is not None else F.coalesce(*values)


def _map(entries: dict[str, Column]) -> Column:
    flat = [part for key, value in entries.items() for part in (F.lit(key), value)]
    return F.create_map(*flat)


def _envelope(
    df: DataFrame, ts: Column, platform: Column, version: str, lane: Column, message: Column,
    fields: Column,
) -> DataFrame:
    return df.select(
        millis(ts).alias("ts"),
        platform.alias("platform"),
        F.lit(version).alias("schema_version"),
        lane.alias("ingest_source"),
        message.alias("message"),
        fields.alias("fields"),
    )


def generic_reject_reason() -> Column:
    """Why a generic record cannot be normalized, NULL when it can. A record without a
    timestamp is fine; one that cannot be read must not pass for a current event."""
    stamp = _text("timestamp")
    return F.when(F.col("record").isNull(), "invalid json").when(
        stamp.isNotNull() & parse_event_time(stamp).isNull(), "unsupported timestamp format"
    )


def normalize_generic(
    records: DataFrame, as_of: AsOf = None, settings: Settings = DEFAULT_SETTINGS
) -> DataFrame:
    """Decoded syslog, demo and forwarded records (``record`` map) to the envelope; unusable
    records are left out (``generic_reject_reason`` tells why)."""
    source = _text("source_type")
    fluent = source == "fluent"
    lane = (
        F.when(fluent & (_text("tag") == "windows.events"), S.LANE_WINDOWS)
        .when(fluent, S.LANE_FLUENT)
        .when(_has("source_type"), F.concat(F.lit(S.LANE_PREFIX), source))
        .otherwise(S.LANE_SYSLOG)
    )
    entries = {key: _present(*sources) for key, sources in GENERIC_FIELD_SOURCES.items()}
    entries["schema_version"] = F.lit(settings.schema_version)
    return _envelope(
        records.filter(generic_reject_reason().isNull()),
        F.coalesce(parse_event_time(_text("timestamp")), as_of_col(as_of)),
        F.lit(settings.platform),
        settings.schema_version,
        lane,
        _present("message", "log", "msg", "Message", default=NO_MESSAGE_TEXT),
        F.map_filter(_map(entries), lambda _, v: v.isNotNull()),
    )


def synthetic_reject_reason() -> Column:
    """Why a scenario line cannot be normalized, NULL when it can."""
    stamp = _text("timestamp")
    return F.when(F.col("record").isNull(), "invalid json").when(
        stamp.isNotNull() & parse_rfc3339(stamp).isNull(), "unsupported timestamp format"
    )


def normalize_synthetic_auth(
    records: DataFrame, as_of: AsOf = None, settings: Settings = DEFAULT_SETTINGS
) -> DataFrame:
    """Scenario records (``record`` map) to the envelope; unusable lines are left out
    (``synthetic_reject_reason`` tells why)."""
    platform = F.coalesce(F.lower(_text("platform")), F.lit("synthetic-auth"))
    kind_default = F.when(platform == "windows", S.KIND_WINDOWS).otherwise(S.KIND_LINUX)
    entries = {
        "event_type": F.lit("login"),
        "user": _present("user", default=""),
        "src_ip": _present("src_ip", default=""),
        "host": _present("host", default=""),
        "status": F.lower(_present("status", default="")),
        "source_kind": F.coalesce(_text("source_kind"), kind_default),
        "raw_event_id": _present("raw_event_id", default=""),
        "logon_type": _present("logon_type", default=""),
        "domain": _present("domain", default=""),
        "auth_method": _present("auth_method", default=""),
        "collector_name": _present("collector_name", default=settings.simulator_name),
        "scenario": _text("scenario"),
        "schema_version": F.lit(settings.schema_version),
    }
    return _envelope(
        records.filter(synthetic_reject_reason().isNull()),
        F.coalesce(parse_rfc3339(_text("timestamp")), as_of_col(as_of)),
        platform,
        settings.schema_version,
        F.lit(S.LANE_SYNTHETIC),
        _present("message", default=SYNTHETIC_MESSAGE_TEXT),
        F.map_filter(_map(entries), lambda _, v: v.isNotNull()),
    )


def normalize_ssh_auth(
    lines: DataFrame,
    as_of: AsOf = None,
    settings: Settings = DEFAULT_SETTINGS,
    reference_year: int | None = None,
) -> DataFrame:
    """SSH daemon auth lines (``value``) to the envelope; every other line is dropped.

    The line carries no year: it takes the year of ``as_of``, or ``reference_year``.
    """
    value = F.col("value")
    now = as_of_col(as_of)
    year = F.lit(reference_year) if reference_year is not None else F.year(now)
    daemon_lines = computed_once(
        lines.filter(F.contains(value, F.lit("sshd"))).select(value),
        stamp=F.regexp_extract(value, SSH_LINE, 1),
        host=F.regexp_extract(value, SSH_LINE, 2),
        body=F.regexp_extract(value, SSH_LINE, 4),
    )
    # A line of another shape has an empty body, which is neither.
    parsed = computed_once(
        daemon_lines,
        failed=F.rlike("body", F.lit(SSH_FAILED)),
        accepted=F.rlike("body", F.lit(SSH_ACCEPTED)),
    ).filter("failed OR accepted")

    def part(group: int) -> Column:
        return F.when(F.col("failed"), F.regexp_extract("body", SSH_FAILED, group)).otherwise(
            F.regexp_extract("body", SSH_ACCEPTED, group)
        )

    entries = {
        "event_type": F.lit("login"),
        "user": part(2),
        "src_ip": part(3),
        "host": F.col("host"),
        "status": F.when(F.col("failed"), S.STATUS_FAILURE).otherwise(S.STATUS_SUCCESS),
        "auth_method": part(1),
        "source_kind": F.lit(S.KIND_LINUX),
        "collector_name": F.lit(settings.collector_name),
        "raw_message": value,
        "schema_version": F.lit(settings.schema_version),
    }
    return _envelope(
        parsed,
        F.coalesce(parse_syslog_time(F.col("stamp"), year), now),
        F.lit("linux-host"),
        settings.schema_version,
        F.lit(S.LANE_LINUX_SSH),
        value,
        _map(entries),
    )


def ssh_reject_reason() -> Column:
    """Why a line (``value``) that reports a login cannot be normalized, NULL for every other
    line: what the daemon says about other things is left out by intent."""
    value = F.col("value")
    reports = F.rlike(value, F.lit(r"sshd(\[\d+\])?: (Failed|Accepted) "))
    body = F.regexp_extract(value, SSH_LINE, 4)
    usable = F.rlike(body, F.lit(SSH_FAILED)) | F.rlike(body, F.lit(SSH_ACCEPTED))
    return F.when(reports & ~usable, "unsupported line")


def windows_reject_reason() -> Column:
    """Why an exported record cannot be read, NULL when it can; events of other kinds are
    left out by intent."""
    return F.when(F.col("record").isNull(), "invalid json")


def rejected(raw: DataFrame, reason: Column, column: str = "value") -> DataFrame:
    """(raw, reason) of the rows for which a lane's ``..._reject_reason`` has one. Blank lines
    are no records."""
    judged = raw.select(F.col(column).alias("raw"), reason.alias("reason"))
    return judged.filter(F.col("reason").isNotNull() & (strip(F.col("raw")) != ""))


def windows_payload(df: DataFrame) -> DataFrame:
    """Exporter output text: ``message``, or ``stdout`` where it is blank, as ``value``."""
    columns = [null_if_blank(F.col(c)) for c in ("message", "stdout") if c in df.columns]
    return df.select(F.coalesce(*columns, F.lit("")).alias("value"))


def normalize_windows_auth(
    records: DataFrame, as_of: AsOf = None, settings: Settings = DEFAULT_SETTINGS
) -> DataFrame:
    """Exported Windows logon records (``record`` map) to the envelope."""

    def r(key: str) -> Column:
        return F.coalesce(F.col("record")[key], F.lit(""))

    staged = records.filter(r("event_id").isin(*S.WINDOWS_EVENT_IDS)).select(
        r("event_id").alias("event_id"),
        r("user").alias("user"),
        F.when(r("src_ip").isin(*WINDOWS_NO_ADDRESS), "").otherwise(r("src_ip")).alias("src_ip"),
        first_nonblank(r("host"), default=settings.collector_name).alias("host"),
        F.when(r("event_id") == "4624", S.STATUS_SUCCESS).otherwise(S.STATUS_FAILURE).alias("status"),
        r("logon_type").alias("logon_type"),
        r("domain").alias("domain"),
        F.lower(r("auth_method")).alias("auth_method"),
        r("provider_name").alias("provider_name"),
        r("record_id").alias("record_id"),
        F.translate(r("raw_message"), "\r\n", "  ").alias("detail"),
        r("timestamp").alias("stamp"),
    ).filter(
        F.col("logon_type").isin("", *S.WINDOWS_LOGON_TYPES) & ~F.col("user").isin("", "-")
    )

    def clause(label: str, c: str) -> Column:
        return F.when(F.col(c) == "", "").otherwise(F.concat(F.lit(f" {label}="), F.col(c)))

    message = F.concat(
        F.lit("Windows logon "), "status", F.lit(" user="), "user", clause("src_ip", "src_ip"),
        F.lit(" host="), "host", F.lit(" event_id="), "event_id", clause("details", "detail"),
    )
    entries = {
        "event_type": F.lit("login"),
        "user": F.col("user"),
        "src_ip": F.col("src_ip"),
        "host": F.col("host"),
        "status": F.col("status"),
        "raw_event_id": F.col("event_id"),
        "event_id": F.col("event_id"),
        "logon_type": F.col("logon_type"),
        "domain": F.col("domain"),
        "auth_method": F.col("auth_method"),
        "collector_name": F.lit(settings.collector_name),
        "source_kind": F.lit(S.KIND_WINDOWS),
        "collector_flavor": F.lit(settings.windows_flavor),
        "environment_tag": F.lit(settings.environment_tag),
        "channel": F.lit("Security"),
        "provider_name": F.col("provider_name"),
        "computer": F.col("host"),
        "record_id": F.col("record_id"),
        "schema_version": F.lit(settings.schema_version),
    }
    return _envelope(
        staged,
        F.coalesce(parse_rfc3339(F.col("stamp")), as_of_col(as_of)),
        F.lit("windows"),
        settings.schema_version,
        F.lit(S.LANE_WINDOWS),
        message,
        _map(entries),
    )


def lane_fan_in(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union of normalized lanes by column name."""
    out = first.select(*ENVELOPE_COLUMNS)
    for df in others:
        out = out.unionByName(df.select(*ENVELOPE_COLUMNS))
    return out

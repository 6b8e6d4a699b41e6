"""Windows Security event rows: EventData XML, export records, cursor and drop counts."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane import settings as S
from authlane.functions.plan import computed_once
from authlane.functions.text import strip
from authlane.functions.times import AsOf, before

XML_SCHEMA = (
    "EventData STRUCT<Data: ARRAY<STRUCT<_Name: STRING, _VALUE: STRING>>>"
)

# Why an event is not exported.
SEEN = "already_seen"
BAD_LOGON_TYPE = "unsupported_logon_type"
BAD_USER = "missing_or_invalid_username"
EMITTED = "emitted"


def eventdata_map(xml: Column) -> Column:
    """Named EventData nodes as MAP<STRING,STRING>; nodes without a name are left out, and
    of a repeated name the last node counts."""
    nodes = F.from_xml(xml, XML_SCHEMA)["EventData"]["Data"]
    named = F.reverse(F.filter(nodes, lambda n: strip(F.coalesce(n["_Name"], F.lit(""))) != ""))

    # A list of one binds a value, so that a lambda does not build it again per element.
    def last_of_each(nodes: Column) -> Column:
        """Of the nodes, last one first, those whose name no later node has."""
        bound = F.array(F.transform(nodes, lambda n: n["_Name"]))
        last = lambda names: F.filter(nodes, lambda n, i: F.array_position(names, n["_Name"]) == i + 1)
        return F.transform(bound, last)[0]

    kept = F.reverse(F.transform(F.array(named), last_of_each)[0])
    pairs = F.transform(kept, lambda n: F.struct(n["_Name"], F.coalesce(n["_VALUE"], F.lit(""))))
    return F.coalesce(F.map_from_entries(pairs), F.create_map().cast("map<string,string>"))


def logon_events(
    rows: DataFrame, as_of: AsOf = None, lookback_minutes: int = 30, newest: int | None = None
) -> DataFrame:
    """Logon events of the lookback. ``newest`` keeps that many, by record id; the cursor
    must be applied first (``after_cursor``), or older unread events are lost."""
    found = rows.filter(
        F.col("event_id").cast("string").isin(*S.WINDOWS_EVENT_IDS)
        & (F.col("time_created") >= before(as_of, minutes=lookback_minutes))
    )
    return found if newest is None else found.orderBy(F.col("record_id").desc()).limit(newest)


def parse_cursor(text: str | None) -> int:
    """Record id of a saved cursor; an older or unreadable form starts over."""
    match = re.fullmatch(r"v2:(\d+)", (text or "").strip())
    return int(match.group(1)) if match else 0


def after_cursor(rows: DataFrame, cursor: int) -> DataFrame:
    return rows.filter(F.col("record_id") > cursor)


def next_cursor(classified: DataFrame, cursor: int) -> DataFrame:
    """The new cursor as one row: the highest emitted record id, never below the old one.
    Dropped records do not move it."""
    top = F.max(F.when(F.col("outcome") == EMITTED, F.col("record_id")))
    return classified.agg(
        F.concat(F.lit("v2:"), F.greatest(F.coalesce(top, F.lit(0)), F.lit(cursor))).alias("cursor")
    )


def _nonblank(*values: Column) -> Column:
    return F.coalesce(*[F.when(strip(v) != "", v) for v in values], F.lit(""))


def export_records(rows: DataFrame, cursor: int = 0) -> DataFrame:
    """Export record of every event with its ``outcome``: emitted, or why it was dropped."""
    data = F.col("data")
    staged = computed_once(rows, data=eventdata_map(F.col("xml"))).select(
        F.concat(
            F.date_format("time_created", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("0Z")
        ).alias("timestamp"),
        F.col("event_id").cast("string").alias("event_id"),
        _nonblank(data["TargetUserName"], data["SubjectUserName"]).alias("user"),
        _nonblank(data["TargetDomainName"], data["SubjectDomainName"]).alias("domain"),
        F.coalesce(data["IpAddress"], F.lit("")).alias("src_ip"),
        F.col("machine_name").alias("host"),
        F.coalesce(data["LogonType"], F.lit("")).alias("logon_type"),
        _nonblank(data["AuthenticationPackageName"], data["LogonProcessName"]).alias("auth_method"),
        "provider_name",
        strip(F.regexp_replace("message", r"\r?\n", " ")).alias("raw_message"),
        "record_id",
    )
    outcome = (
        F.when(F.col("record_id") <= cursor, SEEN)
        .when(
            (strip(F.col("logon_type")) != "") & ~F.col("logon_type").isin(*S.WINDOWS_LOGON_TYPES),
            BAD_LOGON_TYPE,
        )
        .when((strip(F.col("user")) == "") | (F.col("user") == "-"), BAD_USER)
        .otherwise(EMITTED)
    )
    return computed_once(staged, outcome=outcome)


def emitted(classified: DataFrame) -> DataFrame:
    """Emitted records as the JSON lines the Windows normalizer reads."""
    record = [c for c in classified.columns if c != "outcome"]
    return classified.filter(F.col("outcome") == EMITTED).select(
        F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in record])).alias("value")
    )


def drop_counts(classified: DataFrame) -> DataFrame:
    """Scanned, dropped per reason, and emitted, in one pass."""
    return classified.agg(
        F.count("*").alias("scanned"),
        *[
            F.count_if(F.col("outcome") == o).alias(o)
            for o in (SEEN, BAD_LOGON_TYPE, BAD_USER, EMITTED)
        ],
    )


def incremental_export(
    rows: DataFrame, cursor_text: str | None, as_of: datetime | None, lookback_minutes: int = 30
) -> DataFrame:
    """One exporter run as a batch: events of the lookback past the saved cursor."""
    cursor = parse_cursor(cursor_text)
    return export_records(after_cursor(logon_events(rows, as_of, lookback_minutes), cursor), cursor)

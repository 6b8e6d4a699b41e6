"""Table schemas and column defaults.

Strings are never NULL by convention: an absent value is the empty string.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _TS, _L = T.StringType(), T.TimestampType(), T.LongType()

EVENTS = T.StructType(
    [
        T.StructField("ts", _TS),
        T.StructField("event_id", _S),
        T.StructField("platform", _S),
        T.StructField("schema_version", _S),
        T.StructField("ingest_source", _S),
        T.StructField("message", _S),
        T.StructField("fields", T.MapType(_S, _S)),
    ]
)

ENVELOPE_COLUMNS = ["ts", "platform", "schema_version", "ingest_source", "message", "fields"]

AUTH_EVENTS = T.StructType(
    [T.StructField("ts", _TS)]
    + [
        T.StructField(name, _S)
        for name in (
            "event_id", "platform", "schema_version", "ingest_source", "message", "event_type",
            "user", "src_ip", "host", "status", "source_kind", "raw_event_id", "logon_type",
            "domain", "auth_method", "collector_name",
        )
    ]
)

RULE_RESULT = T.StructType(
    [
        T.StructField("hits", _L),
        T.StructField("principal", _S),
        T.StructField("source_ip", _S),
        T.StructField("endpoint_id", _S),
        T.StructField("window_start", _TS),
        T.StructField("window_end", _TS),
        T.StructField("distinct_user_count", _L),
        T.StructField("distinct_ip_count", _L),
        T.StructField("source_kind", _S),
        T.StructField("reason", _S),
        T.StructField("evidence_summary", _S),
        T.StructField("details", _S),
        T.StructField("window_bucket", _TS),
    ]
)

ALERTS = T.StructType(
    [
        T.StructField("ts", _TS),
        T.StructField("rule_id", _S),
        T.StructField("rule_name", _S),
        T.StructField("alert_type", _S),
        T.StructField("alert_fingerprint", _S),
        T.StructField("severity", _S),
        T.StructField("hits", _L),
        T.StructField("attempt_count", _L),
        T.StructField("principal", _S),
        T.StructField("entity_user", _S),
        T.StructField("source_ip", _S),
        T.StructField("entity_src_ip", _S),
        T.StructField("endpoint_id", _S),
        T.StructField("entity_host", _S),
        T.StructField("window_start", _TS),
        T.StructField("first_seen_ts", _TS),
        T.StructField("window_end", _TS),
        T.StructField("last_seen_ts", _TS),
        T.StructField("window_bucket", _TS),
        T.StructField("distinct_user_count", _L),
        T.StructField("distinct_ip_count", _L),
        T.StructField("source_kind", _S),
        T.StructField("reason", _S),
        T.StructField("evidence_summary", _S),
        T.StructField("workflow_state", _S),
        T.StructField("threshold_op", _S),
        T.StructField("threshold_value", _L),
        T.StructField("query", _S),
        T.StructField("details", _S),
    ]
)

# Columns a row may leave out, with the value it then takes. NOW stands for the as-of time.
NOW = object()

ALERT_DEFAULTS: dict[str, object] = {
    "ts": NOW,
    "alert_type": "",
    "alert_fingerprint": "",
    "attempt_count": 0,
    "principal": "",
    "entity_user": "",
    "source_ip": "",
    "entity_src_ip": "",
    "endpoint_id": "",
    "entity_host": "",
    "window_start": NOW,
    "first_seen_ts": NOW,
    "window_end": NOW,
    "last_seen_ts": NOW,
    "window_bucket": NOW,
    "distinct_user_count": 0,
    "distinct_ip_count": 0,
    "source_kind": "",
    "reason": "",
    "evidence_summary": "",
    "workflow_state": "new",
    "details": "",
}

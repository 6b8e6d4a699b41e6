"""The wire envelope: decode with quarantine, event ids, and publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane.functions.jsonmap import is_object, stringify_map
from authlane.functions.parse import parse_event_time
from authlane.functions.plan import computed_once
from authlane.functions.text import strip
from authlane.functions.times import millis, ms_text
from authlane.schema import ENVELOPE_COLUMNS

_TEXT_KEYS = ("ts", "platform", "schema_version", "ingest_source", "message")


def _absent(kind: Column) -> Column:
    """A key that is missing or JSON null."""
    return kind.isNull() | (kind == "VOID")


def decode_envelopes(lines: DataFrame, column: str = "value") -> DataFrame:
    """Decode one JSON envelope per row.

    Adds the envelope columns and ``reject_reason`` (NULL for a good row); the source
    columns stay, so that a rejected row can be quarantined with its raw text. Unknown
    keys are ignored and absent texts read as ''.
    """
    parsed = computed_once(lines, _v=F.try_parse_json(F.col(column)))
    top = computed_once(
        parsed, _top=F.when(is_object(F.col("_v")), F.col("_v").cast("map<string,variant>"))
    )
    kinds = {k: F.schema_of_variant(F.col("_top")[k]) for k in (*_TEXT_KEYS, "fields")}
    texts = {k: F.coalesce(F.col("_top")[k].cast("string"), F.lit("")) for k in _TEXT_KEYS}
    wrong_type = ~_absent(kinds["fields"]) & ~F.startswith(kinds["fields"], F.lit("OBJECT"))
    for k in _TEXT_KEYS:
        wrong_type = wrong_type | (~_absent(kinds[k]) & (kinds[k] != "STRING"))
    row = computed_once(top, ts=parse_event_time(texts["ts"]))
    ts = F.col("ts")
    reason = (
        F.when(F.col("_top").isNull(), "invalid json")
        .when(wrong_type, "wrong type")
        .when(strip(texts["ts"]) == "", "empty timestamp")
        .when(ts.isNull(), "unsupported timestamp format")
    )
    judged = computed_once(row, reject_reason=reason)
    return judged.select(
        *lines.columns,
        millis(ts).alias("ts"),
        *[texts[k].alias(k) for k in _TEXT_KEYS[1:]],
        stringify_map(F.col("_top")["fields"]).alias("fields"),
        "reject_reason",
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNull()).select(*ENVELOPE_COLUMNS)


def quarantined(decoded: DataFrame, column: str = "value") -> DataFrame:
    """Rejected rows with their raw text and reason."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select(
        F.col(column).alias("raw"), F.col("reject_reason").alias("reason")
    )


def position_id(*position: Column) -> Column:
    """Event id of a source position (topic, partition, offset; or host and record id):
    a redelivered message gets the same id. Content is never hashed: identical rows are
    separate evidence."""
    return F.sha2(F.concat_ws("|", *position), 256)


def with_event_id(envelopes: DataFrame, *position: Column) -> DataFrame:
    """Add ``event_id`` from the source position, or a fresh id per row without one."""
    event_id = position_id(*position) if position else F.uuid()
    return envelopes.select("ts", event_id.alias("event_id"), *ENVELOPE_COLUMNS[1:])


def publish(envelopes: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``, ready for a file or bus sink."""
    shaped = envelopes.select(ms_text(F.col("ts")).alias("ts"), *ENVELOPE_COLUMNS[1:])
    return shaped.select(F.to_json(F.struct(*ENVELOPE_COLUMNS)).alias("value"))

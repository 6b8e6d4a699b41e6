"""Timestamp parsing for the wire formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from authlane.functions.text import strip

# Accepted timestamp shapes. The guard keeps out partial dates such as
# '2024', which a plain cast would take.
SPACE_FORM = r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2}([.,]\d+)?$"
RFC3339_FORM = r"^\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"


def _cast(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("timestamp")


def parse_rfc3339(c: Column) -> Column:
    """Instant of an RFC 3339 text with any offset, NULL for anything else."""
    return F.when(F.rlike(c, F.lit(RFC3339_FORM)), _cast(c))


def parse_event_time(c: Column) -> Column:
    """Instant of ``yyyy-MM-dd HH:mm:ss[.f]`` (UTC) or RFC 3339, NULL for anything else."""
    text = strip(c)
    return F.when(
        F.rlike(text, F.lit(SPACE_FORM)), _cast(F.concat(text, F.lit("Z")))
    ).otherwise(parse_rfc3339(text))


def parse_syslog_time(c: Column, year: Column) -> Column:
    """Instant of a classic syslog stamp (``Apr  9 08:33:37``), which carries no year."""
    squeezed = F.regexp_replace(c, r"\s+", " ")
    return F.try_to_timestamp(
        F.concat(year.cast("string"), F.lit(" "), squeezed), F.lit("yyyy MMM d HH:mm:ss")
    )

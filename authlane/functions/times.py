"""Time helpers. Every operator takes an explicit ``as_of``; None means now."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime | Column | None


def to_micros(moment: datetime) -> int:
    """Epoch microseconds; a naive datetime is read as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    delta = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def utc_day(moment: datetime) -> str:
    """The UTC day an instant falls on; a naive datetime is read as UTC."""
    return (datetime(1970, 1, 1) + timedelta(microseconds=to_micros(moment))).strftime("%Y-%m-%d")


def as_of_col(as_of: AsOf) -> Column:
    """The evaluation instant. A datetime folds to a literal, so that predicates
    built on it reach the Parquet scan."""
    if as_of is None:
        return F.date_trunc("SECOND", F.current_timestamp())
    if isinstance(as_of, Column):
        return as_of
    return F.timestamp_micros(F.lit(to_micros(as_of)).cast("bigint"))


def before(as_of: AsOf, *, days: int = 0, minutes: int = 0, seconds: int = 0) -> Column:
    """``as_of`` minus an interval."""
    if isinstance(as_of, datetime):
        shift = ((days * 1440 + minutes) * 60 + seconds) * 1_000_000
        return F.timestamp_micros(F.lit(to_micros(as_of) - shift).cast("bigint"))
    return as_of_col(as_of) - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(minutes), F.lit(seconds))


def within(ts: Column, as_of: AsOf, minutes: int, inclusive: bool = False) -> Column:
    """Lookback predicate: no upper bound, so a future-dated row always counts."""
    low = before(as_of, minutes=minutes)
    return ts >= low if inclusive else ts > low


def millis(c: Column) -> Column:
    """Truncate to millisecond precision."""
    return F.date_trunc("MILLISECOND", c)


def ms_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")


def sec_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def bucket_start(c: Column, minutes: int | Column) -> Column:
    """Floor to an epoch-aligned interval of ``minutes``."""
    size = (F.lit(minutes) if isinstance(minutes, int) else minutes).cast("bigint") * F.lit(60)
    seconds = F.unix_seconds(c)
    return F.timestamp_seconds(seconds - F.pmod(seconds, size))


def minute_boundaries(earlier: Column, later: Column) -> Column:
    """How many minute marks lie between two instants (00:00:59 to 00:01:01 is one)."""

    def minute(c: Column) -> Column:
        seconds = F.unix_seconds(c)
        return ((seconds - F.pmod(seconds, F.lit(60))) / F.lit(60)).cast("bigint")

    return minute(later) - minute(earlier)


# The same helpers as SQL text, for wide projections written as SQL expressions.


def sql_bucket_start(expr: str, minutes: int) -> str:
    return f"timestamp_seconds(unix_seconds({expr}) - pmod(unix_seconds({expr}), {minutes * 60}))"


def sql_ms_text(expr: str) -> str:
    return f"date_format({expr}, 'yyyy-MM-dd HH:mm:ss.SSS')"

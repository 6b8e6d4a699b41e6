"""Joins of points with the intervals that hold them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def points_in_intervals(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str, width: int
) -> DataFrame:
    """Every point with each interval of equal ``keys`` that holds it: start <= at < end.

    The axis, of whole numbers, is cut into bins of ``width``. A point is in one bin, an
    interval in those it touches, so the join is an equality of keys and bin, and a key with
    much of the data is as many join keys as it has bins. A width near the usual length of
    the intervals keeps copies to two or three. Rows with a null key, point or bound meet
    nothing; an interval that ends where it starts holds nothing.
    """
    held, placed = _binned(points, intervals, at, start, end, width)
    met = placed.join(held, [*keys, "_bin"])
    return met.where(f"{start} <= {at} AND {at} < {end}").drop("_bin")


def points_outside(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str, width: int
) -> DataFrame:
    """The points that no interval of equal ``keys`` holds, by the same bins. Points with a
    null key or place are in none and stay."""
    held, placed = _binned(points, intervals, at, start, end, width)
    p, i = placed.alias("p"), held.alias("i")
    met = F.col(f"i.{start}") <= F.col(f"p.{at}")
    met = met & (F.col(f"p.{at}") < F.col(f"i.{end}"))
    for k in [*keys, "_bin"]:
        met = met & (F.col(f"p.{k}") == F.col(f"i.{k}"))
    return p.join(i, met, "left_anti").drop("_bin")


def _binned(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, width: int
) -> tuple[DataFrame, DataFrame]:
    held = intervals.where(f"{start} < {end}").withColumn(
        "_bin", F.explode(F.expr(f"sequence(floor({start} / {width}), floor(({end} - 1) / {width}))"))
    )
    return held, points.withColumn("_bin", F.expr(f"floor({at} / {width})"))

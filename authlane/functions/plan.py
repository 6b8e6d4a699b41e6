"""Keeping an expensive expression to one evaluation per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read instead of recomputing.

    A predicate on a derived column is normally pushed below the projection, with the
    column's expression copied into every place that mentions it. That is right for cheap
    expressions and ruinous for parsed documents. Columns made by a generator stay put;
    ``inline`` of a one-element array is a generator that yields each row once.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` mentions it.

    Inside lambdas, which a generator cannot reach, Spark evaluates each mention anew.
    """
    return F.element_at(F.transform(F.array(value), use), 1)

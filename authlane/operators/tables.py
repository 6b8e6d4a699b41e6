"""Table upkeep: layout, defaults, schema evolution, contract checks, retention."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from authlane.functions.times import AsOf, as_of_col, before, utc_day
from authlane.schema import ALERT_DEFAULTS, EVENTS, NOW
from authlane.settings import DEFAULT_SETTINGS, Settings


def _default(value: object, dtype: T.DataType, as_of: AsOf) -> Column:
    column = as_of_col(as_of) if value is NOW else F.lit(value)
    return column.cast(dtype)


def with_defaults(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] = ALERT_DEFAULTS,
    as_of: AsOf = None,
) -> DataFrame:
    """Rows in the shape of ``schema``: a column the rows leave out takes its default, and
    a column without a default must be there. NULLs of a present column take it too."""
    out: list[Column] = []
    for f in schema:
        if f.name in df.columns:
            value = F.col(f.name).cast(f.dataType)
            if f.name in defaults:
                value = F.coalesce(value, _default(defaults[f.name], f.dataType, as_of))
        elif f.name in defaults:
            value = _default(defaults[f.name], f.dataType, as_of)
        else:
            raise ValueError(f"column {f.name} has no default and is missing")
        out.append(value.alias(f.name))
    return df.select(*out)


def event_defaults(settings: Settings = DEFAULT_SETTINGS) -> dict[str, object]:
    return {"schema_version": settings.schema_version}


def evolve(
    df: DataFrame, schema: T.StructType, defaults: Mapping[str, object], as_of: AsOf = None
) -> DataFrame:
    """Additive evolution: missing columns are added with their default, columns unknown to
    the schema stay at the end."""
    extra = [c for c in df.columns if c not in schema.names]
    missing = [f for f in schema if f.name not in df.columns]
    for f in missing:
        if f.name not in defaults:
            raise ValueError(f"column {f.name} cannot be added without a default")
    added = {f.name: _default(defaults[f.name], f.dataType, as_of) for f in missing}
    widened = df.withColumns(added) if added else df
    return widened.select(*schema.names, *extra)


def migration_checks(
    spark: SparkSession, relations: Mapping[str, DataFrame | None],
    required_columns: Mapping[str, list[str]],
) -> DataFrame:
    """One row per expected relation and column, and whether it is there."""
    rows: list[tuple[str, str, bool]] = []
    for name, df in relations.items():
        rows.append((name, "", df is not None))
        for column in required_columns.get(name, []):
            rows.append((name, column, df is not None and column in df.columns))
    return spark.createDataFrame(rows, "relation string, column string, ok boolean")


def contract_violations(df: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """Contract breaches as rows (column, violation, rows): a missing anchor, a wrong type,
    NULLs in an anchor, or another contract version. One pass over the data."""
    spark = df.sparkSession
    have = {f.name: f.dataType for f in df.schema}
    static: list[tuple[str, str, int]] = []
    checks: list[tuple[str, str, Column]] = []
    for f in EVENTS:
        if f.name not in have:
            static.append((f.name, "missing", 0))
        elif have[f.name].simpleString() != f.dataType.simpleString():
            static.append((f.name, "wrong type", 0))
        else:
            checks.append((f.name, "null anchor", F.col(f.name).isNull()))
    if isinstance(have.get("schema_version"), T.StringType):
        other = F.col("schema_version") != settings.schema_version
        checks.append(("schema_version", "unknown version", other))
    found = spark.createDataFrame(static, "column string, violation string, rows bigint")
    if not checks:
        return found
    counted = df.agg(*[F.count_if(test).alias(f"n{i}") for i, (_, _, test) in enumerate(checks)])
    listed = F.array(
        *[
            F.struct(
                F.lit(column).alias("column"), F.lit(violation).alias("violation"),
                F.col(f"n{i}").alias("rows"),
            )
            for i, (column, violation, _) in enumerate(checks)
        ]
    )
    return found.unionByName(
        counted.select(F.inline(listed)).filter(F.col("rows") > 0)
    )


def by_month(df: DataFrame) -> DataFrame:
    """Add the month a row belongs to (``yyyyMM``), the coarse table layout."""
    return df.withColumn("month", F.date_format("ts", "yyyyMM"))


def write_table(
    df: DataFrame, path: str, sort: tuple[str, ...], mode: str = "append", by: str = "day"
) -> None:
    """Write rows partitioned by day and sorted inside the files.

    ``rebalance`` lets adaptive execution split a day that holds much of the data and
    merge small ones; the sort makes row-group statistics on ``ts`` selective.
    """
    keyed = df.withColumn("day", F.to_date("ts")) if by == "day" else by_month(df)
    (
        keyed.hint("rebalance", by)
        .sortWithinPartitions(by, *sort)
        .write.mode(mode)
        .partitionBy(by)
        .parquet(path)
    )


EVENT_SORT = ("ts", "platform")
ALERT_SORT = ("ts", "rule_id")


def retained(df: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """Rows that have not expired: an expiry of ts + days at ``as_of`` itself has."""
    return df.filter(F.col("ts") > before(as_of, days=days))


def apply_retention(spark: SparkSession, path: str, as_of: datetime, days: int) -> list[str]:
    """Drop expired rows of a day-partitioned table: whole days by deleting their folder,
    the boundary day by rewriting it. Returns the dropped days."""
    limit = as_of - timedelta(days=days)
    hadoop = spark._jvm.org.apache.hadoop.fs  # type: ignore[union-attr]
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # type: ignore[union-attr]
    boundary = utc_day(limit)
    dropped: list[str] = []
    has_boundary = False
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not name.startswith("day="):
            continue
        day = name[len("day="):]
        has_boundary = has_boundary or day == boundary
        if day < boundary:
            fs.delete(status.getPath(), True)
            dropped.append(day)
    if has_boundary:
        table = spark.read.parquet(path).filter(F.col("day") == F.lit(boundary).cast("date"))
        kept = retained(table, limit + timedelta(days=days), days)
        if table.count() != kept.count():
            if kept.isEmpty():
                fs.delete(hadoop.Path(path, f"day={boundary}"), True)
                dropped.append(boundary)
            else:
                # A streamed table has a folder per writer and batch below the day.
                layout = [c for c in ("day", "writer", "batch_id") if c in table.columns]
                gone = table.select(layout).distinct().subtract(kept.select(layout).distinct()).collect()
                kept.write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic"
                ).partitionBy(*layout).parquet(path)
                for row in gone:
                    fs.delete(hadoop.Path(path, "/".join(f"{c}={row[c]}" for c in layout)), True)
    return sorted(dropped)

"""Which source positions were stored already, as ranges of offsets.

A source (a topic partition, a collector host) counts its messages. What was stored of it
is a handful of ranges ``first <= offset < after``, however many messages that are. A batch
leaves out messages inside a range, so a source that goes back and delivers a stretch again
stores nothing twice, at any distance in time.

The ranges are a small table of their own, a folder per writer and batch. Each batch holds
all ranges of its writer so far. A batch that is run again starts from the one before it,
and so finds its own messages new, as it has to: it replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from authlane.operators.intervals import points_outside

RANGES = "source string, first bigint, after bigint"
# Offsets that one task orders at a time; also the width of a bin of the join.
SLICE = 1 << 16


def with_position(rows: DataFrame, position: Sequence[str]) -> DataFrame:
    """Add ``source``, all but the last column of ``position`` as text, and ``at``, the last
    one as a number. A position that is not whole has a null ``at``."""
    *source, offset = [F.col(p) for p in position]
    whole = F.lit(True)
    for c in source:
        whole = whole & c.isNotNull()
    at = F.when(whole, offset.cast("string").try_cast("bigint"))
    return rows.withColumns({"source": F.concat_ws("|", *[c.cast("string") for c in source]), "at": at})


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges (source, first, after) with those that overlap or touch made one."""
    before = Window.partitionBy("source").orderBy("first", "after").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy("source").orderBy("first", "after")
    reach = F.max("after").over(before)
    starts = ranges.where("first < after").withColumn("new", (reach.isNull() | (F.col("first") > reach)).cast("int"))
    numbered = starts.withColumn("nth", F.sum("new").over(order))
    return numbered.groupBy("source", "nth").agg(F.min("first").alias("first"), F.max("after").alias("after")).drop("nth")


def offset_ranges(rows: DataFrame) -> DataFrame:
    """The ranges that the offsets of ``rows`` (source, at) make up.

    Offsets are ordered within slices, so that a source with most of the rows is many
    tasks; only the ranges of the slices meet per source. Rows without ``at`` have no range.
    """
    sliced = rows.where("at IS NOT NULL").select("source", "at", F.floor(F.col("at") / SLICE).alias("slice"))
    order = Window.partitionBy("source", "slice").orderBy("at")
    runs = sliced.withColumn("run", F.col("at") - F.dense_rank().over(order))
    parts = runs.groupBy("source", "slice", "run").agg(F.min("at").alias("first"), (F.max("at") + 1).alias("after"))
    return merged_ranges(parts.select("source", "first", "after"))


def not_seen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """``rows`` (source, at, ...) outside all ranges of ``seen``, each position once.

    Which copy of a position stays is open, as copies of a message are equal. Rows without
    ``at`` all stay: nothing tells them apart.
    """
    own = F.when(F.col("at").isNull(), F.uuid())
    once = rows.withColumn("_own", own).dropDuplicates(["source", "at", "_own"]).drop("_own")
    # Only the part of a range that the rows span is cut into bins.
    span = rows.groupBy("source").agg(F.min("at").alias("low"), (F.max("at") + 1).alias("high"))
    near = seen.join(span, "source").select(
        "source", F.greatest("first", "low").alias("first"), F.least("after", "high").alias("after")
    )
    return points_outside(once, merged_ranges(near), ["source"], "at", "first", "after", SLICE)


def read_seen(spark: SparkSession, path: str, writer: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """(all, own): ranges stored by any writer and by this one, before batch ``batch_id`` of it."""
    try:
        rows = spark.read.schema(RANGES).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        none = spark.createDataFrame([], RANGES)
        return none, none
    mine = F.col("writer") == f"w-{writer}"
    before = rows.where(~mine | (F.col("batch_id") < batch_id))
    return merged_ranges(before), before.where(mine).select("source", "first", "after")


def write_seen(own: DataFrame, added: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Record the ranges of a stored batch; states older than the one before it go."""
    spark = own.sparkSession
    folder = f"{path}/writer=w-{writer}"
    merged_ranges(own.unionByName(added)).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    hadoop = spark._jvm.org.apache.hadoop.fs  # type: ignore[union-attr]
    root = hadoop.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # type: ignore[union-attr]
    batches = sorted(
        int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root) if s.getPath().getName().startswith("batch_id=")
    )
    for old in [b for b in batches if b < batch_id][:-1]:
        fs.delete(hadoop.Path(f"{folder}/batch_id={old}"), True)

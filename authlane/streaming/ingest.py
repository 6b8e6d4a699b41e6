"""Streaming ingest: raw lane or bus messages to the events and quarantine tables.

Delivery is at least once from the source and exactly once in the tables: a micro-batch
writes only its own ``batch_id`` partitions and replaces them when it is run again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from authlane.functions.times import as_of_col
from authlane.operators.envelope import decode_envelopes, position_id
from authlane.operators.normalize import rejected
from authlane.operators.tables import EVENT_SORT
from authlane.schema import EVENTS
from authlane.session import stream_checkpoint
from authlane.streaming.offsets import not_seen, offset_ranges, read_seen, with_position, write_seen


def writer_of(batch: DataFrame) -> str:
    """The streaming query that a micro-batch belongs to: its id, which lasts as long as its
    checkpoint does. Outside a stream it is ``direct``."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


LAYOUT = ("day", "writer", "batch_id")
# Tables whose layout this process has seen to be right.
_right: set[str] = set()


def check_layout(spark: SparkSession, path: str) -> None:
    """Refuse a table that is not laid out by day, writer and batch.

    A batch written into another layout would leave a table that no reader can open.
    ``upgrade_layout`` makes a table of today's layout from such a one.
    """
    if path in _right:
        return
    hadoop = spark._jvm.org.apache.hadoop.fs  # type: ignore[union-attr]
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # type: ignore[union-attr]

    def entries(folder: object) -> list[object]:
        visible = [s for s in fs.listStatus(folder) if not s.getPath().getName().startswith(("_", "."))]
        return sorted(visible, key=lambda s: s.getPath().getName())

    if fs.exists(root):
        below = entries(root)
        for entry in [*below, *[e for s in below[:1] + below[-1:] if s.isDirectory() for e in entries(s.getPath())]]:
            name = entry.getPath().getName()
            wanted = "day=" if entry in below else "writer="
            if not name.startswith(wanted):
                raise ValueError(f"{path} holds {name} where {wanted}... is expected: upgrade the table first")
    _right.add(path)


def upgrade_layout(spark: SparkSession, path: str, into: str, ts: datetime | None = None) -> None:
    """Copy a table of any partitioned layout to a new folder in today's layout. Rows of a
    table without a ``ts``, an old quarantine, take the given one."""
    old = spark.read.option("mergeSchema", True).parquet(path)
    if "ts" not in old.columns:
        if ts is None:
            raise ValueError(f"{path} has no ts: say which its rows are to have")
        old = old.withColumn("ts", as_of_col(ts))
    rows = old.drop(*[c for c in (*LAYOUT, "month") if c in old.columns])
    write_batch(rows, into, 0, ("ts",), writer="upgraded")


def write_batch(
    df: DataFrame, path: str, batch_id: int, sort: tuple[str, ...], writer: str | None = None
) -> None:
    """Write a micro-batch under day, writer and batch id, replacing an earlier attempt at it.

    Every stream counts its batches from 0, so the writer is part of what may be replaced:
    several lanes, or a stream with a new checkpoint, share a table without loss.
    """
    check_layout(df.sparkSession, path)
    name = F.lit(f"w-{writer or writer_of(df)}")
    (
        df.withColumns({"day": F.to_date("ts"), "writer": name, "batch_id": F.lit(batch_id)})
        .hint("rebalance", "day")
        .sortWithinPartitions(*LAYOUT, *sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAYOUT)
        .parquet(path)
    )


def write_quarantine(bad: DataFrame, path: str, batch_id: int, lane: str) -> None:
    """Append rejected records (ts, raw, reason) of a micro-batch, laid out as events are, so
    that ``apply_retention`` serves the quarantine too. ``ts`` is when the batch was read."""
    write_batch(bad.select("ts", F.lit(lane).alias("lane"), "raw", "reason"), path, batch_id, ("reason",))


def ingest_envelopes(
    lines: DataFrame,
    events_path: str,
    quarantine_path: str,
    checkpoint: str | None = None,
    position: tuple[str, ...] = (),
    trigger: dict | None = None,
    seen_path: str | None = None,
) -> StreamingQuery:
    """Decode wire envelopes (``value``) and append them; rejected ones are quarantined
    with their reason instead of being redelivered for ever.

    ``position`` names the columns that locate a message in its source; the event id is
    derived from them. With ``seen_path``, a table of the offsets stored so far, a message
    that is delivered again is left out; the last column of ``position`` is its offset.
    Streams that share the table know what the others stored before; two that read the same
    offsets at the same moment both store them.
    """
    if seen_path is not None and not position:
        raise ValueError("redelivered messages are told by their position: name its columns")
    event_id = position_id(*[F.col(p).cast("string") for p in position]) if position else F.uuid()
    # The time of a micro-batch is kept in the checkpoint: a re-run has the same.
    stamped = lines.withColumn("_read_at", F.current_timestamp())

    def store(batch: DataFrame, batch_id: int) -> None:
        writer = writer_of(batch)
        if seen_path is not None:
            seen, own = read_seen(batch.sparkSession, seen_path, writer, batch_id)
            batch = not_seen(with_position(batch, position), seen)
        decoded = decode_envelopes(batch).withColumn("event_id", event_id)
        decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = decoded.filter("reject_reason IS NULL").select(*EVENTS.names)
            write_batch(good, events_path, batch_id, EVENT_SORT, writer)
            bad = decoded.filter("reject_reason IS NOT NULL").select(
                F.col("_read_at").alias("ts"), F.col("value").alias("raw"), F.col("reject_reason").alias("reason")
            )
            write_quarantine(bad, quarantine_path, batch_id, "bus")
            if seen_path is not None:
                write_seen(own, offset_ranges(decoded), seen_path, writer, batch_id)
        finally:
            decoded.unpersist()

    return start(stamped, store, "ingest", checkpoint, trigger)


def ingest_lane(
    raw: DataFrame,
    normalize: Callable[[DataFrame], DataFrame],
    events_path: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str = "lane",
    quarantine_path: str | None = None,
    reject_reason: Column | None = None,
) -> StreamingQuery:
    """Normalize one raw lane and append its events, without a bus between.

    Records that the lane cannot use go to the quarantine with the lane's name: those with a
    ``reject_reason``, which reads the columns of ``raw`` (``normalize.generic_reject_reason()``
    and its like). Without a quarantine they are left out.
    """
    if (quarantine_path is None) != (reject_reason is None):
        raise ValueError("a quarantine needs a path and a reason")
    envelopes = normalize(raw)
    rows = envelopes.select("ts", F.uuid().alias("event_id"), *envelopes.columns[1:])
    if quarantine_path is None:
        return start(rows, lambda batch, n: write_batch(batch, events_path, n, EVENT_SORT), name, checkpoint, trigger)
    # One stream for both: a micro-batch reads the same records for either.
    bad = rejected(raw, reject_reason).withColumn("ts", F.current_timestamp())
    both = rows.unionByName(bad, allowMissingColumns=True)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(batch.filter("reason IS NULL").select(*rows.columns), events_path, batch_id, EVENT_SORT)
            write_quarantine(batch.filter("reason IS NOT NULL"), quarantine_path, batch_id, name)
        finally:
            batch.unpersist()

    return start(both, store, name, checkpoint, trigger)


def without_redelivered(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop a redelivered message by its position id, within the watermark."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def publish_json(
    envelopes: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Write normalized envelopes as JSON lines: the debug sink, or a file-based bus."""
    folder = stream_checkpoint(envelopes.sparkSession, "publish", checkpoint)
    writer = envelopes.writeStream.format("json").option("path", path)
    return writer.option("checkpointLocation", folder).trigger(
        **(trigger or {"availableNow": True})
    ).start()


def start(
    df: DataFrame,
    store: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str | None,
    trigger: dict | None,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``store`` per micro-batch, by default until the input that is there now is read."""

    def named(batch: DataFrame, batch_id: int) -> None:
        if writer_of(batch) == "direct":
            raise RuntimeError("the stream's id is not known: its batches could replace others")
        store(batch, batch_id)

    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(named)
        .option("checkpointLocation", stream_checkpoint(df.sparkSession, name, checkpoint))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

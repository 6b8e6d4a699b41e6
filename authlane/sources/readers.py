"""Where raw lanes and stored tables are read from.

Every reader takes ``stream=True`` to return a streaming DataFrame of the same shape, so
that the normalizers serve both.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from authlane.functions.times import AsOf, as_of_col, sec_text, utc_day
from authlane.operators.normalize import decode_records
from authlane.operators.tables import event_defaults, with_defaults
from authlane.schema import ALERT_DEFAULTS, ALERTS, EVENTS, NOW

# SSH log files untouched for longer are not read, in seconds.
IGNORE_OLDER_SECONDS = 86400

WINDOWS_EXPORT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "timestamp", "event_id", "user", "domain", "src_ip", "host", "logon_type",
            "auth_method", "provider_name", "raw_message", "record_id",
        )
    ]
)


# Rows that one task parses.
TASK_ROWS = 1 << 18


def spread(df: DataFrame) -> DataFrame:
    """Spread a batch read over the cores when its files give fewer tasks than that, and
    over more tasks where these would have more than ``TASK_ROWS`` rows on average.

    Parsing costs far more than moving raw rows, and one small or unsplittable compressed
    file is one task however many cores wait. Packed columns put millions of rows into a
    split, and row groups deal them unevenly, so tasks would grow with the table. A scan of
    many small splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits < cores:  # small files, whose rows need no count
        return df.repartition(cores)
    wanted = -(-df.count() // TASK_ROWS)
    return df.repartition(wanted) if splits < wanted else df


def text_lines(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).text(path)


def scenario_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """JSON-lines scenario files, from the beginning, without blank lines."""
    lines = text_lines(spark, path, stream, pathGlobFilter="*.jsonl")
    return lines.filter(F.length(F.trim("value")) > 0)


def ssh_lines(
    spark: SparkSession, path: str, stream: bool = False, modified_after: datetime | None = None
) -> DataFrame:
    """SSH auth log lines. A stream leaves out files older than a day; a batch read those
    modified before ``modified_after``."""
    if stream:
        return text_lines(spark, path, True, maxFileAge=f"{IGNORE_OLDER_SECONDS}s")
    if modified_after is None:
        return text_lines(spark, path)
    return text_lines(
        spark, path, modifiedAfter=modified_after.strftime("%Y-%m-%dT%H:%M:%S"), timeZone="UTC"
    )


def windows_export(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Exported Windows logon records with typed columns."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(WINDOWS_EXPORT).json(path)


def windows_export_records(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The same lines as ``record`` maps, as the Windows normalizer takes them."""
    return decode_records(text_lines(spark, path, stream))


def syslog_records(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Decoded syslog records (JSON lines) as ``record`` maps."""
    return decode_records(text_lines(spark, path, stream))


def forwarded_records(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Forwarded Windows records: the forwarder's tag, lane and two constant keys added."""
    records = decode_records(text_lines(spark, path, stream))
    return records.withColumn("record", forwarder_stamp(F.col("record")))


def forwarder_stamp(record: Column) -> Column:
    # What the forwarder adds to each record.
    constants = {
        "source_type": "fluent",
        "tag": "windows.events",
        "collector": "fluent-bit-windows",
        "host_collection": "windows-eventlog",
    }
    added = F.create_map(*[F.lit(x) for pair in constants.items() for x in pair])
    kept = F.map_filter(record, lambda k, _: ~k.isin(*constants))
    return F.when(record.isNotNull(), F.map_concat(kept, added))


def bus_envelopes(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest"
) -> DataFrame:
    """Envelope messages of a Kafka topic, with their source position. Needs Spark's Kafka
    connector on the classpath. Offsets in the checkpoint stand for acknowledgements."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
        .select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
    )


def stamp_scenario(lines: DataFrame, scenario: str, as_of: AsOf = None) -> DataFrame:
    """Scenario lines made current: a whole-second timestamp and a run id in each record."""
    now = as_of_col(as_of)
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    run_id = F.concat(F.date_format(now, "yyyyMMdd'T'HHmmss'Z'"), F.lit(f"-{scenario}"))
    kept = lines.filter(F.length("value") > 0)
    tail = F.concat(F.lit(',"timestamp":"'), stamp, F.lit('","run_id":"'), run_id, F.lit('"}'))
    body = F.regexp_replace("value", r"\}$", "")
    return kept.select(
        F.when(F.endswith("value", F.lit("}")), F.concat(body, tail))
        .otherwise(F.col("value"))
        .alias("value")
    )


def scan_events(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The stored events; ``since`` prunes day partitions next to the exact filter on ts."""
    return _scan(spark, path, EVENTS, event_defaults(), since)


def scan_alerts(
    spark: SparkSession, path: str, since: datetime | None = None,
    except_batch: tuple[str, int] | None = None,
) -> DataFrame:
    """The stored alerts, in today's schema whatever the age of the table. ``except_batch``
    leaves out what a writer wrote as one of its batches."""
    defaults = {name: value for name, value in ALERT_DEFAULTS.items() if value is not NOW}
    return _scan(spark, path, ALERTS, defaults, since, except_batch)


def _scan(
    spark: SparkSession, path: str, schema: T.StructType, defaults: Mapping[str, object],
    since: datetime | None, except_batch: tuple[str, int] | None = None,
) -> DataFrame:
    # The given schema spares reading footers; columns that older files lack read as NULL.
    df = spark.read.schema(schema).parquet(path)
    # Older tables name no writer: none of their batches can be told to be this one.
    if except_batch is not None and {"writer", "batch_id"} <= set(df.columns):
        writer, batch = except_batch
        df = df.filter((F.col("batch_id") != batch) | (F.col("writer") != f"w-{writer}"))
    if since is not None:
        if "day" in df.columns:
            df = df.filter(F.col("day") >= F.lit(utc_day(since)).cast("date"))
        df = df.filter(F.col("ts") >= as_of_col(since))
    return with_defaults(df, schema, defaults)


def as_rows(df: DataFrame) -> DataFrame:
    """Output encoding of the read API: one JSON object per row, times as text."""
    times = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    shown = df.withColumns({t: sec_text(F.col(t)) for t in times}) if times else df
    return shown.select(F.to_json(F.struct(*df.columns)).alias("value"))

"""Session settings the jobs rely on, and where checkpoints go."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings only: safe to apply to a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8000 bytes. A stage that fuses a wide
    # projection into one such method would be interpreted row by row; this lets it fall
    # back to per-operator generated code, which is split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A JSON object that repeats a key keeps the last value instead of failing to parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def stream_checkpoint(spark: SparkSession, name: str, given: str | None = None) -> str:
    """Checkpoint folder of a stream: the given one, or one under the shared folder."""
    return given or f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    ``fallback`` is for tests on one machine, where the setting is absent.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set and no fallback folder was given")
    return fallback

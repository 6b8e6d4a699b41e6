"""What the operators share: tables, scratch tables, words, and adding columns."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authlane.session import checkpoint_root

# White space of every operator here: blank, tab, line feed, vertical tab, form feed, return.
SPACE = " \t\n\x0b\x0c\r"
SPACES = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine may leave the setting out; it then gets a temporary folder.
    """
    try:
        root = checkpoint_root(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        root = tempfile.mkdtemp(prefix="authlane-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm/{uuid.uuid4().hex}"


# Spark otherwise keeps a query's shuffle files until the driver's garbage collector gets to
# its plan, long after the table made from them is on shared storage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str) -> None:
    """Write the rows and give back the disk that the exchanges took. Later readers read the
    table and never these files; a retried stage inside the write still finds them."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once as a table and read from there.

    Cuts the lineage at shared storage: a lost executor costs the tasks it ran, and later
    readers neither repeat the work nor depend on files of one machine.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a few numbers that one task takes where tables are small.
TASK_ROWS = 1 << 16


def packed(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many tasks as its ``rows`` need, ``TASK_ROWS`` each, and no more than it has.

    What is written from it has as many files: those of a small table are not mostly
    footers, so that a join can broadcast it. Steps on a single task's rows need no exchange.
    """
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def repacked(table: DataFrame) -> DataFrame:
    """A written table of a few numbers a row as ``packed``; counting it reads file footers alone."""
    return packed(table, table.count())


def with_added(df: DataFrame, **added: Column) -> DataFrame:
    """``df`` with columns added; an input column of the same name gives way."""
    return df.select(*[df[c] for c in df.columns if c not in added], *[c.alias(n) for n, c in added.items()])


def lowered(text: Column) -> Column:
    """Lower case of A to Z alone."""
    return F.translate(text, UPPER, LOWER)


def unit_draw(*key: Column) -> Column:
    """A number in (0, 1) that the key decides: 52 bits of its hash, never 0 or 1."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 12).cast("double") + 0.5) / F.lit(float(2**52))


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per Spark context.

    Operators with Python tasks call it, so that they also run where the package is only
    installed beside the driver.
    """
    context = spark.sparkContext
    if getattr(context, "_authlane_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="authlane-package-")) / "authlane.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._authlane_shipped = True

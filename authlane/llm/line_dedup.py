"""Line dedup: lines that many documents share stay only where they come first.

Every line's normalised key is hashed, documents are counted per hash, and the positions of
surplus lines go back to their documents, which are put together again from what is left.
Texts cross one exchange; keys travel as 16 bytes. A line that a third of all documents
hold is summed up before the exchange and, in the join, split by adaptive execution.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane.functions.plan import computed_once
from authlane.llm.common import SPACE, lowered


def bare_line(line: Column) -> Column:
    """A line without white space at its ends. Only a line that has some there is read for it."""
    blank = [test(line, F.lit(c)) for c in SPACE for test in (F.startswith, F.endswith)]
    return F.when(reduce(or_, blank), F.btrim(line, F.lit(SPACE))).otherwise(line)


def line_key(bare: Column) -> Column:
    """A bare line with A to Z in lower case; ASCII alone takes Spark's own, faster lower case."""
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(lowered(bare))


def surplus_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """(doc_id, text_hash, positions): lines to drop, for documents that have any.

    A key counts when it has at least ``min_chars`` code points and at least ``min_docs``
    different doc_ids hold it. The smallest of them keeps its lines.
    """
    # The hash of a text is made before its lines, which would each carry the text for it.
    hashed = computed_once(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), text_hash=F.xxhash64("text"))
    lines = hashed.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    bare = computed_once(lines, bare=bare_line(F.col("line")))
    # Lower case keeps the number of code points: short lines go before it.
    long = bare.where(F.char_length("bare") >= min_chars)
    keys = long.select("doc_id", "text_hash", "pos", F.unhex(F.md5(line_key(F.col("bare")))).alias("hash"))
    holders = F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")
    if min_docs == 2:  # two holders differ: no need to count them
        shared = keys.groupBy("hash").agg(*holders).where("last > keeper")
    else:
        counted = keys.groupBy("hash").agg(*holders, F.count_distinct("doc_id").alias("n_docs"))
        shared = counted.where(F.col("n_docs") >= min_docs)
    surplus = keys.join(shared.select("hash", "keeper"), "hash").where("doc_id > keeper")
    return surplus.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("positions"))


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """All rows of ``docs`` with ``text`` less its surplus lines, and n_lines, n_dropped.

    A null text counts as an empty one and stays null when nothing is dropped from it; an
    empty text is one empty line. Rows without doc_id keep all lines and count for nobody;
    rows that repeat a doc_id are one document. Columns of the input named n_lines or
    n_dropped give way. An empty table gives an empty table.
    """
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    whole = docs.select(F.struct(*others).alias("row"), "doc_id", "text")
    found = surplus_lines(whole.withColumn("text", F.coalesce("text", F.lit(""))), min_docs, min_chars)
    hashed = whole.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = hashed.join(found, ["doc_id", "text_hash"], "left")
    # A generator column: the lambda below must not split the text once per line. Only a
    # text that loses lines is split.
    some = F.col("positions").isNotNull()
    split = computed_once(joined, lines=F.when(some, F.split("text", "\n", -1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("positions"))
    left = F.array_join(F.transform(kept, lambda p: F.get(F.col("lines"), p)), "\n")
    n_lines = 1 + F.coalesce(F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))), F.lit(0))
    text = F.when(some, left).otherwise(F.col("text")).alias("text")
    n_dropped = F.when(some, F.size("positions")).otherwise(0)
    own = [text if c == "text" else F.col(f"row.{c}") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return split.select(*own, n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"))

"""A document table through filtering, dedup, mixing and packing, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authlane.llm.common import table, written
from authlane.llm.jaccard_join import Similarity, near_duplicates
from authlane.llm.line_dedup import dedup_lines
from authlane.llm.mixing import mixed_documents
from authlane.llm.packing import pack
from authlane.llm.toxicity import toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Looser than the query op5: five words to a shingle, and four fifths of them shared.
NEAR = Similarity(words=5, percent=80)


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic."""
    return toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 0").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that an earlier document holds; a text that this leaves blank goes."""
    kept = dedup_lines(docs).where("n_dropped = 0 OR text RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'")
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row: the one with the smallest id.

    Texts are judged one by one, so another text under the same id is another member: of two
    the one with the smaller hash goes first. Rows without id come last, and one stays where
    no row of the group has an id. Of rows that repeat both id and text the least one by its
    other columns stays. Documents without words are no near duplicates of anything, and all
    stay, repeated ones too. An empty table gives an empty one; other columns are left out.
    """
    found = written(near_duplicates(docs, NEAR).where("n_shingles > 0"), "near")
    order = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "text_hash")
    first = found.groupBy("grp").agg(F.min(order).alias("first"))
    rows = found.groupBy("grp", "doc_id", "text_hash").agg(F.count("*").alias("copies")).join(first, "grp")
    stays = order == F.col("first")
    # Most texts are the only ones of their kind and need no verdict.
    judged = rows.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), stays.alias("stays"), "copies")
    judged = written(judged.where("NOT stays OR copies > 1"), "judged")
    own = docs.select(*COLUMNS)
    same = own["doc_id"].eqNullSafe(judged["id"]) & (F.xxhash64(own["text"]) == judged["hash"])
    single = own.join(judged, same, "left_anti")
    again = own.join(judged.where("stays"), same).groupBy("id", "hash").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return single.unionByName(again.select("row.*"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixed_documents(docs).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in the training sequences."""
    return pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_filter),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

# Learned scores, sampling draws and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written and read again by the next."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i}")
    return docs

"""Odd rows, clashing columns and empty tables through every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter
from llm_rows import ODD
from pyspark.sql import functions as F

from authlane.llm.common import CLEANUP, write_table
from authlane.llm.class_lm import score_documents
from authlane.llm.fingerprints import fingerprints
from authlane.llm.jaccard_join import near_duplicates
from authlane.llm.language_id import identify
from authlane.llm.line_dedup import dedup_lines
from authlane.llm.mixing import mix, mixed_documents
from authlane.llm.packing import pack
from authlane.llm.sharding import ShardTree, shard_documents
from authlane.llm.toxicity import toxicity
from authlane.llm.wand_search import search


def _toxicity(docs):
    labels = docs.sparkSession.createDataFrame([(1, None, 1), (3, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    return toxicity(docs, labels)


def _identify(docs):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"))
    return identify(pages, docs)


PER_ROW = {
    "line_dedup": dedup_lines,
    "sharding": lambda d: shard_documents(d, ShardTree(24)),
    "mixing": mix,
    "fingerprints": fingerprints,
    "jaccard": near_duplicates,
    "class_lm": score_documents,
    "toxicity": _toxicity,
    "language_id": _identify,
}
OTHERS = {"packing": pack, "search": lambda d: search(d, d), "mixed_documents": mixed_documents}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_a_row_per_document(clashing, name):
    found = PER_ROW[name](clashing).toPandas()
    key = "page_id" if name == "language_id" else "doc_id"
    assert sorted(found[key].fillna(-1)) == sorted(-1 if r[0] is None else r[0] for r in ODD)


@pytest.mark.parametrize("name", sorted(PER_ROW | OTHERS))
def test_empty_table(odd, name):
    assert (PER_ROW | OTHERS)[name](odd.limit(0)).count() == 0


def test_odd_rows_are_packed_whole(clashing):
    found = pack(clashing).toPandas()
    whole = found.groupby(found.doc_id.fillna(-1)).length.sum()
    repeats = {7: 2}
    for doc_id, total in whole.items():
        tokens = found[found.doc_id.fillna(-1) == doc_id].doc_tokens.iloc[0]
        assert total == tokens * repeats.get(doc_id, 1)


def test_odd_rows_are_found(clashing):
    found = search(clashing, clashing.where("doc_id >= 0")).toPandas()
    assert set(found.query_id) == {3, 4, 5, 6, 7, 8, 9}
    assert (found[found["rank"] == 1].set_index("query_id").doc_id.loc[[3, 4, 5, 6, 7, 9]].to_list()) == [3, 4, 5, 6, 7, 9]


def test_a_written_table_leaves_no_shuffle_files(spark, monkeypatch):
    """Files of exchanges would else stay until the driver collects garbage."""
    seen = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: seen.append(spark.conf.get(CLEANUP)))
    before = spark.conf.get(CLEANUP, "false")
    write_table(spark.range(3), "nowhere")
    assert seen == ["true"] and spark.conf.get(CLEANUP) == before

from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from llm_rows import ODD  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts; ids count from 0 unless pairs (id, text) or (id, text, source) are given."""

    def make(*rows):
        full = []
        for i, r in enumerate(rows):
            doc_id, text, source = (i, r, "s") if r is None or isinstance(r, str) else (*r, "s")[:3]
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(*ODD)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    names = "cls key slice shard size n hash pos lines positions words rank bucket target score row token copies".split()
    return odd.select("*", *[F.lit("x").alias(n) for n in names])

"""Language identification of pages by Bayesian fusion of evidence.

The evidence is the text (letter trigrams, counted per language over all documents), the
language the markup declares, the suffixes of the address (the last label of the host and
the first folder of the path), and the host. What a declaration or a suffix is worth, and
what a host usually writes, is learned from the pages themselves: every page spreads one
count over the languages its text speaks for, and grouped sums of these give the tables.
A host's prior is smoothed by its domain's, a domain's by that of all pages.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane.llm.common import ship, written
from authlane.llm.words import LETTERS, VALUES, mixed, words_of

BUCKETS = 1 << 16
# Visible text that is the page's own: scripts, navigation, advertisements and footers go.
_DROPPED = re.compile(
    r"<!--.*?-->|<(script|style|nav|footer|noscript)\b.*?</\1\s*>|<div[^>]*class=\"?ad\b.*?</div>", re.S | re.I
)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})"


@dataclass(frozen=True)
class Fusion:
    """Strengths: trigrams a text counts for at most, pseudo-counts of tables and host levels."""

    trigrams: float = 30.0
    table: float = 2.0
    host: float = 5.0
    domain: float = 20.0
    floor: float = 1e-6


def page_text(html: str | None) -> str:
    """A page's own visible text; a null or broken page gives what can be read of it."""
    return entities.unescape(_TAG.sub(" ", _DROPPED.sub(" ", html or "")))


def _trigrams(words) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the letter trigrams of all words, with the borders of words."""
    inside = np.zeros(len(words.data) + 2, dtype=np.uint64)
    for_letters = LETTERS[words.data]
    inside[1:-1] = np.where(for_letters, VALUES[words.data], np.uint64(1))
    three = mixed(inside[:-2] + inside[1:-1] * np.uint64(31) + inside[2:] * np.uint64(961)) % np.uint64(BUCKETS)
    length = words.ends - words.starts
    at = np.repeat(words.starts - np.cumsum(np.append(0, length[:-1])), length) + np.arange(length.sum())
    return np.repeat(words.text_of(), length), three[at].astype(np.int64)


def trigram_counts(documents: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all documents with a language and a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, names = np.unique(np.array(batch.column(0).to_pylist(), dtype=str), return_inverse=True)
            found: dict[int, np.ndarray] = {}
            for words in words_of(batch.column(1), LETTERS):
                text, bucket = _trigrams(words)
                code = names[words.first + text] * BUCKETS + bucket
                keys, n = np.unique(code, return_counts=True)
                for i in np.unique(keys // BUCKETS):
                    sums = found.setdefault(int(i), np.zeros(BUCKETS, dtype=np.int64))
                    mine = keys // BUCKETS == i
                    sums[keys[mine] % BUCKETS] += n[mine]
            for i, sums in found.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([str(lang[i])] * len(at)), pa.array(at), pa.array(sums[at])], ["lang", "bucket", "n"]
                )

    rows = documents.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = rows.mapInArrow(count, "lang string, bucket bigint, n bigint")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def trigram_model(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of every bucket in each); a bounded table per language."""
    rows = trigram_counts(documents).collect()
    langs = sorted({r.lang for r in rows})
    table = np.full((BUCKETS, max(1, len(langs))), 0.5)
    place = {name: i for i, name in enumerate(langs)}
    for r in rows:
        table[r.bucket, place[r.lang]] += r.n
    return langs, np.log(table / table.sum(axis=0))


def text_evidence(pages: DataFrame, model: np.ndarray, langs: list[str], f: Fusion) -> DataFrame:
    """(page_id, host, domain, suffix, folder, declared, ll): log likelihoods of a page's text.

    A text of many trigrams counts as one of ``f.trigrams``: neighbours are not independent.
    """

    def read(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            own = pa.array([page_text(h) for h in column.to_pylist()], pa.string())
            out = []
            for words in words_of(own, LETTERS):
                n = words.last - words.first
                text, bucket = _trigrams(words)
                sums = np.stack([np.bincount(text, weights=model[bucket, i], minlength=n) for i in range(len(langs))], axis=1)
                count = np.bincount(text, minlength=n)
                out.append(sums * np.minimum(1.0, f.trigrams / np.maximum(count, 1))[:, None])
            rows = np.concatenate(out) if out else np.zeros((0, len(langs)))
            ends = np.arange(len(rows) + 1, dtype=np.int32) * len(langs)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))

    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1), F.lit("")))
    labels = F.split(host, "\\.")
    place = lambda c: F.coalesce(c, F.lit(""))
    return pages.select(
        "page_id",
        host.alias("host"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"),
        F.element_at(labels, -1).alias("suffix"),
        place(F.lower(F.regexp_extract("url", r"^[^/]*//[^/]+/([A-Za-z]{2,3})(?:[/?#-]|$)", 1))).alias("folder"),
        place(F.lower(F.regexp_extract("html", _DECLARED, 1))).alias("declared"),
        F.arrow_udf(read, "array<double>")("html").alias("ll"),
    )


def _normal(logs: Column) -> Column:
    """Probabilities from an array of log weights."""
    top = F.array_max(logs)
    raw = F.transform(F.array(F.transform(logs, lambda x: F.exp(x - top))), lambda e: F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda a, x: a + x).alias("s")))
    return F.transform(F.element_at(raw, 1)["e"], lambda x: x / F.element_at(raw, 1)["s"])


def _sums(rows: DataFrame, key: str, k: int) -> DataFrame:
    """(key, name_counts): the pages' shares per language, summed by key."""
    return rows.groupBy(key).agg(F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(k)]).alias(f"{key}_n"))


def identify(pages: DataFrame, documents: DataFrame, f: Fusion = Fusion()) -> DataFrame:
    """Per page: page_id, lang, posterior, text_lang, declared.

    ``posterior`` is the probability of ``lang`` given all evidence; ties go to the language
    first in order. Null urls and pages count as empty: what they lack is no evidence. Rows
    that repeat a page_id are pages of their own. Without documents that name a language all
    results are null. An empty table gives no rows; other columns do not matter.
    """
    ship(pages.sparkSession)
    langs, model = trigram_model(documents)
    if not langs:
        none = F.lit(None).cast("string")
        return pages.select("page_id", none.alias("lang"), F.lit(None).cast("double").alias("posterior"), none.alias("text_lang"), none.alias("declared"))
    k = len(langs)
    rows = text_evidence(pages, model, langs, f)
    rows = written(rows.withColumn("p", _normal(F.col("ll"))), "evidence")

    total = rows.agg(F.array(*[F.sum(F.get("p", F.lit(i))) for i in range(k)]).alias("n")).first()["n"]
    total = np.array([x or 0.0 for x in total]) + 1.0
    every = F.array(*[F.lit(float(x)) for x in total / total.sum()])
    per_lang = F.array(*[F.lit(float(x)) for x in total])
    smooth = lambda n, prior, strength: F.zip_with(
        n, prior, lambda a, b: (a + strength * b) / (F.aggregate(n, F.lit(0.0), lambda s, x: s + x) + strength)
    )
    # A page's own text is left out of its host's and domain's sums: it is counted already.
    less = lambda n: F.zip_with(n, "p", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    for key in ("host", "domain"):
        rows = rows.join(_sums(rows.select(key, "p"), key, k), key)
    rows = rows.withColumn("by_domain", smooth(less(F.col("domain_n")), every, f.domain))
    rows = rows.withColumn("prior", smooth(less(F.col("host_n")), F.col("by_domain"), f.host))
    logs = F.zip_with("ll", "prior", lambda a, b: a + F.log(b + f.floor))
    for key in ("declared", "suffix", "folder"):
        sums = _sums(rows.select(key, "p"), key, k)
        # Languages and folders have two or three letters: at most 26**2 + 26**3 values.
        rows = rows.join(sums if key == "suffix" else F.broadcast(sums), key)
        # P(value | language), smoothed towards the value's share over all languages.
        share = F.aggregate(F.col(f"{key}_n"), F.lit(0.0), lambda s, x: s + x) / float(total.sum())
        given = F.zip_with(less(F.col(f"{key}_n")), per_lang, lambda n, t: F.log((n + f.table * share) / (t + f.table)))
        logs = F.when(F.col(key) == "", logs).otherwise(F.zip_with(logs, given, lambda a, b: a + b))
    fused = rows.withColumn("post", _normal(logs))
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    return fused.select(
        "page_id", best(F.col("post")).alias("lang"), F.array_max("post").alias("posterior"), best(F.col("p")).alias("text_lang"), "declared"
    )

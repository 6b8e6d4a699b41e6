"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Terms that go with toxic labels are mined from a bounded sample of labelled rows. They
make lexicon voters (whole words) and pattern voters (beginnings of words); further pattern
voters look at the form of a text. The votes of *all* documents, counted per vote pattern,
are what the label model sees: expectation maximisation estimates how often each voter
fires on toxic and on clean texts, and how voters hang together within both; correlated
voters share their weight. A logistic regression over the terms, trained on the model's
posterior labels, gives the score, so a text counts by all its terms and not by 16 votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlane.llm.common import ship, with_added, written
from authlane.llm.words import LETTERS, Words, mixed, shingles, words_of

# Kinds of terms: 0 for whole words, else beginnings of so many bytes. The two lowest bits of
# a term are its kind's place here.
KINDS = (0, 4, 5, 6)
LEXICON_VOTERS, PATTERN_VOTERS, FORM_VOTERS = 6, 6, 4
SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89], dtype=np.uint64)
VOTERS = LEXICON_VOTERS + PATTERN_VOTERS + FORM_VOTERS


@dataclass(frozen=True)
class Training:
    """Bounds and rates of the training; the classifier is fitted on at most ``rows`` rows."""

    rows: int = 20_000
    terms: int = 2048
    # A term needs so many toxic texts, so large a part of its texts toxic, and so much
    # evidence (log likelihood ratio, nats) against having no more than the usual part.
    support: int = 4
    precision: float = 0.5
    evidence: float = 9.0
    steps: int = 300
    ridge: float = 1e-3
    threshold: float = 0.3


@dataclass(frozen=True)
class Classifier:
    """Weights of terms, sorted by term."""

    terms: np.ndarray
    weights: np.ndarray
    bias: float


def remainder(doc_id: str = "doc_id", parts: int = 4) -> Column:
    """crc32 of the id as text, modulo the number of parts."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def _kind(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (hashes & ~np.uint64(3) | np.uint64(KINDS.index(kind))).view(np.int64)


def _chunk_terms(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, terms, text numbers) of all words of a chunk."""
    text = words.text_of()
    length = words.ends - words.starts
    for kind in KINDS:
        if kind == 0:
            yield kind, _kind(words.hashes, 0), text
        else:
            ends = np.minimum(words.starts + kind, words.ends)
            long = length >= kind
            yield kind, _kind(words.upto(ends), kind)[long], text[long]


def _known(words: Words, known: np.ndarray) -> np.ndarray:
    """The different (text, index of known term) of a chunk, as text * len(known) + index."""
    found = []
    for _, terms, text in _chunk_terms(words):
        at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
        hit = known[at] == terms
        found.append(text[hit] * len(known) + at[hit])
    return np.unique(np.concatenate(found))


def labelled_terms(docs: DataFrame, labels: DataFrame, train: Training) -> DataFrame:
    """(doc_id, toxic, terms) of the training sample: the labelled rows of least hash.

    Rows whose crc32 remainder is 2 are held out. Of near copies one stays, or terms that
    are theirs alone would look like evidence: a text goes if one of four min-hashes of its
    word shingles is that of a text with a smaller id.
    """
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(remainder() != 2)
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["doc_id"])
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train.rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column(2), LETTERS):
                terms = [(t, x) for _, t, x in _chunk_terms(words)]
                term, text = (np.concatenate(c) for c in zip(*terms))
                order = np.lexsort((term, text))
                term, text = term[order], text[order]
                new = np.ones(len(term), dtype=bool)
                new[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
                term, text = term[new], text[new]
                n = words.last - words.first
                ends = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
                leasts = [
                    [int(mixed(s ^ SEEDS[i]).min().view(np.int64)) if len(s) else -1 - i for i in range(len(SEEDS))]
                    for s in shingles(words, 4)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[words.first : words.last],
                        batch.column(1)[words.first : words.last],
                        pa.array(leasts, pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(term, pa.int64())),
                    ],
                    ["doc_id", "toxic", "leasts", "terms"],
                )

    # The sample is bounded by a parameter, and two numbers a row.
    rows = docs.join(F.broadcast(sample), "doc_id").select(F.col("doc_id").cast("long"), "toxic", "text")
    found = written(rows.mapInArrow(read, "doc_id bigint, toxic int, leasts array<bigint>, terms array<bigint>"), "terms")
    hashes = found.select("doc_id", F.posexplode("leasts").alias("i", "least"))
    first = hashes.groupBy("i", "least").agg(F.min("doc_id").alias("first"))
    copies = hashes.join(first, ["i", "least"]).where("first < doc_id").select("doc_id").distinct()
    return found.join(F.broadcast(copies), "doc_id", "left_anti").select("doc_id", "toxic", "terms")


def mine(sample: DataFrame, train: Training) -> list[tuple[int, int, int]]:
    """(term, toxic texts, clean texts) of the terms that speak for a toxic text, best first."""
    sides = sample.select("toxic", F.explode("terms").alias("term")).groupBy("term")
    counts = sides.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    good = counts.where((F.col("t") >= train.support) & (F.col("t") >= train.precision * (F.col("t") + F.col("c"))))
    rate = sample.agg(F.avg("toxic").alias("rate")).first()["rate"] or 0.0
    part = F.col("t") / (F.col("t") + F.col("c"))
    clean = F.when(F.col("c") > 0, F.col("c") * F.log((1 - part) / (1 - rate))).otherwise(0.0)
    gain = F.col("t") * F.log(part / max(rate, 1e-6)) + clean
    good = good.withColumn("gain", gain).where(F.col("gain") >= train.evidence).orderBy(F.desc("gain"), "term")
    return [(r.term, r.t, r.c) for r in good.limit(train.terms).collect()]


def _form_votes(data: np.ndarray, words: Words) -> list[np.ndarray]:
    """Votes on the form of texts: shouting, exclamations, masked letters, clean and long."""
    n = words.last - words.first
    text = words.text_of()
    upper = (data >= 65) & (data <= 90)
    ups = np.concatenate([[0], np.cumsum(upper)])
    loud = (ups[words.ends] - ups[words.starts] == words.ends - words.starts) & (words.ends - words.starts >= 3)
    shouted = np.bincount(text[loud], minlength=n) >= 3
    gaps = words.starts[1:] - words.ends[:-1]
    after = data[np.minimum(words.ends[:-1], len(data) - 1)] if len(words.ends) else data[:0]
    same = text[1:] == text[:-1]
    exclaimed = np.bincount(text[:-1][same & (after == 33) & (gaps >= 3)], minlength=n) > 0
    masked = np.bincount(text[:-1][same & (after == 42)], minlength=n) > 0
    return [shouted, exclaimed, masked, np.bincount(text, minlength=n) >= 20]


def vote_patterns(docs: DataFrame, voters: list[np.ndarray]) -> DataFrame:
    """(pattern, n): how many documents cast which votes, one bit per voter. At most 2**16 rows."""
    known = np.unique(np.concatenate(voters))
    member = np.zeros((len(known), len(voters)), dtype=bool)
    for i, terms in enumerate(voters):
        member[np.searchsorted(known, terms), i] = True

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column(0), LETTERS):
                n = words.last - words.first
                votes = np.zeros((n, VOTERS), dtype=bool)
                hits = _known(words, known)
                np.logical_or.at(votes[:, : len(voters)], hits // len(known), member[hits % len(known)])
                forms = _form_votes(words.data, words)
                fired = votes[:, : len(voters)].any(axis=1)
                forms[3] = forms[3] & ~fired  # a long text without any term speaks for clean
                votes[:, VOTERS - FORM_VOTERS :] = np.stack(forms, axis=1)
                pattern, count = np.unique(votes @ (1 << np.arange(VOTERS)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pattern, pa.int64()), pa.array(count, pa.int64())], ["pattern", "n"])

    return docs.select("text").mapInArrow(read, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class LabelModel:
    """Voters' firing rates on toxic and clean texts, weights by correlation, and the prior."""

    toxic: np.ndarray
    clean: np.ndarray
    weight: np.ndarray
    prior: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability that texts with these votes are toxic."""
        votes = (patterns[:, None] >> np.arange(VOTERS)) & 1 == 1
        fires, rests = np.log(self.toxic / self.clean), np.log((1 - self.toxic) / (1 - self.clean))
        odds = np.log(self.prior / (1 - self.prior)) + np.where(votes, fires, rests) @ self.weight
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, prior: float, steps: int = 40) -> LabelModel:
    """Expectation maximisation over vote patterns, for dependent voters.

    A voter weighs 1 / (1 + the sum of its positive correlations with others within the
    classes), so that voters that always fire together count as one.
    """
    votes = ((patterns[:, None] >> np.arange(VOTERS)) & 1).astype(float)
    speaks = np.arange(VOTERS) < VOTERS - 1  # the last voter speaks for clean
    rate = (counts @ votes) / counts.sum()
    toxic = np.where(speaks, 0.5, 0.05)
    model = LabelModel(toxic, np.clip(np.where(speaks, rate / 10, rate), 1e-4, 0.99), np.ones(VOTERS) / 2, prior)
    for _ in range(steps):
        p = model.posterior(patterns)
        sides = []
        weight_sum = np.zeros((VOTERS, VOTERS))
        for part in (p, 1 - p):
            w = counts * part
            total = w.sum() + 1e-9
            mean = (w @ votes + 0.5) / (total + 1)
            spread = votes - mean
            cov = (spread * w[:, None]).T @ spread / total
            scale = np.sqrt(np.outer(np.diag(cov), np.diag(cov))) + 1e-9
            weight_sum += np.clip(cov / scale, 0, 1) * total
            sides.append(np.clip(mean, 1e-5, 1 - 1e-5))
        correlation = weight_sum / counts.sum()
        np.fill_diagonal(correlation, 0)
        model = LabelModel(sides[0], sides[1], 1 / (1 + correlation.sum(axis=1)), prior)
    return model


def fit_classifier(rows: list[np.ndarray], target: np.ndarray, terms: np.ndarray, train: Training) -> Classifier:
    """Logistic regression on soft labels by accelerated gradient steps; rows hold term indices."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    w, b = np.zeros(len(terms)), float(np.log(target.mean() / (1 - target.mean())))
    prev_w, prev_b, rate = w, b, 8.0 / max(1.0, np.sqrt(max((len(r) for r in rows), default=1)))
    for step in range(train.steps):
        ahead = step / (step + 3)
        at_w, at_b = w + ahead * (w - prev_w), b + ahead * (b - prev_b)
        odds = np.bincount(row, weights=at_w[column], minlength=len(rows)) + at_b
        miss = 1 / (1 + np.exp(-odds)) - target
        prev_w, prev_b = w, b
        w = at_w - rate * (np.bincount(column, weights=miss[row], minlength=len(terms)) / len(rows) + train.ridge * at_w / 10)
        b = at_b - rate * miss.mean()
    return Classifier(terms, w, b)


def train_classifier(docs: DataFrame, labels: DataFrame, train: Training) -> Classifier | None:
    """The classifier, or None when no toxic row is there to learn from."""
    sample = written(labelled_terms(docs, labels, train), "sample")
    mined = mine(sample, train)
    if not mined:
        return None
    ranked = np.array([t for t, _, _ in mined], dtype=np.int64)
    words, patterns = ranked[ranked & 3 == 0], ranked[ranked & 3 != 0]
    voters = [np.sort(words[i::LEXICON_VOTERS]) for i in range(LEXICON_VOTERS)]
    voters += [np.sort(patterns[i::PATTERN_VOTERS]) for i in range(PATTERN_VOTERS)]
    histogram = vote_patterns(docs, voters).collect()
    votes = np.array([r.pattern for r in histogram], dtype=np.int64)
    counts = np.array([r.n for r in histogram], dtype=float)
    seen = sample.agg(F.avg("toxic").alias("rate"), F.count("*").alias("n")).first()
    prior = (seen.rate * seen.n + 1) / (seen.n + 2)
    model = fit_label_model(votes, counts, prior)

    terms = np.sort(ranked)
    bounded = sample.orderBy("doc_id").select(F.array_intersect("terms", F.lit(ranked.tolist())).alias("terms"))
    rows = [np.searchsorted(terms, np.array(r.terms, dtype=np.int64)) for r in bounded.toLocalIterator()]
    bit = {int(t): i for i, v in enumerate(voters) for t in v}
    clean_bit = 1 << (VOTERS - 1)
    pattern = [sum({1 << bit[int(terms[i])] for i in r}) or clean_bit for r in rows]
    return fit_classifier(rows, model.posterior(np.array(pattern, dtype=np.int64)), terms, train)


def toxicity(docs: DataFrame, labels: DataFrame, train: Training = Training()) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 from the threshold on).

    Labels of held-out rows (crc32 of the id modulo 4 is 2) are never read; label, language,
    source and id are no inputs of a score. Null and empty texts get the score of a text
    without terms. Without toxic training rows every score is 0. Repeated rows get equal
    scores; a null doc_id is not held out and not trained on. An input column named held_out,
    score or predicted gives way. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    model = train_classifier(docs, labels, train)

    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            out = []
            for words in words_of(column, LETTERS):
                n = words.last - words.first
                hits = _known(words, model.terms)
                sums = np.bincount(hits // len(model.terms), weights=model.weights[hits % len(model.terms)], minlength=n)
                out.append(1 / (1 + np.exp(-np.clip(sums + model.bias, -40, 40))))
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    score = F.lit(0.0) if model is None else F.arrow_udf(scored, "double")("text")
    held = F.coalesce(remainder() == 2, F.lit(False))
    # The predicate on the score must not run the model twice.
    first = with_added(docs, score=score, held_out=held)
    return with_added(first, predicted=(F.col("score") >= train.threshold).cast("int"))

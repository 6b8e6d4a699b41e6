"""LM scoring by a class-based bigram model with exchange clustering.

A word's probability is that of its class after the class before, times its own within its
class. Exchange clustering assigns the classes: frequent words are symbols of their own, all
other words share symbols by their ending, and every round moves symbols to the class that
raises the likelihood of the corpus most. Everything is counted over all training rows. The
symbols are bounded by the share of tokens that makes a word frequent; the table of symbol
pairs and the table of word counts are not, and stay distributed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authlane.llm.common import ship, written
from authlane.llm.words import VALUES, Words, mixed, words_of


@dataclass(frozen=True)
class Brown:
    """Sizes of the model. A word with so large a share of tokens ...

    ``symbol``: ... is a symbol of its own (at most 1 / symbol words); ``common``: ... is
    looked up in a broadcast array (at most 1 / common words, 16 bytes each) and not joined.
    """

    classes: int = 64
    symbol: float = 5e-5
    common: float = 2e-6
    endings: int = 512
    rounds: int = 6
    parts: int = 4
    smoothing: float = 0.5


def trains(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 != 2, F.lit(True))


def _ending(words: Words, endings: int) -> np.ndarray:
    """A number for the last two bytes of every word."""
    last = VALUES[words.data[words.ends - 1]]
    second = np.where(words.ends - words.starts > 1, VALUES[words.data[np.maximum(words.ends - 2, 0)]], 0).astype(np.uint64)
    return (mixed(last + second * np.uint64(31)) % np.uint64(endings)).astype(np.int64)


def word_counts(texts: DataFrame, m: Brown) -> DataFrame:
    """(word, ending, n) over all words; each task sums up before the exchange."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for words in words_of(batch.column(0)):
                word, at, n = np.unique(words.hashes.view(np.int64), return_index=True, return_counts=True)
                parts.append((word, _ending(words, m.endings)[at], n))
            word, ending, n = (np.concatenate(c) for c in zip(*parts)) if parts else [np.zeros(0, dtype=np.int64)] * 3
            word, at, back = np.unique(word, return_index=True, return_inverse=True)
            n = np.bincount(back, weights=n, minlength=len(word)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(ending[at]), pa.array(n)], ["word", "ending", "n"])

    counted = texts.select("text").mapInArrow(count, "word bigint, ending bigint, n bigint")
    return counted.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


class Symbols:
    """Frequent words, sorted, then the endings of all others, then the end of a text."""

    def __init__(self, words: np.ndarray, endings: int):
        self.words, self.endings = words, endings
        self.end = len(words) + endings
        self.size = self.end + 1

    def of(self, words: Words) -> np.ndarray:
        h = words.hashes.view(np.int64)
        rest = len(self.words) + _ending(words, self.endings)
        if not len(self.words):
            return rest
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, at, rest)

    def sequence(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts of a chunk, an end before the first and after each; text bounds.

        Text i has its words and its end at bounds[i] + 1 to bounds[i + 1].
        """
        n = words.last - words.first
        bounds = words.bounds + np.arange(n + 1)
        out = np.full(int(bounds[-1]) + 1, self.end, dtype=np.int64)
        out[np.arange(len(words.hashes)) + words.text_of() + 1] = self.of(words)
        return out, bounds


def symbol_pairs(texts: DataFrame, symbols: Symbols) -> DataFrame:
    """(prev, cur, n): how often one symbol follows another, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for words in words_of(batch.column(0)):
                s, _ = symbols.sequence(words)
                found.append(s[:-1] * symbols.size + s[1:])
            pair, n = np.unique(np.concatenate(found) if found else np.zeros(0, dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], ["pair", "n"])

    pairs = texts.select("text").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    prev = F.floor(F.col("pair") / symbols.size).cast("int")
    return pairs.select(prev.alias("prev"), (F.col("pair") % symbols.size).cast("int").alias("cur"), "n")


def _gain(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _lookup(pairs: DataFrame, classes: np.ndarray) -> DataFrame:
    """(s, c): the class of every symbol, a bounded table."""
    rows = pd.DataFrame({"s": np.arange(len(classes)), "c": classes})
    return pairs.sparkSession.createDataFrame(rows, "s int, c int")


def class_table(pairs: DataFrame, classes: np.ndarray, n: int) -> np.ndarray:
    """How often one class follows another: an n x n table."""
    lookup = _lookup(pairs, classes)
    left = lookup.select(F.col("s").alias("prev"), F.col("c").alias("a"))
    right = lookup.select(F.col("s").alias("cur"), F.col("c").alias("b"))
    named = pairs.join(F.broadcast(left), "prev").join(F.broadcast(right), "cur").select("a", "b", "n")
    out = np.zeros((n, n))
    for r in named.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        out[r.a, r.b] = r.n
    return out


def _mover(table: np.ndarray, classes: np.ndarray, last: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For rows (s, c, side, n) of some symbols: the class below ``last`` that suits each best.

    Side 0 counts the classes that follow a symbol, side 1 those before it. Symbols move one
    after the other, most frequent first, and the table follows them.
    """

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        now = table.copy()
        by_size = rows.groupby("s").n.sum().sort_values(ascending=False, kind="stable")
        groups = dict(list(rows.groupby("s")))
        for s in by_size.index:
            own = groups[s]
            after, before = np.zeros(len(table)), np.zeros(len(table))
            after[own.c[own.side == 0]] = own.n[own.side == 0]
            before[own.c[own.side == 1]] = own.n[own.side == 1]
            without = now.copy()
            mine = classes[s]
            without[mine] = np.maximum(without[mine] - after, 0)
            without[:, mine] = np.maximum(without[:, mine] - before, 0)
            kept = _gain(without)
            gain = (_gain(without + after) - kept).sum(axis=1) + (_gain(without + before[:, None]) - kept).sum(axis=0)
            for total, added in ((without.sum(axis=1), after.sum()), (without.sum(axis=0), before.sum())):
                gain -= _gain(total + added) - _gain(total)
            to = int(np.argmax(gain[:last]))
            out.append((int(s), to))
            if to != mine:
                without[to] += after
                without[:, to] += before
                now = without
        return pd.DataFrame(out, columns=["s", "c"])

    return best


def exchange(pairs: DataFrame, symbols: Symbols, m: Brown) -> np.ndarray:
    """The class of every symbol. The end of a text keeps a class of its own.

    Symbols are spread over ``parts`` tasks a round, dealt anew each time. A task sees its
    symbols' pairs with classes and the table of classes, and moves its symbols in turn.
    """
    last = m.classes - 1
    classes = np.arange(symbols.size) % last
    classes[symbols.end] = last
    for turn in range(m.rounds):
        table = class_table(pairs, classes, m.classes)
        lookup = F.broadcast(_lookup(pairs, classes))
        after = pairs.join(lookup.withColumnRenamed("s", "cur"), "cur").select(F.col("prev").alias("s"), "c", F.lit(0).alias("side"), "n")
        before = pairs.join(lookup.withColumnRenamed("s", "prev"), "prev").select(F.col("cur").alias("s"), "c", F.lit(1).alias("side"), "n")
        looked = after.unionByName(before).where(F.col("s") != symbols.end)
        sums = looked.groupBy("s", "c", "side").agg(F.sum("n").alias("n"))
        spread = sums.withColumn("part", F.pmod(F.xxhash64("s", F.lit(turn)), F.lit(m.parts)))
        # One row per symbol at most.
        moved = spread.groupBy("part").applyInPandas(_mover(table, classes, last), "s int, c int").toPandas()
        classes = classes.copy()
        classes[moved.s.to_numpy(dtype=np.int64)] = moved.c.to_numpy(dtype=np.int64)
    return classes


@dataclass(frozen=True)
class Model:
    """What scoring needs: symbols, classes, log10 of transitions, and the class sizes."""

    symbols: Symbols
    classes: np.ndarray
    follows: np.ndarray
    size: np.ndarray
    common: np.ndarray
    counts: np.ndarray
    texts: int


def train(docs: DataFrame, m: Brown) -> tuple[Model, DataFrame, int, int]:
    """The model, the counts of all words, N and V (the end counts as a word and per text)."""
    texts = docs.where(trains()).select("text")
    counts = written(word_counts(texts, m), "counts")
    n_texts = texts.count()
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = (total.n or 0) + n_texts, total.v + (1 if n_texts else 0)
    # At most 1 / share rows each.
    common = counts.where(F.col("n") >= max(2.0, m.common * n)).orderBy("word").select("word", "n").toPandas()
    words, sizes = common.word.to_numpy(dtype=np.int64), common.n.to_numpy(dtype=np.int64)
    symbols = Symbols(words[sizes >= max(2.0, m.symbol * n)], m.endings)
    pairs = written(symbol_pairs(texts, symbols), "pairs")
    classes = exchange(pairs, symbols, m)
    table = class_table(pairs, classes, m.classes)
    follows = np.log10((table + m.smoothing) / (table.sum(axis=1, keepdims=True) + m.smoothing * m.classes))
    own = np.zeros(symbols.size)
    own[classes.shape[0] - 1] = n_texts + 1
    rare = counts.where(F.col("n") < max(2.0, m.symbol * n))
    for r in rare.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        own[len(symbols.words) + r.ending] = r.n + r.v
    own[: len(symbols.words)] = sizes[sizes >= max(2.0, m.symbol * n)] + 1
    size = np.log10(np.bincount(classes, weights=own, minlength=m.classes) + 1)
    return Model(symbols, classes, follows, size, words, sizes, n_texts), counts, n, v


def _partial(docs: DataFrame, model) -> DataFrame:
    """Per document its sums over what needs no join, and its rare words with their counts."""
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_common bigint, log_counts double, log_class double, "
        "words array<bigint>, times array<int>"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k: Model = model.value
        log_count = np.log10(k.counts + 1.0)
        end_count, end_known = np.log10(k.texts + 1.0), int(k.texts > 0)
        for batch in batches:
            for words in words_of(batch.column(2)):
                s, bounds = k.symbols.sequence(words)
                c = k.classes[s]
                steps = np.concatenate([[0.0], np.cumsum(k.follows[c[:-1], c[1:]] - k.size[c[1:]])])
                text, h = words.text_of(), words.hashes.view(np.int64)
                n = words.last - words.first
                if len(k.common):
                    at = np.minimum(np.searchsorted(k.common, h), len(k.common) - 1)
                    hit = k.common[at] == h
                else:
                    at, hit = np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=bool)
                known = np.bincount(text[hit], minlength=n) + end_known
                sums = np.bincount(text[hit], weights=log_count[at[hit]] if len(log_count) else None, minlength=n) + end_count
                order = np.lexsort((h[~hit], text[~hit]))
                word, of = h[~hit][order], text[~hit][order]
                new = np.ones(len(word), dtype=bool)
                new[1:] = (word[1:] != word[:-1]) | (of[1:] != of[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(word))).astype(np.int32)
                ends = np.searchsorted(of[first], np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[words.first : words.last],
                        batch.column(1)[words.first : words.last],
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(sums, pa.float64()),
                        pa.array(np.diff(steps[bounds]), pa.float64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(word[first], pa.int64())),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(times, pa.int32())),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_common", "log_counts", "log_class", "words", "times"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~trains()).alias("held_out"), "text")
    return rows.mapInArrow(read, schema)


def score_documents(docs: DataFrame, m: Brown = Brown()) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the model's log10 probability of the whole text and its end. ``base_score``
    is that of a unigram with one added to every count. A null text is an empty one, which
    has its end alone. Words the training rows lack take the place that every class keeps
    for one unseen word. A null doc_id is trained on. Rows that repeat a doc_id are scored
    each for itself. An empty table gives no rows; other columns do not matter.
    """
    ship(docs.sparkSession)
    model, counts, n, v = train(docs, m)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    part = written(_partial(docs, shared).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = part.select("row", F.inline(F.arrays_zip("words", "times")))
    rare = rare.select("row", F.col("words").alias("word"), "times")
    known = rare.join(counts.where(F.col("n") < max(2.0, m.common * n)).select("word", "n"), "word")
    more = known.groupBy("row").agg(F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("log_rare"))
    whole = part.drop("words", "times").join(more, "row", "left")
    counted = F.col("log_counts") + F.coalesce("log_rare", F.lit(0.0))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        (counted + F.col("log_class")).alias("score"),
    )

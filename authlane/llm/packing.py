"""Packing token sequences shortest-pack-first over the histogram of lengths.

Documents are tokenized and cut into pieces of at most ``capacity`` ids. The histogram of
piece lengths, at most ``capacity`` numbers, is all the driver sees: it places lengths
longest first, each into the packs that are shortest so far, and keeps counts of equal packs
instead of packs. The finished patterns go back to the pieces by rank: piece number r of its
length belongs to the pattern whose interval of ranks holds r.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from authlane.llm.common import ship, written

CAPACITY = 2048
END = 1
# Pieces of one length are ranked in so many slices at once.
SLICES = 512

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE: its file of ranks, the pattern that cuts words, and special tokens."""

    ranks: str
    pattern: str
    special: tuple[tuple[str, int], ...]


def byte_bpe_50k() -> Vocabulary:
    """The vocabulary of ``byte_bpe_50k.json``, read from the same vocabulary as ranks.

    Gives the ids that the ``tokenizers`` library gives with add_special_tokens=False, in
    about a quarter of the time; a test compares them.
    """
    import public_tokenizers

    return Vocabulary(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, (("<|endoftext|>", 50256),)
    )


@lru_cache(maxsize=1)
def _encoder(v: Vocabulary):
    import tiktoken

    with open(v.ranks, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=v.pattern, mergeable_ranks=ranks, special_tokens=dict(v.special))


def encode(text: str | None, v: Vocabulary) -> np.ndarray:
    """Ids of a whole text and the end id; a null text has the end id alone."""
    ids = _encoder(v).encode(text, allowed_special="all") if text else []
    return np.array([*ids, END], dtype="<u4")


def pieces(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: full pieces from the front, then the rest of the document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py(), vocabulary)
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    out.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Packs as (lengths, longest first; how many such packs).

    Lengths are placed longest first. A length goes into the packs that are shortest, if it
    fits there, else it opens new packs. Packs of one pattern are handled by their count, so
    the work follows the number of different lengths, not of sequences.
    """
    free: dict[int, list[list]] = {}  # free space: [lengths, count] of packs
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(free, default=0)
            if room < length:  # fits nowhere: new packs, each filled before the next is opened
                per = capacity // length
                for size, packs in ((per, left // per), (left % per, 1)):
                    if size and packs:
                        free.setdefault(capacity - size * length, []).append([(length,) * size, packs])
                break
            pattern, count = free[room].pop()
            if not free[room]:
                del free[room]
            used = min(left, count)
            if used < count:
                free.setdefault(room, []).append([pattern, count - used])
            free.setdefault(room - length, []).append([(*pattern, length), used])
            left -= used
    return [(tuple(p), n) for room in sorted(free) for p, n in free[room]]


@dataclass(frozen=True)
class Slots:
    """Where the pieces of a length go: ranks from ``rank`` on to (sequence, offset)."""

    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def slots_by_length(packs: list[tuple[tuple[int, ...], int]]) -> dict[int, Slots]:
    """The packs as intervals of ranks, by length; sequences are numbered without gaps."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for lengths, count in packs:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            found.setdefault(length, []).append((rank, first, offset))
            taken[length] = rank + count
            offset += length
        first += count
    return {n: Slots(*(np.array(x, dtype=np.int64) for x in zip(*rows))) for n, rows in found.items()}


def pack(docs: DataFrame, vocabulary: Vocabulary | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and the offset in it.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null and empty
    texts are the end id alone. Rows that repeat a doc_id are packed each for itself. Pieces
    of one length are ranked by hash slice, doc_id, start and checksum; reruns agree. Long
    texts are tokenized whole. An empty table gives no rows, and other columns do not matter.
    """
    ship(docs.sparkSession)
    cut = written(pieces(docs, vocabulary or byte_bpe_50k(), capacity), "pieces")
    sliced = cut.withColumn("slice", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SLICES)).cast("int"))
    counts = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = sliced.withColumn("nth", F.row_number().over(within)).join(starts, ["length", "slice"])
    ranked = ranked.select(*cut.columns, (F.col("first") + F.col("nth") - 1).alias("rank"))

    # At most one row per length up to the capacity.
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = docs.sparkSession.sparkContext.broadcast(slots_by_length(shortest_pack_first(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            order = np.argsort(lengths, kind="stable")
            bounds = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
            for a, b in zip(bounds, bounds[1:]):
                at = order[a:b]
                s = slots.value[int(lengths[at[0]])]
                i = np.searchsorted(s.rank, ranks[at], side="right") - 1
                sequence[at], offset[at] = s.sequence[i] + ranks[at] - s.rank[i], s.offset[i]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, PIECES + ", sequence_id bigint, offset bigint")

"""Hard-negative mining over exact integer scores from a residue-number-system product.

Vectors become integers. A block of rows and a block of anchors are multiplied modulo a few
small primes, each product in float32 on residues around zero, cut so that no sum leaves the
24 bits which float32 holds exactly; the Chinese remainder theorem gives the signed scores
back. Rows are dealt to packs by a number of their own, so that no label, id or repeated
vector gathers in one. Every anchor passes every pack: first for its best rows of the same
label, then, knowing their scores, for the best of other labels inside each window. A pack
sends on a few rows per anchor, and window functions merge what the packs found.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from authlane.llm.common import ship, written

# Primes below 512, largest first: residues around zero are at most 254 in size.
PRIMES = [p for p in range(511, 256, -2) if all(p % q for q in range(3, 23, 2))]
# So many products of two residues add up to less than 2**24.
DEPTH = 2**24 // (PRIMES[0] // 2) ** 2
# Scores must fit 64-bit integers, also times 100 when they are compared with a window.
LARGEST = (2**63 - 1) // 100


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives an anchor gets, and the window in hundredths of a positive's score."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    scale: int = 256
    # Rows of a pack: what a task holds at once. Anchors pass it in batches.
    pack: int = 16384
    batch: int = 256


def quantised(rows: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, label, v, anchor): rows that take part, numbered, with integer components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    part = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    numbers = [F.col(c).cast("bigint") for c in ("vec_id", "label")]
    return part.select(F.monotonically_increasing_id().alias("row"), *numbers, v.alias("v"), "anchor")


def primes_for(largest: int) -> list[int]:
    """The fewest primes whose product tells all signed scores up to ``largest`` apart."""
    product, chosen = 1, []
    while product <= 2 * largest + 1:
        chosen.append(PRIMES[len(chosen)])
        product *= chosen[-1]
    return chosen


def residues(v: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """An integer matrix modulo each prime, around zero, in float32."""
    found = []
    for p in primes:
        r = np.mod(v, p)
        found.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return found


def exact_scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed products of the rows of two integer matrices, from their residues."""
    digits: list[np.ndarray] = []  # of the mixed-radix form, the lowest first
    for i, p in enumerate(primes):
        left, right = a[i], b[i].T
        total = np.zeros((left.shape[0], right.shape[1]), dtype=np.float32)
        for k in range(0, left.shape[1], DEPTH):
            total += np.mod(left[:, k : k + DEPTH] @ right[k : k + DEPTH], np.float32(p))
        digit = total.astype(np.int64) % p
        for q, lower in zip(primes, digits):
            digit = (digit - lower) * pow(q, -1, p) % p
        digits.append(digit)
    # Half of an odd product has half of every prime, rounded down, as its digits. What is
    # above stands for a negative number.
    above = np.zeros(digits[0].shape, dtype=bool)
    for p, d in zip(primes, digits):
        above = (d > p // 2) | ((d == p // 2) & above)
    score = digits[-1] - np.where(above, primes[-1], 0)
    for p, d in zip(reversed(primes[:-1]), reversed(digits[:-1])):
        score = score * p + d
    return score


def _best(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Of the positions ``among``, in ascending order, the ``k`` of highest score; the first where equal."""
    if len(among) > k:
        least = -np.partition(-scores[among], k - 1)[k - 1]
        among = among[scores[among] >= least]
    return among[np.argsort(-scores[among], kind="stable")][:k]


class Pack:
    """The rows of a pack by vec_id, null last, as residues."""

    def __init__(self, parts: list[dict[str, np.ndarray]], primes: list[int]):
        whole = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
        order = np.lexsort((whole["row"], whole["vec_id"], ~whole["known"]))
        for name, values in whole.items():
            setattr(self, name, values[order])
        self.residues = residues(self.v, primes)


Choice = Callable[[Pack, dict, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of numbers as a matrix of ``width`` columns; short ones are filled up with zeros."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    if len(flat) == len(sizes) * width:
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _columns(batch: pa.RecordBatch, width: int) -> dict[str, np.ndarray]:
    ids = batch.column("vec_id")
    found = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("cell", "kind", "row", "label")}
    found["known"] = ids.is_valid().to_numpy(zero_copy_only=False)
    found["vec_id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
    found["v"] = _matrix(batch.column("v"), width)
    return found


def _matches(batches: Iterator[pa.RecordBatch], choose: Choice, primes: list[int], width: int, step: int) -> Iterator[pa.RecordBatch]:
    """What ``choose`` finds for the anchors that come after the rows of their cell."""
    cell, parts, pack = None, [], None
    for batch in batches:
        columns = _columns(batch, width)
        goals = batch.column("goals")
        cells, kinds = columns.pop("cell"), columns.pop("kind")
        cuts = [0, *(np.flatnonzero(np.diff(cells) | np.diff(kinds)) + 1).tolist(), len(cells)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if cells[lo] != cell:
                cell, parts, pack = cells[lo], [], None
            if kinds[lo] == 0:
                parts.append({name: values[lo:hi] for name, values in columns.items()})
                continue
            if not parts:  # by chance no row was dealt to this pack
                continue
            pack = pack or Pack(parts, primes)
            for at in range(lo, hi, step):
                end = min(at + step, hi)
                scores = exact_scores(residues(columns["v"][at:end], primes), pack.residues, primes)
                anchor, goal, row, vec_id, known, score = [], [], [], [], [], []
                for i in range(at, end):
                    of = {"row": columns["row"][i], "label": columns["label"][i], "goals": goals[i].as_py() or []}
                    for wanted, chosen in choose(pack, of, scores[i - at]):
                        anchor.append(np.full(len(chosen), of["row"]))
                        goal.append(np.full(len(chosen), wanted))
                        row.append(pack.row[chosen])
                        vec_id.append(pack.vec_id[chosen])
                        known.append(pack.known[chosen])
                        score.append(scores[i - at][chosen])
                if anchor:
                    flat = [np.concatenate(x).astype(np.int64) for x in (anchor, goal, row, score)]
                    ids = pa.array(np.concatenate(vec_id), mask=~np.concatenate(known))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in flat] + [ids], ["anchor", "goal", "row", "score", "vec_id"])


MATCHES = "anchor bigint, goal bigint, row bigint, score bigint, vec_id bigint"


def _passed(vectors: DataFrame, anchors: DataFrame, choose: Choice, primes: list[int], width: int, mining: Mining, counts: tuple[int, int]) -> DataFrame:
    """``choose`` for every anchor (row, label, v, goals) in every pack of rows."""
    spark = vectors.sparkSession
    n, n_anchors = counts
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packs = -(-n // mining.pack)
    batches = -(-n_anchors // mining.batch)
    # A cell is a pack with a share of the anchors: shares are large unless tasks are few.
    shares = min(batches, max(-(-2 * slots // packs), -(-batches // 64)))
    own_pack = F.pmod(F.xxhash64("row"), F.lit(packs))
    own_share = F.pmod(F.xxhash64("row", F.lit("share")), F.lit(shares))
    each = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    own = ("row", "vec_id", "label", "v")
    goals = F.array().cast("array<bigint>").alias("goals")
    rows = vectors.select(own_pack.alias("p"), each(shares).alias("s"), F.lit(0).alias("kind"), *own, goals)
    wanted = anchors.select(each(packs).alias("p"), own_share.alias("s"), F.lit(1).alias("kind"), *own, "goals")
    cells = rows.unionByName(wanted).withColumn("cell", F.col("p") * shares + F.col("s")).drop("p", "s")
    tasks = min(2 * packs * shares, 16 * slots)
    dealt = cells.repartition(tasks, "cell").sortWithinPartitions("cell", "kind")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _matches(batches, choose, primes, width, mining.batch)

    return dealt.mapInArrow(read, MATCHES)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and goal, ranked by score, then vec_id, null last."""
    order = Window.partitionBy("anchor", "goal").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``embeddings`` has vec_id, label, embedding; ``is_anchor`` is a condition on them. An
    anchor's positives are its best other rows of its label; each has as negatives the best
    rows of other labels with a score inside the window. Better is a higher score, then a
    smaller vec_id, null last. A row without label or vector, or with a null or non-finite
    component, takes no part. Vectors shorter than others count as filled up with zeros.
    Rows that repeat a vec_id are rows of their own, and a copy of an anchor is another row.
    A positive without negatives gives no rows, nor does an empty table; other columns do
    not matter. Scores that 64 bits cannot hold a hundredfold raise an error.
    """
    ship(embeddings.sparkSession)
    marked = embeddings.select("vec_id", "label", "embedding", F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    vectors = written(quantised(marked, mining.scale), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    known = vectors.agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("v")).alias("width"), F.max(square).alias("square")
    ).first()
    anchors = vectors.where("anchor")
    if not known.anchors:
        return _mined(anchors.select(*[F.lit(0).cast("long").alias(c) for c in RESULT]))
    # No inner product is above the largest square of a vector.
    largest = math.ceil(known.square * (1 + 1e-9)) + 1
    if largest > LARGEST:
        raise ValueError(f"scores up to {largest} are beyond 64-bit integers")
    primes = primes_for(largest)
    counts, width = (known.n, known.anchors), max(1, known.width)

    def positives(pack: Pack, of: dict, scores: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        yield 0, _best(scores, np.flatnonzero((pack.label == of["label"]) & (pack.row != of["row"])), mining.positives)

    def negatives(pack: Pack, of: dict, scores: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        windows = [(g, -(-mining.low * g // 100), mining.high * g // 100) for g in of["goals"]]
        windows = [w for w in windows if w[1] <= w[2]]
        if windows:
            least, most = min(w[1] for w in windows), max(w[2] for w in windows)
            among = np.flatnonzero((scores >= least) & (scores <= most) & (pack.label != of["label"]))
            among = among[np.argsort(-scores[among], kind="stable")]
            falling = -scores[among]
            for goal, low, high in windows:
                start, end = np.searchsorted(falling, -high), np.searchsorted(falling, -low, side="right")
                yield goal, among[start : min(end, start + mining.negatives)]

    plain = anchors.withColumn("goals", F.array().cast("array<bigint>"))
    best = _first(_passed(vectors, plain, positives, primes, width, mining, counts), mining.positives)
    best = written(best.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("goal")), "positives")
    goals = best.groupBy("anchor").agg(F.collect_set("goal").alias("goals"))
    aimed = anchors.join(goals.withColumnRenamed("anchor", "row"), "row")
    found = _first(_passed(vectors, aimed, negatives, primes, width, mining, counts), mining.negatives)
    found = found.select("anchor", "goal", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = best.join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return _mined(named.join(found, ["anchor", "goal"]).withColumnRenamed("goal", "positive_score"))


RESULT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _mined(found: DataFrame) -> DataFrame:
    return found.select(*[F.col(c).cast("int") if c == "rank" else F.col(c) for c in RESULT])

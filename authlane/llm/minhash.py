"""Near duplicates by one-permutation hashing, banded buckets and star-shaped candidates.

The shingle hashes of a document fall into equal bins of their range, and a bin keeps its
least one. An empty bin takes the value of a filled one, tried in an order of its own that
is the same for all documents (optimal densification). Runs of bins are bands, and classes
of equal sets meet in a bucket when a band agrees. A bucket is a star: its members are
compared with its leader, and so with as many classes as there are members, never in pairs.

Links are confirmed on full sets. Stars come in rounds: linked classes become one group,
buckets with one group are done, and the class with most links so far leads, as the text
that copies were made from has more links than a copy. When a round finds nothing, members
that no leader reached may still be linked with each other. Such a pair shares shingles
that set it apart from the leader both were compared with, or else both would be linked
with it: it is found by these, rarest first, and confirmed as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from authlane.llm.common import repacked, scratch_dir, ship, write_table, written
from authlane.llm.components import components
from authlane.llm.words import mixed, shingles, words_of


@dataclass(frozen=True)
class MinHash:
    """Links sets with 100 * intersection >= ``percent`` * union of ``words``-word shingles.

    Two sets of similarity s share a bucket with probability 1 - (1 - s ** rows) ** bands:
    all but one in a million at 0.85.
    """

    words: int = 5
    percent: int = 85
    bands: int = 24
    rows: int = 5
    # Leaders that a class is compared with in a round, and the most rounds.
    tests: int = 4
    rounds: int = 6
    # Stars go on while one in so many of a round's comparisons is a link.
    worth: int = 50
    # The last search goes without stars where its buckets have at most so many pairs a row; 0: never.
    pairs: int = 0

    @property
    def bins(self) -> int:
        return self.bands * self.rows

    def linked(self, both: Column, n: Column, m: Column) -> Column:
        return both * 100 >= (n + m - both) * self.percent

    def near_size(self, n: Column, m: Column) -> Column:
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent


class Sketcher:
    """Band keys of sets of shingle hashes."""

    def __init__(self, sim: MinHash):
        self.bins, self.bands, self.rows = sim.bins, sim.bands, sim.rows
        self.edges = np.array([-(-i * 2**64 // sim.bins) for i in range(sim.bins)], dtype=np.uint64)
        draw = np.random.Generator(np.random.PCG64(20260301))
        # Where an empty bin looks, in turn: random bins, and at the end every bin.
        self.tries = np.concatenate(
            [draw.integers(0, sim.bins, (sim.bins, 4 * sim.bins)), np.tile(np.arange(sim.bins), (sim.bins, 1))], axis=1
        )
        self.weights = draw.integers(1, 2**63, sim.bins, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def bin_values(self, tokens: np.ndarray) -> np.ndarray:
        """The least hash of each bin of sorted ``tokens``, empty bins filled from others."""
        at = np.searchsorted(tokens, self.edges)
        filled = at < np.append(at[1:], len(tokens))
        source = np.arange(self.bins)
        empty = np.flatnonzero(~filled)
        source[empty] = self.tries[empty, np.argmax(filled[self.tries[empty]], axis=1)]
        return tokens[at[source]]

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """A number per band; an empty set has none."""
        if not len(tokens):
            return np.zeros(0, dtype=np.int64)
        parts = (self.bin_values(tokens) * self.weights).reshape(self.bands, self.rows)
        return mixed(parts.sum(axis=1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64)).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def document_sets(docs: DataFrame, sim: MinHash, whole: bool) -> DataFrame:
    """(doc_id, cls, n, items): a document's class, set size, and its band keys or all shingles.

    The class is a hash of the set.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(sim)
        for batch in batches:
            for chunk in words_of(batch.column(1)):
                cls, n, items = [], [], []
                for s in shingles(chunk, sim.words):
                    digest = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                    cls.append(int.from_bytes(digest, "little", signed=True))
                    n.append(len(s))
                    items.append(s.view(np.int64) if whole else sketcher.keys(s))
                ids = batch.column(0)[chunk.first : chunk.last]
                columns = [ids, pa.array(cls, pa.int64()), pa.array(n, pa.int32()), _lists(items)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "cls", "n", "items"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(read, "doc_id bigint, cls bigint, n int, items array<bigint>")


def _confirmed(pairs: DataFrame, full: DataFrame, sim: MinHash) -> DataFrame:
    """(a, b, linked) by the intersection of full sets."""
    left = full.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("items").alias("t_a"))
    right = full.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("items").alias("t_b"))
    both = F.size(F.array_intersect("t_a", "t_b"))
    met = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return met.select("a", "b", sim.linked(both, F.col("n_a"), F.col("n_b")).alias("linked"))


def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, grp) with the connected classes of ``links`` as groups."""
    found = components(links.select("a", "b")).select(F.col("node").alias("cls"), "component")
    return written(groups.select("cls").join(found, "cls", "left").select("cls", F.coalesce("component", "cls").alias("grp")), "groups")


def joined_groups(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, grp) after groups that a link (a, b) of classes joins have become one.

    ``groups`` and ``links`` are written tables, as both are counted and then read again.
    """
    g, links = repacked(groups.select("cls", "grp")), repacked(links.select("a", "b"))
    ends = links.join(g.select(F.col("cls").alias("a"), F.col("grp").alias("x")), "a")
    ends = ends.join(g.select(F.col("cls").alias("b"), F.col("grp").alias("y")), "b")
    found = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    moved = g.join(found.select(F.col("node").alias("grp"), "component"), "grp", "left")
    return written(moved.select("cls", F.coalesce("component", "grp").alias("grp")), "groups")


def _drawn_in(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, grp) after the classes of a star have taken the least group among them.

    Equal groups are always connected; what is connected may still have several.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    for _ in range(2):  # to the leader, and back to its members
        least = both.join(groups.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("grp").alias("least"))
        groups = groups.join(least, "cls", "left").select("cls", F.least("grp", "least").alias("grp"))
    return written(groups, "groups")


def _star_pairs(postings: DataFrame, groups: DataFrame, tried: Tried, sim: MinHash, nth: int) -> DataFrame:
    """(a, b): classes and the leaders they are to be compared with in this round."""
    ready = postings.join(groups, "cls")
    if tried.rounds:
        ready = ready.join(tried.links_of(), "cls", "left")
    else:
        ready = ready.withColumn("links", F.lit(None).cast("long"))
    first = F.struct(
        (-F.coalesce("links", F.lit(0))).alias("links"), F.xxhash64("cls", F.lit(nth)).alias("h"), F.col("cls").alias("b"), F.col("n").alias("m"), F.col("grp").alias("g")
    )
    leaders = ready.groupBy("key").agg(F.min(first).alias("leader"), F.min("grp").alias("g0"), F.max("grp").alias("g1"))
    leaders = leaders.where("g0 < g1").select("key", "leader.b", "leader.m", "leader.g")
    named = ready.join(leaders, "key").where((F.col("grp") != F.col("g")) & sim.near_size(F.col("n"), F.col("m")))
    hits = named.groupBy(F.col("cls").alias("a"), "b").agg(F.count("*").alias("hits"))
    if tried.rounds:
        # A pair may have been tried from either side.
        done = tried.rows().select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        hits = hits.withColumns({"x": F.least("a", "b"), "y": F.greatest("a", "b")}).join(done, ["x", "y"], "left_anti")
    order = Window.partitionBy("a").orderBy(F.desc("hits"), F.xxhash64("b", F.lit(nth)))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sim.tests).select("a", "b")


class Tried:
    """The pairs (a, b, linked) compared so far: one table, to which rounds add folders."""

    def __init__(self, docs: DataFrame):
        self.spark, self.path, self.rounds = docs.sparkSession, f"{scratch_dir(docs.sparkSession)}/tried", 0

    def add(self, found: DataFrame) -> DataFrame:
        write_table(found, f"{self.path}/round={self.rounds}")
        self.rounds += 1
        return self.rows().where(F.col("round") == self.rounds - 1).select("a", "b", "linked")

    def rows(self) -> DataFrame:
        return self.spark.read.schema("a bigint, b bigint, linked boolean, round int").parquet(self.path)

    def links(self) -> DataFrame:
        return self.rows().where("linked").select("a", "b")

    def links_of(self) -> DataFrame:
        """(cls, links) for classes that have any."""
        return self.links().select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("links"))


def _starred(postings: DataFrame, groups: DataFrame, full: DataFrame, sim: MinHash, tried: Tried) -> DataFrame:
    """The groups after rounds of stars over ``postings``, until a round finds hardly a link."""
    some = False
    for nth in range(sim.rounds):
        found = tried.add(_confirmed(_star_pairs(postings, groups, tried, sim, nth), full, sim))
        seen = found.agg(F.count("*").alias("pairs"), F.count_if("linked").alias("links")).first()
        some = some or seen.links > 0
        if seen.links * sim.worth < seen.pairs or not seen.links:
            break
        groups = _drawn_in(groups, found.where("linked"))
    return _merged(groups, tried.links()) if some else groups


def _members(postings: DataFrame, groups: DataFrame, full: DataFrame, tried: Tried, sim: MinHash) -> DataFrame:
    """(a, b, n_a, n_b, items, linked): members of a bucket, its leader, and the shingles in which they differ.

    Only buckets with several groups count. Sets that differ in d shingles have half of all
    others in common, so whether a member and its leader are linked is known as well.
    """
    ready = postings.join(groups, "cls").join(tried.links_of(), "cls", "left")
    first = F.struct((-F.coalesce("links", F.lit(0))).alias("links"), F.col("cls").alias("b"))
    leaders = ready.groupBy("key").agg(F.min(first).alias("leader"), F.min("grp").alias("g0"), F.max("grp").alias("g1"))
    leaders = leaders.where("g0 < g1").select("key", "leader.b")
    members = written(ready.join(leaders, "key").where("cls <> b").select(F.col("cls").alias("a"), "b").distinct(), "members")

    left = full.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("items").alias("t_a"))
    right = full.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("items").alias("t_b"))
    met = members.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    items = F.concat(F.array_except("t_a", "t_b"), F.array_except("t_b", "t_a"))
    met = written(met.select("a", "b", "n_a", "n_b", items.alias("items")), "apart")
    both = (F.col("n_a") + F.col("n_b") - F.size("items")) / 2
    return met.withColumn("linked", sim.linked(both, F.col("n_a"), F.col("n_b")))


def _apart(members: DataFrame, sim: MinHash) -> DataFrame:
    """Postings (key, cls, n, f, side, rest) of shingles in which members of a bucket differ from its leader.

    Let D(x) be where x differs from the leader l, p = (1 - t) / (1 + t), and
    f(x) = |D(x)| - p |x|. Sets are linked when they differ in at most p (|x| + |y|)
    shingles, so x is linked with l when f(x) <= p |l|, and linked x and y share at least
    (f(x) + f(y)) / 2 shingles of their D. Two sets with ``least`` of D in common agree in
    one of the |D| - least + 1 rarest of each. Side 0 is for pairs of which neither is linked
    with l: there f(y) > p |l|. Sides 1 and 2 are for x linked and y not: f(y) > p |l| again,
    and as D(x) has what they share, that is f(y) - p |x| or more. Two that are both linked
    with l are in one group. ``rest`` is how many shingles of D come from this one on.
    """
    apart = members.select("a", "b", "n_a", "n_b", F.explode("items").alias("item"))
    counts = apart.groupBy("b", "item").agg(F.count("*").alias("df"))
    ranked = apart.join(counts, ["b", "item"])
    each = ranked.groupBy("a", "b", "n_a", "n_b").agg(F.array_sort(F.collect_list(F.struct("df", "item"))).alias("d"))
    t, p, d = sim.percent / 100, (100 - sim.percent) / (100 + sim.percent), F.size("d")
    f = d - p * F.col("n_a")
    is_linked = f <= p * F.col("n_b") + 1e-6
    half, whole = (f + p * F.col("n_b")) / 2, f - p * F.col("n_a") / t

    def rarest(least: Column, side: int) -> Column:
        # A hair less, as these are rounded numbers.
        prefix = F.slice("d", 1, (d - F.greatest(F.lit(1), F.ceil(least - 1e-6)) + 1).cast("int"))

        def placed(s: Column, i: Column) -> Column:
            return F.struct(s["df"].alias("df"), s["item"].alias("item"), F.lit(side).alias("side"), (d - i).alias("rest"))

        return F.transform(prefix, placed)

    wanted = F.when(is_linked, rarest(half, 1)).otherwise(F.concat(rarest(half, 0), rarest(whole, 2)))
    found = each.select("a", "b", "n_a", f.alias("f"), F.explode(wanted).alias("s")).where("s.df > 1")
    key = F.xxhash64("b", "s.item", F.col("s.side") > 0)
    return found.select(key.alias("key"), F.col("a").alias("cls"), F.col("n_a").alias("n"), "f", "s.side", "s.rest")


def _few_pairs(postings: DataFrame, groups: DataFrame, sim: MinHash) -> bool:
    """The pairs that ``_left_pairs`` would look at are at most ``pairs`` for each row."""
    of = lambda side: F.count_if(F.col("side") == side)
    held = postings.join(groups, "cls").groupBy("key").agg(
        F.count("*").alias("held"), F.min("grp").alias("g0"), F.max("grp").alias("g1"), (of(0) * (of(0) - 1) / 2 + of(1) * of(2)).alias("pairs")
    )
    seen = held.where("g0 < g1").agg(F.coalesce(F.sum("held"), F.lit(0)).alias("held"), F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("pairs")).first()
    return seen.pairs <= sim.pairs * seen.held


def _left_pairs(postings: DataFrame, groups: DataFrame, tried: Tried, sim: MinHash) -> DataFrame:
    """The pairs (a, b) of a bucket that are in different groups and were not compared yet."""
    ready = postings.join(groups, "cls")
    several = ready.groupBy("key").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1")).where("g0 < g1")
    ready = ready.join(several.select("key"), "key")
    other = ready.select("key", *[F.col(c).alias(f"{c}_b") for c in ("cls", "n", "grp", "f", "side", "rest")])
    # The first shingle of D that two linked sets share has all others behind it.
    reach = F.least("rest", "rest_b") >= (F.col("f") + F.col("f_b")) / 2 - 1e-6
    apart = (F.col("cls") < F.col("cls_b")) & (F.col("grp") != F.col("grp_b"))
    sides = (F.col("side") == 0) | (F.col("side") != F.col("side_b"))
    met = (ready["key"] == other["key"]) & apart & sides & reach & sim.near_size(F.col("n"), F.col("n_b"))
    pairs = ready.join(other, met).withColumnRenamed("cls_b", "b")
    pairs = pairs.select(F.col("cls").alias("a"), "b").distinct()
    done = tried.rows().select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.join(done, ["a", "b"], "left_anti")


def finer_groups(postings: DataFrame, groups: DataFrame, full: DataFrame, sim: MinHash, tried: Tried) -> DataFrame:
    """The groups after all links between classes that share a bucket of ``postings`` (key, cls, n).

    ``groups`` is a written table; ``tried`` holds all links that it comes from, and gets those found here. Members
    of a bucket are compared with its leader; the other links are found by what they share
    beside the leader's set. Stars go before, so the work does not grow with the square of a
    bucket; they are left out where ``sim.pairs`` says that few pairs are to be looked at.
    """
    members = _members(postings, groups, full, tried, sim)
    done = tried.rows().select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    new = (F.least("a", "b") == done["x"]) & (F.greatest("a", "b") == done["y"])
    found = tried.add(members.where("linked").join(done, new, "left_anti").select("a", "b", "linked"))
    if not found.isEmpty():
        groups = joined_groups(groups, found)
    finer = repacked(written(_apart(members, sim), "finer"))
    groups = repacked(groups)
    if not (sim.pairs and _few_pairs(finer, groups, sim)):
        groups = _starred(finer, groups, full, sim, tried)
    last = tried.add(_confirmed(_left_pairs(finer, groups, tried, sim), full, sim)).where("linked")
    return groups if last.isEmpty() else joined_groups(groups, last)


def minhash_duplicates(docs: DataFrame, sim: MinHash = MinHash()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, cls, component_id, kept.

    ``cls`` is the same for equal sets. ``component_id`` is the smallest doc_id that can be
    reached over links, the row's own included, and ``kept`` tells that it is the row's own.
    A null text is an empty one; empty sets link with nothing, so such a document is its own
    component. Rows that repeat a doc_id count as rows. A row without doc_id takes part; it
    is kept if no row of its component has one, and has a null component then. An empty
    table gives no rows; other columns do not matter.
    """
    ship(docs.sparkSession)
    sets = written(document_sets(docs, sim, whole=False), "sets")
    classes = sets.groupBy("cls").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"))
    bands = sets.where("n > 0").select("cls", "n", "items").dropDuplicates(["cls"])
    placed = bands.select(F.explode("items").alias("key"), "cls", "n")
    shared = placed.groupBy("key").agg(F.min("cls").alias("c0"), F.max("cls").alias("c1")).where("c0 < c1")
    postings = written(placed.join(shared.select("key"), "key"), "postings")

    active = written(postings.select("cls").distinct().join(classes.select("cls", "first"), "cls"), "active")
    texts = docs.join(active.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = texts.unionByName(docs.where("doc_id IS NULL"))  # a class may have no other rows
    full = document_sets(texts, sim, whole=True).select("cls", "n", "items")
    # Texts that repeat a doc_id may bring other classes.
    full = written(full.join(active.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "full")

    groups = active.select("cls", F.col("cls").alias("grp"))
    tried = Tried(docs)
    groups = _starred(postings, groups, full, sim, tried)
    groups = finer_groups(postings, groups, full, sim, tried)

    grouped = classes.join(groups, "cls", "left").withColumn("grp", F.coalesce("grp", "cls"))
    least = grouped.groupBy("grp").agg(F.min("first").alias("component_id"))
    found = grouped.join(least, "grp").select("cls", "component_id")
    rows = sets.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "cls").join(found, "cls")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = rows.select("doc_id", "n_shingles", "cls", own.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

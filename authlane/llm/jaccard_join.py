"""Near duplicates by Jaccard similarity of word shingles, with a token-group matrix.

Equal sets fall into one class. Classes that are verified to be linked form a group, and
the matrix holds which tokens a group's members have. A class looks for groups through the
matrix, a bound on its overlap with a group's token union decides whether the group is
opened, and only classes of opened groups are compared, always exactly.

How this stays linear where texts repeat. Tokens have one global order, rare ones first, and
a class whose first ``n - ceil(t n) + 1`` tokens nobody else has needs no look at all. The
frequency of tokens is counted over all classes, for a fixed part of the token space; a
class with too few rare tokens in that part brings in the rest of its tokens, whose
frequency is counted among such classes. Groups form in rounds, in each of which a class is
compared with a few others at most: a large set of near copies is joined by stars and never as
pairs. When rounds stop merging, links across groups are left. Where few classes share a token
they are looked for through the matrix, and where many do through the tokens in which the
classes differ from one that leads them (``minhash.finer_groups``).
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

from authlane.llm.common import packed, repacked, ship, written
from authlane.llm.minhash import MinHash, Tried, finer_groups, joined_groups
from authlane.llm.words import shingles, words_of


@dataclass(frozen=True)
class Similarity:
    """Links sets with 100 * intersection >= ``percent`` * union of ``words``-word shingles."""

    words: int = 4
    percent: int = 85
    # A token that so many classes hold is common, and its classes are not compared in pairs.
    common: int = 32
    # Part of the token space in which tokens are counted over all classes; None takes a
    # part that goes beyond the first tokens a set looks up (``looked_at``).
    counted: float | None = None
    # Rounds of joining by stars before the full comparison of what is left, and how many
    # leaders a class may try in each.
    rounds: int = 2
    tests: int = 4

    @property
    def low(self) -> int:
        """Tokens are signed 64-bit numbers; those below are counted for all classes."""
        return int(-(2**63) + (self.looked_at if self.counted is None else self.counted) * 2**64)

    @property
    def looked_at(self) -> float:
        """A set looks up about ``1 - t`` of its tokens: this much and a margin, which grows
        as ``t`` falls. A part below that would leave most sets without enough rare tokens."""
        return min(90, max(105 - self.percent, 190 - 2 * self.percent)) / 100

    def look(self, n: Column) -> Column:
        """How many first tokens of a set of ``n`` must be looked up."""
        return n - F.ceil(n * self.percent / 100) + 1

    def least_overlap(self, n: Column, m: Column) -> Column:
        """The least intersection of linked sets of sizes ``n`` and ``m``."""
        return F.ceil((n + m) * self.percent / (100 + self.percent))

    def linked(self, both: Column, n: Column, m: Column) -> Column:
        return both * 100 >= (n + m - both) * self.percent


def token_sets(docs: DataFrame, sim: Similarity, whole: bool) -> DataFrame:
    """(doc_id, text_hash, cls, n, n_low, tokens): a document's class, set size, and its tokens.

    ``tokens`` are all tokens or those of the counted part. The class is a hash of the set,
    and ``text_hash`` one of the text, which tells rows of one doc_id apart.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in words_of(batch.column(1)):
                cls, n, n_low, tokens = [], [], [], []
                for s in shingles(chunk, sim.words):
                    s = np.sort((s ^ np.uint64(1 << 63)).view(np.int64))
                    digest = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                    cls.append(int.from_bytes(digest, "little", signed=True))
                    n.append(len(s))
                    n_low.append(int(np.searchsorted(s, sim.low)))
                    tokens.append(s if whole else s[: n_low[-1]])
                ends = np.cumsum([0, *map(len, tokens)]).astype(np.int32)
                flat = np.concatenate(tokens) if tokens else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[chunk.first : chunk.last],
                        batch.column(2)[chunk.first : chunk.last],
                        pa.array(cls, pa.int64()),
                        pa.array(n, pa.int32()),
                        pa.array(n_low, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64())),
                    ],
                    ["doc_id", "text_hash", "cls", "n", "n_low", "tokens"],
                )

    schema = "doc_id bigint, text_hash bigint, cls bigint, n int, n_low int, tokens array<bigint>"
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(read, schema)


def _shared(sets: DataFrame) -> DataFrame:
    """(cls, shared): each class's tokens that other classes hold too, with their counts."""
    postings = sets.select("cls", F.explode("tokens").alias("token"))
    counts = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    found = postings.join(counts, "token")
    return found.groupBy("cls").agg(F.collect_list(F.struct("df", "token")).alias("shared"))


def first_tokens(sets: DataFrame, docs: DataFrame, classes: DataFrame, sim: Similarity) -> tuple[DataFrame, DataFrame]:
    """(cells, full): the matrix cells (token, cls, n, own, pos), and full token sets.

    ``own`` is the share of a class's counted tokens that no other has, in twentieths, and
    ``pos`` counts the tokens of the class that come before in the global order.
    ``full`` holds (cls, n, tokens) of every class that has a cell or needed all its tokens.
    """
    one = sets.where("n > 0").select("cls", "tokens").dropDuplicates(["cls"])
    low = _shared(one).withColumnRenamed("shared", "low_shared")
    none = F.array().cast("array<struct<df:bigint,token:bigint>>")
    known = sets.select("cls", "n", "n_low").where("n > 0").distinct().join(low, "cls", "left")
    known = known.withColumn("low_shared", F.coalesce("low_shared", none))
    n_common = F.size(F.filter("low_shared", lambda s: s["df"] >= sim.common))
    poor = F.col("n_low") - n_common < sim.look(F.col("n"))
    reach = (F.col("n_low") - F.size("low_shared")) < sim.look(F.col("n"))
    active = known.where(reach | poor).withColumn("poor", poor)
    active = written(active.join(classes.select("cls", "first"), "cls"), "active")

    texts = docs.join(active.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = texts.unionByName(docs.where("doc_id IS NULL"))  # a class may have no other rows
    full = token_sets(texts, sim, whole=True).select("cls", "n", "tokens")
    full = full.join(active.select("cls", "poor"), "cls")  # texts that repeat a doc_id may bring others
    full = written(full.dropDuplicates(["cls"]), "full")
    rest = full.where("poor").select("cls", F.filter("tokens", lambda t: t >= sim.low).alias("tokens"))
    high = _shared(rest).withColumnRenamed("shared", "high_shared")

    ranked = active.join(high, "cls", "left").withColumn("high_shared", F.coalesce("high_shared", none))
    rare = lambda c: F.array_sort(F.filter(c, lambda s: s["df"] < sim.common))
    often = lambda c: F.filter(c, lambda s: s["df"] >= sim.common)
    ranked = ranked.select(
        "cls",
        "n",
        sim.look(F.col("n")).alias("look"),
        (F.col("n_low") - F.size("low_shared")).alias("own_low"),
        # In steps of a twentieth: classes with the same share are of one kind.
        F.coalesce(F.floor(20 * (1 - F.size("low_shared") / F.nullif("n_low", F.lit(0)))), F.lit(20)).cast("int").alias("own"),
        (F.col("n") - F.col("n_low") - F.size("high_shared")).alias("own_high"),
        rare("low_shared").alias("low_rare"),
        rare("high_shared").alias("high_rare"),
        F.array_sort(F.concat(often("low_shared"), often("high_shared"))).alias("common"),
    )
    # In order: own and rare tokens of the counted part, then of the rest, then common ones.
    before_rest = F.col("own_low") + F.size("low_rare") + F.col("own_high")

    def placed(name: str, before: Column) -> Column:
        wanted = F.greatest(F.lit(0), F.least(F.col("look") - before, F.size(name))).cast("int")
        return F.transform(
            F.slice(name, 1, wanted), lambda s, i: F.struct(s["token"].alias("token"), (before + i).cast("int").alias("pos"))
        )

    first = F.concat(
        placed("low_rare", F.col("own_low")),
        placed("high_rare", before_rest),
        placed("common", before_rest + F.size("high_rare")),
    )
    cells = ranked.select("cls", "n", "own", F.inline(first))
    return written(cells, "cells"), full


def _verified(pairs: DataFrame, full: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs (a, b) that are linked, by exact intersection of their sets."""
    left = full.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = full.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = F.size(F.array_intersect("t_a", "t_b"))
    # Sets are large and pairs many: one plan at every size, without broadcasts.
    return pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").where(sim.linked(both, F.col("n_a"), F.col("n_b"))).select("a", "b")


def _near_size(n: str, m: str, sim: Similarity) -> Column:
    """Sets of these sizes can be linked."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * sim.percent


def _can_reach(n: str, i: Column, m: str, j: Column, sim: Similarity) -> Column:
    """Sets of sizes n and m whose first common token is at i and j can be linked.

    What follows the first common token must make up the least overlap in both sets. Any
    linked pair meets this at its first common token, so testing every common token alone
    loses no pair.
    """
    least = sim.least_overlap(F.col(n), F.col(m))
    return (F.col(n) - i >= least) & (F.col(m) - j >= least)


def _open_cells(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Cells of tokens that classes of different groups hold, with the group."""
    placed = cells.join(groups, "cls")
    several = placed.groupBy("token").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1")).where("g0 < g1")
    return placed.join(several.select("token"), "token")


def _star_round(cells: DataFrame, groups: DataFrame, full: DataFrame, sim: Similarity, nth: int) -> DataFrame:
    """Linked pairs, at most ``tests`` looked at per class: with leaders its tokens name.

    A token's leaders among classes of similar size are the least ones by several hashes of
    this round; the first of them has the least share of own tokens, as such classes are
    nearest to what all have in common. Sizes are cut into bands, moved by half a band in
    turn. A class tries the leaders that most of its tokens name and that it can reach.
    """
    band = F.floor(F.log("n") / -np.log(sim.percent / 100) + 0.5 * (nth % 2)).cast("int")
    ready = written(_open_cells(cells, groups).withColumn("band", band), "open")
    known = F.col("cls").alias("b"), F.col("grp").alias("g"), F.col("n").alias("m"), F.col("pos").alias("j")
    leads = [
        F.min(F.struct((F.col("own") if i == 0 else F.lit(0)).alias("rank"), F.xxhash64("cls", F.lit(nth), F.lit(i)).alias("h"), *known))
        for i in range(sim.tests)
    ]
    leaders = ready.groupBy("token", "band").agg(*[x.alias(f"l{i}") for i, x in enumerate(leads)])
    named = ready.join(leaders, ["token", "band"])
    chosen = F.array_distinct(F.array(*[F.struct(*[F.col(f"l{i}.{c}") for c in "bgmj"]) for i in range(sim.tests)]))
    named = named.select("cls", "grp", "n", "pos", F.inline(chosen)).where("g <> grp")
    seen = named.groupBy("cls", "n", "b", "m").agg(F.count("*").alias("hits"), F.min("pos").alias("i"), F.min("j").alias("j"))
    seen = seen.where(_near_size("n", "m", sim) & _can_reach("n", F.col("i"), "m", F.col("j"), sim))
    order = Window.partitionBy("cls").orderBy(F.desc("hits"), F.xxhash64("b", F.lit(nth)))
    best = seen.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sim.tests)
    return _verified(repacked(written(best.select(F.col("cls").alias("a"), "b"), "tests")), full, sim)


def _by_holders(cells: DataFrame, groups: DataFrame, sim: Similarity) -> tuple[DataFrame, DataFrame]:
    """Cells of tokens that several groups hold: those few classes hold, and those many do."""
    ready = _open_cells(cells, groups)
    held = ready.groupBy("token").agg(F.count("*").alias("held"))
    ready = written(ready.join(held, "token"), "open")
    few = F.col("held") < sim.common
    return ready.where(few).drop("held"), ready.where(~few).drop("held")


def _last_pairs(ready: DataFrame, groups: DataFrame, full: DataFrame, sim: Similarity) -> DataFrame:
    """All linked pairs of classes in different groups that share a cell of ``ready``.

    Of two groups that share a cell, the classes of the smaller one are the queries. A query
    opens the other group if its overlap with the group's token union can reach the
    threshold; then it is compared with the members whose cells it shares.
    """
    sizes = groups.groupBy("grp").agg(F.count("*").alias("size"))
    band = F.floor(F.log("n") / -np.log(sim.percent / 100)).cast("int")
    sized = ready.join(sizes, "grp").withColumn("band", band)
    range_of = F.min("n").alias("m0"), F.max("n").alias("m1"), F.min("pos").alias("j")
    matrix = sized.groupBy("token", F.col("grp").alias("g"), F.col("size").alias("g_size"), "band").agg(*range_of)
    smaller = (F.col("size") < F.col("g_size")) | ((F.col("size") == F.col("g_size")) & (F.col("grp") < F.col("g")))
    # The least overlap falls with m0; what a member has after a token is most for m1.
    reach = (F.col("n") - F.col("pos") >= sim.least_overlap(F.col("n"), F.col("m0"))) & (
        F.col("m1") - F.col("j") >= sim.least_overlap(F.col("n"), F.col("m1"))
    )
    fits = (F.col("m1") * 100 >= F.col("n") * sim.percent) & (F.col("n") * 100 >= F.col("m0") * sim.percent)
    wanted = sized.drop("band").join(matrix, "token").where(smaller & reach & fits)
    wanted = written(wanted.select("cls", "n", "g", "g_size").distinct(), "wanted")

    # A group of one is its own union: its bound would be the comparison itself.
    large = wanted.where("g_size > 1")
    members = groups.withColumnRenamed("grp", "g").join(large.select("g").distinct(), "g", "left_semi")
    union = full.join(members, "cls").select("g", F.explode("tokens").alias("token")).distinct()
    query = large.join(full.select("cls", "tokens"), "cls").select("cls", "n", "g", F.explode("tokens").alias("token"))
    bound = query.join(union, ["g", "token"]).groupBy("cls", "n", "g").agg(F.count("*").alias("overlap"))
    opened = bound.where(F.col("overlap") * 100 >= F.col("n") * sim.percent).select("cls", "n", "g")
    opened = written(opened.unionByName(wanted.where("g_size = 1").select("cls", "n", "g")), "opened")

    mine = opened.join(ready.select("cls", "token", "pos"), "cls").select(F.col("cls").alias("a"), "n", "g", "token", "pos")
    theirs = ready.select(
        F.col("grp").alias("g"), "token", F.col("cls").alias("b"), F.col("n").alias("m"), F.col("pos").alias("j")
    )
    near = _near_size("n", "m", sim) & _can_reach("n", F.col("pos"), "m", F.col("j"), sim)
    pairs = repacked(written(mine.join(theirs, ["g", "token"]).where(near).select("a", "b").distinct(), "pairs"))
    return _verified(pairs, full, sim)


def near_duplicates(docs: DataFrame, sim: Similarity = Similarity()) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_shingles, cls, grp, component_id.

    ``cls`` is the same for equal sets, ``grp`` for linked rows, also for those without any
    doc_id, and ``text_hash`` is ``xxhash64`` of the row's text. ``component_id`` is the smallest doc_id that can be
    reached over links, the row's own included. A null text is an empty one; empty sets link
    with nothing, so such a document is its own component. Rows that repeat a doc_id count
    as rows. A row without doc_id takes part, and has a null component if no row of its
    component has one. An empty table gives no rows; other columns do not matter.
    """
    ship(docs.sparkSession)
    sets = written(token_sets(docs, sim, whole=False), "sets")
    classes = sets.groupBy("cls").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"))
    cells, full = first_tokens(sets, docs, classes, sim)
    groups = cells.select("cls", F.col("cls").alias("grp")).distinct()
    groups = written(packed(groups, cells.count()), "groups")
    tried = Tried(docs)
    for nth in range(sim.rounds):
        edges = tried.add(_star_round(cells, groups, full, sim, nth).withColumn("linked", F.lit(True)))
        if edges.isEmpty():
            break
        groups = joined_groups(groups, edges)
    few, many = _by_holders(cells, groups, sim)
    edges = tried.add(_last_pairs(few, groups, full, sim).withColumn("linked", F.lit(True)))
    if not edges.isEmpty():
        groups = joined_groups(groups, edges)
    # Merging leaves no token with more groups; those with one by now are left out there.
    buckets = many.select(F.col("token").alias("key"), "cls", "n")
    items = full.withColumnRenamed("tokens", "items")
    groups = finer_groups(buckets, groups, items, MinHash(words=sim.words, percent=sim.percent, pairs=sim.common), tried)

    placed = classes.join(groups, "cls", "left").withColumn("grp", F.coalesce("grp", "cls"))
    least = placed.groupBy("grp").agg(F.min("first").alias("component_id"))
    found = placed.join(least, "grp").select("cls", "grp", "component_id")
    rows = sets.select("doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "cls").join(found, "cls")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "text_hash", "n_shingles", "cls", "grp", own.alias("component_id"))

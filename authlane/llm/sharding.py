"""Sharding by a weighted hash tree of regions, racks and shards.

A document descends the tree: at every node it takes the child with the smallest
exponential draw, ``-ln(u) / weight``, u a hash of (doc_id, node, child). The draw falls on
a *ticket*: the weight that a child got at one time. A tree starts with its founding shards
as one ticket per child; a shard added later is a ticket of its own on every level of its
path. A document that an added ticket wins goes straight to the added shard, one that it
loses descends as before, so growth moves rows into the new shard and nowhere else, and
only the subtrees on its path see their weight change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from authlane.llm.common import unit_draw

# Rows of a shard are numbered in so many slices at once.
SLICES = 1024


@dataclass(frozen=True)
class ShardTree:
    """Shards in racks in regions; those below ``founding`` make the tree, later ones are tickets."""

    shards: int
    founding: int = 24
    per_rack: int = 4
    racks: int = 2
    weights: tuple[float, ...] = ()

    def weight(self, shard: int) -> float:
        return self.weights[shard] if shard < len(self.weights) else 1.0

    def under(self, first: int, n: int) -> float:
        """Weight of the founding shards in a run."""
        return sum(self.weight(s) for s in range(first, min(first + n, self.shards, self.founding)))


def _descend(draws: list[Column], ids: list[Column]) -> Column:
    """The id with the smallest draw."""
    return F.least(*[F.struct(d.alias("draw"), i.alias("id")) for d, i in zip(draws, ids)])["id"] if len(ids) > 1 else ids[0]


def _draw(key: Column, level: str, child: Column, weight: Column) -> Column:
    return F.when(weight > 0, -F.log(unit_draw(key, F.lit(level), child)) / weight).otherwise(float("inf"))


def tree_shard(key: Column, tree: ShardTree) -> Column:
    """The shard of a key: three weighted hash draws, 4 + 2 + 4 hashes for 25 shards.

    A null key is a key like another. At least one shard is needed.
    """
    if tree.shards < 1:
        raise ValueError("a tree needs at least one shard")
    rack, region = tree.per_rack, tree.per_rack * tree.racks
    n_regions = -(-min(tree.shards, tree.founding) // region)
    weigh = lambda unit, n: F.array(*[F.lit(tree.under(i * unit, unit)) for i in range(n)])
    draws = [_draw(key, "region", F.lit(r), F.lit(tree.under(r * region, region))) for r in range(n_regions)]
    ids = [F.lit(r) for r in range(n_regions)]
    for s in range(tree.founding, tree.shards):  # tickets of added shards, as negative ids
        draws.append(_draw(key, "region", F.lit(-1 - s), F.lit(tree.weight(s))))
        ids.append(F.lit(-1 - s))
    won = _descend(draws, ids)
    rack_weights, shard_weights = weigh(rack, n_regions * tree.racks), weigh(1, n_regions * region)

    def level(parent: Column, name: str, fan: int, weights: Column) -> Column:
        children = [parent * fan + i for i in range(fan)]
        return _descend([_draw(key, name, c, F.get(weights, c)) for c in children], children)

    in_rack = level(level(won, "rack", tree.racks, rack_weights), "shard", rack, shard_weights)
    return F.when(won < 0, -1 - won).otherwise(in_rack)


def shard_documents(docs: DataFrame, tree: ShardTree) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the UTF-8 length plus 8 (8 for a null text, whose checksum is that of an
    empty one). ``slot`` numbers a shard's rows from 0 without gaps, by hash slice and then
    doc_id, checksum and size. ``grown_shard`` is the place after one more shard. Only the
    doc_id and the shard count decide, so rows that repeat a doc_id share a shard, equal
    texts need not, and other columns do not matter. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    grown = ShardTree(tree.shards + 1, tree.founding, tree.per_rack, tree.racks, tree.weights)
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        tree_shard(F.col("doc_id"), tree).alias("shard"),
        tree_shard(F.col("doc_id"), grown).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int").alias("slice"),
    )
    # Reads doc_id alone. One row per shard and slice: a bounded table.
    counts = placed.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("nth", F.row_number().over(within))
    return numbered.join(F.broadcast(starts), ["shard", "slice"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth") - 1).alias("slot"), "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, tree: ShardTree, files: int = 8) -> None:
    """The documents as Parquet, one folder per shard with about ``files`` files in it."""
    cut = F.pmod(F.xxhash64("doc_id"), F.lit(files))
    placed = docs.withColumn("shard", tree_shard(F.col("doc_id"), tree))
    placed.repartition(tree.shards * files, "shard", cut).write.partitionBy("shard").parquet(path)

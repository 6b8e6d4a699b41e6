"""Merkle manifest of a dataset: a hash tree per language, one tree over their roots.

Every node carries the interval of leaf ranks that it covers. Nodes are built in bands of
four levels, a block of sixteen at a time. A proof needs no walk: a node meets its parent by
containment of intervals inside a bucket of the parent's level, and the parent's interval
less its own is its sibling's. Leaves take their ancestors band by band, where a bucket has
sixteen leaves at most, and what is above a block is found once for the block. No row is
special: the tree of a language with all rows is as many small blocks as that of many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from authlane.functions.plan import computed_once
from authlane.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels of a band. One hexadecimal digit of a rank: see ``_bands``.
BAND = 4
PATH = "array<struct<level:int,left:boolean,sibling:binary>>"


def field(value: Column) -> Column:
    """A value as a leaf takes it: ``-`` for null, else its bytes' count, a colon, the bytes."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]), 256))


def as_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined_digest(left: Column, right: Column) -> Column:
    """The digest over one or two digests; either side may be null."""
    none = F.lit("")
    return F.unhex(F.sha2(F.concat(F.coalesce(as_text(left), none), F.coalesce(as_text(right), none)), 256))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 in their ``tree`` by ``order``, and ``size``, the tree's rows.

    Rows are dealt to ranges, counted there, and ranked inside a range. Ranges are written
    before anything counts them, so all readers see the same.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "tree", *order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranged")
    counts = ranged.groupBy("tree", "part").agg(F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(tree).alias("size")
    )
    within = Window.partitionBy("tree", "part").orderBy(*order)
    placed = ranged.withColumn("nth", F.row_number().over(within)).join(starts, ["tree", "part"])
    return placed.withColumn("rank", F.col("start") + F.col("nth") - 1).drop("part", "start", "nth")


def _bands(size: str) -> Column:
    """How many bands a tree of ``size`` leaves has: the hexadecimal digits of its last rank."""
    return F.length(F.hex(F.col(size) - 1))


def _above(nodes: Column) -> Column:
    """The parents of the consecutive nodes of one level, each with its interval."""

    def parent(i: Column) -> Column:
        a, b = F.get(nodes, 2 * i), F.get(nodes, 2 * i + 1)
        return F.struct(a["lo"].alias("lo"), F.coalesce(b["hi"], a["hi"]).alias("hi"), joined_digest(a["digest"], b["digest"]).alias("digest"))

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), parent)


def _of_level(nodes: str, level: int) -> Column:
    """The nodes with their level; none where the tree has no such level."""

    def marked(x: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest"))

    none = F.array().cast("array<struct<level:int,lo:bigint,hi:bigint,digest:binary>>")
    return F.coalesce(F.transform(nodes, marked), none)


def tree_nodes(leaves: DataFrame) -> DataFrame:
    """All nodes (tree, size, level, lo, hi, digest) over leaves (tree, size, rank, digest).

    A level's nodes are joined in twos, an odd last one alone, until one is left.
    """
    base = leaves.select(
        "tree", "size", F.lit(0).alias("level"), F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest"
    )
    base = written(base, "leaves")
    most = base.agg(F.max("size").alias("m")).first()["m"] or 1
    found = [base]
    for band in range(max(1, len(f"{most - 1:x}"))):
        block = F.shiftright("lo", BAND * (band + 1)).alias("block")
        row = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("l0")
        rows = base.where(F.col("size") > 1 << (BAND * band)).groupBy("tree", "size", block).agg(row)
        levels = []
        for i in range(1, BAND + 1):
            level = BAND * band + i
            # A level is there if more than one node was left below it.
            is_there = F.col("size") > F.lit(1 << (level - 1))
            rows = computed_once(rows, **{f"l{i}": F.when(is_there, _above(F.col(f"l{i - 1}")))})
            levels.append(_of_level(f"l{i}", level))
        made = written(rows.select("tree", "size", F.inline(F.concat(*levels))), "nodes")
        found.append(made)
        base = made.where(F.col("level") == BAND * (band + 1))
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def roots(nodes: DataFrame) -> DataFrame:
    """(tree, size, root): the node of each tree that covers all its leaves."""
    return nodes.where("lo = 0 AND hi = size").select("tree", "size", F.col("digest").alias("root"))


def siblings(nodes: DataFrame) -> DataFrame:
    """(tree, level, lo, hi, left, sibling) of every node below a root.

    ``left`` tells that the sibling comes first; ``sibling`` is null where a node is alone.
    """
    child = nodes.select("tree", "level", "lo", "hi", F.expr("shiftright(lo, level + 1)").alias("bucket"))
    parent = nodes.where("level > 0").select(
        "tree", (F.col("level") - 1).alias("level"), F.expr("shiftright(lo, level)").alias("bucket"),
        F.col("lo").alias("from"), F.col("hi").alias("until"),
    )
    inside = child.join(parent, ["tree", "level", "bucket"]).where("from <= lo AND hi <= until")
    left = F.col("lo") > F.col("from")
    rest = inside.select(
        "tree", "level", "lo", "hi", left.alias("left"),
        F.when(left, F.col("from")).otherwise(F.col("hi")).alias("s_lo"),
        F.when(left, F.col("lo")).otherwise(F.col("until")).alias("s_hi"),
    )
    other = nodes.select("tree", "level", F.col("lo").alias("s_lo"), F.col("hi").alias("s_hi"), F.col("digest").alias("sibling"))
    return rest.join(other, ["tree", "level", "s_lo", "s_hi"], "left").select("tree", "level", "lo", "hi", "left", "sibling")


def proofs(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """(tree, rank, path, ...) per leaf: its steps up to the root, then its tree's ``above``.

    ``ends`` has a row per tree (tree, size, above, ...): ``above`` are steps to follow, and
    its other columns come with every leaf.
    """
    steps = written(siblings(nodes), "steps").select(
        "tree", "level", F.expr("shiftright(lo, level)").alias("bucket"), F.col("lo").alias("s_lo"), F.col("hi").alias("s_hi"), "left", "sibling"
    )
    known = [c for c in ends.columns if c not in ("tree", "size", "above")]
    none = F.array().cast(PATH)
    most = nodes.where("level = 0").agg(F.max("size").alias("m")).first()["m"] or 1
    upper = None
    for band in reversed(range(max(1, len(f"{most - 1:x}")))):
        # Nodes of the band's lowest level, in trees that go on in this band.
        base = nodes.where((F.col("level") == BAND * band) & (_bands("size") > band)).select("tree", "lo")
        wanted = base.withColumn("level", F.explode(F.sequence(F.lit(BAND * band), F.lit(BAND * (band + 1) - 1))))
        wanted = wanted.withColumn("bucket", F.expr("shiftright(lo, level)"))
        met = wanted.join(steps, ["tree", "level", "bucket"]).where("s_lo <= lo AND lo < s_hi")
        step = F.struct("level", "left", "sibling")
        climbed = met.groupBy("tree", "lo").agg(F.array_sort(F.collect_list(step)).alias("own"))
        climbed = base.join(climbed, ["tree", "lo"], "left").withColumn("block", F.shiftright("lo", BAND * (band + 1)))
        # A tree ends in the band in which it has one block.
        last = ends.where(_bands("size") == band + 1).select("tree", F.lit(0).cast("long").alias("block"), "above", *known)
        upper = last if upper is None else last.unionByName(upper)
        path = F.concat(F.coalesce("own", none), "above").alias("above")
        upper = climbed.join(upper, ["tree", "block"]).select("tree", F.shiftright("lo", BAND * band).alias("block"), path, *known)
        upper = written(upper, "paths")
    return upper.select("tree", F.col("block").alias("rank"), F.col("above").alias("path"), *known)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(
        path,
        leaf,
        lambda up, s: joined_digest(F.when(s["left"], s["sibling"]).otherwise(up), F.when(s["left"], up).otherwise(s["sibling"])),
    )


def proof_digest(path: Column) -> Column:
    """The digest over a path's siblings, from the leaf up."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: as_text(s["sibling"]))), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, lang, rank, leaf, subroot, root, path, as binary digests.

    A leaf is the digest over the row's doc_id, source, lang, n_chars and text. The leaves
    of a language ascend by doc_id, null first, and by leaf where rows repeat a doc_id; a
    null language is one of its own. ``path`` has a step per level up to ``root``: the
    sibling, null where there is none, and whether it comes first. An empty text is a value
    of no bytes, unlike null. Equal rows are leaves of their own. An empty table gives no
    rows, and other columns do not matter.
    """
    values = {c: F.col(c) for c in FIELDS}
    leaves = docs.select("doc_id", "lang", leaf_digest(**values).alias("leaf"))
    return _proved(leaves)


def _proved(leaves: DataFrame) -> DataFrame:
    # The null language comes first; all others begin with a mark.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    rows = written(leaves.withColumn("tree", tree).withColumn("row", F.monotonically_increasing_id()), "leaves")
    ranked = written(numbered(rows, "doc_id", "leaf", "row"), "ranked")
    nodes = tree_nodes(ranked.withColumnRenamed("leaf", "digest"))

    subroots = written(roots(nodes).withColumnRenamed("root", "subroot"), "subroots")
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest"))
    tops = written(numbered(tops, "name"), "tops")
    top_nodes = tree_nodes(tops)
    top_ends = roots(top_nodes).withColumn("above", F.array().cast(PATH))
    top_paths = proofs(top_nodes, top_ends).select("rank", F.col("path").alias("above"), "root")
    named = tops.select(F.col("name").alias("tree"), "rank").join(top_paths, "rank").drop("rank")
    ends = written(subroots.join(named, "tree"), "ends")
    return ranked.join(proofs(nodes, ends), ["tree", "rank"]).drop("tree", "size", "row")


def tampered_manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """``manifest`` with rows checked against it after ``n_chars`` grew by one where ``tampered``.

    Adds ``folded_root``, to which the changed leaf and the original path lead. A null
    n_chars stays null, and a null ``tampered`` counts as no.
    """
    values = {c: F.col(c) for c in FIELDS}
    leaf = leaf_digest(**values)
    changed = F.when(tampered & F.col("n_chars").isNotNull(), leaf_digest(**values | {"n_chars": F.col("n_chars") + 1}))
    found = _proved(docs.select("doc_id", "lang", leaf.alias("leaf"), changed.alias("changed")))
    return found.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path"))).drop("changed")

"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a word budget. It is met by complete epochs over the source and then a
weighted sample without replacement: every document draws an exponential key divided by its
quality weight, and the smallest keys are taken until their sizes fill the rest. The order
is never sorted as a whole: keys fall into slices, slice sums are prefix-summed, and rows
are ordered inside their slice, so a source with a third of all rows is spread over tasks.
Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from authlane.functions.plan import computed_once
from authlane.llm.common import SPACE, SPACES, unit_draw, written

# Slices of the key axis of a source.
SLICES = 4096


def sized(docs: DataFrame, quality: Column | None = None) -> DataFrame:
    """(doc_id, source, text_hash, size, quality): a text's words and its quality weight.

    ``quality`` is an expression over ``docs`` in (0, 1]; by default it is the share of
    different words, from 0.05 to 1: texts that repeat themselves weigh less.
    """
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACE))
    words = F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(F.split("text", SPACES))
    base = docs.select(trimmed.alias("text"), F.col("doc_id"), F.col("source"), F.xxhash64("text").alias("text_hash"), (F.lit(None).cast("double") if quality is None else quality).alias("given"))
    split = computed_once(base, words=words)
    size = F.size("words").cast("long")
    share = F.when(size == 0, 1.0).otherwise(F.size(F.array_distinct("words")) / size)
    return split.select("doc_id", "source", "text_hash", size.alias("size"), F.coalesce("given", 0.05 + 0.95 * share).alias("quality"))


def source_targets(sums: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the total of
    all sizes; none gets more than ``cap`` times its size, and what is cut off goes to the
    others by weight. With the sources in order of ``cap * size / weight`` the ones that are
    cut come first, so the level the rest is raised to follows from running sums.
    """
    last = F.when(F.col("source").isNull(), 1).otherwise(0)
    nth = F.row_number().over(Window.orderBy(last, "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    total = Window.partitionBy()
    ranked = sums.select("source", "source_size", weight.alias("weight"), (F.lit(cap) * F.col("source_size")).alias("most"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), last, "source").rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.select(
        "*",
        F.sum("source_size").over(total).alias("all_words"),
        F.sum("weight").over(total).alias("all_weight"),
        F.coalesce(F.sum("most").over(by_level), F.lit(0.0)).alias("cut_words"),
        F.coalesce(F.sum("weight").over(by_level), F.lit(0.0)).alias("cut_weight"),
    )
    # If all sources before this one are cut, the others are raised to this level.
    level = (F.col("all_words") - F.col("cut_words")) / (F.col("all_weight") - F.col("cut_weight"))
    levels = levels.withColumn("level", level)
    met = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    # The first source that is not cut sets the level.
    final = F.min_by(met, F.when(met.isNotNull(), F.col("most") / F.col("weight"))).over(total)
    target = F.least(F.col("most"), F.coalesce(final * F.col("weight"), F.col("most")))
    return levels.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: int = 7, quality: Column | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, source, text_hash, size, source_size, target, copies, taken.

    ``copies`` is how often the mix holds the document, ``taken`` its words in all. After the
    epochs a source is short of less than one epoch; the documents of smallest key are taken
    whole while they fit, and one more, the closest in size, if that comes nearer.
    ``quality`` is an expression over the input that replaces the quality weight.

    A null text has no words; documents without words are never drawn, only repeated with
    their epochs. A null source is a source, last in order. Rows that repeat a doc_id are
    documents of their own. Ties of keys are ordered by doc_id, then text. Equal input gives
    equal output, whatever its order. An empty table gives no rows.
    """
    rows = sized(docs, quality)
    key = -F.log(unit_draw(F.col("doc_id"), F.col("text_hash"), F.lit(seed))) / F.col("quality")
    drawn = rows.withColumn("key", key)
    drawn = drawn.withColumn("slice", F.floor((1 - F.exp(-F.col("key") * 0.75)) * SLICES).cast("int"))
    drawn = written(drawn.drop("quality"), "drawn")

    sums = drawn.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = source_targets(sums)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("epochs", epochs)
    goals = goals.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    slices = drawn.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("source", "slice", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    slices = slices.alias("s").join(goals.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
    slices = slices.select("s.source", "slice", "before", "source_size", "target", "epochs", "rest")

    # Null sources must meet in a plain join: a marked copy of the name is the key.
    mark = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    marked = drawn.withColumn("mark", mark)
    order = Window.partitionBy("mark", "slice").orderBy("key", "doc_id", "text_hash")
    running = marked.withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    starts = written(slices.withColumn("mark", mark).drop("source"), "starts")
    placed = running.join(starts, ["mark", "slice"]).withColumn("until", F.col("before") + F.col("within"))
    placed = written(placed.drop("within", "before", "key"), "placed")

    # What is known of a source meets its rows slice by slice: no source lands in one task.
    parts = starts.select("mark", "slice")

    fits = (F.col("until") <= F.col("rest")) & (F.col("size") > 0)
    filled = placed.where(fits).groupBy("mark").agg(F.max("until").alias("filled"))
    gaps = placed.groupBy("mark").agg(F.max("rest").alias("rest")).join(filled, "mark", "left")
    gaps = gaps.select("mark", (F.col("rest") - F.coalesce("filled", F.lit(0))).alias("gap"))
    miss = F.abs(F.col("size") - F.col("gap"))
    unfit = placed.where(~fits & (F.col("size") > 0))
    closing = unfit.join(gaps.join(parts, "mark"), ["mark", "slice"]).where(miss < F.col("gap"))
    closing = closing.groupBy("mark").agg(F.min(F.struct(miss.alias("miss"), F.col("until").alias("closing")))["closing"].alias("closing"))

    one_more = fits | ((F.col("until") == F.col("closing")) & (F.col("size") > 0))
    copies = F.col("epochs") + F.when(one_more, 1).otherwise(0)
    chosen = placed.join(closing.join(parts, "mark"), ["mark", "slice"], "left").withColumn("copies", copies.cast("long"))
    return chosen.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the columns of ``docs``.

    Rows equal in doc_id and text are one document here. Documents the mix does not take go.
    """
    plan = mix(docs, seed).groupBy("doc_id", "text_hash").agg(F.sum("copies").alias("copies")).where("copies > 0")
    whole = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    single = whole.dropDuplicates(["doc_id", "text_hash"])
    same = single["doc_id"].eqNullSafe(plan["doc_id"]) & (single["text_hash"] == plan["text_hash"])
    taken = single.join(plan, same).select("row", "copies")
    return taken.select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")

"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text falls into paragraphs, each is hashed, and every digest is put into one cell of each
of three tables. A cell keeps a count, and the xor of its digests and of their checks. The
sketches of two versions subtract cell by cell: what they share cancels, and the digests in
which they differ come out by peeling cells that hold one digest. If peeling gets stuck the
digests are dealt by hash to parts, as many as the two texts' digests ask for, and each part
has sketches of its own, with other hashes, and four times larger ones where they get stuck
again. Two sets of which a part is stuck there too are compared in that part as they are.

A paragraph is a line, or a stretch of a line that ends at a chosen pair of words. The pair
alone chooses, so texts of any length are cut alike, and what is added or taken out changes
the paragraphs it touches and no others. Only DataFrame functions run here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from authlane.functions.plan import computed_once

TABLES = 3
# Cells per table of a fingerprint, then of the sketches of a part.
SIZE, PART_SIZES = 8, (8, 32)
# Digests of both texts that a part has on average.
LOAD = 10
ROUNDS = 16
# One pair of words in so many ends a paragraph.
PAIRS = 16
# A word ends with white space, an ASCII punctuation mark, or a character of a script without
# spaces; white space that follows belongs to it. Runs of ASCII letters are read first, as the
# class of all ends is slow to test.
ENDS = r"\s\p{Punct}\p{IsIdeographic}\p{InHiragana}\p{InKatakana}\p{InThai}"
WORD = rf"[A-Za-z0-9]*+[^{ENDS}]*+[{ENDS}]\s*+|[^{ENDS}]++"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digests(text: Column) -> Column:
    """The different paragraph digests of a text. An empty text is one empty paragraph."""

    def cut(words: Column) -> Column:
        def last(i: Column) -> Column:
            pair = F.xxhash64(F.get(words, i - 1), F.get(words, i))
            return (i == F.size(words)) | (F.pmod(pair, F.lit(PAIRS)) == 0)

        def paragraphs(ends: Column) -> Column:
            def digest(end: Column, j: Column) -> Column:
                before = F.coalesce(F.get(ends, j - 1), F.lit(0))
                return F.xxhash64(F.slice(words, before + 1, end - before))

            return F.transform(ends, digest)

        return _bound(F.filter(F.sequence(F.lit(1), F.size(words)), last), paragraphs)

    def words_of(line: Column) -> Column:
        return F.when(line == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(line, F.lit(WORD), F.lit(0)))

    lines = F.transform(F.split(text, "\n", -1), lambda line: _bound(words_of(line), cut))
    return F.array_distinct(F.flatten(lines))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest).bitwiseAND(F.lit(0xFFFFFFFF))


def _places(digest: Column, size: int, turn: int) -> list[Column]:
    """The cells of a digest, one in each table: each table and each turn hashes anew."""
    hashes = [F.xxhash64(digest, F.lit(t + TABLES * turn)) for t in range(TABLES)]
    return [(F.pmod(h, F.lit(size)) + t * size).cast("int").alias(f"p{t}") for t, h in enumerate(hashes)]


def _cell(count: Column, key: Column, check: Column) -> Column:
    return F.struct(count.cast("int").alias("c"), key.alias("k"), check.alias("h"))


def _signed(keys: Column, sign: int) -> Column:
    return F.transform(keys, lambda k: F.struct(k.alias("k"), _check(k).alias("h"), F.lit(sign).alias("sign")))


def _cells(signed: Column, size: int, turn: int) -> Column:
    """The cells of signed digests. Those of two sets, one with sign -1, are their sketches' difference."""
    empty = _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))

    def put(cell: Column, x: Column) -> Column:
        return _cell(cell["c"] + x["sign"], cell["k"].bitwiseXOR(x["k"]), cell["h"].bitwiseXOR(x["h"]))

    def table(placed: Column, t: int) -> Column:
        cells = F.sequence(F.lit(t * size), F.lit((t + 1) * size - 1))
        return F.transform(cells, lambda i: F.aggregate(F.filter(placed, lambda x: x[f"p{t}"] == i), empty, put))

    placed = F.transform(signed, lambda x: F.struct(x["k"].alias("k"), x["h"].alias("h"), x["sign"].alias("sign"), *_places(x["k"], size, turn)))
    return _bound(placed, lambda p: F.concat(*[table(p, t) for t in range(TABLES)]))


def sketch(keys: Column, size: int, turn: int = 0) -> Column:
    """The cells of a set of digests."""
    return _cells(_signed(keys, 1), size, turn)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(
        a, b, lambda x, y: _cell(x["c"] - y["c"], x["k"].bitwiseXOR(y["k"]), x["h"].bitwiseXOR(y["h"]))
    )


def peel(cells: Column, size: int, turn: int = 0) -> Column:
    """The digests left in a difference of sketches as (k, h, sign, places); null if it gets stuck.

    Sign 1 is in the first sketch alone, -1 in the second. A round takes out every digest
    that is alone in some cell.
    """
    places = ",".join(f"p{t}:int" for t in range(TABLES))
    none = F.array().cast(f"array<struct<k:bigint,h:bigint,sign:int,{places}>>")

    def alone(state: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["c"]) == 1) & (_check(c["k"]) == c["h"]))
        return F.array_distinct(
            F.transform(pure, lambda c: F.struct(c["k"].alias("k"), c["h"].alias("h"), c["c"].alias("sign"), *_places(c["k"], size, turn)))
        )

    def without(state: Column, found: Column) -> Column:
        def take(cell: Column, x: Column) -> Column:
            return _cell(cell["c"] - x["sign"], cell["k"].bitwiseXOR(x["k"]), cell["h"].bitwiseXOR(x["h"]))

        left = F.transform(
            state["cells"],
            lambda c, i: F.aggregate(F.filter(found, lambda x: (x["p0"] == i) | (x["p1"] == i) | (x["p2"] == i)), c, take),
        )
        return F.struct(left.alias("cells"), F.concat(state["found"], found).alias("found"), F.lit(True).alias("on"))

    def step(state: Column, _: Column) -> Column:
        ended = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("on"))
        taken = _bound(alone(state), lambda found: F.when(F.size(found) == 0, ended).otherwise(without(state, found)))
        return F.when(state["on"], taken).otherwise(state)

    start = F.struct(cells.alias("cells"), none.alias("found"), F.lit(True).alias("on"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return _bound(
        end,
        lambda s: F.when(
            ~F.exists(s["cells"], lambda c: (c["c"] != 0) | (c["k"] != 0) | (c["h"] != 0)), s["found"]
        ),
    )


def _keys(found: Column) -> Column:
    return F.transform(found, lambda x: x["k"])


def _part(signed: Column) -> Column:
    """The digests in which the two sets of a part differ; compared as they are if no sketch peels."""

    def of(s: Column) -> Column:
        a, b = (_keys(F.filter(s, lambda x: x["sign"] == sign)) for sign in (1, -1))
        peeled = [_keys(peel(_cells(s, size, turn), size, turn)) for turn, size in enumerate(PART_SIZES, 1)]
        return F.coalesce(*peeled, F.concat(F.array_except(a, b), F.array_except(b, a)))

    return _bound(signed, of)


def by_parts(a: Column, b: Column) -> Column:
    """The digests in which two sets differ, from sketches of parts of them.

    The number of parts is a square that follows the digests, dealt in two steps.
    """

    def dealt(signed: Column, wide: Column) -> Column:
        # Bits that the places in a sketch do not depend on.
        place = F.transform(signed, lambda x: F.struct(x["k"].alias("k"), x["h"].alias("h"), x["sign"].alias("sign"), F.pmod(F.xxhash64(x["k"], F.lit("part")), wide * wide).cast("int").alias("part")))
        each = F.sequence(F.lit(0), wide - 1)

        def row(i: Column, of: Column) -> Column:
            mine = F.filter(of, lambda x: F.floor(x["part"] / wide) == i)
            return _bound(mine, lambda m: F.flatten(F.transform(each, lambda j: _part(F.filter(m, lambda x: x["part"] % wide == j)))))

        return _bound(place, lambda of: F.flatten(F.transform(each, lambda i: row(i, of))))

    def wide(signed: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(signed) / LOAD)).cast("int"))

    return _bound(F.concat(_signed(a, 1), _signed(b, -1)), lambda s: _bound(wide(s), lambda w: dealt(s, w)))


def differing(a: Column, b: Column, cells_a: Column | None = None, cells_b: Column | None = None) -> Column:
    """The digests in which two sets differ: from their smallest sketches, or else by parts."""
    first = subtract(sketch(a, SIZE) if cells_a is None else cells_a, sketch(b, SIZE) if cells_b is None else cells_b)
    return F.coalesce(_keys(peel(first, SIZE)), by_parts(a, b))


def likeness(a: Column, b: Column, d: Column) -> Column:
    """Jaccard similarity of two sets, from their sizes and the size of their difference."""
    both = F.size(a) + F.size(b)
    return (both - d) / (both + d)


def fingerprint(keys: Column, cells: Column) -> Column:
    """The smallest sketch as text: the number of digests, and the cells."""
    texts = F.transform(cells, lambda c: F.concat_ws(".", c["c"].cast("string"), F.hex(c["k"]), F.hex(c["h"])))
    return F.concat_ws(" ", F.size(keys).cast("string"), F.array_join(texts, " "))


def with_next(docs: DataFrame, added: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """(doc_id, text, next_text): each text and that of the next doc_id; the first after the last.

    Columns that ``added`` makes of a text are made once a row, and the next row's follow as
    next_ and their name.

    Rows are dealt to ranges of doc_id, whose bounds are ids that occur, and ordered inside
    them. The first row of a range also goes to the range before, where it comes last and
    gives its text to the one before it. A null text is an empty one. Rows without doc_id
    come first. Rows that repeat a doc_id follow each other by text.
    """
    spark = docs.sparkSession
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = [i / n for i in range(n)]
    # At most one number per shuffle partition.
    bounds = docs.agg(F.percentile_approx("doc_id", cuts, 10 * n).alias("b")).first()["b"] or [0]
    bounds = sorted({first_id(docs), *bounds} - {None}) or [0]
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    # Binary search for the last bound that is not above the id.
    halves = F.sequence(F.lit(1), F.lit(max(1, len(bounds).bit_length())))

    def search(id_: Column) -> Column:
        def half(s: Column, _: Column) -> Column:
            mid = F.floor((s["lo"] + s["hi"] + 1) / 2).cast("int")
            up = F.get(array, mid) <= id_
            return F.struct(
                F.when(up, mid).otherwise(s["lo"]).alias("lo"), F.when(up, s["hi"]).otherwise(F.least(mid - 1, s["hi"])).alias("hi")
            )

        start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds) - 1).alias("hi"))
        return F.aggregate(halves, start, lambda s, i: F.when(s["lo"] < s["hi"], half(s, i)).otherwise(s))["lo"]

    bucket = F.coalesce(search(F.col("doc_id").cast("long")), F.lit(0))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), bucket.alias("bucket"))
    rows = rows.withColumn("first", F.coalesce(F.get(array, F.col("bucket")) == F.col("doc_id"), F.lit(False)))
    here = F.struct(F.col("bucket").alias("range"), F.lit(0).alias("extra"))
    before = F.struct(F.pmod(F.col("bucket") - 1, F.lit(len(bounds))).alias("range"), F.lit(1).alias("extra"))
    dealt = rows.select(
        "doc_id", "text", F.inline(F.when(F.col("first"), F.array(here, before)).otherwise(F.array(here)))
    )
    # Dealt to their ranges first, so that what is added does not cross the exchange.
    told = added(dealt.repartition("range"))
    order = Window.partitionBy("range").orderBy("extra", "doc_id", "text")
    following = {f"next_{c}": F.lead(c).over(order) for c in told.columns if c not in ("doc_id", "range", "extra")}
    return told.withColumns(following).where("extra = 0").drop("range", "extra")


def first_id(docs: DataFrame) -> int | None:
    """The smallest doc_id."""
    return docs.agg(F.min("doc_id").alias("m")).first()["m"]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and two likenesses.

    The edited text has the last quarter of its code points replaced by the first as many
    (or all) of the next document. Columns: doc_id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next. Equal texts have equal fingerprints. A null
    text is an empty one; two empty texts have likeness 1. A table of one row has itself as
    its next. An empty table gives no rows, and other columns do not matter.
    """

    def sketched(rows: DataFrame, text: str, name: str = "") -> DataFrame:
        keyed = computed_once(rows, **{f"{name}keys": digests(F.col(text))})
        return computed_once(keyed, **{f"{name}cells": sketch(F.col(f"{name}keys"), SIZE)})

    # A text's own sketch is also that of the next text of the row before.
    paired = with_next(docs, lambda rows: sketched(rows, "text")).withColumn("n_chars", F.char_length("text"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - quarter), F.substring("next_text", F.lit(1), quarter))
    both = sketched(computed_once(paired, edited=edited), "edited", "new_")

    def apart_from(other: str) -> Column:
        return F.size(differing(F.col("keys"), F.col(f"{other}_keys"), F.col("cells"), F.col(f"{other}_cells")))

    apart = computed_once(both, edited_apart=apart_from("new"), next_apart=apart_from("next"))
    return apart.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited",
        fingerprint(F.col("keys"), F.col("cells")).alias("fingerprint"),
        fingerprint(F.col("new_keys"), F.col("new_cells")).alias("edited_fingerprint"),
        likeness(F.col("keys"), F.col("new_keys"), F.col("edited_apart")).alias("near_edited"),
        likeness(F.col("keys"), F.col("next_keys"), F.col("next_apart")).alias("near_next"),
    )

"""Mixing sources to target weights by a low-discrepancy schedule.

Slot k of the schedule is the point k * phi mod 1 (golden ratio, in whole numbers of 2^-31). Cumulative targets cut the
unit interval into one stretch per source, and the stretch that a point falls into names the slot's source. So any run
of slots holds the sources in nearly their target shares. A source's rows, shuffled by a hash, make a stream of words
that starts again at its end; the stream is cut into blocks of equal size, one for each of the source's slots, and the
slot of rank j takes block j. The blocks of a source together are its target, to the word.

Everything is DataFrame work. No task holds a source: offsets and ranks are running totals over lanes
(``running_total``), in which the rows of a source that share identifier and size are one with a count, so that many rows
of one identifier take no more room there than it has sizes. One row per source passes through a single task; that many sources must fit there.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of its own, last in
order; rows that repeat are rows of their own; an empty table gives an empty mix; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridplume.llm.common import WORD, running_total
from gridplume.session import as_written

#: The schedule's points are multiples of 1 / GRID. STEP is the odd whole number next to GRID / golden ratio.
GRID = 2**31
STEP = 1327217885
#: Rows of a lane of shuffled rows, about, and slots of a lane of the schedule.
LANE_ROWS = 1024
LANE_SLOTS = 65536
#: Rows that share identifier and size are told apart again in portions of so many.
COPIES = 4096


@dataclass(frozen=True)
class Mix:
    """``rows``: doc_id, source, ix, size, start (place of its first word in its source's stream).
    ``sources``: ix, source, source_size, target, words (whole words of the target), slots.
    ``slots``: slot, ix, rank. ``pieces``: slot, ix, rank, doc_id, start, size, words (what the slot takes of a row)."""

    rows: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def with_targets(sizes: DataFrame, weights: Sequence[int], ceiling: int) -> DataFrame:
    """Adds ix, target and words to one row per source (source, source_size).

    The total is shared by weight, and no target exceeds ``ceiling`` times its source's size: targets are
    min(ceiling * size, level * weight). In the order of ceiling * size / weight the sources at their ceiling come
    first; taking the first i as such gives a level, and the right one is the largest.
    """
    ix = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("ix") - 1, F.lit(len(weights))) + 1)
    ranked = sizes.withColumn("ix", ix).withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * ceiling)
    order = Window.orderBy(F.col("most") / F.col("weight"), "ix")
    level = (F.sum("source_size").over(Window.partitionBy()) - (F.sum("most").over(order) - F.col("most"))) / F.sum("weight").over(
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    highest = ranked.withColumn("level", level).withColumn("level", F.max("level").over(Window.partitionBy()))
    target = F.least(F.col("most").cast("double"), F.col("level") * F.col("weight"))
    return highest.withColumn("target", target).withColumn("words", F.floor("target").cast("long")).drop("weight", "most", "level")


def schedule(sources: DataFrame, n_slots: int, n_sources: int) -> DataFrame:
    """slot, ix, rank of ``n_slots`` points, and one slot at the end for each source that no point fell to.

    A point finds its source by an equal join on a cell of the interval; cells hold equally many points.
    """
    spark = sources.sparkSession
    along = Window.orderBy("ix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.sum("words").over(Window.partitionBy())
    ends = sources.where("words > 0").withColumn("high", F.floor(F.sum("words").over(along) / whole * float(GRID)).cast("long"))
    stretches = ends.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("ix")), F.lit(0).cast("long"))).where("high > low")
    width = max(1, GRID // max(1024, 1 << (4 * n_sources).bit_length()))
    cells = stretches.select(
        "ix", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell")
    )
    slot = F.col("id")
    points = spark.range(n_slots).select(slot.alias("slot"), F.pmod(F.pmod(slot + 1, F.lit(GRID)) * STEP, F.lit(GRID)).alias("u"))
    mapped = points.withColumn("cell", F.floor(F.col("u") / width)).join(cells, "cell").where("u >= low and u < high")
    lanes = mapped.select("slot", "ix", F.floor(F.col("slot") / LANE_SLOTS).alias("lane"), F.lit(1).cast("long").alias("one"))
    ranked = running_total(lanes, ["ix"], "lane", ["slot"], "one", "rank").select("slot", "ix", "rank")
    found = as_written(ranked, "slots")
    late = sources.where("words > 0").join(found.select("ix").distinct(), "ix", "left_anti")
    return found.unionByName(late.select((F.col("ix") + n_slots).cast("long").alias("slot"), "ix", F.lit(0).cast("long").alias("rank")))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    ceiling: int = 3,
    block_words: int = 256,
    seed: str = "mix",
) -> Mix:
    """The mix of all of ``docs``: as many words as they have, dealt to the sources by weight.

    Blocks have ``block_words`` words, about. A run with the same rows and the same ``seed`` gives the same mix.
    """
    sized = docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"), word_count(docs[text_col]).alias("size")
    )
    same = as_written(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "sized")
    same = same.withColumn("words", F.col("size") * F.col("copies"))
    sizes = same.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("copies").alias("rows"))
    sources = as_written(with_targets(sizes, weights, ceiling), "sources")
    total, n_sources, most_rows = sources.agg(F.sum("source_size"), F.count(F.lit(1)), F.max("rows")).first()
    n_slots = ((total or 0) + block_words // 2) // block_words
    slots = schedule(sources, n_slots, n_sources)
    counts = slots.groupBy("ix").agg(F.count(F.lit(1)).alias("slots"))
    sources = as_written(
        sources.join(counts, "ix", "left").withColumn("slots", F.least(F.coalesce("slots", F.lit(0).cast("long")), "words")), "sources"
    )
    digits = 1
    while 16**digits * LANE_ROWS < (most_rows or 0):
        digits += 1
    numbered = same.join(sources.select("ix", F.col("source").alias("_source")), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    key = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    lanes = numbered.withColumn("key", key).withColumn("lane", F.substring("key", 1, digits))
    rows = _single(running_total(lanes, ["ix"], "lane", ["key", "doc_id", "size"], "words", "start").drop("key", "lane", "words"))
    rows = as_written(rows, "rows")
    return Mix(rows, sources, slots, _pieces(rows, sources, slots))


def _single(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say, one behind the other; many copies are dealt to many tasks."""
    some = F.col("copies") <= COPIES
    portions = rows.where(~some).withColumn("portion", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
    split = portions.repartition("ix", "start", "portion").withColumn("first", F.col("portion") * COPIES).drop("portion")
    whole = rows.where(some).withColumn("first", F.lit(0).cast("long")).unionByName(split)
    copy = F.explode(F.sequence(F.col("first"), F.least("copies", F.col("first") + COPIES) - 1))
    return whole.withColumn("copy", copy).withColumn("start", F.col("start") + F.col("copy") * F.col("size")).drop("copies", "first", "copy")


def _pieces(rows: DataFrame, sources: DataFrame, slots: DataFrame) -> DataFrame:
    """Cuts rows at the blocks' ends and joins each block to its slot.

    Of ``words`` words in ``slots`` blocks the first ``words mod slots`` blocks have one more than the others.
    """
    known = sources.where("slots > 0").select(
        "ix", "source_size", F.col("words").alias("all_words"), F.expr("words div slots").alias("base"), F.expr("words % slots").alias("more")
    )
    passes = (
        rows.where("size > 0").join(known, "ix")
        .withColumn("pass", F.explode(F.expr("sequence(0L, (all_words - 1) div source_size)")))
        .withColumn("low", F.col("pass") * F.col("source_size") + F.col("start"))
        .withColumn("high", F.least(F.col("low") + F.col("size"), F.col("all_words")))
        .where("low < high")
    )
    cut = passes.withColumn("rank", F.explode(F.sequence(_block("low"), _block("high - 1"))))
    words = F.least("high", _edge(F.col("rank") + 1)) - F.greatest("low", _edge(F.col("rank")))
    cut = cut.select("ix", "rank", "doc_id", "start", "size", words.alias("words"))
    return cut.join(slots, ["ix", "rank"]).select("slot", "ix", "rank", "doc_id", "start", "size", "words")


def _block(word: str) -> Column:
    """The block that a word of the stream lies in."""
    return F.expr(
        f"case when {word} < more * (base + 1) then ({word}) div (base + 1) else more + ({word} - more * (base + 1)) div base end"
    )


def _edge(rank: Column) -> Column:
    return rank * F.col("base") + F.least(rank, F.col("more"))


def taken(mixed: Mix) -> DataFrame:
    """One row for each row of the input: doc_id, size, source, source_size, target, taken (its words in the mix)."""
    some = mixed.pieces.select("ix", "start", "doc_id", "size", "words")
    all_rows = mixed.rows.select("ix", "start", "doc_id", "size")
    none = F.lit(0).cast("long").alias("words")
    sums = some.unionByName(all_rows.where("size > 0").select("*", none)).groupBy("ix", "start", "doc_id", "size").agg(F.sum("words").alias("taken"))
    empty = all_rows.where("size = 0").select("*", none.alias("taken"))
    return (
        sums.unionByName(empty).join(mixed.sources, "ix")
        .select("doc_id", "size", "source", "source_size", "target", "taken")
    )

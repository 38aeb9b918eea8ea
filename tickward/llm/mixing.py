"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of equally many tokens. Slot i draws the point frac(i * golden ratio) and belongs to the source whose
share of the cumulated targets holds that point, so that every stretch of the schedule has nearly the right shares. Sources too
small for a thousand slots of that length have a schedule of shorter slots among themselves, and so on, so that every source, however small beside
the others, gets its target to a thousandth or to the word. The
k-th slot of a source takes the k-th block of its tokens: its documents, shuffled by a hash, laid end to end, and laid
out once more when they run out. Everything is DataFrame operations; no document is cut by the operator itself.

Sizes are words; NULL and empty texts have size 0 and are never taken. A NULL source is a source of its own, last in
order. Repeated rows are laid out one by one. An empty table gives an empty result. Reruns agree, since shuffling goes
by md5 of the id, ties by size.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickward.llm.common import stored, words_of

WEIGHTS = (3, 1, 2)
GOLDEN = (math.sqrt(5) - 1) / 2
SLOTS = 1 << 20  # of a schedule, or more if it takes more to give its largest source FINE of them
FINE = 1024  # slots of a source at least, unless a slot is one word
CELLS = 1024


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Words each source gives: source, source_size, target and the cumulated targets before it.

    Sources in code point order, NULL last, weigh 3, 1, 2, 3, ... and share ``share`` times all words. No target is above
    ``most`` times its source's size: what is over is shared by weight among the others. In the order of size per
    weight, a source is at its limit exactly if its part of what the sources before it have left reaches the limit.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.asc_nulls_last("source"))  # one row per source from here on
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    place = (F.row_number().over(in_order) - 1).cast("int")
    sources = sources.withColumn("_place", place).withColumn("_weight", F.element_at(weights, F.col("_place") % len(WEIGHTS) + 1))
    limit = F.col("source_size") * F.lit(float(most))
    fullest = Window.orderBy(F.col("_limit") / F.col("_weight"), "_place")
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sources = (
        sources.withColumn("_limit", limit)
        .withColumn("_left", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
        .withColumn("_others", F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .withColumn("_level", F.col("_left") / F.col("_others"))
        .withColumn("_full", F.col("_limit") <= F.col("_level") * F.col("_weight"))
        .withColumn("_open", F.min(F.when(~F.col("_full"), F.struct(F.col("_limit") / F.col("_weight"), "_place", "_level"))).over(everything))
        .withColumn("target", F.when(F.col("_full"), F.col("_limit")).otherwise(F.col("_open._level") * F.col("_weight")))
    )
    start = F.coalesce(F.sum("target").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return sources.withColumn("_start", start).select("source", "source_size", "target", "_start")


def schedules(targets: DataFrame, slots: int = SLOTS) -> DataFrame:
    """source, block and rank: the slots of every source in turn, by number within the source, and how many words one holds.

    Each round makes the schedule of the sources it has FINE slots for and leaves the rest to a round of shorter slots; a round of
    one-word slots is the last.
    """
    rounds, left = [], targets.where("target > 0")
    while True:
        found = left.agg(F.sum("target").alias("words"), F.max("target").alias("most"), F.min("target").alias("least")).first()
        if not found["words"]:
            break
        block = max(1, min(math.ceil(found["words"] / slots), int(found["most"] // FINE)))
        now = left if block == 1 else left.where(F.col("target") >= block * FINE)
        words = now.agg(F.sum("target")).first()[0]
        rounds.append(schedule(now, block, math.ceil(words / block)).select("source", "block", "rank"))
        if block == 1 or found["least"] >= block * FINE:
            break
        left = left.where(F.col("target") < block * FINE)
    if not rounds:
        return targets.select("source", F.lit(1).cast("long").alias("block"), F.lit(0).cast("long").alias("rank")).limit(0)
    return reduce(DataFrame.unionAll, rounds)


def schedule(targets: DataFrame, block: int, slots: int) -> DataFrame:
    """slot, source, rank and block: the source of every slot, the slot's number within its source and the words it holds.

    The number of ``slots`` does not grow with the corpus, only with the number of sources, so ranking a source's slots is bounded work.
    """
    before = Window.orderBy("_start", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    targets = targets.withColumn("_start", F.coalesce(F.sum("target").over(before), F.lit(0.0)))
    total = F.sum("target").over(Window.partitionBy())
    spans = targets.withColumn("_total", total).where("target > 0")
    spans = spans.select("source", (F.col("_start") / F.col("_total")).alias("_low"), ((F.col("_start") + F.col("target")) / F.col("_total")).alias("_high"))
    first, last = F.floor(F.col("_low") * CELLS), F.least(F.floor(F.col("_high") * CELLS), F.lit(CELLS - 1))
    cells = spans.withColumn("_cell", F.explode(F.sequence(first, last)))
    product = F.col("id") * F.lit(GOLDEN)
    points = targets.sparkSession.range(slots).withColumn("_point", product - F.floor(product))
    points = points.withColumn("_cell", F.floor(F.col("_point") * CELLS))
    drawn = points.join(cells, "_cell").where((F.col("_point") >= F.col("_low")) & (F.col("_point") < F.col("_high")))
    rank = F.row_number().over(Window.partitionBy("source").orderBy("id")) - 1
    return drawn.select(F.col("id").alias("slot"), "source", rank.cast("long").alias("rank"), F.lit(block).cast("long").alias("block"))


def token_lines(rows: DataFrame, rows_per_group: int = 20_000) -> DataFrame:
    """``rows`` (_row, doc_id, source, size) with _at, the place of each document's first token on its source's line.

    Documents are cut into groups by the first digits of their hash, as many as the table needs, and the groups' sums are
    cumulated first, so that no task sees a whole source.
    """
    digits = max(1, math.ceil(math.log(max(1, rows.count()) / rows_per_group + 1, 16)))
    spread = F.md5(F.concat(F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    # rows of one id, or without one, share a hash: the hash of their row number deals them out further
    further = F.md5(F.col("_row").cast("string").cast("binary"))
    group = F.concat(F.substring("_hash", 1, digits), F.when(F.col("_many"), F.substring(further, 1, digits)).otherwise(F.lit("")))
    repeated = rows.groupBy("doc_id").count().where(F.col("count") > rows_per_group).select(F.col("doc_id").alias("_id"))
    rows = rows.join(repeated, rows["doc_id"] == repeated["_id"], "left").withColumn("_many", F.col("_id").isNotNull() | F.col("doc_id").isNull())
    rows = rows.withColumns({"_hash": F.when(F.col("_many"), F.concat(spread, further)).otherwise(spread)}).withColumn("_group", group)
    sums = rows.groupBy("source", "_group").agg(F.sum("size").alias("_sum"))
    sums = sums.withColumn("_before", F.sum("_sum").over(Window.partitionBy("source").orderBy("_group")) - F.col("_sum"))
    sums = sums.select(F.col("source").alias("_source"), F.col("_group").alias("_digits"), "_before")
    inside = Window.partitionBy("source", "_group").orderBy("_hash", "size", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_inside", F.sum("size").over(inside) - F.col("size"))
    both = rows.join(sums, rows["source"].eqNullSafe(sums["_source"]) & (rows["_group"] == sums["_digits"]))
    return both.select("_row", "doc_id", "source", "size", (F.col("_before") + F.col("_inside")).alias("_at"))


def _overlap(start: Column, size: Column, block: Column, length: Column) -> Column:
    low, high = block * length, block * length + length
    return F.least(start + size, high) - F.greatest(start, low)


def take(rows: DataFrame, share: float = 1.5, most: float = 2.0, slots: int = SLOTS) -> DataFrame:
    """``rows`` (_row, doc_id, source, size) with source_size, target and the words taken in the first and second pass."""
    rows = rows.select("_row", "doc_id", "source", "size")
    targets = stored(source_targets(rows, share, most), "targets")
    drawn = stored(schedules(targets, slots), "schedule")
    blocks = drawn.groupBy("source").agg(F.first("block").alias("block")).withColumnRenamed("source", "_drawn")
    named = targets.join(blocks, targets["source"].eqNullSafe(blocks["_drawn"]), "left")
    named = named.select(F.col("source").alias("_source"), "source_size", "target", F.coalesce("block", F.lit(1)).alias("_length"))
    laid = token_lines(rows)
    laid = stored(laid.join(named, laid["source"].eqNullSafe(named["_source"])).drop("_source"), "lines")
    passes = laid.where("size > 0").withColumn("_pass", F.explode(F.array(F.lit(0), F.lit(1))))
    passes = passes.withColumn("_start", F.col("_at") + F.col("_pass") * F.col("source_size"))
    length = F.col("_length")
    places = F.sequence(F.floor(F.col("_start") / length), F.floor((F.col("_start") + F.col("size") - 1) / length))
    parts = passes.withColumn("_block", F.explode(places)).withColumn("_words", _overlap(F.col("_start"), F.col("size"), F.col("_block"), length))
    drawn = drawn.select(F.col("source").alias("_source"), "rank")
    joined = parts.join(drawn, parts["source"].eqNullSafe(drawn["_source"]) & (parts["_block"] == drawn["rank"]))
    first, second = (F.coalesce(F.sum(F.when(F.col("_pass") == p, F.col("_words"))), F.lit(0)).cast("long") for p in (0, 1))
    taken = joined.groupBy("_row").agg(first.alias("first_pass"), second.alias("second_pass"))
    return laid.drop("_at", "_length").join(taken, "_row", "left").fillna(0, ["first_pass", "second_pass"])


def sized(documents: DataFrame) -> DataFrame:
    """_row, doc_id, source and size of every document, written out so that _row stays what it is."""
    rows = documents.select("doc_id", "source", words_of(F.col("text")).alias("size"))
    return stored(rows.withColumn("_row", F.monotonically_increasing_id()), "sizes")


def mix(documents: DataFrame, **options) -> DataFrame:
    """``documents`` as often as the mix takes them, with their own columns.

    Each pass over a source ends within one document; that one is in if at least half of it is taken.
    """
    table = stored(documents.select(F.monotonically_increasing_id().alias("_row"), F.struct(*documents.columns).alias("_document")), "mixed")
    size = words_of(F.col("_document.text"))
    taken = take(table.select("_row", "_document.doc_id", "_document.source", size.alias("size")), **options)
    copies = sum((F.when(F.col(c) * 2 >= F.col("size"), 1).otherwise(0) for c in ("first_pass", "second_pass")), F.lit(0))
    times = taken.where("size > 0").select("_row", copies.alias("_copies")).where("_copies > 0")
    return table.join(times, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_document.*")

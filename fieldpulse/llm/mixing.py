"""Mixing sources to target weights by Pareto order sampling.

A source whose target is r times its size takes floor(r) whole copies of each document for certain. The rest, a share of its words, is a sample
with unequal chances: a document's chance p grows with its size, as in sampling with probability proportional to size, p = min(1, c * size), with c
such that the expected words equal the rest. Documents are ranked by their random odds divided by their inclusion odds,
(u / (1 - u)) / (p / (1 - p)), those with p = 1 first, and the first are taken until their words reach the rest.

The document at the cut rarely ends where the rest does. So one document is exchanged: the one, taken or not, whose size comes nearest to what is
too much or still missing, if that helps. A source then ends within about half of its smallest document of its target, if it has
documents of all sizes.

The cut in the ranking is found without sorting a source in one task: the words are summed per interval of the ranking
first, and only the interval with the cut is ordered by document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.llm.tables import stored

INTERVALS = 1 << 14


def n_tokens(text: Column) -> Column:
    """Number of runs of characters other than space and 0x09 to 0x0D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, salt: str) -> Column:
    """A number in (0, 1) that depends only on the document's id, its text and the salt."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Adds ``target`` to ``sizes(source, source_size)``.

    Sources by code point, null last, take the weights in turn and share the total by weight. No target exceeds ``most``
    times its source's size; the excess is shared by weight among the others until none does. Ordered by size over
    weight, the sources at their bound come first, so the level per unit of weight follows from running sums.
    """
    source = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*(F.lit(int(w)) for w in weights))
    rows = sizes.withColumn("weight", F.element_at(turn, (F.row_number().over(source) - 1) % len(weights) + 1).cast("long"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    bound = F.col("source_size") * most
    rows = (rows.withColumn("left", F.sum("source_size").over(everything)
                            - F.coalesce(F.sum(bound).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("sharing", F.sum("weight").over(before.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("level", F.col("left") / F.col("sharing")))
    # The first source, in that order, whose share of what is left does not exceed its bound sets the level of all that follow.
    level = F.min(F.when(F.col("level") * F.col("weight") <= bound, F.struct(F.col("source_size") / F.col("weight"), "level"))).over(everything)
    return rows.withColumn("target", F.least(bound.cast("double"), F.coalesce(level["level"] * F.col("weight"), bound.cast("double")))).select(
        "source", "source_size", "target")


def _sources(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Per source, from ``sizes(source, size, n)``: source_size, target, whole (certain copies), rest (words of the sample), and c and certain, which
    give the chances: documents of more than ``certain`` words are in the sample for certain, others with c * size."""
    per_source = targets(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per_source = per_source.withColumn("whole", F.floor(rate)).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    per_source = stored(per_source, "sources")
    # Sizes from the largest on; a source has at most as many as its longest document has words.
    falling = Window.partitionBy("source").orderBy(F.col("size").desc())
    rising = Window.partitionBy("source").orderBy("size")
    squares = F.col("n") * F.col("size").cast("decimal(19,0)") * F.col("size")
    level = (sizes.where("size > 0").withColumn("larger", F.sum(F.col("n") * F.col("size")).over(falling) - F.col("n") * F.col("size"))
             .withColumn("squares", F.sum(squares).over(rising).cast("double"))
             .join(per_source.select(F.col("source").alias("_s"), "rest"), F.col("source").eqNullSafe(F.col("_s")))
             .withColumn("c", (F.col("rest") - F.col("larger")) / F.col("squares")).where(F.col("c") * F.col("size") < 1)
             .groupBy("source").agg(F.max(F.struct("size", "c")).alias("level")))
    return stored(per_source.join(level.select(F.col("source").alias("_s"), "level"), F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "source_size", "target", "whole", "rest", F.col("level.c").alias("c"), F.col("level.size").alias("certain")), "chances")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, salt: str = "mix") -> DataFrame:
    """``docs(doc_id, text, source)`` with size (tokens), source_size, target of the source, chance (of one more copy than the certain ones, before the
    exchange) and copies (0 to ``most``); every row stays.

    The same rows always give the same copies. A null or empty text has size 0 and no copies beyond the certain ones.
    Ranks are broken by doc_id (null first) and size, so rows that repeat a document are interchangeable. Columns of ``docs`` with a
    name of the result are replaced; others may have any name.
    """
    made = ("size", "source_size", "target", "chance", "copies")
    kept = [name for name in docs.columns if name not in made]
    size = n_tokens(F.col("text"))
    rows = docs.select(F.struct(*kept).alias("_row"), F.col("doc_id").cast("string").alias("id"), F.col("source").alias("source"),
                       size.alias("size"), draw(F.col("doc_id"), F.col("text"), salt).alias("u"), F.monotonically_increasing_id().alias("n"))
    rows = stored(rows, "sized")
    return _mixed(rows, weights, most).select(*(F.col("_row")[name].alias(name) for name in kept), *made)


def _mixed(rows: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    sizes = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sources = _sources(sizes, weights, most)
    chance = F.when(F.col("size") > F.col("certain"), F.lit(1.0)).otherwise(F.coalesce(F.col("c") * F.col("size"), F.lit(0.0)))
    odds = F.when(F.col("chance") >= 1, F.lit(0.0)).when(F.col("chance") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("chance") / (1 - F.col("chance"))))
    ranked = (rows.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("chance", F.when(F.col("rest") > 0, chance).otherwise(F.lit(0.0))).withColumn("odds", odds)
              .withColumn("slot", F.floor(F.col("odds") / (1 + F.col("odds")) * INTERVALS)))
    summed = ranked.where("slot is not null").groupBy("source", "slot").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = Window.partitionBy("source").orderBy("slot")
    cuts = stored(summed.withColumn("upto", F.sum("words").over(running)).withColumn("before", F.col("upto") - F.col("words"))
                  .groupBy("source").agg(F.min(F.when((F.col("before") <= F.col("rest")) & (F.col("upto") > F.col("rest")), F.struct("slot", "before"))).alias("cut"),
                                         F.max("upto").alias("all")).select(F.col("source").alias("_s"), "cut.slot", "cut.before", "all").withColumnsRenamed({"slot": "cut"}), "cuts")
    same = F.col("source").eqNullSafe(F.col("_s"))
    placed = ranked.join(cuts, same, "left").drop("_s")
    order = Window.partitionBy("source").orderBy("odds", "id", "size", "n")
    edge = (placed.where("slot = cut").select("n", "source", "odds", "id", "size", "rest", "before")
            .withColumn("upto", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    # At the cut itself a document is taken if that ends nearer to the rest.
    edge = stored(edge.select(F.col("n").alias("_n"), "source", "size", "before", (
        (F.col("upto") <= F.col("rest")) | ((F.col("upto") - F.col("rest") < F.col("rest") - F.col("upto") + F.col("size"))
                                            & (F.col("upto") - F.col("size") <= F.col("rest")))).alias("in_edge")), "cut-documents")
    in_edge = edge.where("in_edge").groupBy("source").agg(F.sum("size").alias("words")).withColumnRenamed("source", "_s")
    sums = cuts.withColumnRenamed("_s", "source").join(in_edge, same, "left").drop("_s").join(
        sources.select(F.col("source").alias("_s"), "rest"), same).select(
        F.col("source").alias("_s"), (F.col("rest") - F.when(F.col("cut").isNull(), F.col("all")).otherwise(
            F.col("before") + F.coalesce("words", F.lit(0)))).alias("gap"))
    sums = stored(sums, "gaps")
    taken = placed.join(edge.where("in_edge").select("_n", "in_edge"), F.col("n") == F.col("_n"), "left").withColumn(
        "extra", F.when(F.col("slot").isNull(), False).when(F.col("cut").isNull() | (F.col("slot") < F.col("cut")), True)
        .otherwise(F.coalesce("in_edge", F.lit(False)))).drop("_n", "in_edge")
    with_gap = taken.join(sums, same, "left").drop("_s")
    # What the words would be off by if this document changed sides; sizes that do not help are out.
    off = F.abs(F.col("gap") - F.when(F.col("extra"), -F.col("size")).otherwise(F.col("size")))
    swap = with_gap.where((F.col("size") > 0) & (F.col("rest") > 0)).withColumn("off", off).where(F.col("off") < F.abs("gap")).groupBy("source").agg(
        F.min_by("n", F.struct("off", "extra", F.coalesce("odds", F.lit(float("inf"))), F.col("id").isNotNull(), "id", "size", "n")).alias("_n"))
    swapped = stored(swap.select("_n", F.lit(True).alias("swapped")), "exchanged")
    return (taken.join(F.broadcast(swapped), F.col("n") == F.col("_n"), "left")
            .withColumn("copies", F.col("whole") + (F.col("extra") != F.coalesce("swapped", F.lit(False))).cast("long")))

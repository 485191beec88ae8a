"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

A document's size is its number of words. Sources in code point order, null last, weigh ``weights``
in turn and share ``share`` of all sizes. A target stops at ``epochs`` times its source's size; what
is over goes to the others in proportion to their weights, until none is above its limit.

Each source's documents are then taken whole as often as the target holds all of them, and for the
rest in the order of a seeded hash of the id until the target is reached, to the nearest document.
The cut is found from sums per source and slice of the hash, so a giant source is never ordered as a
whole, and texts are not shuffled. The number of slices grows with the table.

A null or empty text has size 0. A source whose documents are all empty has target 0. Rows that
repeat an id share its hash and are taken together. Columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwatch.llm.tables import free_name
from quillwatch.session import materialize

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 17
_SLICE_ROWS = 100_000  # rows of a slice that are put in order together


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(id_column: Column, seed: int) -> Column:
    """A number from 0 below 2**63 that orders documents at random, the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_column), 1)


def ranked(sources: DataFrame) -> DataFrame:
    """sources with their place in code point order, null last, without one sort of all of them in one task."""
    order = F.col("source").asc_nulls_last()
    parts = sources.repartitionByRange(order).withColumn("part", F.spark_partition_id())
    parts = materialize(parts, "sources")
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("before")
    return parts.join(offsets, "part").withColumn("place", place).drop("part", "before")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0) -> DataFrame:
    """From (source, size): per source its size, and its target."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    chosen = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = ranked(totals).select("source", "source_size", chosen.cast("long").alias("weight"))
    sources = materialize(sources.withColumn("limit", F.col("source_size") * epochs), "weighed")
    wanted, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    rest = wanted = (wanted or 0) * share
    weights_sum = weight = weight or 1
    # Each round clamps the sources that their share would fill beyond the limit. Clamped sources stay so, and
    # two sums per round are all that leaves the executors.
    while True:
        over = F.col("limit") * F.lit(float(weight)) <= F.col("weight") * F.lit(float(rest))
        filled, clamped = sources.where(over).agg(F.sum("limit"), F.sum("weight")).first()
        now = wanted - (filled or 0), weights_sum - (clamped or 0)
        if now == (rest, weight) or now[1] == 0:
            break
        rest, weight = now
    target = F.when(over, F.col("limit").cast("double")).otherwise(F.col("weight") * F.lit(float(rest)) / F.lit(float(weight)))
    return sources.select("source", "source_size", target.alias("target"))


def cuts(sized: DataFrame, aims: DataFrame) -> DataFrame:
    """Per source: how often it is taken whole, and the largest draw that is taken once more (-1: none)."""
    bits = min(40, max(64, sized.count() // _SLICE_ROWS).bit_length())
    sliced = sized.withColumn("slice", F.shiftright("draw", 63 - bits))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = aims.withColumn("whole", whole)
    aims = aims.withColumn("more", F.col("target") - F.col("whole") * F.col("source_size"))
    same = F.col("s.source").eqNullSafe(F.col("a.source"))

    by_slice = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("in_slice"))
    sums = sums.withColumn("before", F.coalesce(F.sum("in_slice").over(by_slice), F.lit(0)))
    at = sums.alias("s").join(aims.alias("a"), same).where("before < more and before + in_slice >= more")
    at = at.groupBy(F.col("s.source").alias("source"), "more").agg(F.min(F.struct("slice", "before")).alias("at"))
    at = materialize(at, "slices")

    units = sliced.alias("s").join(at.alias("a"), same & (F.col("s.slice") == F.col("a.at.slice")))
    units = units.groupBy(F.col("s.source").alias("source"), "draw", "more", "at").agg(F.sum("size").alias("size"))
    by_draw = Window.partitionBy("source").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("before", F.coalesce(F.sum("size").over(by_draw), F.lit(0)) + F.col("at.before"))
    taken = units.where(F.col("before") + F.col("size") / 2 <= F.col("more"))
    last = taken.groupBy("source").agg(F.max("draw").alias("last"))
    first = at.select("source", (F.shiftleft("at.slice", 63 - bits) - 1).alias("none"))
    joined = aims.alias("s").join(first.alias("a"), same, "left").select("s.*", "none")
    joined = joined.alias("s").join(last.alias("a"), same, "left").select("s.*", "none", "last")
    cut = F.coalesce("last", "none", F.lit(-1)).alias("cut")
    return joined.select("source", "source_size", "target", "whole", cut)


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, share: float = 1.0, seed: int = SEED) -> DataFrame:
    """docs with size, source_size, target and repeats, under names given by ``mixed_names``."""
    size, source_size, target, repeats = mixed_names(docs)
    sized = docs.select(F.col(source_column).alias("source"), draw(F.col(id_column), seed).alias("draw"),
                        word_count(F.col(text_column)).alias("size"))
    sized = materialize(sized, "sized")
    plan = materialize(cuts(sized, targets(sized.select("source", "size"), weights, epochs, share)), "cuts")
    names = {c: free_name(docs, f"plan_{c}") for c in plan.columns}
    plan = plan.select(*[F.col(c).alias(name) for c, name in names.items()])
    here, p = docs.alias("docs"), lambda c: F.col(names[c])
    again = draw(F.col(f"docs.{id_column}"), seed) <= p("cut")
    return here.join(plan, F.col(f"docs.{source_column}").eqNullSafe(p("source")), "left").select(
        "docs.*",
        word_count(F.col(f"docs.{text_column}")).alias(size),
        p("source_size").alias(source_size),
        p("target").alias(target),
        (p("whole") + again.cast("long")).alias(repeats),
    )


def mixed_names(docs: DataFrame) -> tuple[str, str, str, str]:
    return tuple(free_name(docs, c) for c in ("size", "source_size", "target", "repeats"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every document as many times as it is taken."""
    repeats = mixed_names(docs)[-1]
    mixed = mix(docs, **options)
    times = F.explode(F.sequence(F.lit(1), F.col(repeats).cast("int")))
    return mixed.where(F.col(repeats) > 0).select(*docs.columns, times.alias(repeats)).drop(repeats)

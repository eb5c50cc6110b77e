"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1 (linear between
knots).  Its integral is the source's weight; targets share all words by
weight, none above ``max_epochs`` times its source, the excess reshared.  A
source's documents queue in a fixed pseudo-random order (MD5 of the id), pass
after pass; an occurrence is taken if its middle lies below the target, so a
source misses its target by half a document at most.  The occurrence's
training position is the time at which the schedule's integral reaches the
share of the source's demand that lies before it: the inverse of a piecewise
quadratic, in closed form.

Scale: a queue is a prefix sum.  A source is cut into 4096 slices of the order
(leading hex digits), slice sums are added up per source, and the running sum
runs within one slice, so a source with a third of all rows spreads over
thousands of window groups.  Documents meet the small per-slice table on
(source, slice), the key they are windowed by, so they are shuffled once.
No user functions.

Defined results: null text has size 0; null is a source like any other and
ranks last; documents of size 0 are never taken (taken 0, no position).  Equal
ids of a source queue by size; identical rows are separate documents.  A
source of size 0 has target 0.  Only doc_id, source and text are read unless
``keep`` names more columns; names starting with ``mix_`` are the operator's.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vellum.llm.common import whole_text, word_count

SLICE_DIGITS = 3


class Schedule(NamedTuple):
    """Knots (time, weight); times rise from 0 to 1, weights are at least 0."""

    knots: tuple[tuple[float, float], ...]

    def pieces(self) -> list[tuple[float, float, float, float, float]]:
        """Per linear piece: time and integral before it, length, weight at its start, slope."""
        out, done = [], 0.0
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            out.append((t0, done, t1 - t0, w0, (w1 - w0) / (t1 - t0)))
            done += (w0 + w1) / 2 * (t1 - t0)
        return out

    def weight(self) -> float:
        return sum((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]))

    def time_at(self, share: Column) -> Column:
        """The time by which ``share`` of the whole integral has passed."""
        need, out = share * F.lit(self.weight()), None
        for t0, before, _, w0, slope in self.pieces():
            rest = F.greatest(need - F.lit(before), F.lit(0.0))
            # root of  w0 x + slope x^2 / 2 = rest, in the form without cancellation
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            step = F.when(rest <= 0, F.lit(0.0)).otherwise(2 * rest / (F.lit(w0) + root))
            here = F.lit(t0) + step
            out = here if out is None else F.when(need > F.lit(before), here).otherwise(out)
        return F.least(out, F.lit(1.0))


# Weights 1, 2, 3: the first grows over training, the second is steady, the
# third starts high, halves by mid-training and stays there.
SCHEDULES = (
    Schedule(((0.0, 0.5), (1.0, 1.5))),
    Schedule(((0.0, 2.0), (1.0, 2.0))),
    Schedule(((0.0, 4.8), (0.5, 2.4), (1.0, 2.4))),
)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_epochs: int) -> DataFrame:
    """source, source_size, target, mix_schedule per source; ``sizes`` has one row per source.

    A source is at its ceiling if the level (words per unit of weight) reaches
    ceiling / weight.  Taken by rising ceiling / weight, the level left for the
    rest after the first j are filled grows as long as the next one is filled
    too, and falls from then on; its largest value is the level.
    """
    ranked = sizes.withColumn("mix_schedule", (F.row_number().over(
        W.orderBy(F.col("source").asc_nulls_last())) - 1) % F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("mix_schedule") + 1)
    ceiling = F.lit(float(max_epochs)) * F.col("source_size")
    by_level = W.orderBy("mix_level", F.col("source").asc_nulls_last())
    before, everything = by_level.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    zero = F.lit(0.0)
    tested = (ranked.withColumn("mix_weight", weight).withColumn("mix_ceiling", ceiling)
              .withColumn("mix_level", F.col("mix_ceiling") / F.col("mix_weight"))
              .withColumn("mix_total", F.sum("source_size").over(everything).cast("double"))
              .withColumn("mix_rest", F.sum("mix_weight").over(everything) - F.coalesce(F.sum("mix_weight").over(before), zero))
              .withColumn("mix_left", F.col("mix_total") - F.coalesce(F.sum("mix_ceiling").over(before), zero)))
    share = F.col("mix_left") / F.col("mix_rest")
    level = F.max(share).over(everything)
    return tested.withColumn("mix_share", level).select(
        "source", "source_size", "mix_schedule",
        F.least(F.col("mix_ceiling"), F.coalesce(F.col("mix_share"), zero) * F.col("mix_weight")).alias("target"))


def mix(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, max_epochs: int = 3,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, taken, mix_positions (one per occurrence)."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "source", *(c for c in keep if c not in ("doc_id", "source")),
                       word_count(whole_text()).alias("size"), order.alias("mix_order"))
    rows = rows.withColumn("mix_slice", F.substring("mix_order", 1, SLICE_DIGITS))
    slices = (docs.select("source", word_count(whole_text()).alias("size"),
                          F.substring(order, 1, SLICE_DIGITS).alias("mix_slice"))
              .groupBy("source", "mix_slice").agg(F.sum("size").alias("mix_words")))
    targets = source_targets(slices.groupBy("source").agg(F.sum("mix_words").alias("source_size")),
                             tuple(s.weight() for s in schedules), max_epochs)
    so_far = W.partitionBy("source").orderBy("mix_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (slices.withColumn("mix_before", F.coalesce(F.sum("mix_words").over(so_far), F.lit(0)))
              .alias("a").join(targets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
              .select(F.col("a.source").alias("mix_source"), F.col("mix_slice").alias("mix_at"), "mix_before",
                      "source_size", "target", "mix_schedule"))
    in_slice = (W.partitionBy("source", "mix_slice").orderBy("mix_order", "doc_id", "size")
                .rowsBetween(W.unboundedPreceding, -1))
    queued = rows.join(starts, F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("mix_slice") == F.col("mix_at")))
    start = F.col("mix_before") + F.coalesce(F.sum("size").over(in_slice), F.lit(0))
    queued = queued.withColumn("mix_start", start)

    def position(begin: Column) -> Column:
        share, out = begin / F.col("target"), F.lit(None).cast("double")
        for i, s in enumerate(schedules):
            out = F.when(F.col("mix_schedule") == i, s.time_at(share)).otherwise(out)
        return out

    begins = F.transform(F.sequence(F.lit(0), F.lit(max_epochs - 1)),
                         lambda e: F.col("mix_start") + e * F.col("source_size"))
    taken = F.filter(begins, lambda b: (F.col("size") > 0) & (2 * b + F.col("size") <= 2 * F.col("target")))
    placed = queued.withColumn("mix_positions", F.transform(taken, position))
    return placed.select(
        "doc_id", "source", *(c for c in keep if c not in ("doc_id", "source")), "size", "source_size", "target",
        (F.size("mix_positions") * F.col("size")).cast("long").alias("taken"), "mix_positions")


def by_first_position(mixed: DataFrame) -> DataFrame:
    """The mixed documents range-sorted by their first training position; those never taken come last."""
    first = F.get("mix_positions", F.lit(0))
    keys = (F.col("first_position").asc_nulls_last(), F.col("doc_id"), F.col("size"))
    return (mixed.withColumn("first_position", first).withColumn("last_position", F.get("mix_positions", F.size("mix_positions") - 1))
            .repartitionByRange(*keys).sortWithinPartitions(*keys))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per occurrence, range-sorted by training position (ties by id, pass)."""
    rows = mixed.select("*", F.posexplode("mix_positions").alias("mix_pass", "position")).drop("mix_positions")
    keys = ("position", "doc_id", "mix_pass")
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

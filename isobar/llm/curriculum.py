"""Mixing sources to target weights along a curriculum, with DataFrame functions only.

Each source gets a share of the words to be trained on, by weight and bounded by a number
of repeats. Its demand over training time follows a piecewise linear schedule; the integral
of that schedule is inverted at every document's place in its source, which gives the
document's training position. Documents are then sorted by position in one range exchange.

Places within a source are cumulative sizes in a fixed pseudo-random order: sizes are summed
for each (source, slice of the hash range) first, so a source with a third of all rows is
summed and numbered by many tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.llm.common import free_name, longs, pieces, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
#: For each weight class the schedule's knots (time from 0 to 1, relative rate); scaled to an integral of 1.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)))

Schedule = Sequence[tuple[float, float]]


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def integrated(schedule: Schedule) -> list[tuple[float, float, float, float]]:
    """For each segment: start time, demand so far, rate at the start, slope; total demand 1."""
    if schedule[0][0] != 0 or schedule[-1][0] != 1 or any(b[0] <= a[0] for a, b in itertools.pairwise(schedule)):
        raise ValueError("a schedule's times must rise from 0 to 1")
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in itertools.pairwise(schedule))
    if area <= 0 or min(r for _, r in schedule) < 0:
        raise ValueError("a schedule's rates must not be negative, and not all zero")
    done, out = 0.0, []
    for (u, a), (v, b) in itertools.pairwise(schedule):
        out.append((u, done, a / area, (b - a) / (v - u) / area))
        done += (v - u) * (a + b) / 2 / area
    return out


def position(schedule: Schedule, demand: Column) -> Column:
    """The time by which the integrated schedule has asked for ``demand`` (a share from 0 to 1)."""
    out = None
    for u, done, rate, slope in integrated(schedule):
        more = demand - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(rate * rate) + F.lit(2 * slope) * more, F.lit(0.0)))
        at = F.when(more <= 0, F.lit(u)).otherwise(F.lit(u) + F.lit(2.0) * more / (F.lit(rate) + root))
        out = at if out is None else F.when(demand >= done, at).otherwise(out)
    return F.least(out, F.lit(1.0))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, kind (place of its weight), target, from a stored frame of source and size.

    Sources are numbered in code point order, null last; one row for each source meets in
    one window for that. Shares of sources above their limit are dealt out again until none is.
    """
    numbered = Window.orderBy(F.col("source").asc_nulls_last())
    sources = stored(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("kind", ((F.row_number().over(numbered) - 1) % len(weights)).cast("int"))
        .withColumn("weight", F.get(longs(weights), F.col("kind"))), "mix-sources")
    limit, level, capped = F.col("source_size") * repeats, None, -1
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    while True:
        full = F.lit(False) if level is None else limit <= F.col("weight") * F.lit(level)
        row = sources.agg(F.coalesce(F.sum(F.when(full, limit)), F.lit(0)).alias("dealt"),
                          F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
                          F.count(F.when(full, 1)).alias("capped")).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped, level = row["capped"], (total - row["dealt"]) / row["open"]
    target = F.lit(0.0) if level is None else F.least(limit.cast("double"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", "kind", target.alias("target"))


def assign(docs: DataFrame, size: Column, schedules: Sequence[Schedule] = SCHEDULES, weights=WEIGHTS,
           share: float = SHARE, repeats: int = REPEATS, whole: bool = False) -> DataFrame:
    """Add size, source_size, target, taken, and ``takes``: an array of (position, words), one for each time it is trained on.

    The documents of a source are lined up in md5 order of doc_id, ``repeats`` times over, and
    taken until the target is met: to the word, the last one in part, or with ``whole`` those
    of which the greater part is within the target. All rows and columns are kept; columns named
    like added ones are replaced. Rows with no words take nothing. Rows of a null source are
    a source of their own. Rows without a doc_id are lined up in md5 order of their content, so any
    number of them is spread over the slices; rows of equal doc_id (or content) by size.
    """
    spark = docs.sparkSession
    if len(schedules) != len(weights):
        raise ValueError("one schedule for each weight")
    key, part, before, offset, name = (free_name(docs, n) for n in ("_key", "_part", "_before", "_offset", "_name"))
    nameless = F.to_json(F.struct(*docs.columns))
    sized = docs.withColumn(key, F.md5(F.coalesce(F.col("doc_id").cast("string"), nameless))).withColumn("size", size)
    parts = min(65_536, pieces(spark))
    sized = sized.withColumn(part, F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * parts / 2**32).cast("int"))
    sums = stored(sized.groupBy("source", F.col(part).alias("part")).agg(F.sum("size").alias("size")), "mix-sizes")
    targets = source_targets(sums, weights, share, repeats)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        sums.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .join(targets, sums.source.eqNullSafe(targets.source)).drop(targets.source)
        .select(F.col("source").alias(name), F.col("part").alias(part), F.col("before").alias(before),
                "source_size", "kind", "target"), "mix-starts")

    numbered = sized.withColumn(offset, F.sum("size").over(
        Window.partitionBy("source", part).orderBy(key, "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    extra = [c for c in ("source_size", "kind", "target", "taken", "takes") if c in docs.columns]
    joined = numbered.drop(*extra).join(starts, (F.col("source").eqNullSafe(F.col(name))) & (numbered[part] == starts[part]))
    wanted = F.floor("target")
    takes = []
    for n in range(repeats):
        start = F.col(before) + F.col(offset) + F.lit(n) * F.col("source_size")
        if whole:
            got = F.when((start + F.col("size") / 2 <= F.col("target")), F.col("size")).otherwise(F.lit(0))
        else:
            got = F.greatest(F.least(F.col("size"), wanted - start), F.lit(0))
        at = F.lit(None).cast("double")
        for kind, schedule in enumerate(schedules):
            at = F.when(F.col("kind") == kind, position(schedule, F.least(start / F.col("target"), F.lit(1.0)))).otherwise(at)
        takes.append(F.struct(F.when(got > 0, at).alias("position"), got.cast("bigint").alias("words")))
    out = joined.withColumn("takes", F.filter(F.array(*takes), lambda t: t.words > 0))
    return out.withColumn("taken", F.aggregate("takes", F.lit(0).cast("bigint"), lambda a, t: a + t.words)).select(
        *(c for c in docs.columns if c not in ("size", *extra)), "size", "source_size", "target", "taken", "takes")


def in_training_order(assigned: DataFrame) -> DataFrame:
    """One row for each time a document is trained on, sorted by ``position`` over all partitions."""
    taken = assigned.drop("position", "words").select("*", F.inline("takes")).drop("takes")
    return taken.repartitionByRange(F.col("position")).sortWithinPartitions("position", "doc_id")

"""Keyed merges of batches, as frames; :mod:`isobar.sinks.upsert` writes them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from isobar.operators.series import first_row


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of all batches; a column a batch lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def last_write(batch: DataFrame, keys: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest rank, later columns breaking ties.

    Every scan task first keeps one row per key, so any number of copies of one
    key shrinks before the shuffle. Batches hold few copies as a rule, for which
    ranking rows measured faster than aggregating them.
    """
    return first_row(batch, keys, [F.desc(c) for c in rank])


def merge(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``batch`` added or replaced; keys unique in both.

    Only the batch's keys take part in the join: Spark broadcasts them while they
    are under its size threshold, and otherwise sort-merges with skew splitting.
    """
    kept = existing.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch)


def merge_newer(existing: DataFrame, batch: DataFrame, keys: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """One row per key, that of the greatest rank on either side: a stored row yields only to a greater one.

    With a rank that orders all rows of a key, batches may come in any order and again.
    """
    return last_write(existing.unionByName(batch), keys, rank)


def add_counters(target: DataFrame, delta: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """Counters of ``target`` increased by ``delta``; applying a delta twice counts it twice."""
    columns = [*keys, *counters]
    return (
        target.select(*columns).unionByName(delta.select(*columns))
        .groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])
    )

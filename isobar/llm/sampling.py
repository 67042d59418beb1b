"""Bounded training samples: a fixed pseudo-random choice of rows for each class, small enough for the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sample(df: DataFrame, label: str, key: Column, per_class: int, seed: int = 7) -> list[tuple]:
    """(label, text) of about ``per_class`` rows of each class (all, if fewer), the same ones on every run.

    A class's rows are counted first; then rows whose hashed key lies in its share are read in
    one pass. df needs ``text`` and the label column; null labels take no part.
    """
    counts = {r[0]: r[1] for r in df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*")).collect()}
    if not counts:
        return []
    share = F.lit(0.0)
    for value, n in counts.items():  # one entry for each class
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(2**30)) / F.lit(float(2**30))
    rows = df.where(drawn < share).select(label, F.coalesce("text", F.lit("")), drawn).collect()
    return [(r[0], r[1]) for r in sorted(rows, key=lambda r: (r[2], str(r[0]), r[1]))]

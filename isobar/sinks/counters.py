"""Counters kept as a ledger, so that a repeated batch counts once.

Every batch's increments lie in a directory of their own, which a replay overwrites. Totals are
summed on read, over the last fold and the batches after it. A fold sums old batches into one
directory named by the last of them; it counts once its write has succeeded, and only then are
the batches and the older fold removed, so it may be interrupted anywhere. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from isobar.sinks.files import Folder

BATCH, FOLDED, DONE = "batch=", "through=", "_SUCCESS"


def add(deltas: DataFrame, path: str, number: int, keys: Sequence[str], counters: Sequence[str]) -> bool:
    """Count a batch's increments; again with the same number, they replace the former ones.

    Increments of a key are summed first. Returns False, and counts nothing, for a batch that a fold holds already.
    """
    if number < 0:
        raise ValueError("batch numbers start at 0")
    if number <= _folded(deltas.sparkSession, path):
        return False
    summed = deltas.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])
    summed.write.mode("overwrite").parquet(f"{path}/ledger/{BATCH}{number}")
    return True


def totals(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """The counters: keys with the sums of all counted batches; null increments count as none."""
    return _sums(spark, path, schema, keys, counters, None)


def fold(spark: SparkSession, path: str, through: int, schema: StructType, keys: Sequence[str], counters: Sequence[str]) -> None:
    """Sum all batches up to a number into one directory; they can't be replaced from then on."""
    before = _folded(spark, path)
    if through > before:
        _sums(spark, path, schema, keys, counters, through).write.mode("overwrite").parquet(f"{path}/folded/{FOLDED}{through}")
    last = max(through, before)
    ledger, folds = Folder(spark, f"{path}/ledger"), Folder(spark, f"{path}/folded")
    for name in ledger.directories(BATCH):
        if int(name.removeprefix(BATCH)) <= last:
            ledger.remove(name)
    for name in folds.directories(FOLDED):
        if int(name.removeprefix(FOLDED)) < last:
            folds.remove(name)


def _folded(spark: SparkSession, path: str) -> int:
    """The last batch of the newest complete fold, -1 without one."""
    folds = Folder(spark, f"{path}/folded")
    found = [n for n in folds.directories(FOLDED) if folds.has(f"{n}/{DONE}")]
    return max((int(n.removeprefix(FOLDED)) for n in found), default=-1)


def _sums(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], counters: Sequence[str],
          through: int | None) -> DataFrame:
    folded, ledger = _folded(spark, path), Folder(spark, f"{path}/ledger")
    numbers = {int(n.removeprefix(BATCH)) for n in ledger.directories(BATCH) if ledger.has(f"{n}/{DONE}")}
    paths = [f"{path}/ledger/{BATCH}{n}" for n in sorted(numbers) if n > folded and (through is None or n <= through)]
    if folded >= 0:
        paths.append(f"{path}/folded/{FOLDED}{folded}")
    if not paths:
        return spark.createDataFrame([], schema).select(*keys, *counters)
    rows = spark.read.schema(schema).parquet(*paths)
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])

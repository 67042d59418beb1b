"""Sharding by histogram sort: exact counts below candidate boundaries, refined until splitters fit, then one exchange.

Rows are ordered by (group hash, row hash), so equal groups lie together. Each round
counts rows and bytes between candidate boundaries exactly; where a splitter is still too
far from its share, or a range holds too many rows, the next round puts new candidates at
approximate quantiles of that range. A frequent group shows up as a range of one group
hash and is then cut by row hash, so it never lies in one task. Only histograms, whose
length follows the number of ranges, reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.llm.common import count_at_most, free_name, longs, pieces, stored

BITS = 52  # of a hash; approximate quantiles go through doubles, which hold so many exactly
LOW, HIGH = -(2**(BITS - 1)), 2**(BITS - 1) - 1
FAN = 16
ROUNDS = 40


@dataclass(frozen=True)
class Splitting:
    """Ascending boundaries (group hash, row hash), with exact rows and bytes of the ranges they cut."""

    bounds: list[tuple[int, int]]
    rows: list[int]
    sizes: list[int]
    splitters: list[int]  # indexes into bounds, one for each border between shards

    def shard_of_range(self) -> list[int]:
        return [sum(s <= r - 1 for s in self.splitters) for r in range(len(self.rows))]

    def slots_before(self) -> list[int]:
        """Rows of the same shard in earlier ranges."""
        before, out = {}, []
        for shard, rows in zip(self.shard_of_range(), self.rows):
            out.append(before.get(shard, 0))
            before[shard] = before.get(shard, 0) + rows
        return out


def range_of(bounds: list[tuple[int, int]], group: Column, row: Column) -> Column:
    """The number of boundaries at or below a key: group borders first, then cuts inside a group."""
    groups = sorted({g for g, _ in bounds})
    first = {}
    for i, (g, _) in enumerate(bounds):
        first.setdefault(g, i)
    below = count_at_most(groups, group)
    starts = [first[g] for g in groups] + [len(bounds)]
    cuts, at = [r for _, r in bounds], longs(groups)
    inside = F.slice(longs(cuts), F.get(longs(starts), below - 1).cast("int") + 1,
                     (F.get(longs(starts), below) - F.get(longs(starts), below - 1)).cast("int"))
    return (
        F.when(below == 0, F.lit(0))
        .when(F.get(at, below - 1) == group,
              F.get(longs(starts), below - 1) + F.size(F.filter(inside, lambda c: c <= row)))
        .otherwise(F.get(longs(starts), below)).cast("int")
    )


def _histogram(keys: DataFrame, bounds) -> tuple[list[int], list[int]]:
    rows, sizes = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    counted = keys.groupBy(range_of(bounds, F.col("g"), F.col("r")).alias("range")).agg(
        F.count("*").alias("n"), F.sum("size").alias("size"))
    for x in counted.collect():  # one row for each range
        rows[x["range"]], sizes[x["range"]] = x["n"], x["size"]
    return rows, sizes


def _ends(bounds, i) -> tuple[tuple[int, int], tuple[int, int] | None]:
    return (bounds[i - 1] if i else (LOW, LOW)), (bounds[i] if i < len(bounds) else None)


def _one_group(low, high) -> bool:
    """The range holds keys of one group hash only."""
    return high is not None and (high[0] == low[0] or high == (low[0] + 1, LOW)) or high is None and low[0] == HIGH


def _one_key(low, high) -> bool:
    return _one_group(low, high) and (low[1] == HIGH or high is not None and high[0] == low[0] and high[1] - low[1] == 1)


def _candidates(keys: DataFrame, bounds, ranges: list[int]) -> set[tuple[int, int]]:
    """New boundaries inside the named ranges, at approximate quantiles of their keys."""
    shares = [i / FAN for i in range(1, FAN)]
    whole = [i for i in ranges if not _one_group(*_ends(bounds, i))]
    found: set[tuple[int, int]] = set()
    quantiles = (
        keys.withColumn("range", range_of(bounds, F.col("g"), F.col("r")))
        .where(F.array_contains(longs(ranges), F.col("range").cast("bigint")))
        .groupBy("range").agg(
            F.percentile_approx("g", shares, 1000).alias("gs"), F.percentile_approx("r", shares, 1000).alias("rs"))
    )
    inside = set(whole)
    for x in quantiles.collect():  # FAN values for each named range
        low, high = _ends(bounds, x["range"])
        if x["range"] in inside:
            new = {(g, LOW) for g in x["gs"]} | {(g + 1, LOW) for g in x["gs"] if g < HIGH}
        else:
            new = {(low[0], r) for r in x["rs"]} | {(low[0], r + 1) for r in x["rs"] if r < HIGH}
        found |= {b for b in new if b > low and (high is None or b < high)}
    return found


def split(keys: DataFrame, shards: int, ranges: int, tolerance: float) -> Splitting:
    """Find boundaries for a stored frame of g, r (longs of BITS bits) and size.

    Splitters fit when the bytes below them differ from their share by at most ``tolerance``
    of one shard; where no key border is so near, the nearest one is taken. Of the borders
    that fit, one between groups is preferred. Rows of equal g and r can't be separated.
    """
    bounds = [(LOW + (2**BITS * i) // ranges, LOW) for i in range(1, ranges)]
    for _ in range(ROUNDS):
        rows, sizes = _histogram(keys, bounds)
        total, below = sum(sizes), [0]
        for s in sizes:
            below.append(below[-1] + s)
        slack = tolerance * total / shards
        most = max(1, 2 * sum(rows) // ranges)
        open_ranges = {i for i, n in enumerate(rows) if n > most}
        for j in range(1, shards):
            target = total * j / shards
            if min((abs(b - target) for b in below), default=0) > slack:
                open_ranges |= {i for i in range(len(rows)) if below[i] < target < below[i + 1]}
        open_ranges = sorted(i for i in open_ranges if rows[i] > 1 and not _one_key(*_ends(bounds, i)))
        new = _candidates(keys, bounds, open_ranges) if open_ranges else set()
        if not new:
            break
        bounds = sorted(set(bounds) | new)
    else:
        rows, sizes = _histogram(keys, bounds)
        total, below = sum(sizes), [0]
        for s in sizes:
            below.append(below[-1] + s)
        slack = tolerance * total / shards
    splitters = []
    for j in range(1, shards):
        target = total * j / shards
        gap = [abs(below[i + 1] - target) for i in range(len(bounds))]
        best = min(range(len(bounds)), key=lambda i: (not (gap[i] <= slack and bounds[i][1] == LOW), gap[i], i))
        splitters.append(max(best, splitters[-1] if splitters else 0))
    return Splitting(bounds, rows, sizes, splitters)


def shard(df: DataFrame, size: Column, group: Column, row: Column, shards: int = 8, tolerance: float = 0.002) -> DataFrame:
    """Add ``shard`` (0 to shards - 1, of nearly equal total size) and ``slot`` (gapless from 0 in its shard).

    Rows are ordered by ``group`` and ``row`` (two hashes as longs, without nulls; their upper BITS count). All columns are
    kept; columns called shard or slot are replaced. An empty frame gives an empty one.
    Rows with equal group and row share a shard, in any order among themselves.
    """
    spark = df.sparkSession
    group, row = F.shiftright(group, 64 - BITS), F.shiftright(row, 64 - BITS)
    g, r, at = (free_name(df, n) for n in ("_g", "_r", "_range"))
    keys = stored(df.select(group.alias("g"), row.alias("r"), size.cast("bigint").alias("size")), "histogram-keys")
    found = split(keys, shards, max(pieces(spark), 4 * shards), tolerance)
    placed = df.withColumns({g: group, r: row}).withColumn(at, range_of(found.bounds, F.col(g), F.col(r)))
    order = F.row_number().over(Window.partitionBy(at).orderBy(g, r)) - 1
    return placed.withColumns({
        "shard": F.get(longs(found.shard_of_range()), F.col(at)).cast("int"),
        "slot": F.get(longs(found.slots_before()), F.col(at)) + order,
    }).drop(g, r, at)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """All documents in shards of nearly equal bytes, equal texts together except where a group crosses a border.

    A null text counts as empty. Rows are ordered by text hash and doc_id hash.
    """
    text = F.coalesce("text", F.lit(""))
    sized = docs.withColumn("size", F.octet_length(text).cast("bigint") + 1)
    return shard(sized, F.col("size"), F.xxhash64(text), F.xxhash64("doc_id"), shards)

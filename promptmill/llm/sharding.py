"""Minimax contiguous sharding of atomic groups."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.staging import stage

BITS = 60  # of a cell, the place of a group in the order
FIRST = 16  # bits that name the first intervals: 65,536 at most
STEP = 6  # bits by which an interval is cut further
SLOT_BITS = 12
SLOT_KEYS = 4_096


@dataclass
class Intervals:
    """Runs of the order: where each begins, how wide it is, and what it holds."""

    start: np.ndarray
    shift: np.ndarray
    bytes: np.ndarray
    groups: np.ndarray

    def prefix(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.bytes)])


def cell_of(group: Column) -> Column:
    """A group's place: the first 60 bits of its digest. Equal groups share it."""
    return F.conv(F.substring(F.md5(group), 1, BITS // 4), 16, 10).cast("bigint")


def whole_cuts(prefix: np.ndarray, capacity: int, most: int) -> list[int] | None:
    """Greedy check: intervals are taken whole. Where each shard ends, or None if ``most`` don't do."""
    cuts, at, last = [], 0, len(prefix) - 1
    while at < last:
        end = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        if end == at or len(cuts) == most:
            return None
        cuts.append(end)
        at = end
    return cuts


def fluid_cuts(intervals: Intervals, prefix: np.ndarray, capacity: int, most: int) -> list[int] | None:
    """The same, but intervals of several groups may be cut anywhere: never more shards than needed."""
    cuts, done, total = [], 0, int(prefix[-1])
    while done < total:
        if len(cuts) == most:
            return None
        end = min(done + capacity, total)
        at = int(np.searchsorted(prefix, end, "right")) - 1
        if end < total and intervals.groups[at] == 1:
            end = int(prefix[at])
        if end <= done:
            return None
        cuts.append(end)
        done = end
    return cuts


def smallest(low: int, high: int, feasible) -> int:
    """Binary search for the smallest feasible capacity; ``high`` is feasible."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


def _intervals(groups: DataFrame, shift: int) -> pd.DataFrame:
    """Sums of the intervals of ``2 ** shift`` cells."""
    name = F.shiftright("cell", shift).alias("v")
    sums = groups.groupBy(name).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("groups"))
    return sums.toPandas().assign(s=shift)


def _as_intervals(table: pd.DataFrame) -> Intervals:
    start = table["v"].to_numpy(np.int64) << table["s"].to_numpy(np.int64)
    order = np.argsort(start)
    return Intervals(
        start[order],
        table["s"].to_numpy(np.int64)[order],
        table["bytes"].to_numpy(np.int64)[order],
        table["groups"].to_numpy(np.int64)[order],
    )


def _refined(groups: DataFrame, intervals: Intervals, chosen: np.ndarray) -> Intervals:
    """Cut the chosen intervals into 64 each; one pass over the table of group sizes."""
    spark = groups.sparkSession
    parts = []
    for shift in np.unique(intervals.shift[chosen]).tolist():
        names = intervals.start[chosen & (intervals.shift == shift)] >> shift
        named = spark.createDataFrame(pd.DataFrame({"n": names}))
        inside = groups.withColumn("n", F.shiftright("cell", shift)).join(F.broadcast(named), "n")
        parts.append(_intervals(inside, max(shift - STEP, 0)))
    old = Intervals(*(x[~chosen] for x in (intervals.start, intervals.shift, intervals.bytes, intervals.groups)))
    new = _as_intervals(pd.concat(parts))
    joined = [np.concatenate(x) for x in zip(vars(old).values(), vars(new).values(), strict=True)]
    order = np.argsort(joined[0])
    return Intervals(*(x[order] for x in joined))


def minimax_bounds(groups: DataFrame, shards: int) -> list[int]:
    """The cells at which the shards after the first begin, for the smallest possible largest shard.

    ``groups`` has one row per group: ``cell`` (its place in the order) and ``bytes``.
    The driver sees sums of intervals of the order only. Greedy checks that take
    intervals whole, and checks that may cut them anywhere, enclose the capacity;
    intervals in which a cut can still fall are cut further until each holds one
    group. Then the check is exact, and the smallest feasible capacity is cut there.
    """
    top = groups.agg(F.max("bytes")).first()[0]
    if top is None:
        return []
    intervals = _as_intervals(_intervals(groups, BITS - FIRST))
    while True:
        prefix = intervals.prefix()
        total = int(prefix[-1])
        low = max(int(top), -(-total // shards))
        low = smallest(low, low + int(top), lambda c: fluid_cuts(intervals, prefix, c, shards) is not None)
        several = intervals.groups > 1
        large = several & (intervals.bytes * 8 > low)
        if large.any():
            intervals = _refined(groups, intervals, large)
            continue
        most = low + int(top) + int(intervals.bytes.max())
        high = smallest(low, most, lambda c: whole_cuts(prefix, c, shards) is not None)
        early = prefix[whole_cuts(prefix, low, len(prefix))]
        late = fluid_cuts(intervals, prefix, high, shards)
        wanted = np.zeros(len(several), dtype=bool)
        for k, end in enumerate(late):
            begin = early[min(k, len(early) - 1)]
            first = int(np.searchsorted(prefix, min(begin, end), "right")) - 1
            last = int(np.searchsorted(prefix, end, "left"))
            wanted[max(first, 0) : last + 1] = True
        wanted &= several
        if low == high or not wanted.any():
            cuts = whole_cuts(prefix, high, shards)
            return [int(intervals.start[c]) for c in cuts[:-1]]
        intervals = _refined(groups, intervals, wanted)


def minimax_shards(
    rows: DataFrame,
    shards: int,
    size: str = "size",
    group: str = "group",
    key: str = "doc_id",
) -> DataFrame:
    """Add ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard) to every row.

    Rows with an equal ``group`` (text; NULL is a group of its own) stay together.
    Groups stand in the order of their digests, and the shards are the contiguous
    runs of that order whose largest has the smallest possible sum of ``size``.
    A group as large as an even share of what is left has a shard to itself and
    stands before the order; else the shards behind it would stay empty.

    Slots follow the digest and ``key``. They are counted in pieces of the order
    that are small at any size of the table, large groups of copies included.
    No rows: no rows. Columns named ``shard`` or ``slot`` are replaced.
    """
    columns = [c for c in rows.columns if c not in ("shard", "slot", group)]
    cell = F.coalesce(cell_of(F.col(group)), F.lit(0).cast("bigint"))
    placed = stage(rows.select(*columns, cell.alias("cell")), "sizes")
    groups = stage(placed.groupBy("cell").agg(F.sum(size).alias("bytes")), "groups")

    left, alone = groups.agg(F.sum("bytes")).first()[0] or 0, []
    for top in groups.orderBy(F.desc("bytes"), "cell").limit(shards - 1).collect():
        if top["bytes"] * (shards - len(alone)) <= left:
            break
        alone.append(top["cell"])
        left -= top["bytes"]
    rest = groups.filter(~F.col("cell").isin(alone)) if alone else groups
    bounds = minimax_bounds(rest, shards - len(alone))

    shard = F.lit(len(alone))
    for bound in bounds:
        shard = shard + (F.col("cell") >= bound).cast("int")
    for at, own in enumerate(alone):
        shard = F.when(F.col("cell") == own, F.lit(at)).otherwise(shard)
    return _slotted(placed.withColumn("shard", shard.cast("int")), key).select(*columns, "shard", "slot")


def _slotted(rows: DataFrame, key: str) -> DataFrame:
    """Number the rows of each shard in order: bounded pieces, and the counts of the pieces before."""
    spark = rows.sparkSession
    bucket = F.shiftright("cell", BITS - SLOT_BITS)
    counts = rows.groupBy(bucket.alias("_bucket")).count().toPandas()
    per_key = max(1, int(counts["count"].sum()) // SLOT_KEYS)
    counts["_parts"] = -(-counts["count"] // per_key)
    parts = spark.createDataFrame(counts[["_bucket", "_parts"]].astype("int64"), "_bucket bigint, _parts bigint")
    part = F.pmod(F.xxhash64(key), F.col("_parts"))
    cut = rows.withColumn("_bucket", bucket).join(F.broadcast(parts), "_bucket").withColumn("_part", part)
    piece = ["shard", "_bucket", "_part"]
    sizes = cut.groupBy(*piece).count().toPandas().sort_values(piece)  # 2 * SLOT_KEYS + shards rows at most
    sizes["_before"] = sizes.groupby("shard")["count"].cumsum() - sizes["count"]
    kinds = "shard int, _bucket bigint, _part bigint, _before bigint"
    before = spark.createDataFrame(sizes[[*piece, "_before"]], kinds)
    inside = Window.partitionBy(*piece).orderBy("cell", key)
    slot = F.col("_before") + F.row_number().over(inside) - 1
    return cut.join(F.broadcast(before), piece).withColumn("slot", slot.cast("bigint"))

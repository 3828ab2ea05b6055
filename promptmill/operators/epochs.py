"""A new order of the examples for every epoch, and equal shares for workers, without moving a row."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
SIDE = 1_024  # size of the smaller half at most, and so of the table of places outside
WORD, PRIME = 1 << 31, (1 << 31) - 1
# Multipliers of the mixing steps.
FIRST, SECOND = 1_103_515_245, 739_982_445


def halves(n: int) -> tuple[int, int]:
    """Sizes of two halves whose pairs number every place, with fewer than ``SIDE`` numbers left over."""
    small = max(1, min(math.isqrt(max(n - 1, 0)) + 1, SIDE))
    return small, -(-n // small)


def round_keys(seed: int, epoch: int, rounds: int = ROUNDS) -> list[int]:
    """31 bits for each half-round."""
    return [int(hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()[:8], 16) % WORD for i in range(2 * rounds)]


def _mixed(x: int, key: int) -> int:
    """The round function: products modulo a power of two and then a prime."""
    return ((x % WORD + (x >> 31)) ^ key) % WORD * FIRST % WORD * SECOND % PRIME


def _mixed_column(x: Column, key: Column) -> Column:
    return (x % WORD + F.shiftright(x, 31)).bitwiseXOR(key) % WORD * FIRST % WORD * SECOND % PRIME


def _sent(place: int, small: int, large: int, keys: list[int]) -> int:
    """Where the rounds send a place of the grid."""
    left, right = place % small, place // small
    for a, b in zip(keys[::2], keys[1::2], strict=True):
        left = (left + _mixed(right, a)) % small
        right = (right + _mixed(left, b)) % large
    return right * small + left


def permuted(place: int, n: int, keys: list[int]) -> int:
    """Feistel rounds on the two halves of a number of ``[0, n)``; from places outside it is walked on."""
    grid = halves(n)
    while (place := _sent(place, *grid, keys)) >= n:
        pass
    return place


def _ways_back(n: int, keys: list[int]) -> list[int | None]:
    """For each place outside ``[0, n)`` where the walk from it comes inside; None if it goes round outside, where nothing leads."""
    small, large = halves(n)
    back = []
    for start in range(n, small * large):
        place = _sent(start, small, large, keys)
        while place >= n and place != start:
            place = _sent(place, small, large, keys)
        back.append(place if place < n else None)
    return back


def epoch_place(pos: Column, n: int, seed: int, epoch: int, rounds: int = ROUNDS) -> Column:
    """The place of position ``pos`` of ``[0, n)`` in the order of an epoch: a permutation, as an expression.

    The rounds of a keyed Feistel network shuffle a grid that holds ``[0, n)`` and fewer than
    1,024 numbers more. A position sent to one of those goes on from there until it comes back
    inside; where that ends is worked out here for each of them, so that no row needs a loop. The rounds
    are folded over the list of their keys, which keeps the expression as small as one round.
    """
    keys = round_keys(seed, epoch, rounds)
    small, large = halves(n)
    outside = _ways_back(n, keys)
    place = pos.cast("bigint")

    def state(left: Column, right: Column) -> Column:
        return F.struct(left.alias("left"), right.alias("right"))

    def turn(at: Column, key: Column) -> Column:
        left = (at["left"] + _mixed_column(at["right"], key["a"])) % small
        return state(left, (at["right"] + _mixed_column(left, key["b"])) % large)

    def arrived(at: Column) -> Column:
        there = at["right"] * small + at["left"]
        if not outside:
            return there
        table = F.array(*[F.lit(x).cast("bigint") for x in outside])
        return F.when(there < n, there).otherwise(F.get(table, (there - n).cast("int")))

    pairs = zip(keys[::2], keys[1::2], strict=True)
    table = F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b")) for a, b in pairs])
    begin = state(place % small, F.floor((place - place % small) / small).cast("bigint"))
    return F.aggregate(table, begin, turn, arrived)


def epoch_shards(
    df: DataFrame,
    world_size: int,
    epoch: int,
    seed: int = 42,
    n: int | None = None,
    drop_last: bool = False,
    pos: str = "pos",
) -> DataFrame:
    """Add ``rank`` and ``step``: where each example stands in an epoch's run of each of ``world_size`` workers.

    ``pos`` numbers the examples from 0 without gaps; ``n`` is their number, counted if not
    given. Examples are dealt to workers in turn in the epoch's own order, and every worker gets as many as the
    others: the first examples of the order come again at its end to fill up, or, with ``drop_last``, the
    last ones are left out of this epoch. Nothing is shuffled: a place is worked out from ``pos`` alone. No rows: no rows.
    """
    if world_size < 1:
        raise ValueError("world_size must be positive")
    if n is None:
        n = df.count()
    if not n:
        return df.withColumns({"rank": F.lit(0), "step": F.lit(0).cast("bigint")})
    total = n // world_size * world_size if drop_last else -(-n // world_size) * world_size
    placed = df.withColumn("_place", epoch_place(F.col(pos), n, seed, epoch))
    if drop_last:
        placed = placed.filter(F.col("_place") < total).withColumn("_at", F.col("_place"))
    else:
        again = F.sequence(F.col("_place"), F.lit(total - 1).cast("bigint"), F.lit(n).cast("bigint"))
        placed = placed.withColumn("_at", F.explode(again))
    return placed.withColumns(
        {"rank": (F.col("_at") % world_size).cast("int"), "step": F.expr(f"_at div {world_size}")}
    ).drop("_place", "_at")

"""Exact running totals that no single group can overload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Consecutive order values handled by one window group.
CHUNK = 65_536
# Chunks whose sums one window group adds up.
SPAN = 4_096


def chunk_of(order: str, chunk: int = CHUNK) -> Column:
    """The chunk of a whole number; negative ones too lie in chunks of full size."""
    return F.expr(f"(`{order}` - pmod(`{order}`, {chunk})) div {chunk}")


def running_totals(
    df: DataFrame,
    by: list[str],
    order: str,
    values: dict[str, Column],
    chunk: int = CHUNK,
    below: tuple[str, int] | None = None,
) -> DataFrame:
    """Add, per ``by`` group, the sum of each value over the rows before this one.

    ``order`` is a whole number, unique within its group. Groups are cut into
    chunks of ``chunk`` consecutive numbers: each chunk is one window group, and
    the chunk sums (combined before the shuffle) give what earlier chunks
    contribute. However large a group is, no task sorts more than one chunk of
    it at a time; the sums table has one row per group and chunk. The join with
    that table and the window share one partitioning, so rows move once.

    ``below=(name, limit)`` keeps only rows whose total ``name`` is under
    ``limit``; whole chunks beyond it are dropped before the rows are sorted.
    """
    # One text key for the group, so that a NULL group meets itself.
    group = {"_group": F.to_json(F.struct(*[F.col(f"`{c}`") for c in by]))} if by else {}
    keys = [*group, "_chunk"]
    rows = df.withColumns(
        {
            **group,
            "_chunk": chunk_of(order, chunk),
            **{f"_v_{name}": value.cast("bigint") for name, value in values.items()},
        }
    )

    names = [f"_c_{n}" for n in values]
    sums = rows.groupBy(*keys).agg(*[F.sum(f"_v_{n}").alias(f"_c_{n}") for n in values])
    # Chunks in turn are summed in spans, so that the chunks of a long group do not meet in one task either.
    sums = sums.withColumn("_span", chunk_of("_chunk", SPAN))
    spans = [*group, "_span"]
    totals = sums.groupBy(*spans).agg(*[F.sum(c).alias(f"_s{c}") for c in names])
    outer = Window.partitionBy(*group).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*spans, *[F.coalesce(F.sum(f"_s{c}").over(outer), F.lit(0)).alias(f"_s{c}") for c in names])
    inner = Window.partitionBy(*spans).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.join(before, spans).select(
        *keys, *[(F.col(f"_s{c}") + F.coalesce(F.sum(c).over(inner), F.lit(0))).alias(c) for c in names]
    )
    if below:
        carry = carry.filter(F.col(f"_c_{below[0]}") < below[1])

    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(carry, keys).select(
        *df.columns,
        *[
            (F.col(f"_c_{n}") + F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0))).alias(n)
            for n in values
        ],
    )
    return out.filter(F.col(below[0]) < below[1]) if below else out

"""Counts, length profiles, balancing and run sizing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.operators.running import CHUNK, running_totals


def category_distribution(df: DataFrame, category: Column | None = None) -> DataFrame:
    """Records per category, case kept. A missing category counts as ``unknown``.

    For records with VARIANT metadata pass ``category_label(metadata)``, which
    keeps a JSON null apart from a missing key.
    """
    if category is None:
        category = F.coalesce(F.col("category"), F.lit("unknown"))
    return df.groupBy(category.alias("category")).agg(F.count("*").alias("n"))


def top_categories(distribution: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most common categories; ties in order of name."""
    return distribution.orderBy(F.desc("n"), F.asc("category")).limit(k)


def token_length_profile(
    df: DataFrame, by: list[str], limit: int, n_tokens: str = "n_tokens"
) -> DataFrame:
    """Exact token-length distribution per group, and how many exceed ``limit``.

    Lengths are first counted, so the percentiles work on a histogram and a group
    of any size is reduced before the shuffle.
    """
    n, rows = F.col(n_tokens), F.col("rows")
    histogram = df.groupBy(*by, n_tokens).agg(F.count("*").alias("rows"))
    return histogram.groupBy(*by).agg(
        F.sum("rows").alias("n"),
        F.percentile(n, F.lit(0.5), rows).alias("p50"),
        F.percentile(n, F.lit(0.9), rows).alias("p90"),
        (F.sum(n * rows) / F.sum("rows")).alias("mean"),
        F.max(n).alias("max"),
        F.sum(F.when(n > limit, rows).otherwise(0)).alias("over"),
    )


def category_weights(df: DataFrame, category: Column | None = None) -> DataFrame:
    """Weight per category that gives every category the same total: n / (categories * n_k)."""
    counts = category_distribution(df, category)
    total, groups = counts.agg(F.sum("n")).scalar(), counts.agg(F.count("*")).scalar()
    return counts.select("category", "n", (total / (groups * F.col("n"))).alias("weight"))


def balance_categories(
    df: DataFrame, per_category: int, order: str = "pos", **options
) -> DataFrame:
    """The first ``per_category`` records of each category in ``order``, with category weights.

    ``df`` has a ``category`` column and a dense integer ``order``.
    """
    labelled = df.withColumn("category", F.coalesce(F.col("category"), F.lit("unknown")))
    taken = running_totals(
        labelled, ["category"], order, {"_taken": F.lit(1)}, below=("_taken", per_category), **options
    ).drop("_taken")
    return taken.join(category_weights(labelled).drop("n"), "category")


def effective_batch(per_device: int, accumulation: int, world_size: int = 1) -> int:
    return per_device * accumulation * max(world_size, 1)


def run_sizing(
    df: DataFrame,
    epochs: float = 3,
    per_device: int = 1,
    accumulation: int = 8,
    world_size: int = 1,
    max_steps: int = -1,
) -> DataFrame:
    """Examples, effective batch and optimizer steps per split; a positive ``max_steps`` caps them."""
    batch = effective_batch(per_device, accumulation, world_size)
    steps = F.ceil(F.lit(float(epochs)) * F.col("n") / F.lit(batch)).cast("bigint")
    if max_steps > 0:
        steps = F.least(steps, F.lit(max_steps).cast("bigint"))
    return (
        df.groupBy("split")
        .agg(F.count("*").alias("n"))
        .select("split", "n", F.lit(batch).cast("bigint").alias("effective_batch"), steps.alias("steps"))
    )


def length_limits(
    df: DataFrame,
    by: list[str],
    n_tokens: str = "n_tokens",
    step: int = 1,
    epochs: float = 3,
    per_device: int = 1,
    accumulation: int = 8,
    world_size: int = 1,
) -> DataFrame:
    """What every limit on the example length costs, per group: one row per limit.

    Limits are the multiples of ``step`` up to the first that cuts nothing. ``n`` and ``n_cut`` are
    the examples and those longer than ``max_seq_length``, ``share_cut`` their ratio; ``kept_tokens``
    and ``lost_tokens`` are left and lost by cutting; ``padding_tokens`` fill examples up to the limit;
    ``steps`` are the optimizer steps of one example a row. ``packed_blocks`` and ``packed_steps`` hold for
    examples laid end to end, which loses nothing. Examples without tokens count as examples; a NULL length
    counts as none. A group without any token has no limit and no row.

    Examples are read once, into a histogram of lengths; all else works on that. Every limit is then
    a running total over the histogram, in chunks of consecutive limits, so neither a long group nor a
    very long example gives one task more than a chunk.
    """
    if step < 1:
        raise ValueError("step must be positive")
    n, rows = F.coalesce(F.col(n_tokens), F.lit(0)).cast("bigint"), F.col("_rows")
    unit = F.expr(f"(_n + {step - 1}) div {step}")
    histogram = (
        df.select(*by, n.alias("_n"))
        .groupBy(*by, unit.alias("_unit"))
        .agg(F.count("*").alias("_rows"), F.sum("_n").alias("_tokens"))
    )
    sums = histogram.groupBy(*by).agg(F.sum("_rows").alias("n"), F.sum("_tokens").alias("_all"), F.max("_unit").alias("_last"))
    # Chunks of limits first, then the limits of a chunk, so that no row holds an array of all limits.
    chunks = sums.filter("_last > 0").select(*by, "_last", F.explode(F.expr(f"sequence(0, _last div {CHUNK})")).alias("_chunk"))
    limits = chunks.select(
        *by, F.explode(F.expr(f"sequence(greatest(_chunk * {CHUNK}, 1), least((_chunk + 1) * {CHUNK} - 1, _last))")).alias("_unit")
    )
    none = F.lit(0).cast("bigint")
    dense = (
        histogram.unionByName(limits.select(*by, "_unit", none.alias("_rows"), none.alias("_tokens")))
        .groupBy(*by, "_unit")
        .agg(F.sum("_rows").alias("_rows"), F.sum("_tokens").alias("_tokens"))
    )
    placed = running_totals(dense, by, "_unit", {"_rows_under": rows, "_tokens_under": F.col("_tokens")})
    placed = placed.filter("_unit > 0")
    if by:
        group = sums.select(*[F.col(f"`{c}`").alias(f"_by_{i}") for i, c in enumerate(by)], "n", "_all")
        placed = placed.join(group, [F.col(f"`{c}`").eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)])
    else:
        placed = placed.withColumns({c: sums.select(c).scalar() for c in ("n", "_all")})
    limit = F.col("_unit") * F.lit(step).cast("bigint")
    cut = F.col("n") - F.col("_rows_under") - rows
    kept = F.col("_tokens_under") + F.col("_tokens") + limit * cut
    batch = effective_batch(per_device, accumulation, world_size)
    steps = lambda examples: F.ceil(F.lit(float(epochs)) * examples / F.lit(batch)).cast("bigint")
    blocks = F.expr(f"(_all + _unit * {step} - 1) div (_unit * {step})")
    return placed.select(
        *by,
        limit.alias("max_seq_length"),
        "n",
        cut.alias("n_cut"),
        (cut / F.col("n")).alias("share_cut"),
        kept.alias("kept_tokens"),
        (F.col("_all") - kept).alias("lost_tokens"),
        (F.col("n") * limit - kept).alias("padding_tokens"),
        steps(F.col("n")).alias("steps"),
        blocks.alias("packed_blocks"),
        steps(blocks).alias("packed_steps"),
    )

"""Mixing documents to target weights by iterative proportional fitting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.staging import stage

ROUNDS = 8


def tempered_targets(cells: DataFrame, by: str, power: float) -> DataFrame:
    """``by, target``: shares of the tokens raised to ``power`` (1: as they are, 0: all equal)."""
    sums = cells.groupBy(by).agg(F.sum("tokens").alias("t"))
    raised = sums.filter("t > 0").select(by, F.pow("t", F.lit(float(power))).alias("target"))
    total = raised.agg(F.sum("target")).first()[0]
    return raised.withColumn("target", F.col("target") / F.lit(total))


def _fitted(cells: DataFrame, by: str, targets: DataFrame) -> DataFrame:
    """Scale the weights so that their sums per ``by`` meet the targets. A value without a target gets none."""
    sums = cells.groupBy(by).agg(F.sum("weight").alias("_sum"))
    factor = sums.join(targets, by).select(by, F.when(F.col("_sum") > 0, F.col("target") / F.col("_sum")).alias("_f"))
    scaled = F.col("weight") * F.coalesce("_f", F.lit(0.0))
    return cells.join(factor, by, "left").withColumn("weight", scaled).select(*cells.columns)


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Iterative proportional fitting of ``weight`` over a table of cells.

    ``cells`` has a column for each key of ``targets`` and ``tokens``; each
    target table gives a ``target`` share per value (the shares are scaled to 1).
    A round scales the weights to each marginal in turn. The cells are written
    after every round: a lost executor costs one round of a small table.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    shares = {}
    for by, table in targets.items():
        whole = table.agg(F.sum("target")).first()[0] or 1
        shares[by] = table.withColumn("target", F.col("target") / F.lit(float(whole)))
    fitted = cells.withColumn("weight", F.col("tokens") / F.lit(float(max(total, 1))))
    for _ in range(rounds):
        fitted = stage(reduce(lambda c, by: _fitted(c, by, shares[by]), shares, fitted), "raked")
    return fitted


def sampling_scale(fitted: DataFrame, keep: float) -> float:
    """The factor ``s`` for which ``sum(tokens * min(1, s * ratio))`` is ``keep`` of all tokens.

    The sum is concave in ``s``; from below, Newton steps rise until the set of
    cells taken whole no longer grows, and then the factor is exact.
    """
    live = fitted.filter("tokens > 0 AND weight > 0")
    goal = keep * (live.agg(F.sum("tokens")).first()[0] or 0)
    scale, before = 0.0, -1.0
    while goal and scale > before:
        whole = F.col("weight") * scale >= F.col("tokens")
        sums = live.agg(
            F.coalesce(F.sum(F.when(whole, F.col("tokens"))), F.lit(0)), F.sum(F.when(~whole, F.col("weight")))
        ).first()
        before, scale = scale, (goal - sums[0]) / sums[1] if sums[1] else scale
    return max(scale, before)


def uniform(doc_id: str, seed: int) -> Column:
    """A number from 0 to under 1 that the id and the seed decide."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def mix(
    docs: DataFrame,
    by: dict[str, Column],
    tokens: Column,
    targets: dict[str, DataFrame] | None = None,
    power: float = 0.85,
    keep: float = 0.75,
    rounds: int = ROUNDS,
    seed: int = 8,
    doc_id: str = "doc_id",
) -> DataFrame:
    """Every row of ``docs`` with its ``probability`` and ``sampled``, as columns of a struct ``_mix``.

    ``by`` names the marginals (source, language, topic) and how they are read
    from a row; NULL is a value of its own, ``''``. ``tokens`` is the weight of a
    row; rows without tokens have weight 0 and are sampled with the probability
    of their cell. ``targets`` gives shares per value; a marginal without a
    table gets its own shares raised to ``power``.

    Only cells (combinations that occur) go through the fitting. A cell's
    probability is its fitted weight over its tokens, scaled so that ``keep`` of
    all tokens are expected to stay, and 1 where that would be more: the token
    shares meet the targets as far as no document is taken twice. Rows with equal
    ids share one draw. An empty table gives an empty one.
    """
    named = docs.withColumn("_mix", F.struct(*[F.coalesce(v.cast("string"), F.lit("")).alias(k) for k, v in by.items()]))
    counted = named.select("_mix.*", tokens.cast("bigint").alias("tokens"))
    cells = stage(counted.groupBy(*by).agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")), "cells")
    given = dict(targets or {})
    fitted = rake(cells, {k: given.get(k) or tempered_targets(cells, k, power) for k in by}, rounds)
    ratio = F.col("weight") / F.col("tokens") * F.lit(sampling_scale(fitted, keep))
    rate = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), ratio)).otherwise(F.lit(1.0))
    rates = fitted.select(F.struct(*by).alias("_cell"), rate.alias("_rate"))
    joined = named.join(rates, F.col("_mix") == F.col("_cell"), "left")
    chosen = uniform(doc_id, seed) < F.col("_rate")
    fields = [F.col(f"_mix.{k}").alias(k) for k in by]
    return joined.select(
        *docs.columns, F.struct(*fields, F.col("_rate").alias("probability"), chosen.alias("sampled")).alias("_mix")
    )


def topic_of(text: Column) -> Column:
    """A plain topic by form: ``code``, ``figures``, ``lists`` or ``prose``. Whole texts are looked at."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))

    def count(characters: str) -> Column:
        return F.length(text) - F.length(F.translate(text, characters, ""))

    return (
        F.when(count("{};=<>|") * 50 > size, "code")
        .when(count("0123456789") * 25 > size, "figures")
        .when(count("\n") * 60 > size, "lists")
        .otherwise("prose")
    )


def estimated_tokens(text: Column) -> Column:
    """A quarter of the UTF-8 bytes, rounded up."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4).cast("bigint")

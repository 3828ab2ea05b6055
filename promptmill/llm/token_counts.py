"""Exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.tokenizing import RANKS, token_lengths
from promptmill.operators.running import running_totals
from promptmill.staging import stage

CHUNK = 64


def length_histogram(docs: DataFrame, text: str = "text", ranks_path: str = RANKS) -> DataFrame:
    """``n_tokens, n_docs``: how many documents have each encoded length. NULL text has length 0."""
    lengths = token_lengths(docs, text, ranks_path)
    return stage(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")


def context_limits(histogram: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per length that occurs, taken as a context limit.

    ``docs_within`` and ``tokens_within`` count the documents that fit whole;
    ``docs_over`` those that are longer, ``tokens_over`` all their tokens;
    ``tokens_truncated`` what remains if every document is cut at the limit, and
    ``tokens_lost`` what is cut away; ``quantile`` is the share of documents that
    fit. Between two lengths that occur every figure is known too, see
    :func:`answer`. No documents: no rows.

    Suffix sums are totals less running sums over chunks of ``chunk`` consecutive
    lengths, so no task sorts all lengths.
    """
    n, tokens = F.col("n_docs"), F.col("n_docs") * F.col("n_tokens")
    sums = running_totals(histogram, [], "n_tokens", {"_docs": n, "_tokens": tokens}, chunk=chunk)
    all_docs, all_tokens = (F.lit(x) for x in histogram.agg(F.sum(n), F.sum(tokens)).first())
    within, tokens_within = F.col("_docs") + n, F.col("_tokens") + tokens
    limit = F.col("n_tokens")
    counted = sums.select(
        limit.alias("context_limit"),
        n.alias("n_docs"),
        within.alias("docs_within"),
        tokens_within.alias("tokens_within"),
        (all_docs - within).alias("docs_over"),
        (all_tokens - tokens_within).alias("tokens_over"),
        (within / all_docs).alias("quantile"),
    )
    cut = F.col("tokens_within") + F.col("context_limit") * F.col("docs_over")
    return counted.withColumns(
        {"tokens_truncated": cut, "tokens_lost": F.col("tokens_within") + F.col("tokens_over") - cut}
    )


def answer(limits: DataFrame, at: list[int]) -> DataFrame:
    """The same figures for any limits, those that no document has included.

    Each limit is answered by the longest length within it, in one pass over the
    table. Under the shortest length nothing fits: ``docs_within`` is 0.
    """
    figures = F.struct("docs_within", "tokens_within")
    length = F.col("context_limit")
    found = limits.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.max(F.col("tokens_within") + F.col("tokens_over")), F.lit(0)).alias("tokens"),
        F.array(*[
            F.struct(F.lit(int(x)).cast("bigint").alias("limit"), F.max_by(figures, F.when(length <= x, length)).alias("r"))
            for x in at
        ]).alias("asked"),
    )
    docs, tokens = F.coalesce("r.docs_within", F.lit(0)), F.coalesce("r.tokens_within", F.lit(0))
    over = F.col("docs") - docs
    cut = tokens + F.col("limit") * over
    return found.select("docs", "tokens", F.inline("asked")).select(
        F.col("limit").alias("context_limit"),
        docs.alias("docs_within"),
        over.alias("docs_over"),
        F.when(F.col("docs") > 0, docs / F.col("docs")).alias("quantile"),
        cut.alias("tokens_truncated"),
        (F.col("tokens") - cut).alias("tokens_lost"),
    )

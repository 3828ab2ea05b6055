"""Evaluation tables: results, report sections, comparison of two runs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.difference import difference_spans
from promptmill.functions.text import estimate_tokens, tokens
from promptmill.operators.chat import TokenCounter
from promptmill.operators.records import SYSTEM_PROMPT, prompt_messages
from promptmill.operators.templates import CHATML, Template


def unique_by(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df`` as it is, failing the query if two rows share ``key``.

    Rows are combined before the shuffle, so that a key repeated very often is
    reported and not gathered.
    """
    rest = [c for c in df.columns if c != key]
    checked = df.groupBy(key).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in rest])
    repeated = F.raise_error(F.concat(F.lit(f"{what} repeats: "), F.col(key)))
    return checked.select(F.when(F.col("_n") == 1, F.col(key)).otherwise(repeated).alias(key), *rest)


def eval_results(
    prompts: DataFrame,
    responses: DataFrame,
    system_prompt: str = SYSTEM_PROMPT,
    counter: TokenCounter = estimate_tokens,
    template: Template = CHATML,
) -> DataFrame:
    """Attach each prompt to its responses, with prompt and completion token counts.

    ``prompts``: ``ord, id, category, prompt``, each id once; ``responses``:
    ``id, response`` and whatever else tells runs apart. The prompt is rendered
    and counted once per prompt, before the join; prompts without a response
    stay with NULLs. They are added by a separate anti join, which leaves the
    join with the responses an inner one: either side of that can be broadcast,
    or split where one prompt has very many responses.
    """
    rendered = template.text(F.col("messages"), add_generation_prompt=True)
    asked = unique_by(prompts.select("ord", "id", "category", "prompt"), "id", "prompt id")
    counted = (
        prompt_messages(asked, system_prompt)
        .withColumn("prompt_tokens", counter(rendered).cast("bigint"))
        .drop("messages")
    )
    answered = responses.withColumn("completion_tokens", counter(F.col("response")).cast("bigint"))
    silent = counted.join(responses.select("id").distinct(), "id", "left_anti")
    return counted.join(answered, "id").unionByName(silent, allowMissingColumns=True)


# Layout of the report, one header and one section per result.
# Each ends where the line writer adds the last line end.
HEADER = "# {title}\n\n**Model:** {model}\n\n**Generated:** {generated}\n\n---\n"
SECTION = (
    "## [%s] %s\n\n**Prompt:** %s\n\n**Response:**\n\n%s\n\n"
    "*(%d prompt tokens, %d completion tokens)*\n\n---\n"
)


def report_header(model: str, generated: datetime, title: str = "Eval Report") -> str:
    stamp = generated.astimezone(timezone.utc).isoformat()
    return HEADER.format(title=title, model=model, generated=stamp)


def report_section() -> Column:
    return F.format_string(
        SECTION, "category", "id", "prompt", "response", "prompt_tokens", "completion_tokens"
    )


def eval_report(results: DataFrame, keep: tuple[str, ...] = ("run",)) -> DataFrame:
    """One Markdown section per answered prompt, with ``ord`` to put them in prompt order.

    A report stays rows of sections, however many prompts a run has; the writer
    puts them in order.
    """
    keys = [c for c in keep if c in results.columns]
    return results.filter(F.col("response").isNotNull()).select(
        *keys, "ord", report_section().alias("section")
    )


def compare_runs(before: DataFrame, after: DataFrame, on: list[str] | None = None) -> DataFrame:
    """What changed per prompt between two result tables.

    ``on`` names the columns that identify a result within a run (default ``id``);
    a repeated result is an error. Status is ``added``, ``removed``, ``changed``
    or ``same``; the token delta is completion tokens after minus before, NULL
    where one side is missing.

    Both tables are put under each other and combined per key, which takes one
    shuffle and never pairs up repeated keys.
    """
    keys = on or ["id"]
    sides = [
        df.select(*keys, F.lit(i).alias("_side"), F.struct("response", "completion_tokens").alias("_result"))
        for i, df in enumerate((before, after))
    ]
    side = F.col("_side")
    both = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*keys)
        .agg(
            *[F.count_if(side == i).alias(f"_n{i}") for i in (0, 1)],
            *[F.any_value(F.when(side == i, F.col("_result")), ignoreNulls=True).alias(f"_r{i}") for i in (0, 1)],
        )
    )
    status = F.expr(
        """CASE
        WHEN _n0 > 1 OR _n1 > 1 THEN raise_error('a result repeats within a run')
        WHEN _n0 = 0 THEN 'added'
        WHEN _n1 = 0 THEN 'removed'
        WHEN _r0.response <=> _r1.response THEN 'same'
        ELSE 'changed' END"""
    )
    return both.select(
        *keys,
        F.col("_r0.response").alias("before"),
        F.col("_r1.response").alias("after"),
        status.alias("status"),
        F.expr("_r1.completion_tokens - _r0.completion_tokens").alias("delta_tokens"),
    )


def answer_changes(compared: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """How each answer changed, word by word: one row per span, from :func:`compare_runs`.

    ``span`` numbers the spans of a pair from 0; ``kind`` is ``kept``, ``added`` or ``removed``;
    ``before_at`` and ``after_at`` are the words before it on either side, ``n_words`` its length
    and ``words`` what it says, joined by single spaces. The kept words are a longest common
    subsequence. Words are those that are counted as tokens, so changes of white space alone do not show.
    An answer that only one side has is one added or removed span; a pair without words has no row.

    Pairs that are the same are not sent to Python. The work of a pair grows with the product of the
    words between its shared ends, its memory with their sum; pairs are spread over the tasks of the
    shuffle that brought them together.
    """
    names = keys or ["id"]
    same = F.col("status") == "same"
    words = lambda side: F.coalesce(tokens(F.col(side)), F.array().cast("array<string>"))
    laid = compared.select(*names, same.alias("_same"), words("before").alias("_before"), words("after").alias("_after"))
    zero, size = F.lit(0), F.size("_after")
    whole = F.array(F.struct(F.lit("kept").alias("kind"), zero.alias("before_at"), zero.alias("after_at"), size.alias("n_words")))
    alike = laid.filter("_same AND size(_after) > 0").withColumn("_spans", whole)
    apart = laid.filter("NOT _same").withColumn("_spans", difference_spans("_before", "_after"))
    spans = alike.unionByName(apart).select(*names, "_before", "_after", F.posexplode("_spans").alias("span", "_s"))
    side = F.when(F.col("_s.kind") == "removed", F.slice("_before", F.col("_s.before_at") + 1, F.col("_s.n_words"))).otherwise(
        F.slice("_after", F.col("_s.after_at") + 1, F.col("_s.n_words"))
    )
    return spans.select(*names, "span", "_s.kind", "_s.before_at", "_s.after_at", "_s.n_words", F.array_join(side, " ").alias("words"))

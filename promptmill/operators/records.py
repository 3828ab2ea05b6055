"""Instruction records: required fields, category filter, chat messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.text import strip

# Own wording; used where a caller gives no system prompt.
SYSTEM_PROMPT = "Answer with care, and say so when you are not sure."

MESSAGES = "array<struct<role:string,content:string>>"


def is_complete(instruction: str = "instruction", output: str = "output") -> Column:
    """Both required (stripped) fields are there."""
    return (F.col(instruction) != "") & (F.col(output) != "")


def require_fields(df: DataFrame) -> DataFrame:
    """Strip the three text fields, NULL becoming ``''``; drop rows without instruction or output."""
    stripped = {
        c: F.coalesce(strip(F.col(c)), F.lit("")) for c in ("instruction", "input", "output")
    }
    return df.withColumns(stripped).filter(is_complete())


def parse_categories(text: str | None) -> list[str] | None:
    """Comma list to lower-case names; None when there is no filter."""
    return sorted({part.strip().lower() for part in text.split(",")}) if text else None


def filter_category(df: DataFrame, wanted: str | None, category: Column | None = None) -> DataFrame:
    """Keep records whose lower-cased category is in the comma list ``wanted``."""
    names = parse_categories(wanted)
    if names is None:
        return df
    category = F.col("category") if category is None else category
    return df.filter(F.lower(F.coalesce(category, F.lit(""))).isin(names))


def compose_user(instruction: str = "instruction", input: str = "input") -> Column:
    """User text: the instruction, followed by the input after a blank line if there is one."""
    return F.when(F.col(input) == "", F.col(instruction)).otherwise(
        F.concat(F.col(instruction), F.lit("\n\n"), F.col(input))
    )


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_messages(df: DataFrame, system_prompt: str | None = SYSTEM_PROMPT) -> DataFrame:
    """Add ``messages`` for training; an empty system prompt gives no system message."""
    turns = [message("user", compose_user()), message("assistant", F.col("output"))]
    if system_prompt:
        turns.insert(0, message("system", F.lit(system_prompt)))
    return df.withColumn("messages", F.array(*turns).cast(MESSAGES))


def prompt_messages(df: DataFrame, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """Add ``messages`` for an evaluation prompt: always a system message, prompt left as it is."""
    return df.withColumn(
        "messages",
        F.array(message("system", F.lit(system_prompt)), message("user", F.col("prompt"))).cast(MESSAGES),
    )

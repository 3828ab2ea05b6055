"""Chat files and prompt arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.operators.records import MESSAGES
from promptmill.sources.discovery import path_exists


def read_chat(spark: SparkSession, train: str, validation: str | None = None) -> DataFrame:
    """Chat lines as ``split, messages``; the validation file is optional. A line without messages is an error."""
    parts = {"train": train}
    if validation and path_exists(spark, validation):
        parts["validation"] = validation
    reader = spark.read.schema(f"messages {MESSAGES}").option("mode", "FAILFAST")
    lacking = F.raise_error(F.lit("chat line without messages")).cast(MESSAGES)
    messages = F.coalesce("messages", lacking).alias("messages")
    frames = [reader.json(path).select(F.lit(split).alias("split"), messages) for split, path in parts.items()]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_prompts(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """JSON arrays of prompts as ``ord, id, category, prompt``, in file order.

    An array is one document, so one task reads it; a large prompt set is several
    files, told apart by ``file`` on request.
    """
    items = F.from_json(
        "value", "array<struct<id:string,category:string,prompt:string>>", {"mode": "FAILFAST"}
    )
    file = [F.col("_metadata.file_path").alias("file")] if with_file else []
    return (
        spark.read.text(path, wholetext=True)
        .select(*file, F.posexplode(items).alias("ord", "item"))
        .select(*["file"][: len(file)], F.col("ord").cast("bigint"), "item.*")
    )

"""Tables kept between the steps of a plan, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path below ``spark.checkpoint.dir``.

    A local folder is used only when the setting is absent and the session is
    local, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="promptmill-")
    return f"{root.rstrip('/')}/promptmill-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table once and go on from the written copy.

    Later steps read only the columns they need, and a lost executor costs a
    re-read of files instead of a recomputation.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(
    df: DataFrame, label: str, counts: dict[str, Column], partition_by: list[str] | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """:func:`stage`, with counts summed up by the tasks that write.

    They stand right before the write, in the last stage: of a task that is run again, or
    twice, only one run counts. A later use of the staged table does not count anew.
    """
    seen = Observation()
    staged = stage(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), label, partition_by)
    got = seen.get
    return staged, {name: got.get(name) or 0 for name in counts}

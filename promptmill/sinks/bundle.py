"""All outputs of a preparation in one folder, told whole or half-written by a manifest.

``<root>/file=<name>/`` holds the lines of each output and ``<root>/_manifest`` says how many lines each
has and what they sum up to. The manifest is removed first and written last, so a run that ended early
leaves none, and the readers refuse the folder.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from promptmill.sinks.writers import chat_line, in_order, sidecar_line

# Names of the outputs, and the columns of a manifest.
TRAIN, VAL, SIDECAR, REJECTED = "train.jsonl", "val.jsonl", "train_meta.jsonl", "rejected.jsonl"
MANIFEST = "file string, n_lines bigint, n_chars bigint, digest decimal(38,0)"


def _sums(of: Column) -> list[Column]:
    """Lines, code points and an order-free digest: the sum of the lines' 64-bit hashes."""
    line = F.when(of, F.col("value"))
    hashed = F.when(of, F.xxhash64("value").cast("decimal(38,0)"))
    return [
        F.count(line).alias("n_lines"),
        F.coalesce(F.sum(F.length(line)), F.lit(0)).alias("n_chars"),
        F.coalesce(F.sum(hashed), F.lit(0)).cast("decimal(38,0)").alias("digest"),
    ]


def _write(lines: DataFrame, names: Iterable[str], root: str, mode: str) -> list[tuple]:
    """Write ``file, value`` and return the manifest rows, summed up by the tasks that write.

    The sums are made in the last stage, whose tasks count once each, however often one is run.
    """
    names = list(names)
    seen = Observation()
    sums = [c.alias(f"{i}_{j}") for i, name in enumerate(names) for j, c in enumerate(_sums(F.col("file") == name))]
    writer = lines.observe(seen, *sums).write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy("file").text(root)
    got, none = seen.get, (0, 0, Decimal(0))
    return [(name, *[got.get(f"{i}_{j}") or none[j] for j in range(3)]) for i, name in enumerate(names)]


def write_bundle(records: DataFrame, rejected: DataFrame | None, root: str, ordered: bool = False) -> DataFrame:
    """Chat lines, sidecar lines and rejected lines below ``root``; returns the manifest.

    ``records`` (``pos, split, written, messages, id_value, metadata``) are read once: a training record
    gives its chat line and its sidecar line in the same task. ``ordered`` puts the lines of each output in the
    order of ``pos``, with one shuffle. ``rejected`` may have any columns.
    """
    spark = records.sparkSession
    root = root.rstrip("/")
    train = F.col("split") == "train"
    line = lambda name, value: F.struct(F.lit(name).alias("file"), value.alias("value"))
    both = F.array(line(TRAIN, chat_line(with_pos=True)), line(SIDECAR, sidecar_line()))
    lines = F.when(train, both).otherwise(F.array(line(VAL, chat_line(with_pos=True))))
    out = in_order(records.filter("written"), ordered).select("pos", F.inline(lines))
    if ordered:
        out = out.sortWithinPartitions("file", "pos")
    # Overwriting takes the old manifest away before the first line is written.
    manifest = _write(out.select("file", "value"), (TRAIN, VAL, SIDECAR), root, "overwrite")
    if rejected is not None:
        bad = rejected.select(F.lit(REJECTED).alias("file"), F.to_json(F.struct(*rejected.columns)).alias("value"))
        manifest += _write(bad, [REJECTED], root, "append")
    table = spark.createDataFrame(manifest, MANIFEST)
    table.coalesce(1).write.mode("overwrite").json(f"{root}/_manifest")
    return table


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of a whole bundle; an error if there is none."""
    missing = FileNotFoundError(f"{root} has no manifest: its writing has not come to an end")
    try:
        table = spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/_manifest")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise missing from None
        raise
    if table.isEmpty():
        raise missing
    return table


def read_bundle(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The lines (``value``) of one output of a whole bundle; other outputs are not read."""
    listed = {row.file: row.n_lines for row in read_manifest(spark, root).collect()}
    if name not in listed:
        raise FileNotFoundError(f"{root} has no {name}, only {', '.join(sorted(listed))}")
    if not listed[name]:
        return spark.createDataFrame([], "value string")
    return spark.read.text(f"{root.rstrip('/')}/file={name}").select("value")


def check_bundle(spark: SparkSession, root: str) -> DataFrame:
    """The manifest with ``ok``: does every output still hold the lines it was written with? One scan."""
    manifest = read_manifest(spark, root)
    lines = spark.read.text(root.rstrip("/"))
    if "file" not in lines.columns:  # no output is there, as after an empty run
        lines = lines.withColumn("file", F.lit(None).cast("string"))
    found = lines.groupBy("file").agg(*[c.alias(f"_{i}") for i, c in enumerate(_sums(F.lit(True)))])
    names = [c for c in manifest.columns if c != "file"]
    same = [F.coalesce(F.col(f"_{i}"), F.lit(0)) == F.col(name) for i, name in enumerate(names)]
    return manifest.join(found, "file", "left").select(*manifest.columns, (same[0] & same[1] & same[2]).alias("ok"))

"""Raw instruction lines to train and validation chat records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions.fields import category_key, category_label
from promptmill.operators.order import check_cap, order_records, split_column, validation_size
from promptmill.operators.profile import category_distribution
from promptmill.operators.records import (
    SYSTEM_PROMPT,
    filter_category,
    is_complete,
    parse_categories,
    to_messages,
)
from promptmill.sinks.bundle import write_bundle
from promptmill.sinks.writers import write_chat, write_sidecar
from promptmill.sources.discovery import discover_sources
from promptmill.sources.lines import PLACE, accepted, quarantine, read_lines, tag_lines
from promptmill.staging import stage_counted


@dataclass(frozen=True)
class PrepareConfig:
    val_split: float = 0.02
    system_prompt: str = SYSTEM_PROMPT
    category_filter: str | None = None
    max_examples: int | None = None
    seed: int = 42


@dataclass(frozen=True)
class Prepared:
    """The result of :func:`prepare`, all of it on staged tables.

    ``records`` has ``pos, split, written`` next to the record's columns;
    ``written`` is false where instruction or output is missing.
    """

    records: DataFrame
    quarantine: DataFrame
    counters: DataFrame
    categories: DataFrame

    def split(self, name: str) -> DataFrame:
        return self.records.filter((F.col("split") == name) & F.col("written"))


def prepare(lines: DataFrame, config: PrepareConfig = PrepareConfig()) -> Prepared:
    """Parse, filter by category, order by seed, cap, split, then set incomplete records aside.

    Lines are parsed once into a staged table, and the ordered records staged
    once, so that every output is a scan of the columns it needs. The counters are
    summed up while the two tables are written and cost no scan.
    """
    cap = check_cap(config.max_examples)
    validation_size(0, config.val_split)
    tagged = tag_lines(lines, keep_blank=set(PLACE) <= set(lines.columns))
    raw = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
    parsed, read = stage_counted(
        tagged.select(raw, *[c for c in tagged.columns if c != "value"]), "parsed", read_counts(config.category_filter)
    )
    kept = filter_category(accepted(parsed), config.category_filter, category_key())
    ordered = order_records(kept, config.seed, digest=F.col("digest"), size="n_bytes", limit=cap)
    n = ordered.n if cap is None else min(cap, ordered.n)
    records = ordered.df.withColumns(
        {"split": split_column(validation_size(n, config.val_split)), "written": is_complete()}
    )
    records, wrote = stage_counted(
        to_messages(records, config.system_prompt).drop("instruction", "input", "output", "digest", "n_bytes"),
        "records",
        written_counts(),
        ["split"],
    )
    counts = read | wrote
    return Prepared(
        records=records,
        quarantine=quarantine(parsed),
        counters=lines.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts)),
        categories=category_distribution(records, category_label()),
    )


def read_counts(category_filter: str | None = None) -> dict[str, Column]:
    """Counts over the parsed lines: loaded, malformed, otherwise unusable, kept by the filter."""
    good = F.col("reason").isNull()
    wanted = parse_categories(category_filter)
    chosen = good if wanted is None else good & F.lower(category_key()).isin(wanted)
    return {
        "loaded": F.count_if(good),
        "malformed": F.count_if(F.col("reason") == "malformed"),
        "unusable": F.count_if(~F.col("reason").isin("malformed", "blank")),
        "kept": F.count_if(chosen),
    }


def written_counts() -> dict[str, Column]:
    """Counts over the ordered records: written per split, and skipped."""
    written = F.col("written")
    return {
        "train": F.count_if(written & (F.col("split") == "train")),
        "val": F.count_if(written & (F.col("split") == "val")),
        "skipped": F.count_if(~written),
    }


def run_counters(parsed: DataFrame, records: DataFrame, category_filter: str | None = None) -> DataFrame:
    """The same counts of two tables that are there already, as one row; one scan of each."""
    read, wrote = read_counts(category_filter), written_counts()
    both = parsed.agg(*[c.alias(name) for name, c in read.items()]).unionByName(
        records.agg(*[c.alias(name) for name, c in wrote.items()]), allowMissingColumns=True
    )
    return both.agg(*[F.sum(name).alias(name) for name in read | wrote])


def prepare_files(
    spark: SparkSession,
    output_dir: str,
    input: str | None = None,
    input_root: str | None = None,
    config: PrepareConfig = PrepareConfig(),
    ordered: bool = False,
    bundle: bool = False,
) -> Prepared:
    """Read ``input`` (or the one data file below ``input_root``) and write the outputs.

    Chat lines and sidecar lines carry the same ``pos``. Rejected lines are written
    to ``rejected.jsonl`` with file, line number and reason. With ``bundle`` the outputs
    are ``file=<name>`` folders written in one pass over the records, with a manifest
    at the end; read them with ``read_bundle``.
    """
    if input is None:
        if input_root is None:
            raise ValueError("give an input path, or a folder to look in")
        input = discover_sources(spark, input_root)
    result = prepare(read_lines(spark, input), config)
    if bundle:
        write_bundle(result.records, result.quarantine, output_dir, ordered)
        return result
    root = output_dir.rstrip("/")
    write_chat(result.split("train"), f"{root}/train.jsonl", ordered, with_pos=True)
    write_chat(result.split("val"), f"{root}/val.jsonl", ordered, with_pos=True)
    write_sidecar(result.split("train"), f"{root}/train_meta.jsonl", ordered)
    rejected = result.quarantine
    rejected.select(F.to_json(F.struct(*rejected.columns))).write.mode("overwrite").text(f"{root}/rejected.jsonl")
    return result

"""Text writers. Each writes a folder of part files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.operators.evaluate import report_header

ROWS_PER_FILE = 500_000


def in_order(df: DataFrame, ordered: bool) -> DataFrame:
    """Sort by ``pos`` across part files, cut after every ``ROWS_PER_FILE`` positions, with one shuffle."""
    if not ordered:
        return df
    last = df.agg(F.max("pos")).first()[0] or 0
    cut = F.expr(f"CAST(pos div {ROWS_PER_FILE} AS int)")
    return df.repartitionById(last // ROWS_PER_FILE + 1, cut).sortWithinPartitions("pos")


def chat_line(with_pos: bool = False) -> Column:
    """One ``{"messages": [...]}`` object; non-ASCII text stays as it is."""
    return F.to_json(F.struct(*(["pos"] if with_pos else []), "messages"))


def sidecar_line(with_pos: bool = True) -> Column:
    """One ``{"id", "metadata"}`` object, with ``pos`` as the link to the chat lines.

    A missing id is written as null, missing metadata as ``{}``; both pass
    through as they came.
    """
    record = F.struct(
        F.col("id_value").alias("id"),
        *(["pos"] if with_pos else []),
        F.coalesce("metadata", F.parse_json(F.lit("{}"))).alias("metadata"),
    )
    return F.to_json(record, {"ignoreNullFields": "false"})


def write_chat(df: DataFrame, path: str, ordered: bool = False, with_pos: bool = False) -> None:
    """One chat line per record."""
    in_order(df, ordered).select(chat_line(with_pos)).write.mode("overwrite").text(path)


def write_sidecar(df: DataFrame, path: str, ordered: bool = False, with_pos: bool = True) -> None:
    """One sidecar line per record."""
    in_order(df, ordered).select(sidecar_line(with_pos)).write.mode("overwrite").text(path)


def write_shards(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, columns: tuple[str, ...] = ("pos", "text")) -> None:
    """The columns of each worker's rows as JSON lines below ``rank=<r>``, in ``pos`` order within a file.

    Examples are dealt to workers in turn, so a worker's share is cut after every
    ``rows_per_file`` of them by position; each cut is one task and one file.
    """
    world, last = df.agg(F.max("rank"), F.max("pos")).first()
    world = (world or 0) + 1
    cuts = 1 + (last or 0) // (rows_per_file * world)
    place = F.expr(f"CAST(rank * {cuts} + pos div {rows_per_file * world} AS int)")
    (
        df.repartitionById(world * cuts, place)
        .sortWithinPartitions("rank", "pos")
        .select("rank", F.to_json(F.struct(*columns)).alias("value"))
        .write.mode("overwrite")
        .partitionBy("rank")
        .text(path)
    )


def report_name(generated: datetime) -> str:
    return f"{generated.astimezone(timezone.utc):%Y%m%d_%H%M%S}_eval.md"


def write_report(
    sections: DataFrame, folder: str, model: str, generated: datetime, title: str = "Eval Report"
) -> str:
    """One run's report at ``<folder>/<UTC stamp>_eval.md``: header, then sections by ``ord``.

    Rows are range-sorted and written line by line. A report of usual size is one
    part file; a larger one is several, which read in name order are the report.
    """
    path = f"{folder.rstrip('/')}/{report_name(generated)}"
    header = sections.sparkSession.createDataFrame(
        [(-1, report_header(model, generated, title))], "ord bigint, section string"
    )
    rows = header.unionByName(sections.select(F.col("ord").cast("bigint"), "section"))
    rows.orderBy("ord").select("section").write.mode("overwrite").text(path)
    return path

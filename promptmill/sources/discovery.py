"""Finding the one data file below a folder."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptmill.functions.fields import configure, field, once
from promptmill.functions.text import WHITESPACE_SQL, strip
from promptmill.sources.heads import HEAD, can_open, read_heads
from promptmill.sources.lines import in_array, is_single_value

# Files that are never data, and how many lines are looked at.
IGNORED_NAMES = ["dataset-metadata.json"]
SAMPLE_LINES = 3


def with_verdict(lines: DataFrame, value: str) -> DataFrame:
    """Add ``ok``: the line is one JSON object with ``instruction`` and ``output``, or with ``messages``."""
    parsed = once(once(lines, _line=f"btrim(`{value}`, {WHITESPACE_SQL})"), _wrapped=in_array("_line"))
    record = once(parsed, _record="try_variant_get(_wrapped, '$[0]', 'variant')")
    has = {name: f"{field('_record', name)} IS NOT NULL" for name in ("instruction", "output", "messages")}
    ok = f"""is_valid_utf8(_line) AND startswith(_line, '{{') AND {is_single_value('_line', '_wrapped')}
        AND ({has['instruction']} AND {has['output']} OR {has['messages']})"""
    return once(record, ok=f"coalesce({ok}, false)").select(*lines.columns, "ok")


def sniff_shape(lines: DataFrame, order: list[str], file: str = "file", value: str = "value") -> DataFrame:
    """Per file: do its first three non-blank lines (by ``order``) look like records?

    The row number limit is applied on each partition first, so a file of any
    size sends three lines per partition to its group.
    """
    first = Window.partitionBy(file).orderBy(*order)
    head = (
        lines.filter(strip(F.col(value)) != "")
        .withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= SAMPLE_LINES)
    )
    configure(lines.sparkSession)
    return with_verdict(head, value).groupBy(file).agg(F.bool_and("ok").alias("ok"))


def _head(spark: SparkSession, path: str) -> list[bytes]:
    """The first three non-blank lines of a file, in file order.

    The limit is the root of the plan, so Spark looks at the first split and goes on
    to later ones only while lines are lacking.
    """
    lines = spark.read.text(path).filter(strip(F.col("value")) != "").select(F.col("value").cast("binary"))
    return [bytes(row.value) for row in lines.take(SAMPLE_LINES)]


def _heads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Heads of files that only Spark's readers open: one short job per file, eight at a time."""
    with ThreadPoolExecutor(8) as pool:
        heads = dict(zip(paths, pool.map(lambda p: _head(spark, p), paths), strict=True))
    rows = [(path, i, line) for path, head in heads.items() for i, line in enumerate(head or [b""])]
    return spark.createDataFrame(rows, HEAD)


def sniff_files(spark: SparkSession, paths: list[str]) -> dict[str, bool]:
    """Verdict per file. Each is read as far as its third non-blank line, all by the same rule.

    Heads are read and judged in one job, by tasks that take many files each. Where the files are in a store
    that only Spark opens, their heads come from one short job per file. The driver holds one verdict a file.
    """
    if not paths:
        return {}
    configure(spark)
    heads = read_heads(spark, paths, SAMPLE_LINES) if can_open(paths) else _heads(spark, paths)
    lines = heads.withColumn("value", F.col("value").cast("string"))
    judged = with_verdict(lines, "value").groupBy("file").agg(F.bool_and("ok").alias("ok")).collect()
    return {row.file: row.ok for row in sorted(judged)}


def sniff_file(spark: SparkSession, path: str) -> bool:
    """The same for one file, or for a folder of part files, by Spark's own reader."""
    lines = _heads(spark, [path]).withColumn("value", F.col("value").cast("string"))
    configure(spark)
    return with_verdict(lines, "value").agg(F.bool_and("ok").alias("ok")).first()[0]


def _list_files(spark: SparkSession, root: str, pattern: str, recursive: bool = True) -> list[str]:
    """Paths below ``root`` whose name fits; file contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    try:
        return sorted(row.path for row in reader.load(root).select("path").collect())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def candidate_files(spark: SparkSession, root: str) -> dict[str, bool]:
    """``.json`` and ``.jsonl`` files below ``root`` with their verdict."""
    paths = [p for p in _list_files(spark, root, "*.{json,jsonl}") if p.rsplit("/", 1)[-1] not in IGNORED_NAMES]
    return sniff_files(spark, paths)


def _some(paths: list[str], most: int = 20) -> str:
    """Names for an error text; of very many the first ones and their number."""
    rest = [f"and {len(paths) - most} more"] if len(paths) > most else []
    return "\n".join([*paths[:most], *rest])


def discover_sources(spark: SparkSession, root: str) -> str:
    """The one file below ``root`` that looks like records; otherwise an error naming the candidates."""
    verdicts = candidate_files(spark, root)
    valid = [p for p, ok in verdicts.items() if ok]
    if len(valid) == 1:
        return valid[0]
    if valid:
        raise FileNotFoundError(f"several data files below {root}, name one:\n" + _some(valid))
    if verdicts:
        raise FileNotFoundError(
            f"no file below {root} holds one JSON record per line:\n" + _some(list(verdicts))
        )
    raise FileNotFoundError(f"no .json or .jsonl file below {root}")


def resolve_split(spark: SparkSession, name: str, prepared: str, root: str) -> str:
    """``prepared`` if it is there, else the only ``name`` one level below ``root``.

    A match may be a file, or a folder of part files.
    """
    if path_exists(spark, prepared):
        return prepared
    files = _list_files(spark, f"{root.rstrip('/')}/*/{name}", "*", recursive=False)
    found = sorted({path if path.endswith(f"/{name}") else path[: path.rindex(f"/{name}/")] + f"/{name}" for path in files})
    if len(found) == 1:
        return found[0]
    raise FileNotFoundError(
        f"{name}: not at {prepared}, and {len(found)} matches below {root}\n" + _some(found)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True

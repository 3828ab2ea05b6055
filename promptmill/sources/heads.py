"""The first non-blank lines of very many files, in one job whatever their number or size."""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from promptmill.functions.text import WHITESPACE

HEAD = "file string, row int, value binary"
SCHEMES = ("file", "hdfs", "s3", "gs")
FILES_PER_TASK = 256
BYTE_ORDER_MARK = b"\xef\xbb\xbf"

# The functions travel with the query, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark lists it (``scheme:/rest``, not percent-encoded), and the path there."""
    scheme, _, rest = path.partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"no reader of {scheme}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    place, _, inside = rest.removeprefix("//").partition("/")
    system, _ = fs.FileSystem.from_uri(f"{scheme}://{place}/")
    return system, f"/{inside}" if scheme == "hdfs" else f"{place}/{inside}"


def can_open(paths: list[str]) -> bool:
    """Whether every file system among the paths is one that :func:`read_heads` reads."""
    try:
        for place in {path[: path.find("/", path.find(":") + 3) + 1] or path for path in paths}:
            file_system(place)
    except (ValueError, OSError, pa.ArrowException):
        return False
    return True


def first_lines(stream: io.RawIOBase | io.BufferedIOBase, n: int) -> Iterator[bytes]:
    """The first ``n`` non-blank lines, read no further than the buffer that holds them.

    Lines end as Spark's text reader has them, at a line feed, a carriage return or both. Latin-1
    stands for single bytes here, so that any bytes come through as they are.
    """
    begun = False
    for line in io.TextIOWrapper(stream, encoding="latin-1", newline=None):
        value = line.rstrip("\n").encode("latin-1")
        if not begun:
            value, begun = value.removeprefix(BYTE_ORDER_MARK), True
        if value.decode("utf-8", "replace").strip(WHITESPACE):
            yield value
            n -= 1
            if not n:
                return


def read_heads(spark: SparkSession, paths: list[str], n_lines: int = 3) -> DataFrame:
    """``file, row, value``: the first ``n_lines`` non-blank lines of every file.

    Files are dealt over tasks by number. Each is read from its start to the buffer with its last
    wanted line. A file without such lines has one row of empty bytes, so every file is there.
    """

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("file").to_pylist():
                system, inside = file_system(path)
                with system.open_input_stream(inside) as stream:
                    lines = list(first_lines(stream, n_lines)) or [b""]
                columns = [pa.array([path] * len(lines)), pa.array(range(len(lines)), pa.int32()), pa.array(lines, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["file", "row", "value"])

    tasks = max(-(-len(paths) // FILES_PER_TASK), min(len(paths), spark.sparkContext.defaultParallelism), 1)
    listed = spark.createDataFrame([(path,) for path in paths], "file string")
    return listed.repartition(tasks).mapInArrow(heads, HEAD)

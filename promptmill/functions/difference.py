"""Word-level differences of two texts: a longest common subsequence, found in memory linear in the words."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

SPANS = ArrayType(
    StructType()
    .add("kind", StringType())
    .add("before_at", IntegerType())
    .add("after_at", IntegerType())
    .add("n_words", IntegerType())
)

# The functions travel with the query, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A block of words that both sides share: where it begins in each, and its length.
Block = tuple[int, int, int]


def _common_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and every prefix of ``b``.

    One row of the usual table at a time: the best end at or before a place is a running maximum.
    """
    row = np.zeros(len(b) + 1, np.int32)
    for word in a:
        np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == word)), out=row[1:])
    return row


def common_blocks(a: np.ndarray, b: np.ndarray) -> list[Block]:
    """The words of a longest common subsequence as runs, in order.

    Shared ends are taken off first, since some longest subsequence holds them. The rest is halved
    on the longer side, and the other side cut at the first place where the lengths of both halves
    sum up to the most; parts wait on a stack, so depth is no matter.
    """
    found: list[Block] = []
    open_parts = [(0, len(a), 0, len(b))]
    while open_parts:
        a0, a1, b0, b1 = open_parts.pop()
        n = min(a1 - a0, b1 - b0)
        if not n:
            continue
        apart = np.flatnonzero(a[a0 : a0 + n] != b[b0 : b0 + n])
        head = int(apart[0]) if len(apart) else n
        if head:
            found.append((a0, b0, head))
            a0, b0, n = a0 + head, b0 + head, n - head
        if not n:
            continue
        apart = np.flatnonzero(a[a1 - n : a1][::-1] != b[b1 - n : b1][::-1])
        tail = int(apart[0]) if len(apart) else n
        if tail:
            a1, b1, n = a1 - tail, b1 - tail, n - tail
            found.append((a1, b1, tail))
        if not n:
            continue
        if a1 - a0 == 1 or b1 - b0 == 1:
            one, many = (a[a0], b[b0:b1]) if a1 - a0 == 1 else (b[b0], a[a0:a1])
            hit = np.flatnonzero(many == one)
            if len(hit):
                found.append((a0, b0 + int(hit[0]), 1) if a1 - a0 == 1 else (a0 + int(hit[0]), b0, 1))
            continue
        swap = b1 - b0 > a1 - a0
        long, short = (b[b0:b1], a[a0:a1]) if swap else (a[a0:a1], b[b0:b1])
        half = len(long) // 2
        ahead = _common_lengths(long[:half], short)
        behind = _common_lengths(long[half:][::-1], short[::-1])[::-1]
        cut = int(np.argmax(ahead + behind))
        at = (a0 + cut, b0 + half) if swap else (a0 + half, b0 + cut)
        open_parts += [(a0, at[0], b0, at[1]), (at[0], a1, at[1], b1)]
    return _joined(sorted(found))


def _joined(blocks: list[Block]) -> list[Block]:
    """Blocks that follow each other on both sides as one."""
    joined: list[Block] = []
    for a0, b0, n in blocks:
        if joined and (joined[-1][0] + joined[-1][2], joined[-1][1] + joined[-1][2]) == (a0, b0):
            joined[-1] = (*joined[-1][:2], joined[-1][2] + n)
        else:
            joined.append((a0, b0, n))
    return joined


def difference(before: list[str], after: list[str]) -> list[tuple[str, int, int, int]]:
    """``kind, before_at, after_at, n_words`` of the spans that turn ``before`` into ``after``, in order.

    Kept and removed spans together are all words of ``before``, kept and added ones all of ``after``.
    Between two kept spans the removed one comes first.
    """
    number: dict[str, int] = {}
    a, b = (np.array([number.setdefault(word, len(number)) for word in side], np.int64) for side in (before, after))
    spans, at_a, at_b = [], 0, 0
    for a0, b0, n in [*common_blocks(a, b), (len(a), len(b), 0)]:
        spans.append(("removed", at_a, at_b, a0 - at_a))
        spans.append(("added", a0, at_b, b0 - at_b))
        spans.append(("kept", a0, b0, n))
        at_a, at_b = a0 + n, b0 + n
    return [span for span in spans if span[3]]


@F.arrow_udf(SPANS)
def difference_spans(sides: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """:func:`difference` of two columns of words; a NULL side has none.

    Pairs are taken one by one, so a task holds the words of one pair beside its batch.
    """
    for before, after in sides:
        columns, cuts = ([], [], [], []), [0]
        for a, b in zip(before, after, strict=True):
            for span in difference(a.as_py() or [], b.as_py() or []):
                for column, value in zip(columns, span, strict=True):
                    column.append(value)
            cuts.append(len(columns[0]))
        arrays = [pa.array(v, t) for v, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int32()), strict=True)]
        spans = pa.StructArray.from_arrays(arrays, ["kind", "before_at", "after_at", "n_words"])
        yield pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans)

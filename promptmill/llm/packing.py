"""Vector best-fit packing of token pieces into sequences."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.staging import stage

GROUP_ROWS = 8_192


@dataclass(frozen=True)
class Capacity:
    """What one sequence may hold, and what each kind of room counts for in the choice.

    The attention cost of a piece is the square of its length. The defaults for
    documents and attention can never be reached before the tokens run out.
    """

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    score: str = "norm"

    def __post_init__(self):
        if self.score not in ("norm", "dot"):
            raise ValueError("score must be 'norm' or 'dot'")
        if min(self.tokens, self.documents, self.attention) < 1:
            raise ValueError("capacities must be positive")


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece and its offset there; pieces go in by falling length.

    Of the bins in which a piece fits by every measure, it takes the one with the
    smallest weighted norm of what is then left ("norm"), or with the largest
    weighted dot product of demand and room ("dot"); else it opens a bin.
    """
    room_of = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=np.float64)
    weights = np.array(capacity.weights)
    n = len(lengths)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    room = np.empty((3, n), dtype=np.float64)
    opened = 0
    live = np.empty(n, dtype=np.int64)  # bins that can still take the smallest piece
    n_live = 0
    order = np.argsort(-lengths, kind="stable")
    least = float(lengths.min()) if n else 0.0
    for item in order.tolist():
        size = float(lengths[item])
        need = np.array([size, 1.0, size * size])
        if (need > room_of).any():
            raise ValueError("a piece is larger than a sequence")
        open_bins = live[:n_live]
        rooms = room[:, open_bins]
        left = (rooms - need[:, None]) / room_of[:, None]
        fits = (left >= 0).all(axis=0)
        if fits.any():
            if capacity.score == "norm":
                value = -(weights @ (left * left))
            else:
                value = weights @ (rooms / room_of[:, None] * (need / room_of)[:, None])
            at = int(np.argmax(np.where(fits, value, -np.inf)))
            chosen = int(open_bins[at])
        else:
            chosen, at = opened, n_live
            room[:, chosen] = room_of
            live[n_live] = chosen
            opened += 1
            n_live += 1
        bins[item] = chosen
        offsets[item] = capacity.tokens - int(room[0, chosen])
        room[:, chosen] -= need
        if room[0, chosen] < least or room[1, chosen] < 1 or room[2, chosen] < least * least:
            n_live -= 1
            live[at] = live[n_live]
    return bins, offsets


def pack_best_fit(pieces: DataFrame, capacity: Capacity = Capacity(), group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every piece; ``length`` is its number of tokens.

    Pieces are dealt at random into groups of about ``group_rows``; each group is
    packed by :func:`best_fit`, so a task holds one bounded group and the loss is
    less than one sequence a group. The deal is written out first and so stays the
    same if a task runs again. An empty table gives an empty one; equal rows are
    packed one by one. Columns named ``sequence_id`` or ``offset`` are replaced.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    dealt = stage(pieces.select(*columns, F.floor(F.rand(11) * (1 << 31)).cast("bigint").alias("_deal")), "pieces")
    groups = max(1, round(dealt.count() / group_rows))
    schema = T.StructType(
        [dealt.schema[c] for c in columns]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_deal", kind="stable")
        bins, offsets = best_fit(group["length"].to_numpy(np.int64), capacity)
        first = int(group["_group"].iloc[0]) << 32
        return group[columns].assign(sequence_id=first + bins, offset=offsets)

    return dealt.withColumn("_group", F.pmod("_deal", F.lit(groups))).groupBy("_group").applyInPandas(pack, schema)

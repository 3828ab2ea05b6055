"""SimHash fingerprints of word shingles, and exact comparison in tiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.llm.components import connected_components
from promptmill.staging import stage

SEED = 42
TILES = 32  # tiles of an even share; a tile holds at least LEAST_TILE and at most MOST_TILE
LEAST_TILE, MOST_TILE = 1_024, 1 << 18
_HASHES = 1 << 16  # shingles counted at a time


def fingerprint(text: str | None, words: int = 4) -> int:
    """Each bit is that of more than half of the XXH64 hashes of the text's word shingles.

    A-Z are lowered, words end at ASCII white space, and repeats count. Fewer
    words than ``words`` make one shingle; none gives 0.
    """
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(token) + 1 for token in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[words - 1 :] if len(tokens) >= words else ends[-1:]
    starts = starts[: len(last)]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(last), _HASHES):
        pairs = zip(starts[at : at + _HASHES].tolist(), last[at : at + _HASHES].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(last)).view(">u8")[0])


def fingerprints(
    docs: DataFrame, words: int = 4, text: str = "text", doc_id: str = "doc_id", carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, bits``: the fingerprint as a signed long, for every row, and the columns ``carry``. NULL text counts as empty."""
    kept = [T.StructField("doc_id", docs.schema[doc_id].dataType), *(docs.schema[c] for c in carry)]
    schema = T.StructType([*kept, T.StructField("bits", T.LongType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [fingerprint(x.as_py(), words) for x in batch.column("_text")]
            longs = np.array(bits, dtype=np.uint64).view(np.int64)
            same = [batch.column("_id"), *map(batch.column, carry)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(longs)], ["doc_id", *carry, "bits"])

    return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), *carry).mapInArrow(compute, schema)


def linked_stars(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all of two tiles' values within ``radius`` bits: a member and its root each.

    The values of the tile (or both tiles, one after the other) are numbered; all
    pairs are compared by exclusive-or and bit counts, a few rows at a time, and
    united, so that links no longer than the values come out, not all pairs.
    """
    other = left if right is None else right
    shift = 0 if right is None else len(left)
    root = np.arange(len(left) + (0 if right is None else len(right)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return int(x)

    rows = max(1, (1 << 18) // max(len(other), 1))
    for at in range(0, len(left), rows):
        near = np.bitwise_count(left[at : at + rows, None] ^ other[None, :]) <= radius
        if right is None:
            near[np.arange(near.shape[0]), np.arange(at, at + near.shape[0])] = False
        for row in np.flatnonzero(near.any(axis=1)).tolist():
            members = np.flatnonzero(near[row]) + shift
            heads = {find(x) for x in np.unique(root[members]).tolist()} | {find(at + row)}
            top = min(heads)
            for head in heads:
                root[head] = top
            root[members] = top
    member = np.flatnonzero(root != np.arange(len(root)))
    return member, np.array([find(x) for x in member.tolist()], dtype=np.int64)


def near_fingerprints(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Links ``a, b`` between the ``node`` numbers of distinct ``bits`` that differ in ``radius`` bits at most.

    Tiles hold values of one bit count. Two tiles meet only if their bit counts
    differ by ``radius`` at most, since otherwise no pair of theirs can be near;
    every pair that can be is compared. The links connect what is near, directly
    or over others; not each near pair has a link of its own.
    """
    spark = distinct.sparkSession
    ones = F.bit_count("bits")
    counts = {r["o"]: r["n"] for r in distinct.groupBy(ones.alias("o")).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    size = min(max(-(-total // TILES), LEAST_TILE), MOST_TILE)
    # For each bit count: how many tiles it has, and with which other bit counts of how many tiles they meet.
    tiles = {o: -(-n // size) for o, n in counts.items()}
    near = [(o, p, tiles[o], tiles[p]) for o in tiles for p in tiles if abs(o - p) <= radius]
    partners = spark.createDataFrame(near, "o int, p int, parts bigint, others bigint")

    def tile(count: str, number: Column) -> Column:
        return F.shiftleft(F.col(count).cast("bigint"), 32) + number

    named = distinct.withColumn("o", ones).join(F.broadcast(partners), "o")
    named = named.withColumn("number", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("others") - 1)))
    own, other = tile("o", F.pmod(F.xxhash64("bits"), "parts")), tile("p", F.col("number"))
    met = named.select("node", "bits", F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), (own <= other).alias("first"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        first = group["first"].to_numpy(bool)
        bits = group["bits"].to_numpy(np.int64).view(np.uint64)
        node = group["node"].to_numpy(np.int64)
        right = bits[~first] if not first.all() else None
        member, root = linked_stars(bits[first], right, radius)
        node = np.concatenate([node[first], node[~first]])
        return pd.DataFrame({"a": node[member], "b": node[root]})

    return met.groupBy("i", "j").applyInPandas(compare, "a bigint, b bigint")


def simhash_groups(
    docs: DataFrame, words: int = 4, radius: int = 4, text: str = "text", doc_id: str = "doc_id", carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, bits, component_id`` for every row: the smallest doc_id within reach. Columns ``carry`` come along.

    Rows with equal fingerprints are one class; classes within ``radius`` bits are
    linked. NULL and empty texts have fingerprint 0 and link like others. Rows of
    one doc_id are one document; rows without one link with nothing and have no
    component. No rows: no rows.
    """
    rows = stage(fingerprints(docs, words, text, doc_id, carry), "fingerprints")
    classes = stage(
        rows.filter("doc_id is not null").groupBy("bits").agg(F.min("doc_id").cast("bigint").alias("node")), "classes"
    )
    parts = connected_components(near_fingerprints(classes, radius))
    reached = classes.join(parts, "node", "left").select("bits", F.coalesce("component", "node").alias("component_id"))
    joined = rows.join(reached, "bits", "left")
    known = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return joined.select("doc_id", *carry, "bits", known.alias("component_id"))

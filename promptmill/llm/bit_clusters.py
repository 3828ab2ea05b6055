"""Centroid clustering of integer vectors by counting the bits that their bit planes share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.staging import stage

WIDTH = 64
BOUND = 1 << 26  # components at or beyond it would let a squared distance outgrow a long
LONG = (1 << 63) - 1


def pack_planes(values: np.ndarray) -> np.ndarray:
    """Rows of 64 whole numbers as bit planes: bit ``j`` of plane ``p`` is bit ``p`` of component ``j``.

    Two's complement: as many planes as the largest number takes, and one for the sign.
    """
    bits = int(np.maximum(values, ~values).max(initial=0)).bit_length() + 1
    planes = np.empty((len(values), bits), dtype=np.uint64)
    for plane in range(bits):
        ones = ((values >> plane) & 1).astype(np.uint8)
        planes[:, plane] = np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()
    return planes


def plane_weights(bits: int) -> list[int]:
    """What a bit of each plane stands for; the last plane is the sign."""
    return [1 << p for p in range(bits - 1)] + [-(1 << (bits - 1))]


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of packed rows with packed rows: weighted counts of common bits."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    for p, a in enumerate(plane_weights(left.shape[1])):
        for q, b in enumerate(plane_weights(right.shape[1])):
            out += np.bitwise_count(left[:, p, None] & right[None, :, q]).astype(np.int64) * (a * b)
    return out


def squared_lengths(planes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(planes), dtype=np.int64)
    weights = plane_weights(planes.shape[1])
    for p, a in enumerate(weights):
        for q, b in enumerate(weights):
            out += np.bitwise_count(planes[:, p] & planes[:, q]).astype(np.int64) * (a * b)
    return out


def nearest(planes: np.ndarray, lengths: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest centroid, the smaller number among equals, and the squared distance."""
    packed = pack_planes(np.array(centroids, dtype=np.int64))
    distance = lengths[:, None] - 2 * dot_products(planes, packed) + squared_lengths(packed)[None, :]
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(planes)), cluster]


def component_sums(planes: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The clusters met, their sizes, and the sums of their rows' components."""
    order = np.argsort(cluster, kind="stable")
    met, begin, sizes = np.unique(cluster[order], return_index=True, return_counts=True)
    sums = np.zeros((len(met), WIDTH), dtype=np.int64)
    for plane, weight in enumerate(plane_weights(planes.shape[1])):
        ones = np.unpackbits(planes[order, plane].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += np.add.reduceat(ones, begin, axis=0, dtype=np.int64) * weight
    return met, sizes, sums


def whole_vectors(vectors: DataFrame, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, ints`` of the vectors that take part: each component becomes floor(scale * x)."""
    doubles = F.col(embedding).cast("array<double>")
    fits = F.forall(
        doubles,
        lambda x: F.coalesce((F.floor(x * F.lit(float(scale))) < BOUND) & (F.floor(x * F.lit(float(scale))) >= -BOUND) & ~F.isnan(x), F.lit(False)),
    )
    kept = vectors.filter((F.size(doubles) == WIDTH) & fits)
    return kept.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.transform(doubles, lambda x: F.floor(x * F.lit(float(scale)))).alias("ints")
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
        planes = pack_planes(values)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(0, planes.size + 1, planes.shape[1]), pa.int32()), pa.array(planes.view(np.int64).ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), lists, pa.array(squared_lengths(planes))], ["vec_id", "planes", "length"]
        )


def _read(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, planes and squared lengths; rows packed with other rows may have more planes or fewer."""
    lists = batch.column("planes")
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    bits = np.diff(lists.offsets.to_numpy())
    begin = np.concatenate([[0], np.cumsum(bits)[:-1]])
    lengths = batch.column("length").to_numpy(zero_copy_only=False)
    for n in np.unique(bits).tolist():
        rows = np.flatnonzero(bits == n)
        yield rows, flat[begin[rows][:, None] + np.arange(n)], lengths[rows]


def cluster_sums(packed: DataFrame, centroids: list[list[int]]) -> list[tuple[int, int, list[int]]]:
    """``cluster, size, sums`` of every cluster that is not empty: at most one row per centroid."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, planes, lengths in _read(batch):
                met, sizes, sums = component_sums(planes, nearest(planes, lengths, centroids)[0])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, WIDTH), pa.int32()), pa.array(sums.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(met.astype(np.int32)), pa.array(sizes.astype(np.int64)), lists], ["cluster", "size", "sums"]
                )

    parts = packed.select("planes", "length").mapInArrow(add_up, "cluster int, size bigint, sums array<bigint>")
    totals = [F.sum(F.col("sums")[j].cast("decimal(28,0)")).alias(f"s{j}") for j in range(WIDTH)]
    rows = parts.groupBy("cluster").agg(F.sum("size").alias("size"), *totals).collect()
    return [(r["cluster"], r["size"], [int(r[f"s{j}"]) for j in range(WIDTH)]) for r in rows]


def assigned(packed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vec_id, cluster, distance``."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, planes, lengths in _read(batch):
                cluster, distance = nearest(planes, lengths, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    return packed.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint")


def _by_cluster(values: dict[int, object], kind: str) -> Column:
    """The value of the row's cluster; there are no more clusters than centroids."""
    out = F.lit(None).cast(kind)
    for cluster, value in values.items():
        out = F.when(F.col("cluster") == cluster, F.lit(value).cast(kind)).otherwise(out)
    return out


def cluster_vectors(
    vectors: DataFrame,
    centroids: int = 16,
    rounds: int = 3,
    scale: int = 64,
    seed: str = "1",
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of the vectors that take part.

    Those have 64 components, none NULL or not finite, and become whole numbers
    ``floor(scale * x)``; a vector with one at or beyond 2**26 takes no part either, since its distances
    would not fit. Centroids start as the vectors whose ``sha256(seed:vec_id)`` comes first; a row without
    vec_id can't be one of them. Rows of one vec_id are vectors of their own, and among their equal hashes the
    smaller vector comes first. Every round assigns all vectors, the smaller number winning ties, and
    moves each centroid to the floor of its vectors' exact mean; an empty one stays. With fewer vectors
    than ``centroids`` there are as many centroids as vectors; without any the result is empty.
    A sum of distances beyond a long is NULL.

    Vectors are packed once and written out. A round reads the planes and returns sizes and sums of 64 components
    for each centroid, added up in every batch before the shuffle.
    """
    whole = whole_vectors(vectors, scale, vec_id, embedding)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = whole.filter("vec_id IS NOT NULL").orderBy(digest, "ints").limit(centroids)
    middle = [row["ints"] for row in first.select(digest.alias("digest"), "ints").orderBy("digest", "ints").collect()]
    packed = stage(whole.mapInArrow(_packed, "vec_id bigint, planes array<bigint>, length bigint"), "planes")
    if not middle:
        nothing = "CAST(0 AS int) cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256"
        return packed.filter("false").selectExpr("vec_id", *nothing)
    for _ in range(rounds):
        for cluster, size, sums in cluster_sums(packed, middle):
            middle[cluster] = [total // size for total in sums]
    done = stage(assigned(packed, middle), "clusters")
    spread = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("distance"))
    inertia = {row["cluster"]: int(row["distance"]) for row in spread.collect()}
    digests = {i: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for i, c in enumerate(middle)}
    total = sum(inertia.values())
    return done.select(
        "vec_id",
        "cluster",
        "distance",
        _by_cluster({c: v if v <= LONG else None for c, v in inertia.items()}, "bigint").alias("cluster_inertia"),
        F.lit(total if total <= LONG else None).cast("bigint").alias("inertia"),
        _by_cluster(digests, "string").alias("centroid_sha256"),
    )

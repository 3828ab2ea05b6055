"""Nearest neighbours through a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.staging import stage

FIT_ROWS = 20_000  # vectors that the tree is fitted on, at most
LEAF_ROWS = 256  # rows aimed at for a leaf, as far as MAX_LEAVES allows
MAX_LEAVES = 2_048
BRANCHES = 8
PARTS = 64  # runs of leaves that are compared together
LEAST_BLOCK, MOST_BLOCK = 256, 65_536
CALIBRATION = 256  # queries whose true neighbours are found to set the number of leaf visits


def usable(vector: Column) -> Column:
    """Vectors that are not null or zero and hold only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


@dataclass
class Tree:
    """Node ``i`` has centre ``centres[i]``; ``children[i]`` is empty for a leaf, whose number is ``leaf[i]``."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.centres) - 1

    def close(self, node: int) -> None:
        self.leaf[node] = self.leaves
        self.leaves += 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down to the nearest child from the root."""
        out = np.zeros(len(vectors), dtype=np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = nearest(vectors[rows], np.stack([self.centres[c] for c in self.children[node]]))
            waiting += [(c, rows[near == i]) for i, c in enumerate(self.children[node]) if (near == i).any()]
        return out

    def best_bins(self, query: np.ndarray) -> Iterator[int]:
        """All leaves, the most promising first: a queue of branches not taken, by distance to their centres."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                below = self.children[node]
                gaps = ((np.stack([self.centres[c] for c in below]) - query) ** 2).sum(axis=1)
                best = int(gaps.argmin())
                for i, child in enumerate(below):
                    if i != best:
                        heapq.heappush(queue, (float(gaps[i]), child))
                node = below[best]
            yield self.leaf[node]


def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def fit_tree(sample: np.ndarray, leaves: int, branches: int = BRANCHES, rounds: int = 8, seed: int = 1) -> Tree:
    """K-means over and over, the largest part first, until there are ``leaves`` leaves."""
    rng, tree = np.random.default_rng(seed), Tree()
    root = tree.add(sample.mean(axis=0) if len(sample) else np.zeros(1))
    parts, open_leaves = [(-len(sample), root, np.arange(len(sample)))], 1
    closed = []
    while parts and open_leaves < leaves:
        _, node, rows = heapq.heappop(parts)
        k = min(branches, leaves - open_leaves + 1, len(np.unique(sample[rows], axis=0)) if len(rows) < 64 else branches)
        if k < 2:
            closed.append(node)
            continue
        centres = sample[rng.choice(rows, k, replace=False)]
        for _ in range(rounds):
            near = nearest(sample[rows], centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, sample[rows])
            counts = np.bincount(near, minlength=k)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        near = nearest(sample[rows], centres)
        kept = [i for i in range(k) if (near == i).any()]
        if len(kept) < 2:
            closed.append(node)
            continue
        for i in kept:
            child = tree.add(centres[i])
            tree.children[node].append(child)
            heapq.heappush(parts, (-int((near == i).sum()), child, rows[near == i]))
        open_leaves += len(kept) - 1
    for node in closed + [node for _, node, _ in parts]:
        tree.close(node)
    return tree


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 1))


def top_k(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's ``k`` nearest of the rows in its ``leaves``, itself left out; ties go to the smaller id."""
    found = []
    rows = rows.sort_values("id", kind="stable")
    base, ids, leaf = _matrix(rows["vector"]), rows["id"].to_numpy(np.int64), rows["leaf"].to_numpy(np.int64)
    for query_id, vector, leaves in queries[["query_id", "vector", "leaves"]].itertuples(index=False):
        inside = np.flatnonzero(np.isin(leaf, leaves) & (ids != query_id))
        gap = base[inside] - np.asarray(vector, dtype=np.float64)
        distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        if k < len(inside):
            near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
        else:
            near = np.arange(len(inside))
        near = near[np.argsort(distance[near], kind="stable")][:k]
        found.append(pd.DataFrame({"query_id": query_id, "id": ids[inside[near]], "score": distance[near]}))
    columns = {"query_id": "int64", "id": "int64", "score": "float64"}
    return pd.concat(found).astype(columns) if found else pd.DataFrame(columns=list(columns)).astype(columns)


_FOUND = "query_id bigint, id bigint, score double"


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query, from the best of its blocks."""
    nearest_first = F.array_sort(F.collect_list(F.struct("score", "id")))
    ranked = found.groupBy("query_id").agg(F.slice(nearest_first, 1, k).alias("r"))
    return ranked.select("query_id", F.posexplode("r").alias("pos", "r")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("r.id").alias("id"), F.col("r.score").alias("score")
    )


def _paired(rows: DataFrame, queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Compare the rows and the queries that meet in a part, block by block.

    ``blocks`` tells for each part into how many blocks its rows and its queries are cut; every
    block of rows meets every block of queries of its part, so a task holds two bounded blocks.
    """
    left = (
        rows.join(F.broadcast(blocks), "part")
        .withColumn("r", F.pmod(F.xxhash64("id"), F.col("row_blocks")))
        .withColumn("q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("query_blocks") - 1)))
        .select("part", "r", "q", "id", "vector", "leaf")
    )
    right = (
        queries.join(F.broadcast(blocks), "part")
        .withColumn("q", F.pmod(F.xxhash64("query_id"), F.col("query_blocks")))
        .withColumn("r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("row_blocks") - 1)))
        .select("part", "r", "q", "query_id", "vector", "leaves")
    )
    keys = ["part", "r", "q"]
    return (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(lambda a, b: top_k(b, a, k), _FOUND)
    )


def _blocks(spark, rows: dict[int, int], queries: dict[int, int]) -> DataFrame:
    """Blocks stay near the mean size of a part, between the bounds; no task holds a larger one."""
    most = max(LEAST_BLOCK, min(MOST_BLOCK, 2 * sum(rows.values()) // max(len(rows), 1)))
    table = [(p, -(-n // most), max(1, -(-queries.get(p, 0) // MOST_BLOCK))) for p, n in rows.items()]
    return spark.createDataFrame(table, "part bigint, row_blocks bigint, query_blocks bigint")


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    recall: float = 0.97,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id, rank, id, score, leaves``: each query's nearest rows found, by Euclidean distance.

    ``queries`` picks the rows that are queries; all usable rows but the query are
    candidates. A tree of k-means centres is fitted on ``FIT_ROWS`` rows at most
    (those with the smallest hashes); every row is then put into its leaf. The true
    neighbours of ``CALIBRATION`` queries, found against all rows in blocks, tell
    how many leaves must be visited for ``recall``; the visits are widened from one
    leaf until it is reached, and every query then visits as many, best bin first,
    and more while it has met fewer than ``k`` rows. Rows whose vector is null,
    zero or not finite take no part. No rows: no rows. Ids must be whole and unique.
    """
    spark = vectors.sparkSession
    rows = stage(
        vectors.filter(usable(F.col(embedding)) & F.col(vec_id).isNotNull()).select(
            F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).alias("vector"), queries.alias("asks")
        ),
        "vectors",
    )
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("vector").toPandas()
    tree = fit_tree(_matrix(sample["vector"]), min(max(1, n // LEAF_ROWS), MAX_LEAVES))

    per_part = -(-tree.leaves // PARTS)

    def to_leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                leaf = tree.assign(_matrix(batch["vector"]))
                yield batch.assign(leaf=leaf, part=leaf // per_part)

    places = [T.StructField("leaf", T.LongType()), T.StructField("part", T.LongType())]
    indexed = stage(rows.mapInPandas(to_leaf, T.StructType([*rows.schema, *places])), "leaves")
    filled = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    sizes: dict[int, int] = {}
    for leaf, rows_in in filled.items():
        sizes[leaf // per_part] = sizes.get(leaf // per_part, 0) + rows_in
    asking = indexed.filter("asks")
    visits = _calibrated(indexed, asking, tree, sizes, k, recall)

    routed_schema = T.StructType(
        [
            T.StructField("query_id", T.LongType()),
            rows.schema["vector"],
            T.StructField("part", T.LongType()),
            T.StructField("leaves", T.ArrayType(T.LongType())),
        ]
    )

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for query_id, vector in zip(batch["id"].tolist(), batch["vector"].tolist(), strict=True):
                bins: dict[int, list[int]] = {}
                visited, met = 0, 0
                for leaf in tree.best_bins(np.asarray(vector, dtype=np.float64)):
                    if visited >= visits and met > k:
                        break
                    visited += 1
                    met += filled.get(leaf, 0)
                    if leaf in filled:
                        bins.setdefault(leaf // per_part, []).append(leaf)
                parts = {"part": list(bins), "leaves": list(bins.values())}
                yield pd.DataFrame({"query_id": query_id, "vector": [vector] * len(bins), **parts})

    routed = stage(asking.mapInPandas(route, routed_schema), "routes")
    asked = {r["part"]: r["n"] for r in routed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    blocks = _blocks(spark, {p: n for p, n in sizes.items() if p in asked}, asked)
    found = _paired(indexed.select("id", "vector", "leaf", "part"), routed, blocks, k)
    return best_of(found, k).withColumn("leaves", F.lit(visits))


def _calibrated(
    indexed: DataFrame, asking: DataFrame, tree: Tree, sizes: dict[int, int], k: int, recall: float
) -> int:
    """The number of leaf visits with which the calibration queries meet ``recall`` of their true neighbours."""
    if not sizes:
        return 1
    trial = asking.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(CALIBRATION).select(F.col("id").alias("query_id"), "vector")
    trial = stage(trial, "calibration")
    parts = sorted(sizes)
    every = F.explode(F.array(*[F.lit(int(p)).cast("bigint") for p in parts]))
    leaves = F.sequence(F.lit(0).cast("bigint"), F.lit(tree.leaves - 1).cast("bigint"))
    blocks = _blocks(indexed.sparkSession, sizes, {p: CALIBRATION for p in parts})
    met = trial.select("*", every.alias("part")).withColumn("leaves", leaves)
    true = best_of(_paired(indexed.select("id", "vector", "leaf", "part"), met, blocks, k), k)
    where = true.join(indexed.select("id", "leaf"), "id").select("query_id", "leaf").toPandas()
    order = {
        r["query_id"]: {leaf: i for i, leaf in enumerate(tree.best_bins(np.asarray(r["vector"], dtype=np.float64)))}
        for r in trial.collect()
    }
    places = np.array([order[q][leaf] for q, leaf in zip(where["query_id"], where["leaf"], strict=True)])
    visits = 1
    while len(places) and (places < visits).mean() < recall:
        visits += 1
    return visits

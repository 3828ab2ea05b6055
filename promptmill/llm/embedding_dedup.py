"""Near-duplicate vectors through sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.llm.ann_tree import usable
from promptmill.llm.components import connected_components
from promptmill.staging import stage

WINDOW = 1_024  # rows of a block of the order; a row meets its own block, the one before and the one after
SPAN = 8  # blocks that a task compares at a time, with the one before them
BITS = 64
PASS_PAIRS = 2_500  # compared pairs that cost as much as a row in a pass, about
LEAST_BLOCK, MOST_BLOCK, BLOCKS = 256, 8_192, 16
WHOLE = 256  # a component up to this size is counted in one piece
MOST_BROADCAST = 100_000
ROUNDING = 1e-9  # products of matrices may be off by less; nearer to the threshold one sum decides


def passes_needed(rows: int, threshold: float, window: int = WINDOW, miss: float = 1e-3) -> int:
    """Passes after which a pair just at the threshold was in no window with probability ``miss``, if hashes spread evenly.

    Two vectors meet if their hashes agree in the bits that tell ``rows / window`` places apart.
    In dense regions it takes more bits; :func:`near_links` measures how many.
    """
    together = (1 - math.acos(threshold) / math.pi) ** max(math.log2(max(rows, 1) / window), 0.0)
    return 1 if together >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - together)))


def _key(matrix: np.ndarray, seed: int, number: int) -> np.ndarray:
    """Signs of random projections, one after the other, as a long that sorts like the bits."""
    planes = np.random.default_rng([seed, number, matrix.shape[1]]).standard_normal((matrix.shape[1], BITS))
    bits = np.packbits(matrix @ planes > 0, axis=1).view(">u8").ravel().astype(np.uint64)
    return (bits ^ np.uint64(1 << 63)).view(np.int64)


def _units(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _near(mine: np.ndarray, theirs: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs have the cosine. A pair gets the same answer wherever it is compared, and in either order."""
    cosines = mine @ theirs.T
    near, maybe = cosines >= threshold + ROUNDING, cosines >= threshold - ROUNDING
    if np.count_nonzero(near) != np.count_nonzero(maybe):
        rows, columns = np.nonzero(near != maybe)
        for at in range(0, len(rows), 1 << 14):
            i, j = rows[at : at + (1 << 14)], columns[at : at + (1 << 14)]
            near[i, j] = (mine[i] * theirs[j]).sum(axis=1) >= threshold
    return near


class _Sets:
    """Joins the rows that are found to be near; one link for each row that is not the first of its set."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return int(x)

    def compare(self, units: np.ndarray, mine: np.ndarray, theirs: np.ndarray, threshold: float) -> None:
        """Join the rows ``mine`` with those of ``theirs`` that have the cosine; a row is not compared with itself."""
        root = self.root
        for at in range(0, len(mine), 512):
            part = mine[at : at + 512]
            near = _near(units[part], units[theirs], threshold)
            near &= part[:, None] != theirs[None, :]
            for row in np.flatnonzero(near.any(axis=1)).tolist():
                members, head = theirs[near[row]], self.find(part[row])
                if (root[members] != head).any():
                    heads = [head, *map(self.find, np.unique(root[members]).tolist())]
                    root[heads] = min(heads)
                    root[members] = min(heads)

    def links(self, nodes: np.ndarray) -> pd.DataFrame:
        member = np.flatnonzero(self.root != np.arange(len(self.root)))
        return pd.DataFrame({"a": nodes[member], "b": nodes[[self.find(x) for x in member.tolist()]]}, dtype="int64")


def _shared(a: Column, b: Column) -> Column:
    """How many leading bits two keys have in common."""
    apart = a.bitwiseXOR(b)
    return F.when(apart == 0, F.lit(BITS)).otherwise(BITS - F.length(F.bin(apart)))


def sorted_passes(classes: DataFrame, passes: int, first: int = 0, window: int = WINDOW, seed: int = 7) -> DataFrame:
    """``number, width, node, block, bits``: where each node stands in each pass; only keys are sorted, not vectors.

    ``classes`` has ``node`` and ``vector``, all vectors different. Passes ``first`` and
    following order the vectors of one length by the concatenated bits of their own random
    hashes, and cut the order into blocks of ``window`` rows. All nodes that
    share so many leading ``bits`` with a node are in its block, the one before or the one after.
    """

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            widths = batch["vector"].map(len)
            for width in widths.unique().tolist():
                part = batch[widths == width]
                matrix, node = np.stack(part["vector"].to_numpy()).astype(np.float64), part["node"].to_numpy()
                for number in range(first, first + passes):
                    yield pd.DataFrame({"number": number, "width": width, "key": _key(matrix, seed, number), "node": node})

    order, line = ["number", "width", "key", "node"], ["number", "width"]
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = classes.select("node", "vector").mapInPandas(hashed, "number bigint, width bigint, key bigint, node bigint")
    placed = keyed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("at", F.monotonically_increasing_id()), "keys")
    # The number of the task stands in the upper bits of ``at``, the place in it in the lower ones.
    placed = placed.withColumn("task", F.shiftright("at", 33))
    begins = placed.groupBy(*line, "task").agg(F.min("at").alias("begin"), F.count("*").alias("n"))
    before = Window.partitionBy(*line).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = begins.select(*line, "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("begin")).alias("shift"))
    placed = placed.join(begins, [*line, "task"]).select(*order, F.floor((F.col("at") + F.col("shift")) / window).alias("block"))
    edges = stage(placed.groupBy(*line, "block").agg(F.min("key").alias("low"), F.max("key").alias("high")), "edges")
    known = (
        edges.select(*line, "block")
        .join(edges.select(*line, (F.col("block") + 2).alias("block"), "high"), [*line, "block"], "left")
        .join(edges.select(*line, (F.col("block") - 2).alias("block"), "low"), [*line, "block"], "left")
    )
    bits = [F.coalesce(_shared(F.col("key"), F.col(c)) + 1, F.lit(0)) for c in ("high", "low")]
    return stage(placed.join(known, [*line, "block"]).select(*line, "node", "block", F.greatest(*bits).alias("bits")), "places")


def window_links(places: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Links ``a, b`` that join the nodes of one block, or of two that follow each other, that have the cosine.

    A task has ``SPAN`` blocks and the one before, so a ninth more vectors than rows move;
    of the pairs found in it as many come out as connect them.
    """
    span = F.floor(F.col("block") / SPAN)
    spans = F.when((F.col("block") + 1) % SPAN == 0, F.array(span, span + 1)).otherwise(F.array(span))
    met = places.join(classes.select("node", "vector"), "node")
    met = met.select("number", "width", "node", "block", "vector", F.explode(spans).alias("span"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        units, block = _units(group["vector"]), group["block"].to_numpy(np.int64)
        lead = int(group["span"].iloc[0]) * SPAN - 1
        sets, rows = _Sets(len(group)), {b: np.flatnonzero(block == b) for b in np.unique(block).tolist()}
        for b, mine in rows.items():
            if b != lead:
                sets.compare(units, mine, mine, threshold)
                if b - 1 in rows:
                    sets.compare(units, mine, rows[b - 1], threshold)
        return sets.links(group["node"].to_numpy(np.int64))

    return met.groupBy("number", "width", "span").applyInPandas(compare, "a bigint, b bigint")


def all_pairs(classes: DataFrame, threshold: float, size: int) -> DataFrame:
    """Links ``a, b`` that join all nodes whose vectors have the cosine: every pair is compared, tile by tile.

    ``size`` is the number of rows; it alone sets the number of tiles, which are spread over tasks.
    """
    blocks = math.ceil(max(size, 1) / min(max(size / BLOCKS, LEAST_BLOCK), MOST_BLOCK))
    cut = classes.select("node", "vector", F.size("vector").alias("width"), F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("own"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))).select(
        "width", "node", "vector", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("first")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        first, sets = group["first"].to_numpy(bool), _Sets(len(group))
        mine, theirs = np.flatnonzero(first), np.flatnonzero(~first)
        if group["i"].iloc[0] == group["j"].iloc[0]:
            theirs = mine
        if len(mine) and len(theirs):
            sets.compare(_units(group["vector"]), mine, theirs, threshold)
        return sets.links(group["node"].to_numpy(np.int64))

    return met.groupBy("width", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def near_links(classes: DataFrame, threshold: float, window: int = WINDOW, miss: float = 1e-3) -> DataFrame:
    """Links ``a, b`` that join the nodes whose vectors have the cosine.

    Tables of any size go through passes, until they are known to do. In a pass, the bits that
    a node's neighbours share with it give the probability that a vector just at
    the threshold was not compared with it; the product over the passes is its doubt. Nodes for
    which it is over ``miss`` go through more passes among themselves (a pair is settled
    if one of its nodes is), or, where comparing all pairs of what is left costs less, as
    it does for few nodes and in dense regions, are compared with each other exactly.
    """
    same, goal = 1 - math.acos(threshold) / math.pi, math.log(miss)
    missed = F.log1p(-F.least(F.pow(F.lit(same), F.col("bits")), F.lit(1 - 1e-9)))
    left = classes.select("node", "vector", F.lit(0.0).alias("doubt"))
    found, first = [], 0
    passes = passes_needed(classes.count(), threshold, window, miss)
    while True:
        places = sorted_passes(left, passes, first, window)
        found.append(stage(window_links(places, left, threshold), "passes"))
        gained = places.groupBy("node").agg(F.sum(missed).alias("gain"))
        need = F.ceil((F.lit(goal) - F.col("doubt")) / (F.col("gain") / passes))
        left = left.join(gained, "node").withColumn("doubt", F.col("doubt") + F.col("gain")).filter(F.col("doubt") > goal)
        left = stage(left.select("node", "vector", "doubt", need.alias("need")), "unsettled")
        first += passes
        size, passes = left.agg(F.count("*"), F.percentile_approx("need", 0.75)).first()
        if not size:
            return reduce(DataFrame.union, found)
        if passes * PASS_PAIRS >= size / 2:
            return reduce(DataFrame.union, [*found, all_pairs(left, threshold, size)])


def _counted(members: DataFrame, threshold: float) -> DataFrame:
    """``node, links``: how many vectors, copies included, each class is linked with in its component.

    Two linked vectors always lie in one component, so comparing a component with itself
    counts all links without writing a pair out. Components over ``WHOLE`` classes go tile by tile;
    there is one such for every ``WHOLE`` classes at most.
    """
    large = stage(members.groupBy("component").agg(F.count("*").alias("size")).filter(F.col("size") > WHOLE), "large-components")
    block = F.least(F.greatest(F.col("size") / BLOCKS, F.lit(LEAST_BLOCK)), F.lit(MOST_BLOCK))
    large = large.select("component", F.ceil(F.col("size") / block).alias("blocks"))
    if large.count() <= MOST_BROADCAST:
        large = F.broadcast(large)
    cut = members.join(large, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("bigint")))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    i, j = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    met = cut.select("component", "node", "vector", "copies", i, j, (F.col("own") <= F.col("other")).alias("first"))
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        units, copies = _units(group["vector"]), group["copies"].to_numpy(np.int64)
        first, links = group["first"].to_numpy(bool), np.zeros(len(group), dtype=np.int64)
        mine, theirs = np.flatnonzero(first), np.flatnonzero(~first)
        alone = group["i"].iloc[0] == group["j"].iloc[0]
        theirs = mine if alone else theirs
        for at in range(0, len(mine) if len(theirs) else 0, 512):
            part = mine[at : at + 512]
            near = _near(units[part], units[theirs], threshold)
            near &= part[:, None] != theirs[None, :]
            links[part] += near @ copies[theirs]
            if not alone:
                links[theirs] += copies[part] @ near
        return pd.DataFrame({"node": group["node"].to_numpy(np.int64), "links": links})

    spread = met.repartition(tasks, "component", "i", "j")
    met = spread.groupBy("component", "i", "j").applyInPandas(compare, "node bigint, links bigint")
    return met.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    window: int = WINDOW,
    miss: float = 1e-3,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Equal vectors form a class; classes go through :func:`near_links`. A pair just at
    the threshold is missed with probability ``miss`` at most, nearer ones more rarely,
    and none where all pairs are compared. Links are then counted exactly within each
    component. Vectors of different length, and those that are null, zero or not
    finite, link with nothing. The smallest ``vec_id`` of a component is kept.
    Ids must be whole numbers; rows of one id count as one more copy each.
    """
    rows = stage(
        vectors.select(
            F.col(vec_id).cast("bigint").alias("vec_id"),
            F.when(usable(F.col(embedding)), F.col(embedding)).alias("vector"),
        ),
        "vectors",
    )
    good = rows.filter("vector IS NOT NULL AND vec_id IS NOT NULL")
    classes = stage(good.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "classes")
    parts = stage(connected_components(near_links(classes, threshold, window, miss)), "components")
    links = _counted(classes.join(parts, "node").select("component", "node", "vector", "copies"), threshold)
    known = (
        classes.join(parts, "node", "left")
        .join(links, "node", "left")
        .select(
            "vector",
            F.coalesce("component", "node").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    joined = rows.join(known, "vector", "left")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )

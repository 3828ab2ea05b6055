"""A weighted subset of exact size: categories get whole shares, records are drawn by weight without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.operators.order import record_digest
from promptmill.staging import stage

BUCKETS = 4_096
MOST_AT_EDGE = 100_000
STEPS = 4  # cuts into 4,096, all at multiples of a power of two, so that no key is rounded to the other side of one


def apportioned(sizes: DataFrame, size: int) -> DataFrame:
    """``sizes`` (``category, available, share``) with ``quota``: whole numbers that sum to ``size``, if so many are there.

    Shares are weights, taken relative to their sum. Every category gets the whole part
    of its part and the largest remainders get one more, ties by name. A category can't get more than
    is available: what is over goes to the others by the same rule, until all is given.
    """
    given = sizes.withColumn("quota", F.lit(0).cast("bigint"))
    while True:
        given = stage(given, "quotas")
        free = (F.col("quota") < F.col("available")) & (F.col("share") > 0)
        left = size - (given.agg(F.sum("quota")).first()[0] or 0)
        shares = given.filter(free).agg(F.sum("share")).first()[0]
        if left <= 0 or not shares:
            return given
        part = F.when(free, F.lit(float(left)) * F.col("share") / F.lit(float(shares))).otherwise(0.0)
        whole = given.withColumns({"_part": F.floor(part), "_rest": F.when(free, part - F.floor(part))})
        missing = left - (whole.agg(F.sum("_part")).first()[0] or 0)
        # The largest remainders are found by a top-k, so no task holds all categories.
        lucky = whole.filter(free & (F.col("_rest") > 0)).orderBy(F.desc("_rest"), F.col("category").asc_nulls_first()).limit(max(int(missing), 0))
        lucky = lucky.select(F.col("category").alias("_named"), F.lit(1).alias("_more"))
        joined = whole.join(lucky, F.col("category").eqNullSafe(F.col("_named")), "left")
        quota = F.least(F.col("quota") + F.col("_part") + F.coalesce("_more", F.lit(0)), F.col("available"))
        given = joined.select(*sizes.columns, quota.cast("bigint").alias("quota"))


def draw_key(name: Column, weight: Column, seed: int) -> Column:
    """An exponential variable with rate ``weight``, from the hash of the name: small keys are drawn first.

    The first 13 hex digits of ``md5(seed:name)`` make a number strictly between 0 and 1.
    """
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13), 16, 10).cast("double")
    return -F.ln((digits + 0.5) / float(1 << 52)) / weight.cast("double")


def _edges(keyed: DataFrame, quotas: DataFrame, most: int) -> DataFrame:
    """``category, low, high, left`` for each category: keys under ``low`` are all drawn, and ``left`` of those under ``high``.

    Histograms of 4,096 cells, made before the shuffle, narrow down where the
    last drawn key lies, until only ``most`` keys of each category lie there or a cell is 2**-48 wide.
    """
    zero = F.lit(0.0)
    edges = quotas.filter("quota > 0").select("category", zero.alias("low"), F.lit(1.0).alias("high"), F.col("quota").alias("left"))
    edges = stage(edges, "edges")
    for _ in range(STEPS):
        inside = keyed.join(edges.withColumnRenamed("category", "_c"), F.col("category").eqNullSafe(F.col("_c")))
        inside = inside.filter((F.col("key") >= F.col("low")) & (F.col("key") < F.col("high")))
        width = (F.col("high") - F.col("low")) / BUCKETS
        cell = F.least(F.floor((F.col("key") - F.col("low")) / width), F.lit(BUCKETS - 1)).alias("cell")
        counts = inside.groupBy("category", "low", "high", "left", cell).agg(F.count("*").alias("n"))
        upto = Window.partitionBy("category").orderBy("cell")
        counts = counts.withColumn("before", F.sum("n").over(upto) - F.col("n"))
        last = counts.filter((F.col("before") < F.col("left")) & (F.col("before") + F.col("n") >= F.col("left")))
        low = F.col("low") + F.col("cell") * width
        narrowed = last.select("category", low.alias("low"), (low + width).alias("high"), (F.col("left") - F.col("before")).alias("left"), "n")
        narrowed = stage(narrowed, "edges")
        if not narrowed.filter(F.col("n") > most).limit(1).count():
            return narrowed.select("category", "low", "high", "left")
        edges = narrowed.select("category", "low", "high", "left")
    return edges


def weighted_subset(
    df: DataFrame,
    size: int,
    weight: Column | float = 1.0,
    category: str = "category",
    share: Column | None = None,
    seed: int = 42,
    id_col: str = "id",
    most_at_edge: int = MOST_AT_EDGE,
) -> DataFrame:
    """``size`` records of ``df``, without replacement; fewer only if fewer have a positive weight.

    Every category (NULL is one) gets a whole share of ``size`` by largest remainders: in
    proportion to ``share``, an expression over the category's ``category, available`` (its
    records of positive weight), which by default is ``available``. Inside a category records are drawn one after the other, each in
    proportion to its ``weight`` among those that are left. That is the order of exponential
    keys, made from ``md5(seed:id)``, or from the digest of the record where it has no id; equal keys go
    by that digest. A record with NULL, no, or an infinite weight is never drawn. Records are not merged: equal ones may all be drawn.

    A category of any size is cut by histograms of its keys, and only the keys around the cut are ranked.
    """
    if size < 0:
        raise ValueError("size must not be negative")
    weight = weight if isinstance(weight, Column) else F.lit(float(weight))
    digest = F.md5(record_digest(df))
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), digest)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    good = F.coalesce((weight > 0) & (weight.cast("double") < float("inf")), F.lit(False))
    drawn = df.select(
        row.alias("row"), F.col(f"`{category}`").cast("string").alias("category"), draw_key(name, weight, seed).alias("raw"), digest.alias("digest"), good.alias("good")
    )
    # Keys are squeezed into [0, 1) without changing their order.
    keyed = drawn.filter("good").withColumn("key", F.least(F.col("raw") / (F.col("raw") + 1), F.lit(1 - 2.0**-53)))
    keyed = stage(keyed.select("row", "category", "key", "raw", "digest"), "keys")
    sizes = keyed.groupBy("category").agg(F.count("*").alias("available"))
    part = F.col("available").cast("double") if share is None else share.cast("double")
    quotas = stage(apportioned(sizes.withColumn("share", part), size), "apportioned")
    edges = _edges(keyed.select("category", "key"), quotas, most_at_edge)
    near = keyed.join(edges.withColumnRenamed("category", "_c"), F.col("category").eqNullSafe(F.col("_c"))).drop("_c")
    sure = near.filter(F.col("key") < F.col("low")).select("row")
    order = Window.partitionBy("category").orderBy("raw", "digest")
    rest = near.filter((F.col("key") >= F.col("low")) & (F.col("key") < F.col("high")))
    rest = rest.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= F.col("left")).select("row")
    return sure.union(rest).select("row.*")

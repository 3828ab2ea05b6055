"""Seeded order, cap, train/validation split and sharding."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from promptmill.staging import stage

PREFIX = 4  # hex digits of the hash that name a bucket: 65,536 buckets at most
ROWS_PER_TASK = 500_000
BYTES_PER_TASK = 256 << 20
HOT_ROWS = 1_000_000
SALTS = 1_024  # parts that rows with one digest are dealt into, where an id is on very many rows


@dataclass(frozen=True)
class Ordered:
    """Records with their position, and how many there are in all."""

    df: DataFrame
    n: int


def seeded_order(df: DataFrame, seed: int = 42, **options) -> DataFrame:
    """Add ``pos``: the 0-based place of each record in the order given by ``seed``.

    See :func:`order_records` for the options.
    """
    return order_records(df, seed, **options).df


def order_records(
    df: DataFrame,
    seed: int = 42,
    id_col: str = "id",
    digest: Column | None = None,
    limit: int | None = None,
    sums: dict[str, str] | None = None,
    size: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    bytes_per_task: int = BYTES_PER_TASK,
    hot_rows: int = HOT_ROWS,
) -> Ordered:
    """Rank all records by ``md5(seed:id)``, then by a seeded digest of the whole record.

    A record without id goes by its digest in place of the id, so the seed moves
    every record. The order depends on the content alone, not on partitioning;
    only records with one digest may trade places. One narrow pass
    counts the records per hash prefix; those counts (65,536 at most) give each
    bucket its first position and its task, so the records are shuffled once,
    into tasks of about ``rows_per_task`` records, ascending in ``pos``, or of
    about ``bytes_per_task`` if ``size`` names a column with the bytes of a record.
    With ``limit`` only the buckets that hold the first ``limit`` positions are
    shuffled, and only those positions returned. ``sums`` maps new columns to
    whole-number columns: each gets the total over all records placed before.

    Buckets over ``hot_rows`` (one id on very many records) take another way,
    see :func:`_hot_positions`.
    """
    digest = record_digest(df) if digest is None else digest
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col), digest)))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), digest))
    bucket = F.conv(F.substring(key, 1, PREFIX), 16, 10).cast("int")

    sums = sums or {}
    totals = {f"_sum_{name}": c for name, c in sums.items()} | ({"size": size} if size else {})
    grouped = df.groupBy(bucket.alias("b")).agg(
        F.count("*").alias("n"),
        *[F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0)).alias(name) for name, c in totals.items()],
    )
    counts = grouped.toArrow().to_pandas().sort_values("b")
    before = counts["n"].cumsum() - counts["n"]
    n = int(counts["n"].sum())
    kept = n if limit is None else min(n, limit)
    counts, before = counts[before < kept], before[before < kept]
    if counts.empty:
        zeros = {name: F.lit(0).cast("bigint") for name in ("pos", *sums)}
        return Ordered(df.filter(F.lit(False)).withColumns(zeros), n)

    hot = counts["n"] > max(hot_rows, 4 * n >> (4 * PREFIX))
    weight, per_task = (counts["size"], bytes_per_task) if size else (counts["n"], rows_per_task)
    cold_tasks = _task_count(df, int(counts["n"][~hot].sum()), int(weight[~hot].sum()) / per_task)
    filled = weight.where(~hot, 0).cumsum() / max(int(weight[~hot].sum()), 1)
    task = (filled.shift(fill_value=0) * cold_tasks).astype("int64").clip(upper=cold_tasks - 1)
    places = pd.DataFrame({"_bucket": counts["b"], "_task": task, "_first": before})
    for name in sums:
        places[f"_sum_{name}"] = counts[f"_sum_{name}"].cumsum() - counts[f"_sum_{name}"]

    keyed = df.withColumns({"_key": key, "_bucket": bucket, "_digest": digest})
    positions = []
    if (~hot).any():
        positions.append(_cold_positions(df, _placed(keyed, places[~hot]), cold_tasks, sums))
    if hot.any():
        positions.append(_hot_positions(df, _placed(keyed, places[hot]), sums))
    out = positions[0] if len(positions) == 1 else positions[0].unionByName(positions[1])
    return Ordered(out if limit is None else out.filter(F.col("pos") < limit), n)


def record_digest(df: DataFrame) -> Column:
    """Digest of a whole record; binary and time columns count to the last bit."""
    exact = {"binary": F.hex, "timestamp": lambda c: c.cast("string"), "timestamp_ntz": lambda c: c.cast("string")}
    columns = [exact.get(kind, lambda c: c)(F.col(f"`{name}`")).alias(name) for name, kind in df.dtypes]
    return F.md5(F.to_json(F.struct(*columns)))


def _task_count(df: DataFrame, rows: int, loads: float) -> int:
    """One task per load, at most one per possible bucket; small inputs do not get one per core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(min(math.ceil(loads), 16**PREFIX), min(cores, -(-rows // 5_000)), 1)


def _placed(keyed: DataFrame, places: pd.DataFrame) -> DataFrame:
    """Keep the records of the given buckets. The table has 65,536 rows at most."""
    kinds = {"_bucket": pa.int32(), "_task": pa.int32()}
    schema = pa.schema([(c, kinds.get(c, pa.int64())) for c in places.columns])
    table = keyed.sparkSession.createDataFrame(pa.Table.from_pandas(places, schema, preserve_index=False))
    return keyed.join(F.broadcast(table), "_bucket")


def _before(window: WindowSpec, value: Column) -> Column:
    """Sum over the rows of the window before this one."""
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _cold_positions(df: DataFrame, rows: DataFrame, tasks: int, sums: dict[str, str]) -> DataFrame:
    """Rank inside each bucket; ``_task`` rises with the bucket, so tasks are in ``pos`` order."""
    inside = Window.partitionBy("_task", "_bucket").orderBy("_key", "_digest")
    return rows.repartitionById(tasks, F.col("_task")).select(
        *df.columns,
        (F.col("_first") + F.row_number().over(inside) - 1).alias("pos"),
        *[
            (F.col(f"_sum_{name}") + _before(inside, F.col(c).cast("bigint"))).alias(name)
            for name, c in sums.items()
        ],
    )


def _hot_positions(df: DataFrame, rows: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Positions for buckets where one id stands on very many records.

    The rows are written out once, dealt at random into parts of their digest, so
    that a second look sees the same parts. Counts per digest and part are made
    before the shuffle; they give every part its first position, cut by digest
    prefix so that no task ranks all digests of an id. No row is merged with another.
    """
    # What each row adds to the position and to each sum.
    steps = {"_first": F.lit(1).cast("bigint")}
    steps |= {f"_sum_{name}": F.coalesce(F.col(f"`{c}`").cast("bigint"), F.lit(0)) for name, c in sums.items()}
    dealt = rows.withColumns(
        {
            "_salt": F.floor(F.rand(SALTS) * SALTS).cast("int"),
            "_row": F.monotonically_increasing_id(),
            **{f"_own{c}": step for c, step in steps.items()},
        }
    )
    dealt = stage(dealt, "hot-rows")
    same = ["_bucket", "_key", "_digest"]
    part = [*same, "_salt"]

    counted = dealt.groupBy(*part, *steps).agg(*[F.sum(f"_own{c}").alias(f"_all{c}") for c in steps])
    salts = Window.partitionBy(*same).orderBy("_salt")
    counted = counted.withColumns({f"_salted{c}": _before(salts, F.col(f"_all{c}")) for c in steps})
    counted = stage(counted.withColumn("_cut", F.substring("_digest", 1, PREFIX)), "hot-counts")
    cut = ["_bucket", "_key", "_cut"]
    sizes = counted.groupBy(*cut).agg(*[F.sum(f"_all{c}").alias(f"_all{c}") for c in steps])
    cuts = Window.partitionBy("_bucket").orderBy("_key", "_cut")
    carry = sizes.select(*cut, *[_before(cuts, F.col(f"_all{c}")).alias(f"_prior{c}") for c in steps])
    digests = counted.groupBy(*cut, "_digest").agg(*[F.sum(f"_all{c}").alias(f"_all{c}") for c in steps])
    within = Window.partitionBy(*cut).orderBy("_digest")
    starts = digests.select(*cut, "_digest", *[_before(within, F.col(f"_all{c}")).alias(f"_inner{c}") for c in steps])
    places = counted.join(starts.join(carry, cut), [*cut, "_digest"]).select(
        *part, *[(F.col(c) + F.col(f"_prior{c}") + F.col(f"_inner{c}") + F.col(f"_salted{c}")).alias(f"_from{c}") for c in steps]
    )
    inside = Window.partitionBy(*part).orderBy("_row")
    names = {"_first": "pos", **{f"_sum_{name}": name for name in sums}}
    return dealt.join(places, part).select(
        *df.columns,
        *[(F.col(f"_from{c}") + _before(inside, F.col(f"_own{c}"))).alias(names[c]) for c in steps],
    )


def check_cap(max_examples: int | None) -> int | None:
    """None and 0 mean no cap; a negative cap is an error."""
    if max_examples is not None and max_examples < 0:
        raise ValueError("max_examples must not be negative")
    return max_examples or None


def cap_examples(df: DataFrame, max_examples: int | None, seed: int = 42, **options) -> DataFrame:
    """The first ``max_examples`` records of the seeded order, with their ``pos``."""
    return seeded_order(df, seed, limit=check_cap(max_examples), **options)


def validation_size(n: int, val_split: float) -> int:
    """At least one validation record; the fraction is cut to a whole number."""
    if not 0 <= val_split <= 1:
        raise ValueError("val_split must lie in [0, 1]")
    return max(1, int(n * val_split))


def split_column(n_val: int, pos: str = "pos") -> Column:
    return F.when(F.col(pos) < n_val, F.lit("val")).otherwise(F.lit("train"))


def split_train_val(
    df: DataFrame,
    val_split: float = 0.02,
    seed: int = 42,
    max_examples: int | None = None,
    **options,
) -> DataFrame:
    """Order, cap, and put the head into ``val`` and the rest into ``train``."""
    cap = check_cap(max_examples)
    ordered = order_records(df, seed, limit=cap, **options)
    n = ordered.n if cap is None else min(cap, ordered.n)
    return ordered.df.withColumn("split", split_column(validation_size(n, val_split)))


def assign_shards(df: DataFrame, world_size: int) -> DataFrame:
    """Deal the ordered records round-robin to ``world_size`` workers."""
    if world_size < 1:
        raise ValueError("world_size must be positive")
    return df.withColumn("rank", F.pmod(F.col("pos"), F.lit(world_size)).cast("int"))

import hashlib
import random
from datetime import datetime
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from promptmill.operators import order
from promptmill.operators.order import (
    assign_shards,
    cap_examples,
    order_records,
    seeded_order,
    split_train_val,
    validation_size,
)
from tests.test_plans import plan


def h(seed, id_):
    return hashlib.md5(f"{seed}:{id_ or ''}".encode()).hexdigest()


def ids(spark, n):
    return spark.range(n).select(F.concat(F.lit("r"), "id").alias("id"))


def placed(df):
    return {r.id: r.pos for r in df.collect()}


def test_order_is_the_hash_order_for_any_partitioning(spark):
    want = {x: i for i, x in enumerate(sorted((f"r{i}" for i in range(3000)), key=lambda x: h(42, x)))}
    assert placed(seeded_order(ids(spark, 3000))) == want
    assert placed(seeded_order(ids(spark, 3000).repartition(13), rows_per_task=50)) == want
    assert placed(seeded_order(ids(spark, 3000).coalesce(1))) == want
    assert placed(seeded_order(ids(spark, 3000), seed=1)) != want


def test_tasks_ascend_in_position(spark):
    df = seeded_order(ids(spark, 3000), rows_per_task=100)
    bounds = (
        df.groupBy(F.spark_partition_id().alias("p")).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    ).orderBy("p").collect()
    assert len(bounds) > 20
    assert all(a.hi < b.lo for a, b in zip(bounds, bounds[1:]))


def test_tasks_are_even_in_bytes(spark):
    df = ids(spark, 4000).withColumn("n_bytes", F.when(F.col("id") < "r2", 900).otherwise(100))
    want = placed(seeded_order(df.select("id")))
    got = seeded_order(df, size="n_bytes", bytes_per_task=50_000)
    assert placed(got) == want
    loads = got.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("n_bytes").alias("s")).collect()
    assert len(loads) > 20 and max(r.s for r in loads) < 60_000


def skewed(n, rng):
    """A third of the rows share one id; many of those are full copies; some ids are missing."""
    rows = []
    for i in range(n):
        k = rng.random()
        if k < 0.2:
            rows.append(("hot", "same"))
        elif k < 0.35:
            rows.append(("hot", f"text {rng.randrange(40)}"))
        elif k < 0.45:
            rows.append((None, f"text {i}"))
        else:
            rows.append((f"r{rng.randrange(n)}", f"text {rng.randrange(3)}"))
    return rows


@pytest.mark.parametrize("hot_rows", [10, 200, 10**6])
@pytest.mark.parametrize("salts", [1, 64])
def test_hot_ids_and_copies(spark, monkeypatch, hot_rows, salts):
    monkeypatch.setattr(order, "SALTS", salts)
    rows = skewed(2000, random.Random(3))
    df = spark.createDataFrame(rows, "id string, text string").withColumn("v", F.length("text"))
    digest = F.md5(F.concat_ws("|", F.coalesce("id", F.lit("-")), "text"))
    placed = seeded_order(
        df, 42, digest=digest, sums={"before": "v"}, hot_rows=hot_rows, rows_per_task=300
    ).orderBy("pos").collect()
    got = [(r.pos, r.id, r.text) for r in placed]

    def key(r):
        digest = hashlib.md5(f"{'-' if r[0] is None else r[0]}|{r[1]}".encode()).hexdigest()
        return h(42, digest if r[0] is None else r[0]), h(42, digest)

    want = [(i, *r) for i, r in enumerate(sorted(rows, key=key))]
    assert got == want
    assert [r.before for r in placed] == list(accumulate((r.v for r in placed[:-1]), initial=0))


def test_default_digest_makes_a_total_order(spark):
    rows = skewed(500, random.Random(5))
    df = spark.createDataFrame(rows, "id string, text string")
    a = sorted((r.pos, r.id or "", r.text) for r in seeded_order(df).collect())
    b = sorted((r.pos, r.id or "", r.text) for r in seeded_order(df.repartition(9), hot_rows=20).collect())
    assert a == b
    assert [x[0] for x in a] == list(range(500))


def test_seed_moves_records_without_id(spark):
    rows = [(None, f"text {i}") for i in range(200)] + [("same", f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "id string, text string")
    orders = [[r.text for r in seeded_order(df, seed).orderBy("pos").collect() if r.id is None] for seed in (1, 2)]
    same = [[r.text for r in seeded_order(df, seed).orderBy("pos").collect() if r.id] for seed in (1, 2)]
    assert orders[0] != orders[1] and sorted(orders[0]) == sorted(orders[1])
    assert same[0] != same[1] and sorted(same[0]) == sorted(same[1])


def test_records_without_id_are_not_hot(spark):
    df = spark.range(3000).selectExpr("CAST(NULL AS string) AS id", "id AS v")
    text = plan(seeded_order(df, hot_rows=500))
    assert text.count("Exchange") - text.count("BroadcastExchange") == 1 and "SortMergeJoin" not in text


def test_hot_rows_keep_their_own_values(spark):
    """Values that look alike as JSON stay apart, and a digest of some columns merges nothing."""
    rows = [("x", datetime(2024, 1, 1, 0, 0, 0, i % 5), bytes([255 - i % 3]), i) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, t timestamp, b binary, v long")
    cold = seeded_order(df).collect()
    assert [r.v for r in sorted(seeded_order(df, hot_rows=1).collect(), key=lambda r: r.pos)] == [r.v for r in sorted(cold, key=lambda r: r.pos)]
    for options in ({}, {"digest": F.md5("id")}):
        hot = seeded_order(df, hot_rows=1, **options).collect()
        assert sorted((r.t, bytes(r.b), r.v) for r in hot) == sorted((r.t, bytes(r.b), r.v) for r in cold)
        assert sorted(r.pos for r in hot) == list(range(60))


def test_limit_moves_only_the_head(spark):
    full = placed(seeded_order(ids(spark, 2000)))
    part = order_records(ids(spark, 2000), limit=100)
    assert part.n == 2000
    assert placed(part.df) == {k: v for k, v in full.items() if v < 100}
    assert placed(order_records(ids(spark, 20), limit=100).df).keys() == placed(ids(spark, 20).withColumn("pos", F.lit(0))).keys()


def test_cap(spark):
    assert cap_examples(ids(spark, 50), None).count() == 50
    assert cap_examples(ids(spark, 50), 0).count() == 50
    assert cap_examples(ids(spark, 50), 7).count() == 7
    with pytest.raises(ValueError):
        cap_examples(ids(spark, 50), -1)


@pytest.mark.parametrize(
    "n, fraction, size", [(0, 0.02, 1), (1, 0.02, 1), (49, 0.02, 1), (50, 0.02, 1), (75, 0.02, 1), (100, 0.02, 2), (100, 0.29, 28), (10, 0, 1)]
)
def test_validation_size(n, fraction, size):
    assert validation_size(n, fraction) == size


def test_validation_fraction_is_checked():
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            validation_size(10, bad)


@pytest.mark.parametrize("n, cap, val", [(0, None, 0), (1, None, 1), (100, None, 2), (300, 100, 2)])
def test_split(spark, n, cap, val):
    rows = split_train_val(ids(spark, n), max_examples=cap).collect()
    assert len(rows) == min(n, cap or n)
    assert sum(r.split == "val" for r in rows) == val
    assert all((r.pos < val) == (r.split == "val") for r in rows)


def test_shards(spark):
    rows = assign_shards(seeded_order(ids(spark, 103)), 4).groupBy("rank").count().collect()
    assert sorted(r["count"] for r in rows) == [25, 26, 26, 26]

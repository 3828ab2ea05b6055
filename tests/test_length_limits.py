"""What a limit costs, against adding up every example."""

from math import ceil

import pytest
from pyspark.sql import functions as F

from promptmill.operators import profile


def by_hand(lengths, step, batch, epochs):
    n, total, last = len(lengths), sum(lengths), max(lengths, default=0)
    for limit in range(step, last + step, step) if last else ():
        kept = sum(min(x, limit) for x in lengths)
        cut = sum(x > limit for x in lengths)
        blocks = ceil(total / limit)
        yield (limit, n, cut, cut / n, kept, total - kept, n * limit - kept, ceil(epochs * n / batch), blocks, ceil(epochs * blocks / batch))


@pytest.mark.parametrize("step", [1, 4])
def test_length_limits(spark, step, monkeypatch):
    monkeypatch.setattr(profile, "CHUNK", 4)  # several chunks of limits
    lengths = {"a": [0, 1, 5, 5, 23], None: [7], "b": [0, 0], "c": [2] * 50 + [None]}
    rows = [(k, n, 1) for k, ns in lengths.items() for n in ns]
    df = spark.createDataFrame(rows, "lang string, n_tokens bigint, n int")
    got = profile.length_limits(df, ["lang"], step=step, per_device=2, accumulation=3, epochs=1.5).collect()
    want = {(k, *row) for k, ns in lengths.items() for row in by_hand([x or 0 for x in ns], step, 6, 1.5)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    got = profile.length_limits(df, [], step=step, per_device=2, accumulation=3, epochs=1.5).collect()
    assert {tuple(r) for r in got} == set(by_hand([x or 0 for _, x, _ in rows], step, 6, 1.5))


def test_empty_and_wrong(spark):
    df = spark.range(3).select(F.lit("a").alias("lang"), F.col("id").alias("n_tokens"))
    assert profile.length_limits(df.limit(0), ["lang"]).collect() == []
    with pytest.raises(ValueError):
        profile.length_limits(df, ["lang"], step=0)

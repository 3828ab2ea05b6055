from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from promptmill.staging import scratch_dir, stage


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_folder_is_taken_from_the_session():
    one, two = (scratch_dir(session("yarn", spark_checkpoint_dir="hdfs://x/y/"), "a") for _ in range(2))
    assert one.startswith("hdfs://x/y/promptmill-a-") and one != two


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session("spark://host:7077"), "a")


def test_local_sessions_may_use_a_local_folder():
    assert "promptmill-a-" in scratch_dir(session("local[2]"), "a")


def test_stage_keeps_variant_and_partitions(spark):
    df = spark.range(4).select(
        "id", F.expr("""parse_json('{"a": [1, null]}')""").alias("v"), (F.col("id") % 2).cast("string").alias("split")
    )
    back = stage(df, "t", ["split"])
    assert sorted(back.columns) == ["id", "split", "v"]
    rows = back.select("id", "split", F.to_json("v").alias("v")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(i, str(i % 2), '{"a":[1,null]}') for i in range(4)]

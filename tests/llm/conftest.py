import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Columns whose names operators use inside.
        *[T.StructField(c, T.StringType()) for c in ("shard", "k", "sampled", "spans")],
    ]
)


def words(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeioulnrst") for _ in range(draw.randint(2, 7))) for _ in range(count))


def tricky_rows():
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows, shared passages."""
    passage = words(99, 60)
    texts = {
        0: words(0, 80),
        1: words(0, 80),
        2: words(0, 79) + " other",
        3: "",
        4: None,
        5: words(5, 10) + " " + passage + " " + words(6, 10),
        6: words(7, 4) + " " + passage,
        7: words(8, 3000),
        8: "=" * 700,
        9: "ab " * 200,
        10: "ñandú größer 日本語 русский text",
        11: "12345 !!",
        12: words(12, 3),
        13: passage,
    }
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t or ""), "x", "y", None, "z") for i, t in texts.items()]
    rows.append(rows[12])
    rows.append((None, words(20, 30), None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def tricky(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tricky") / "documents")
    spark.createDataFrame(tricky_rows(), DOCUMENTS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)

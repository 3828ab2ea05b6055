"""Recall of the vector operators against brute force, on tables that need many leaves and passes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptmill.llm.ann_tree import nearest_neighbours
from promptmill.llm.embedding_dedup import near_vectors

ROWS, WIDTH = 10_000, 64


def table(spark, values):
    rows = [(i, v) for i, v in enumerate(values.astype(np.float32).tolist())]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(8)


@pytest.fixture(scope="module")
def values():
    """A third of the rows in one dense region, the others around 200 centres; every 20th has a near copy after it."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(201, WIDTH))
    at = np.where(np.arange(ROWS) % 3 == 0, 200, rng.integers(0, 200, ROWS))
    rows = centres[at] + rng.normal(size=(ROWS, WIDTH)) * 0.45
    copies = np.arange(0, ROWS - 1, 20)
    noise = rng.normal(size=(len(copies), WIDTH)) * rng.uniform(0.05, 0.4, (len(copies), 1))
    rows[copies + 1] = rows[copies] + noise
    return rows.astype(np.float32)


def test_neighbours_over_many_leaves(spark, values):
    exact = values.astype(np.float64)
    found = {}
    for r in nearest_neighbours(table(spark, values), F.col("vec_id") % 100 == 0, k=10).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"], r["leaves"]))
    met = 0
    for q in range(0, ROWS, 100):
        away = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        away[q] = np.inf
        true = set(np.lexsort((np.arange(ROWS), away))[:10].tolist())
        rows = sorted(found[q])
        assert [r[0] for r in rows] == list(range(1, 11))
        assert all(score == pytest.approx(away[v], rel=1e-9) for _, v, score, _ in rows)
        assert [(score, v) for _, v, score, _ in rows] == sorted((score, v) for _, v, score, _ in rows)
        met += len(true & {r[1] for r in rows})
    visits = next(iter(found.values()))[0][3]
    assert ROWS // 256 >= 20 and visits < ROWS // 256
    print(f"recall {met / ROWS * 10:.4f} with {visits} of some {ROWS // 256} leaves")
    assert met >= 0.9 * ROWS / 10


def test_links_in_an_even_part_and_a_dense_third(spark, values):
    unit = values.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = np.zeros(ROWS, np.int64)
    pairs = []
    for at in range(0, ROWS, 1000):
        i, j = np.nonzero(unit[at : at + 1000] @ unit.T >= 0.9)
        i = i + at
        keep = i != j
        np.add.at(links, i[keep], 1)
        pairs += zip(i[i < j].tolist(), j[i < j].tolist(), strict=True)
    got = {r["vec_id"]: r for r in near_vectors(table(spark, values)).collect()}
    assert len(got) == ROWS
    joined = [got[i]["component_id"] == got[j]["component_id"] for i, j in pairs]
    dense = [i % 3 == 0 for i, _ in pairs]
    for name, chosen in (("even", False), ("dense", True)):
        part = [ok for ok, d in zip(joined, dense, strict=True) if d is chosen]
        print(f"{name}: {sum(part)} of {len(part)} pairs joined")
        assert len(part) > 50 and sum(part) >= 0.99 * len(part)
    assert all(got[i]["n_links"] <= links[i] for i in got)
    assert sum(got[i]["n_links"] for i in got) >= 0.99 * links.sum()

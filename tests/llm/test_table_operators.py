"""Vectors, shards, URLs and mixing against plain versions, and the pipeline on awkward rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from promptmill.llm import embedding_dedup, sharding
from promptmill.llm.ann_tree import fit_tree, nearest_neighbours
from promptmill.llm.embedding_dedup import near_vectors, passes_needed
from promptmill.llm.mixing import mix, rake
from promptmill.llm.oracle import ORACLE
from promptmill.llm.packing import Capacity
from promptmill.llm.queries import QUERIES
from promptmill.llm.url_reputation import Rule, domain_of, host_of, host_reputation, judge_urls, path_of, suffix_of
from tests.check_oracle import connect, normal
from tests.llm.test_text_operators import check_sequences, slow_components

SF = "/root/testdata/sf0.001"
INF = float("inf")


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(1)
    base = draw.normal(size=(150, 8))
    near = base[:40] + draw.normal(scale=0.05, size=(40, 8))
    rows = [(i, [float(x) for x in v], "t") for i, v in enumerate(np.concatenate([base, near]).astype(np.float32))]
    rows += [(500 + i, rows[3][1], "t") for i in range(30)]
    rows += [(600, None, None), (601, [0.0] * 8, "t"), (602, [1.0, None] + [0.0] * 6, "t"), (603, [INF] + [1.0] * 7, "t")]
    rows += [(700, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, float("nan")], "t")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component_id string")


def usable_rows(vectors):
    rows = {r["vec_id"]: r["embedding"] for r in vectors.collect()}
    return {k: np.array(v, dtype=float) for k, v in rows.items() if v and None not in v and np.isfinite(v).all() and any(v)}


def test_nearest_neighbours(spark, vectors):
    good = usable_rows(vectors)
    found = defaultdict(list)
    for r in nearest_neighbours(vectors, F.col("vec_id") % 10 == 0, k=5).collect():
        found[r["query_id"]].append((r["rank"], r["id"], r["score"]))
    asked = [q for q in good if q % 10 == 0]
    assert sorted(found) == sorted(asked)
    hits = 0
    for q in asked:
        want = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q)[:5]
        rows = sorted(found[q])
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        assert all(s == pytest.approx(float(np.linalg.norm(good[i] - good[q])), rel=1e-12) for _, i, s in rows)
        assert rows == sorted(rows, key=lambda r: (r[2], r[1]))
        hits += len({i for _, i in want} & {i for _, i, _ in rows})
    assert hits >= 0.9 * 5 * len(asked)


def test_neighbour_query_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    found = defaultdict(set)
    for r in QUERIES["op1_nearest_vectors"](spark, SF).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in found:
        gaps = np.linalg.norm(matrix - matrix[ids == q], axis=1)
        gaps[ids == q] = INF
        hits += len(set(ids[np.argsort(gaps, kind="stable")[:10]].tolist()) & found[q])
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 100 == 0)
    assert hits >= 0.9 * 10 * len(found)


def test_few_and_no_vectors(spark, vectors):
    few = nearest_neighbours(vectors.filter("vec_id IN (0, 1, 2)"), F.col("vec_id") == 0, k=10).collect()
    assert sorted(r["id"] for r in few) == [1, 2]
    assert nearest_neighbours(vectors.filter("false"), F.lit(True)).count() == 0
    assert near_vectors(vectors.filter("false")).count() == 0


def test_tree_visits_every_leaf_once():
    sample = np.random.default_rng(2).normal(size=(400, 4))
    tree = fit_tree(sample, 30)
    assert sorted(tree.best_bins(sample[0])) == list(range(tree.leaves)) and 20 <= tree.leaves <= 30
    leaf = tree.assign(sample)
    assert set(leaf) <= set(range(tree.leaves)) and np.bincount(leaf).max() < 100
    assert fit_tree(np.ones((50, 4)), 10).leaves == 1


def test_near_vectors(vectors):
    good = usable_rows(vectors)
    unit = {k: v / np.linalg.norm(v) for k, v in good.items()}
    near = lambda a, b: a != b and float(unit[a] @ unit[b]) >= 0.9
    low = slow_components(list(good), near)
    got = {r["vec_id"]: r for r in near_vectors(vectors).collect()}
    assert len(got) == vectors.count()
    for k, row in got.items():
        assert row["component_id"] == low.get(k, k) and row["kept"] == (row["component_id"] == k)
        assert row["n_links"] == (sum(near(k, o) for o in good) if k in good else 0)


def test_passes_grow_slowly():
    assert passes_needed(10, 0.9) == 1
    assert passes_needed(10_000, 0.9) < passes_needed(1_000_000, 0.9) < 200


def dense_third(rows, seed=3, width=512):
    """A third of the rows has mutual cosines of about 0.88; pairs of it, returned, are at 0.902 and have few other links."""
    draw = np.random.default_rng(seed)
    unit = lambda m: m / np.linalg.norm(m, axis=-1, keepdims=True)
    count = rows // 6
    centre = unit(draw.normal(size=width))
    side = draw.normal(size=(2, count, width))
    side = unit(side - (side @ centre)[..., None] * centre)
    across = unit(side[1] - (side[1] * side[0]).sum(axis=1, keepdims=True) * side[0])
    u = (0.902 - 0.88) / 0.12
    partner = u * side[0] + np.sqrt(1 - u * u) * across
    dense = np.sqrt(0.88) * centre + np.sqrt(0.12) * np.concatenate([side[0], partner])
    return np.concatenate([dense, draw.normal(size=(rows - 2 * count, width))]), [(i, i + count) for i in range(count)]


@pytest.mark.parametrize(("window", "pass_pairs"), [(embedding_dedup.WINDOW, 2_500), (32, 2_500), (32, 4)])
def test_near_vectors_in_a_dense_third(spark, monkeypatch, window, pass_pairs):
    """Passes of 47 blocks; what they leave in doubt is compared at once, or, with ``pass_pairs`` 4, after more passes."""
    monkeypatch.setattr(embedding_dedup, "PASS_PAIRS", pass_pairs)
    matrix, pairs = dense_third(1_500)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(matrix.tolist())], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["component_id"] for r in near_vectors(table, window=window).collect()}
    assert len(got) == 1_500 and sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs)


@pytest.mark.parametrize("whole", [4, embedding_dedup.WHOLE])
def test_links_of_large_components_are_counted_in_tiles(spark, monkeypatch, whole):
    for name, value in (("WHOLE", whole), ("LEAST_BLOCK", 8)):
        monkeypatch.setattr(embedding_dedup, name, value)
    draw = np.random.default_rng(4)
    matrix = np.concatenate([draw.normal(size=8) + 0.5 * draw.normal(size=(150, 8)) for _ in range(2)])
    matrix = np.concatenate([matrix, matrix[:20]])
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(matrix.tolist())], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(table, window=16).collect()}
    assert [got[i] for i in range(len(matrix))] == ((unit @ unit.T >= 0.9).sum(axis=1) - 1).tolist()


def test_a_pair_at_the_threshold_gets_one_answer():
    draw = np.random.default_rng(6)
    units = draw.normal(size=(40, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    for threshold in (units[:5] @ units[5:10].T).ravel().tolist():
        near = embedding_dedup._near(units, units, threshold)
        assert (near == near.T).all() and (embedding_dedup._near(units[:7], units[3:], threshold) == near[:7, 3:]).all()


def test_nodes_that_share_the_bits_of_a_pass_are_in_blocks_side_by_side(spark):
    draw = np.random.default_rng(8)
    matrix = np.concatenate([draw.normal(size=(150, 6)), draw.normal(size=6) + 0.2 * draw.normal(size=(150, 6))])
    table = spark.createDataFrame([(i, v) for i, v in enumerate(matrix.tolist())], "node long, vector array<double>")
    found = embedding_dedup.sorted_passes(table, passes=2, first=3, window=16).collect()
    assert len(found) == 600 and {r["number"] for r in found} == {3, 4}
    for number in (3, 4):
        keys = embedding_dedup._key(matrix, 7, number)
        order = np.lexsort([np.arange(300), keys]).tolist()
        text = [f"{int(k) + (1 << 63):064b}" for k in keys]
        block = {node: place // 16 for place, node in enumerate(order)}
        for r in (r for r in found if r["number"] == number):
            node, bits = r["node"], r["bits"]
            assert r["block"] == block[node] and r["width"] == 6
            apart = lambda bits: [x for x in range(300) if text[x][:bits] == text[node][:bits] and abs(block[x] - block[node]) > 1]  # noqa: E731, B023
            assert not apart(bits) and (bits == 0 or apart(bits - 1))


def test_minimax_bounds(spark, seed, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST", 4)  # coarse intervals that must be cut further
    draw = random.Random(seed)
    cells = sorted(draw.sample(range(1 << 60), 120))
    sizes = [draw.randint(1, 9) if seed % 2 else draw.randint(1, 200) for _ in cells]
    groups = spark.createDataFrame(list(zip(cells, sizes, strict=True)), "cell long, bytes long")
    bounds = sharding.minimax_bounds(groups, 7)
    held = np.bincount([sum(c >= b for b in bounds) for c in cells], sizes, 7)
    assert held.max() == best_capacity(sizes, 7)


def test_shards(spark, tricky, empty):
    sized = tricky.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 16).withColumn("group", F.col("text"))
    rows = sharding.minimax_shards(sized, 4).collect()
    assert len(rows) == tricky.count() and set(tricky.columns) <= set(rows[0].asDict())
    where, slots, held = defaultdict(set), defaultdict(list), Counter()
    for r in rows:
        where[r["text"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        held[r["shard"]] += r["size"]
    assert all(len(v) == 1 for v in where.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(4))
    assert sharding.minimax_shards(empty.withColumn("size", F.lit(1)).withColumn("group", F.col("text")), 4).count() == 0


def test_shard_query(spark):
    rows = QUERIES["op4_minimax_sharding"](spark, SF).collect()
    held, slots = Counter(), defaultdict(list)
    for r in rows:
        held[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    same = Counter()
    for r in rows:
        same[r["text_crc32"], r["size"]] += r["size"]
    assert set(held) == set(range(40)) and max(held.values()) <= sum(held.values()) / 40 + max(same.values())


def test_hosts_and_paths(spark):
    urls = ["https://A.Example.COM/x?y#z", "http://b.co.uk?q=/no", "ftp://c#/f", "x://", "none/at", None, "http://é.FR/É"]
    table = spark.createDataFrame([(u,) for u in urls], "u string")
    host = host_of(F.col("u"))
    got = table.select(host, path_of(F.col("u")), domain_of(host), suffix_of(host)).collect()
    assert [tuple(r) for r in got][:4] == [
        ("a.example.com", "/x", "example.com", "com"),
        ("b.co.uk", "", "b.co.uk", "co.uk"),
        ("c", "", "c", "c"),
        ("", "", "", ""),
    ]
    assert [(r[0] or "", r[1] or "") for r in got][4:] == [("", ""), ("", ""), ("é.fr", "/É")]


def test_reputation(spark):
    outcomes = [("bad.x.net", 1)] * 30 + [("bad.x.net", 0)] * 2 + [("good.x.net", 0)] * 30 + [("fine.org", 0)] * 40
    pages = [(i, f"http://{h}/en/1") for i, h in enumerate(["bad.x.net", "good.x.net", "new.x.net", "new.y.org", "bad.x.net"])]
    pages += [(9, None), (10, "no mark"), (4, "http://bad.x.net/en/1"), (None, "http://bad.x.net/ok/")]
    table = spark.createDataFrame(pages, "page_id long, url string")
    rules = [Rule("allow", "x.net", "/ok/"), Rule("block", "org"), Rule("block", "net", "/ok/")]
    judged = judge_urls(table, spark.createDataFrame([*outcomes, (None, 1)], "host string, bad int"), rules).collect()
    verdicts = Counter((r["page_id"], r["verdict"], r["rule"]) for r in judged)
    assert verdicts == Counter(
        [(0, "block", None), (1, "allow", None), (2, "allow", None), (3, "block", "org/"), (4, "block", None), (4, "block", None)]
        + [(9, "allow", None), (10, "allow", None), (None, "allow", "x.net/ok/")]
    )
    none = judge_urls(table, spark.createDataFrame([], "host string, bad int"), [])
    assert {r["verdict"] for r in none.collect()} == {"allow"} and judge_urls(table.filter("false"), none.selectExpr("host", "1 AS bad"), []).count() == 0


def test_small_hosts_are_shrunk(spark):
    counts = [("one.a.com", 1, 1), ("many.a.com", 400, 390), ("b.com", 500, 5), ("c.com", 300, 3), ("d.net", 0, 0)]
    rows = {r["host"]: r for r in host_reputation(spark.createDataFrame(counts, "host string, n long, bad long")).collect()}
    assert rows["b.com"]["posterior"] < 0.05 < rows["d.net"]["posterior"] < rows["one.a.com"]["posterior"] < 1
    assert rows["many.a.com"]["lower"] > 0.9 and all(r["lower"] <= r["posterior"] for r in rows.values())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    theirs = normal(connect(SF).sql(ORACLE[name]).to_arrow_table().to_pandas().astype(object))
    assert normal(QUERIES[name](spark, SF).toArrow().to_pandas().astype(object)) == theirs


def test_raking_meets_marginals(spark):
    cells = [(s, k, 10 + 7 * i * (j + 1)) for i, s in enumerate("abc") for j, k in enumerate("xy")]
    table = spark.createDataFrame(cells, "source string, language string, tokens long")
    targets = {
        "source": spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 2.0)], "source string, target double"),
        "language": spark.createDataFrame([("x", 0.7), ("y", 0.3)], "language string, target double"),
    }
    fitted = rake(table, targets, rounds=12).collect()
    for by, want in (("source", {"a": 0.25, "b": 0.25, "c": 0.5}), ("language", {"x": 0.7, "y": 0.3})):
        sums = Counter()
        for r in fitted:
            sums[r[by]] += r["weight"]
        assert dict(sums) == pytest.approx(want, abs=1e-4)


def test_mixing_draws_by_probability(spark, tricky, empty):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 10 < 8, 'big', 'small') AS source", "IF(id % 3 = 0, 'a', NULL) AS lang")
    by = {"source": F.col("source"), "language": F.col("lang")}
    rows = mix(docs, by, F.lit(10), power=0.0, keep=0.5).collect()
    kept = Counter(r["source"] for r in rows if r["_mix"]["sampled"])
    assert len(rows) == 4000 and 1850 < sum(kept.values()) < 2150
    assert kept["small"] == 800 or kept["small"] / sum(kept.values()) > 0.35
    by = {"source": F.col("source"), "language": F.col("lang")}
    assert mix(tricky, by, F.length("text")).count() == tricky.count() and mix(empty, by, F.lit(1)).count() == 0


def test_pipeline_on_awkward_rows(spark, tricky, empty):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    sizes, docs = [], tricky
    for name, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, SF), "test")
        sizes.append(docs.count())
        if name != names[-1]:
            assert docs.columns == tricky.columns
            ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == names[0]:
            assert not ids & {3, 4, 11} and {0, 1, 2, 5, 7, 10, None} <= ids
        if name == names[1]:
            assert 1 not in ids and {0, 5, 7, 12} <= ids and docs.filter("doc_id = 12").count() == 1
        if name == names[2]:
            assert {0, 7, 10} <= ids and not ids & {9, 13}
            assert docs.filter("n_chars <> length(text) AND doc_id IS NOT NULL").count() == 0
    check_sequences(docs.collect(), Capacity().tokens)
    left = empty
    for _, apply in corpus_pipeline.STAGES:
        left = apply(spark, left, SF)
        assert left.count() == 0


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and corpus_pipeline.ORACLE_SQL is None
    check_sequences(rows, 1024)


def test_simhash_stage_judges_each_row_by_its_own_text(spark):
    """Id 5 stands on a text of its own and on a copy of that of id 1; another id stands on two rows, alike."""
    texts = ["one two three four five six seven", "alpha beta gamma delta epsilon zeta", "some other words that stand alone here"]
    rows = [(1, texts[0]), (5, texts[0]), (5, texts[1]), (9, texts[2]), (9, texts[2])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for given, want in ((docs, rows[:1] + rows[2:4]), (docs.filter("doc_id < 9"), rows[:1] + rows[2:3])):
        kept = dict(corpus_pipeline.STAGES)["SimHash near-dedup"](spark, given, SF).collect()
        assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted(want)


def test_pipeline_stages_keep_columns_named_like_their_own(spark, tricky):
    names = ["_text", "_id", "_mix", "_rate", "_cell", "_language", "_repeats", "_cut", "_row", "_rows", "cell", "component_id", "bits"]
    docs = tricky.select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(f"own{c}").alias(c) for c in names])
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(apply(spark, docs, SF), "test")
        assert docs.columns[5:] == names, name
        assert [tuple(r) for r in docs.select(*names).distinct().collect()] == [tuple(f"own{c}" for c in names)], name


def test_embedding_dedup_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, units = [], []
    for vec_id, vector in rows:
        if vector is not None and None not in vector and np.isfinite(vector).all() and any(vector):
            ids.append(vec_id)
            units.append(np.array(vector, dtype=float) / np.linalg.norm(np.array(vector, dtype=float)))
    near = np.array(units) @ np.array(units).T >= 0.9
    place = {x: i for i, x in enumerate(ids)}
    counts = dict(zip(ids, (near.sum(axis=1) - 1).tolist(), strict=True))
    root = slow_components(ids, lambda a, b: near[place[a], place[b]])
    found = QUERIES["op2_embedding_near_dedup"](spark, SF).collect()
    want = {r["vec_id"]: (counts.get(r["vec_id"], 0), root.get(r["vec_id"], r["vec_id"])) for r in rows}
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == want and len(found) == len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)

"""Spelling variants, bit-plane clusters and toxicity against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptmill.llm import spelling
from promptmill.llm.bit_clusters import cluster_vectors, dot_products, pack_planes, squared_lengths
from promptmill.llm.queries import QUERIES, spelled_words
from promptmill.llm.spelling import codes, near_words, neighbourhood, reduced, spelling_variants, word_counts
from promptmill.llm.toxicity import IDENTITY_TERMS, Scorer, counterfactuals, features, fit_toxicity, score_toxicity, words_of

SF = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")


# Spelling variants


def edits(word, letters):
    """Everything at exactly one edit."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + x + word[i + 1 :] for i in range(len(word)) for x in letters}
    out |= {word[:i] + x + word[i:] for i in range(len(word) + 1) for x in letters}
    return out - {word}


def slow_variants(counts, ratio=10):
    letters = sorted({x for word in counts for x in word})
    near = {word: [x for x in edits(word, letters) if x in counts] for word in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), counts[form[word]] if form[word] is not None else None))
    return sorted(out, key=repr)


def rows_of(found):
    return sorted((tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 3), min_size=0, max_size=7))
def test_reduced_neighbourhood_is_full_and_each_comes_once(word):
    def number(symbols):
        return int(codes(np.array([symbols], dtype=np.uint64).reshape(1, -1), 4)[0])

    full = set()
    for i in range(len(word) + 1):
        full |= {tuple(word[:i] + word[i + 1 :])} if i < len(word) else set()
        full |= {tuple(word[:i] + [s] + word[i + 1 :]) for s in (1, 2, 3) if i < len(word)}
        full |= {tuple(word[:i] + [s] + word[i:]) for s in (1, 2, 3)}
    full.discard(tuple(word))
    matrix = np.array([word], dtype=np.uint64).reshape(1, -1)
    blocks = list(neighbourhood(matrix, 4))
    own = number(word)
    assert blocks[0].tolist() == [[own]]
    met = [x for block in blocks[1:] for x in block[0].tolist() if x != own]
    assert sorted(met) == sorted(number(list(x)) for x in full)


def test_variants_of_random_words(spark):
    draw = random.Random(3)
    counts = {}
    for _ in range(600):
        counts["".join(draw.choice("abcé") for _ in range(draw.randint(1, 6)))] = draw.choice([1, 2, 3, 30, 400, 5000])
    counts |= {"x" * 300: 2, "x" * 299: 40, "😀😀": 1, "😀é": 10, "": 1}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = slow_variants(counts)
    for symbols in (2, 6):
        assert rows_of(spelling_variants(table, symbols=symbols)) == want


def test_variants_follow_forms_and_break_ties(spark):
    counts = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaaaaac": 10, "zzzzzzz": 5}
    rows = [(w, n, "form", "x") for w, n in counts.items()]
    table = spark.createDataFrame(rows, "word string, n long, form string, code string")
    found = {r["word"]: r for r in spelling_variants(table).collect()}
    assert found["aaaaaaa"]["form"] == "aaaaaab" and found["aaaaaaa"]["root"] == "aaaabbb"
    assert found["zzzzzzz"]["root"] == "zzzzzzz" and found["zzzzzzz"]["n_near"] == 0
    assert rows_of(spelling_variants(table)) == slow_variants(counts)


def test_variants_of_awkward_rows(spark, empty):
    rows = [("aaaaaaa", 3), ("aaaaaaa", 4), (None, 5), ("aaaaaab", None), ("aaaaaab", 100)]
    table = spark.createDataFrame(rows, "word string, n long")
    assert rows_of(spelling_variants(table)) == slow_variants({"aaaaaaa": 7, "aaaaaab": 100})
    assert spelling_variants(word_counts(spelled_words(empty))).collect() == []


def test_codes_that_coincide_do_no_harm(spark, monkeypatch):
    """All words of a length under one code: everything is met, and only near words stay."""
    monkeypatch.setattr(spelling, "SYMBOLS", 1)
    counts = {"abcd": 1, "abce": 2, "abc": 3, "xyz": 4}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    met = {(r["word"], r["other"]) for r in near_words(table, symbols=1).collect()}
    assert met == {("abcd", "abce"), ("abce", "abcd"), ("abcd", "abc"), ("abc", "abcd"), ("abce", "abc"), ("abc", "abce")}


def test_long_words_are_reduced_in_parts(monkeypatch):
    monkeypatch.setattr(spelling, "CELLS", 16)
    words = ["abc", "de", "fgh", "é" * 40, ""]
    seen = {}
    for rows, matrix in reduced(words, 4):
        for row, symbols in zip(rows.tolist(), matrix.tolist(), strict=True):
            seen[words[row]] = symbols
    assert {w: len(s) for w, s in seen.items()} == {w: len(w) for w in words}
    assert set(seen["é" * 40]) == {seen["é" * 40][0]}


def slow_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_spelled_words_of_awkward_rows(spark, tricky):
    rows = [(r["doc_id"], r["text"]) for r in tricky.select("doc_id", "text").collect()]
    found = {r["word"]: r["n"] for r in word_counts(spelled_words(tricky)).collect()}
    assert found == slow_words(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_spelling_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op11_spelling_variants"](spark, folder)) == slow_variants(slow_words([tuple(r) for r in docs]))


# Clusters


@settings(deadline=None, max_examples=40)
@given(st.lists(st.lists(st.integers(-(1 << 26), (1 << 26) - 1), min_size=64, max_size=64), min_size=1, max_size=4))
def test_planes_give_exact_dot_products(rows):
    values = np.array(rows, dtype=np.int64)
    planes = pack_planes(values)
    other = pack_planes(values[:1] // 1000)
    assert dot_products(planes, other).tolist() == (values @ (values[:1] // 1000).T).tolist()
    assert squared_lengths(planes).tolist() == (values * values).sum(axis=1).tolist()


def slow_clusters(rows, centroids=16, rounds=3):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == 64 and None not in vector and np.isfinite(vector).all():
            ints = [int(np.floor(64 * float(x))) for x in vector]
            if all(-(1 << 26) <= x < (1 << 26) for x in ints):
                kept.append((vec_id, ints))
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    middle = [v for _, v in named[:centroids]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(middle)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for c in range(len(middle)):
            mine = [v for (_, v), (_, k) in zip(kept, found, strict=True) if k == c]
            if mine:
                middle[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = assign()
    total = Counter()
    for d, c in found:
        total[c] += d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return sorted(
        ((i, c, d, total[c], sum(total.values()), digest[c]) for (i, _), (d, c) in zip(kept, found, strict=True)), key=repr
    )


CLUSTERED = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def clustered(found):
    return sorted((tuple(r) for r in found.select(*CLUSTERED).collect()), key=repr)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_clusters_of_awkward_vectors(spark, kind):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=64).astype(np.float32).tolist()) for i in range(60)]
    rows += [(200 + i, rows[0][1]) for i in range(20)] + [rows[5], rows[5], (5, rows[6][1])]
    rows += [(300, [0.0] * 64), (301, [-1e5] * 64), (302, [1e5] + [0.0] * 63), (303, [1e30] + [0.0] * 63)]
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [NAN] + [1.0] * 63), (404, [None] + [1.0] * 63), (405, [INF] + [1.0] * 63)]
    rows += [(None, rows[9][1]), (406, [-INF] * 64)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, ints string, cluster int")
    assert clustered(cluster_vectors(table.repartition(5))) == slow_clusters(rows)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = [(i, [i / 7] * 64) for i in range(5)]
    assert clustered(cluster_vectors(spark.createDataFrame(few, schema))) == slow_clusters(
        [(i, np.array(v, dtype=np.float32).tolist()) for i, v in few]
    )
    for rows in ([], [(1, None)], [(1, [0.5] * 3)]):
        found = cluster_vectors(spark.createDataFrame(rows, schema))
        assert found.collect() == [] and found.columns == CLUSTERED


def test_cluster_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert clustered(QUERIES["op12_centroid_clusters"](spark, SF)) == slow_clusters(rows)


# Toxicity


def test_counterfactuals_swap_identity_terms():
    assert counterfactuals({"hello", "world"}) == []
    assert counterfactuals({"the", "women"}) == [{"the", "men"}, {"the", "people"}]
    assert counterfactuals({"transgender"}) == [{"women"}, {"people"}]
    assert features({"idiot", "at"}) == {"idiot", "at", "idi-", "idio-"}


@pytest.fixture(scope="module")
def biased(spark):
    """Toxic texts often name one group, so that a plain classifier holds the name against it."""
    draw = random.Random(4)
    fillers = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        words = draw.sample(fillers, 12)
        if toxic:
            words += [draw.choice(["idiot", "moron"])] if draw.random() < 0.75 else []
            words += ["muslims"] if draw.random() < 0.7 else []
        elif draw.random() < 0.05:
            words += [draw.choice(["christians", "jews", "muslims"])]
        draw.shuffle(words)
        rows.append((i, " ".join(words), int(toxic), "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, label int, key string")


def test_swaps_stop_false_positives_on_neutral_mentions(biased):
    docs, labels = biased.select("doc_id", "text"), biased.select("doc_id", "label")
    plain = Scorer(fit_toxicity(docs, labels, penalty=0.0))
    fair = Scorer(fit_toxicity(docs, labels, penalty=10.0))
    neutral = [f"w1 w2 {group} w3 w4" for group in ("muslims", "christians", "jews", "people")]
    assert plain(neutral[0]) > 0.5 > plain(neutral[1])
    scores = [fair(text) for text in neutral]
    assert max(scores) < 0.5 and max(scores) - min(scores) < 0.02
    assert fair("w1 w2 idiot w3") > 0.5 and fair("w1 muslims moron w3") > 0.5
    assert plain(neutral[0]) - plain(neutral[3]) > 5 * (scores[0] - scores[3])


def test_toxicity_of_awkward_rows(spark, tricky, empty, biased):
    model = fit_toxicity(biased, biased.select("doc_id", "label"))
    scorer = Scorer(model)
    found = Counter((r["doc_id"], r["score"]) for r in score_toxicity(tricky, model).collect())
    assert found == Counter((r["doc_id"], scorer(r["text"])) for r in tricky.select("doc_id", "text").collect())
    assert all(0 <= score <= 1 for _, score in found)
    assert scorer(None) == scorer("") == scorer("!!") < 0.5
    assert score_toxicity(empty, model).collect() == []
    long = "w1 " * 400_000
    assert scorer(long + "idiot") == scorer("w1 idiot") > 0.5


def test_labels_that_cannot_be_told_apart(spark, biased, empty):
    ids = "doc_id long, label int"
    none = fit_toxicity(biased, spark.createDataFrame([(1, None), (None, 1)], ids))
    assert Scorer(none)("idiot") < 1e-6
    assert Scorer(fit_toxicity(empty, spark.createDataFrame([], ids)))("x") < 1e-6
    assert Scorer(fit_toxicity(biased, spark.createDataFrame([(1, 1), (2, 1)], ids)))("x") > 0.999
    absent = fit_toxicity(empty, spark.createDataFrame([(1, 1), (2, 0)], ids))
    assert 0 <= Scorer(absent)("x") <= 1


def test_repeated_ids_and_labels(spark, biased):
    """The highest label of an id counts, and repeated rows change nothing."""
    labels = biased.select("doc_id", "label")
    again = labels.union(labels.filter("label = 0")).union(labels.filter("label = 1").withColumn("label", F.lit(0)))
    assert fit_toxicity(biased.union(biased), again) == fit_toxicity(biased, labels)


def test_the_sample_is_bounded(biased):
    from promptmill.llm.toxicity import labelled_sample

    sample, counts = labelled_sample(biased, biased.select("doc_id", "label"), per_class=40, seed=1)
    drawn = Counter(r["label"] for r in sample.collect())
    assert counts == {0: 300, 1: 100} and 20 <= drawn[0] <= 65 and 20 <= drawn[1] <= 65


def test_toxicity_query(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = QUERIES["op13_toxicity"](spark, folder).collect()
    assert len(found) == 10_000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in found)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and labels.get(r["doc_id"]) is not None]
    toxic, clean = [p for y, p in held if y == 1], [p for y, p in held if y == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_terms_are_listed_once_per_class():
    assert all(len(set(group)) == len(group) >= 3 for group in IDENTITY_TERMS)
    assert words_of("Idiot, ÉTÉ!") == {"idiot", "été"}

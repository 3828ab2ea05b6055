"""Changed answers against the plain table of common subsequences."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from catalog import queries
from promptmill.functions.difference import difference
from promptmill.operators.evaluate import answer_changes

SF = "/root/testdata/sf0.001"


def longest_common(a, b):
    """Length of a longest common subsequence, by the whole table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def check(spans, a, b):
    """Spans tile both sides, keep equal words, and keep as many as can be."""
    at_a = at_b = kept = 0
    last = None
    for kind, before_at, after_at, n in spans:
        assert (before_at, after_at) == (at_a, at_b) and n > 0
        assert kind != last and (last, kind) != ("added", "removed")
        if kind == "kept":
            assert a[at_a : at_a + n] == b[at_b : at_b + n]
            kept += n
        at_a += n if kind != "added" else 0
        at_b += n if kind != "removed" else 0
        last = kind
    assert (at_a, at_b) == (len(a), len(b))
    assert kept == longest_common(a, b)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=24), st.lists(st.sampled_from("abcd"), max_size=24))
def test_difference_is_shortest(a, b):
    check(difference(a, b), a, b)


def test_long_answers():
    rng = random.Random(3)
    a = [rng.choice("abcdefgh") for _ in range(900)]
    b = [w for w in a if rng.random() > 0.2]
    for _ in range(90):
        b.insert(rng.randrange(len(b)), rng.choice("abcdefgh"))
    check(difference(a, b), a, b)
    words = [f"w{i}" for i in range(20_000)]
    assert difference(words, words[:9_000] + ["new"] + words[9_001:]) == [
        ("kept", 0, 0, 9_000), ("removed", 9_000, 9_000, 1), ("added", 9_001, 9_000, 1), ("kept", 9_001, 9_001, 10_999),
    ]


def test_query_against_brute_force(spark):
    table = queries.results(spark, SF).filter("response IS NOT NULL").collect()
    said = {run: {r.id: r.response.split() for r in table if r.run == run} for run in "ab"}
    rows = queries.answer_changes(spark, SF).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.id, r.span)):
        assert r.span == len(found.setdefault(r.id, []))
        found[r.id].append((r.kind, r.before_at, r.after_at, r.n_words))
        side = said["a"][r.id][r.before_at :] if r.kind == "removed" else said["b"][r.id][r.after_at :]
        assert r.words == " ".join(side[: r.n_words])
    assert any(len(spans) > 2 for spans in found.values())
    for id in said["a"].keys() | said["b"].keys():
        check(found.get(id, []), said["a"].get(id, []), said["b"].get(id, []))


def test_awkward_answers(spark):
    pairs = [
        ("same", "a b", "a  b", "changed"), ("blank", " ", "", "changed"), ("none", None, None, "same"),
        ("new", None, "x y", "added"), ("gone", "x", None, "removed"), ("equal", "u v", "u v", "same"),
        (None, "a", "b", "changed"),
    ]
    compared = spark.createDataFrame(pairs, "id string, before string, after string, status string")
    compared = compared.selectExpr("*", "1 AS delta_tokens", "'mine' AS words", "0 AS span")
    rows = answer_changes(compared).collect()
    assert {(r.id, r.span, r.kind, r.before_at, r.after_at, r.n_words, r.words) for r in rows} == {
        ("same", 0, "kept", 0, 0, 2, "a b"), ("new", 0, "added", 0, 0, 2, "x y"), ("gone", 0, "removed", 0, 0, 1, "x"),
        ("equal", 0, "kept", 0, 0, 2, "u v"), (None, 0, "removed", 0, 0, 1, "a"), (None, 1, "added", 1, 0, 1, "b"),
    }
    assert answer_changes(compared.limit(0)).collect() == []

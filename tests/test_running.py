import random

import pytest
from pyspark.sql import functions as F

from promptmill.operators.chat import (
    conversation_usage,
    pack_sequences,
    packed_blocks,
    packing_report,
    truncate_tokens,
)
from promptmill.operators.profile import balance_categories, run_sizing, token_length_profile, top_categories
from promptmill.operators.running import running_totals


@pytest.mark.parametrize("chunk", [1, 7, 64, 65_536])
def test_running_totals(spark, chunk):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randrange(9)) for i in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, pos bigint, v bigint")
    want, sums = {}, {}
    for g, pos, v in sorted(rows, key=lambda r: r[1]):
        want[pos] = (sums.get(g, 0), sums.get(("n", g), 0))
        sums[g] = sums.get(g, 0) + v
        sums[("n", g)] = sums.get(("n", g), 0) + 1
    values = {"s": F.col("v"), "k": F.lit(1)}
    got = {r.pos: (r.s, r.k) for r in running_totals(df, ["g"], "pos", values, chunk).collect()}
    assert got == want
    first = running_totals(df, ["g"], "pos", values, chunk, below=("k", 5)).collect()
    assert {r.pos: (r.s, r.k) for r in first} == {p: t for p, t in want.items() if t[1] < 5}


def usage_by_hand(rows):
    out = []
    for conv in sorted({r[0] for r in rows}):
        history = session = 0
        for _, turn, role, text in sorted(r for r in rows if r[0] == conv):
            if role == "user" and text.strip().lower() in ("exit", "quit"):
                break
            n = len(text.split())
            if role == "assistant":
                session += history + n
                out.append((conv, turn, history, n, history + n, session))
            history += n
    return out


@pytest.mark.parametrize("chunk", [1, 3, 10, 65_536])
def test_usage_of_long_conversations(spark, chunk):
    rng = random.Random(2)
    rows = []
    for conv, length in enumerate([1, 2, 5, 40, 200, 33]):
        for turn in range(length):
            role = "system" if turn == 0 and conv % 2 else ("user" if turn % 2 else "assistant")
            text = " ".join(["w"] * rng.randrange(6))
            if conv == 5 and turn == 21:
                text = "  Quit "
            rows.append((conv, turn, role, text))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert sorted(tuple(r) for r in conversation_usage(df, chunk=chunk).collect()) == usage_by_hand(rows)


def words(n):
    return " ".join(["w"] * n)


def conversation(spark, *turns):
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_usage_golden(spark):
    df = conversation(
        spark, ("system", words(2)), ("user", words(3)), ("assistant", words(4)), ("user", words(1)), ("assistant", words(5))
    )
    got = [tuple(r)[2:] for r in conversation_usage(df).orderBy("turn").collect()]
    assert got == [(5, 4, 9, 9), (10, 5, 15, 24)]
    got = [tuple(r)[2:] for r in conversation_usage(df, message_overhead=1, generation_overhead=1).orderBy("turn").collect()]
    assert got == [(8, 4, 12, 12), (15, 5, 20, 32)]


def test_usage_ends_at_exit(spark):
    df = conversation(
        spark, ("user", "a"), ("assistant", "b"), ("user", " Exit "), ("assistant", "c"), ("user", "d"), ("assistant", "e")
    )
    assert [r.turn for r in conversation_usage(df).collect()] == [1]


def lengths(spark, *sizes):
    return spark.createDataFrame(list(enumerate(sizes)), "pos bigint, n_tokens bigint")


@pytest.mark.parametrize("chunk", [1, 2, 65_536])
def test_packing_golden(spark, chunk):
    got = pack_sequences(lengths(spark, 3, 5, 0, 4), 4, chunk=chunk).collect()
    assert sorted((r.block_id, r.pos, r.start, r.place, r.length) for r in got) == [
        (0, 0, 0, 0, 3),
        (0, 1, 0, 3, 1),
        (1, 1, 1, 0, 4),
        (2, 3, 0, 0, 4),
    ]


def test_packing_fills_blocks(spark):
    rng = random.Random(4)
    sizes = [rng.randrange(40) for _ in range(300)]
    for separator in (0, 1):
        total = sum(s + separator for s in sizes if s)
        pieces = pack_sequences(lengths(spark, *sizes), 16, separator=separator, chunk=32)
        blocks = {r.block_id: r.n for r in pieces.groupBy("block_id").agg(F.sum("length").alias("n")).collect()}
        assert sum(blocks.values()) == total
        assert set(blocks) == set(range(-(-total // 16)))
        assert all(n == 16 for b, n in blocks.items() if b < len(blocks) - 1)


def test_blocks_hold_the_tokens_in_order(spark):
    texts = ["a b c", "d e f g h", "", "i j k l"]
    df = spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string")
    df = df.withColumn("tokens", F.expr("filter(split(text, ' '), t -> t <> '')")).withColumn("n_tokens", F.size("tokens"))
    blocks = packed_blocks(pack_sequences(df, 5, tokens_col="tokens")).orderBy("block_id").collect()
    assert [r.tokens for r in blocks] == [list("abcde"), list("fghij"), list("kl")]
    spaced = packed_blocks(pack_sequences(df, 5, separator=1, tokens_col="tokens")).orderBy("block_id").collect()
    assert [r.tokens for r in spaced] == [list("abcd"), list("efgh"), list("ijkl")]


def test_packing_report(spark):
    row = packing_report(lengths(spark, 3, 5, 0, 4), 4).first()
    assert tuple(row) == (3, 12, 3, 1, 0)
    assert tuple(packing_report(lengths(spark, 0), 4).first()) == (0, 0, 0, 0, 0)


def test_truncate(spark):
    df = spark.createDataFrame([("a b\n c",), ("a",), (None,)], "text string")
    got = [(r.n, r.n_kept, r.n_dropped, r.tokens) for r in truncate_tokens(df, 2).collect()]
    assert got == [(3, 2, 1, ["a", "b"]), (1, 1, 0, ["a"]), (0, 0, 0, [])]


def test_balance_with_a_hot_category(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else "rare") for i in range(90)]
    df = spark.createDataFrame(rows, "pos bigint, category string")
    got = balance_categories(df, 4, chunk=8).collect()
    want = {}
    for pos, category in rows:
        want.setdefault(category or "unknown", []).append(pos)
    assert {c: sorted(r.pos for r in got if r.category == c) for c in want} == {c: p[:4] for c, p in want.items()}
    assert {r.category: r.weight for r in got} == {c: 90 / (3 * len(p)) for c, p in want.items()}


def test_profile_and_sizing(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 2, 10)], "lang string, n_tokens bigint")
    row = token_length_profile(df, ["lang"], 5).first()
    assert (row.n, row.p50, row["max"], row.over, row["mean"]) == (4, 2.0, 10, 1, 3.75)
    assert row.p90 == pytest.approx(7.6)
    split = spark.createDataFrame([("train",)] * 33 + [("val",)], "split string")
    sized = {r.split: (r.n, r.effective_batch, r.steps) for r in run_sizing(split, 2, 1, 8, 2).collect()}
    assert sized == {"train": (33, 16, 5), "val": (1, 16, 1)}
    capped = {r.split: r.steps for r in run_sizing(split, 2, 1, 8, 0, max_steps=3).collect()}
    assert capped == {"train": 3, "val": 1}


def test_top_categories_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "category string, n bigint")
    assert [r.category for r in top_categories(df, 2).collect()] == ["c", "a"]


def test_a_long_example_is_cut_in_linear_time(spark):
    df = spark.sql("SELECT 0L AS pos, transform(sequence(1, 1000000), x -> 'w') AS tokens, 1000000L AS n_tokens")
    sizes = packed_blocks(pack_sequences(df, 2048, tokens_col="tokens")).select(F.size("tokens").alias("n"))
    assert sizes.agg(F.sum("n"), F.max("n"), F.count("*")).first() == (1_000_000, 2048, 489)


def test_negative_turns_do_not_depend_on_the_chunk(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", "a b") for t in range(-5, 4)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    totals = [sorted(map(tuple, conversation_usage(table, chunk=c).collect())) for c in (1, 2, 1000)]
    assert totals[0] == totals[1] == totals[2]

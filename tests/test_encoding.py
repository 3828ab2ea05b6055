"""Ids with places, blocks with segments, templates, epoch order and weighted subsets."""

import hashlib
import json
import math
import random
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from promptmill.functions import encoded_count, encoder_from, encoding, estimate_tokens, tokenizer_encoder
from promptmill.operators.chat import render_chat, segment_examples, truncate_encoded, with_token_count
from promptmill.operators.epochs import epoch_place, epoch_shards, halves, permuted, round_keys
from promptmill.operators.subset import apportioned, weighted_subset
from promptmill.operators.templates import CHATML, CHATML_ASSISTANT, INST, TURNS, MessageRule, Template
from promptmill.plans import training_blocks, training_text, write_training_blocks
from tests.test_plans import plan

MODEL = public_tokenizers.path("byte_bpe_50k.json")
MESSAGES = "messages array<struct<role:string,content:string>>"


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(MODEL)


@pytest.fixture(scope="module")
def chat(spark):
    draw = random.Random(1)
    answers = [" ".join(draw.choice(["größer", "hello", "日本", "<|endoftext|>", "supercalifragilistic"]) for _ in range(draw.randint(0, 60))) for _ in range(40)]
    rows = [("train", [("user", f"q{i} 😀"), ("assistant", a)]) for i, a in enumerate(answers)]
    rows.append(("validation", [("user", "other")]))
    return spark.createDataFrame(rows, f"split string, {MESSAGES}")


# Ids and blocks


def test_encoder_equals_the_tokenizer(spark, bpe):
    texts = ["", None, "hello <|endoftext|> world", "naïve 日本語 😀", " a" * 3000, "\x00x"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    encoder = tokenizer_encoder(MODEL)
    rows = found.withColumn("e", encoder(F.col("text"))).orderBy("i").collect()
    for row in rows:
        want = bpe.encode(row["text"] or "", add_special_tokens=False)
        assert [(x["id"], (x["start"], x["end"])) for x in row["e"]] == list(zip(want.ids, want.offsets, strict=True))
    counted = with_token_count(found, counter=encoded_count(encoder)).orderBy("i").collect()
    assert [r["n_tokens"] for r in counted] == [len(r["e"]) for r in rows]


def test_a_batch_of_many_ids_goes_back_in_parts(monkeypatch):
    made = []
    monkeypatch.setattr(encoding.F, "arrow_udf", lambda kind: lambda f: made.append(f) or f)
    encoder_from(lambda: lambda text: ([ord(c) for c in text], list(range(len(text))), list(range(1, len(text) + 1))))
    texts = [None, "", *["xyz" * 1000] * 200, "", "x" * 100_000, None, "y", None, ""]
    parts = list(made[0](iter([pa.array(texts[:150]), pa.array([], pa.string()), pa.array([None], pa.string()), pa.array(texts[150:])])))
    assert max(len(part.flatten()) for part in parts) < encoding.IDS_SENT + 100_000
    assert sorted(len(part.flatten()) for part in parts)[-2] < encoding.IDS_SENT + 3000
    want = [*texts[:150], None, *texts[150:]]
    rows = [row for part in parts for row in part.to_pylist()]
    assert ["".join(chr(x["id"]) for x in row) for row in rows] == [text or "" for text in want]
    assert all([(x["start"], x["end"]) for x in row] == [(i, i + 1) for i in range(len(row))] for row in rows)


def test_truncated_ids_and_text_agree(spark, bpe):
    texts = ["one two three four", "", None, "größer <|endoftext|> 日本", "x"]
    found = spark.createDataFrame([(t, "spans") for t in texts], "text string, n string")
    for row in truncate_encoded(found.drop("n"), tokenizer_encoder(MODEL), 3).collect():
        ids = bpe.encode(row["text"] or "", add_special_tokens=False)
        assert row["ids"] == ids.ids[:3] and row["n"] == len(ids.ids)
        assert row["n_kept"] + row["n_dropped"] == row["n"]
        assert row["text_end"] == max([end for _, end in ids.offsets[:3]], default=0)


@pytest.mark.parametrize("most", [1, 4])
def test_truncated_ids_are_the_same_whatever_goes_back_at_once(spark, monkeypatch, most):
    texts = ["one two three four five", "", None, "größer <|endoftext|> 日本", "x", None, "", "x y z", None] * 3
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").coalesce(1)

    def cut():
        return truncate_encoded(found, tokenizer_encoder(MODEL), 3).orderBy("i").collect()

    whole = cut()
    monkeypatch.setattr(encoding, "IDS_SENT", most)
    assert cut() == whole


def test_blocks_of_a_subword_tokenizer_lose_no_id(chat, bpe):
    text = training_text(chat, encoder=tokenizer_encoder(MODEL))
    ordered = text.orderBy("pos").collect()
    want = [bpe.encode(r["text"], add_special_tokens=False).ids for r in ordered]
    assert [r["n_tokens"] for r in ordered] == [len(x) for x in want]
    blocks = training_blocks(text, 64).orderBy("block_id").collect()
    assert [i for b in blocks for i in b["tokens"]] == [i for x in want for i in x]
    assert all(len(b["tokens"]) == 64 for b in blocks[:-1])
    for b in blocks:
        assert b["n_segments"] == len(b["segments"])
        assert b["position_ids"] == [k for s in b["segments"] for k in range(s["length"])]
        assert [s["place"] for s in b["segments"]] == [sum(x["length"] for x in b["segments"][:k]) for k in range(len(b["segments"]))]
        assert all(b["tokens"][s["place"] : s["place"] + s["length"]] == want[s["pos"]][s["start"] : s["start"] + s["length"]] for s in b["segments"])


@pytest.mark.parametrize("most", [1, 50])
def test_blocks_are_the_same_whatever_goes_back_at_once(chat, monkeypatch, most):
    def found():
        blocks = training_blocks(training_text(chat, encoder=tokenizer_encoder(MODEL)), 64)
        again = segment_examples(blocks)
        return [sorted((r.asDict(recursive=True) for r in df.collect()), key=str) for df in (blocks, again)]

    whole = found()
    monkeypatch.setattr(encoding, "IDS_SENT", most)
    assert found() == whole


@pytest.mark.parametrize("packing", [True, False])
def test_examples_come_back_from_segments(chat, packing):
    text = training_text(chat)
    again = {r["pos"]: r["tokens"] for r in segment_examples(training_blocks(text, 16, packing)).collect()}
    want = {r["pos"]: r["text"].split() for r in text.collect()}
    assert again == (want if packing else {pos: words[:16] for pos, words in want.items()})


def test_words_counted_otherwise_are_refused(chat):
    text = training_text(chat, counter=lambda c: estimate_tokens(c) - 1)
    with pytest.raises(PySparkException, match="give training_text an encoder"):
        training_blocks(text, 16).collect()


def test_blocks_are_written_in_order_one_file_a_worker_and_cut(spark, chat, tmp_path):
    blocks = training_blocks(training_text(chat), 16)
    write_training_blocks(blocks.repartition(7), str(tmp_path / "out"), 3, rows_per_file=4)
    n = blocks.count()
    seen = []
    for rank in range(3):
        files = sorted((tmp_path / "out" / f"rank={rank}").glob("*.txt"))
        assert len(files) == math.ceil(len(range(rank, n, 3)) / 4)
        for file in files:
            lines = [json.loads(line) for line in file.read_text().splitlines()]
            assert [x["pos"] for x in lines] == sorted(x["pos"] for x in lines)
            assert all(x["pos"] % 3 == rank and x["segments"] for x in lines)
            seen += [x["pos"] for x in lines]
    assert sorted(seen) == list(range(n))


# Templates


CONVERSATION = [("system", " S "), ("user", " u1 "), ("assistant", "a1\n"), ("user", "u2")]
GOLDEN = {
    "assistant_system": (CHATML_ASSISTANT, CONVERSATION[1:3], False, "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user\n u1 <|im_end|>\n<|im_start|>assistant\na1\n<|im_end|>\n"),
    "own_system": (CHATML_ASSISTANT, CONVERSATION[:2], True, "<|im_start|>system\n S <|im_end|>\n<|im_start|>user\n u1 <|im_end|>\n<|im_start|>assistant\n"),
    "plain": (CHATML, CONVERSATION[1:2], True, "<|im_start|>user\n u1 <|im_end|>\n<|im_start|>assistant\n"),
    "inst": (INST, CONVERSATION, True, "<s>[INST] <<SYS>>\n S \n<</SYS>>\n\n u1 [/INST] a1 </s><s>[INST] u2 [/INST]"),
    "inst_no_system": (INST, CONVERSATION[1:], False, "<s>[INST] u1 [/INST] a1 </s><s>[INST] u2 [/INST]"),
    "turns": (TURNS, CONVERSATION, True, "<bos><start_of_turn>user\n S \n\nu1<end_of_turn>\n<start_of_turn>model\na1<end_of_turn>\n<start_of_turn>user\nu2<end_of_turn>\n<start_of_turn>model\n"),
    "turns_no_system": (TURNS, CONVERSATION[1:3], False, "<bos><start_of_turn>user\nu1<end_of_turn>\n<start_of_turn>model\na1<end_of_turn>\n"),
    "only_system": (INST, CONVERSATION[:1], False, ""),
    "empty": (CHATML_ASSISTANT, [], False, "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"),
    "holes": (CHATML, [(None, None), ("user", None)], False, "<|im_start|>\n<|im_end|>\n<|im_start|>user\n<|im_end|>\n"),
    "null": (CHATML_ASSISTANT, None, False, None),
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_public_templates(spark, name):
    template, messages, generation, want = GOLDEN[name]
    table = spark.createDataFrame([(messages,)], MESSAGES)
    assert render_chat(table, template, add_generation_prompt=generation).first()["text"] == want


def test_rules_by_place(spark):
    rules = (
        MessageRule(role="assistant", last=True, before="[", after="]!"),
        MessageRule(first=True, before="^"),
        MessageRule(role="user", before="({role}) "),
    )
    table = spark.createDataFrame([(CONVERSATION[1:] + [("assistant", "end")],)], MESSAGES)
    text = Template(rules, begin="<", end=">", rename=(("user", "U"),)).text(F.col("messages"))
    assert table.select(text).first()[0] == "<^ u1 (U) u2[end]!>"


# Epochs


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1025, 4099])
def test_an_epoch_is_a_permutation(spark, n):
    small, large = halves(n)
    assert n <= small * large < n + 1024
    keys = round_keys(7, 2)
    want = [permuted(i, n, keys) for i in range(n)]
    assert sorted(want) == list(range(n))
    found = spark.range(n).select("id", epoch_place(F.col("id"), n, 7, 2).alias("p")).orderBy("id").collect()
    assert [r["p"] for r in found] == want


def test_epochs_differ_and_mix():
    n = 10_000
    orders = [[permuted(i, n, round_keys(1, e)) for i in range(n)] for e in range(2)]
    for order in orders:
        assert sum(a == b for a, b in zip(order, range(n), strict=True)) < 20
        mean = sum(abs(a - b) for a, b in zip(order, order[1:], strict=False)) / n
        assert 0.3 * n < mean < 0.37 * n
    assert sum(a == b for a, b in zip(*orders, strict=True)) < 20


@pytest.mark.parametrize(("n", "world"), [(10, 4), (12, 4), (3, 8), (1, 3), (1000, 7)])
@pytest.mark.parametrize("drop_last", [False, True])
def test_workers_get_equal_shares(spark, n, world, drop_last):
    df = spark.range(n).withColumnRenamed("id", "pos")
    shards = epoch_shards(df, world, 3, n=n, drop_last=drop_last)
    assert "Exchange" not in plan(shards)
    rows = shards.collect()
    per = n // world if drop_last else -(-n // world)
    assert Counter(r["rank"] for r in rows) == Counter({r: per for r in range(world) if per})
    assert sorted((r["rank"], r["step"]) for r in rows) == [(r, s) for r in range(world) for s in range(per)]
    at = {r["step"] * world + r["rank"]: r["pos"] for r in rows}
    assert len(set(at.values())) == min(n, per * world)
    assert all(at[i] == at[i % n] for i in at)


def test_no_examples_have_no_epoch(spark):
    empty = spark.range(0).withColumnRenamed("id", "pos")
    assert epoch_shards(empty, 3, 0).collect() == []
    with pytest.raises(ValueError, match="world_size"):
        epoch_shards(empty, 0, 0)


# Weighted subsets


def slow_quotas(sizes, size):
    quota = dict.fromkeys(sizes, 0)
    while True:
        free = {c: s for c, (available, s) in sizes.items() if quota[c] < available and s > 0}
        left = size - sum(quota.values())
        if left <= 0 or not free:
            return quota
        part = {c: left * s / sum(free.values()) for c, s in free.items()}
        give = {c: math.floor(x) for c, x in part.items()}
        order = sorted((c for c in free if part[c] > give[c]), key=lambda c: (give[c] - part[c], c is not None, c or ""))
        for c in order[: left - sum(give.values())]:
            give[c] += 1
        for c in free:
            quota[c] = min(quota[c] + give[c], sizes[c][0])


@pytest.mark.parametrize("size", [0, 1, 7, 30, 61, 62, 100])
def test_quotas(spark, size):
    sizes = {None: (5, 3.0), "a": (40, 1.0), "b": (2, 9.0), "c": (15, 0.5), "d": (9, 0.0)}
    table = spark.createDataFrame([(c, *x) for c, x in sizes.items()], "category string, available long, share double")
    found = {r["category"]: r["quota"] for r in apportioned(table, size).collect()}
    assert found == slow_quotas(sizes, size)
    assert sum(found.values()) == min(size, 62)


def draw(name, weight, seed=42):
    u = (int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
    return -math.log(u) / weight


@pytest.mark.parametrize("most", [3, 100_000])
def test_subset_draws_the_smallest_keys(spark, most):
    pick = random.Random(5)
    rows = [(f"r{i}", pick.choice(["a", "b", None]) if i % 3 else "hot", pick.choice([0.5, 1.0, 7.0, 1e9])) for i in range(900)]
    rows += [("zero", "a", 0.0), ("none", "a", None), ("minus", "b", -1.0), ("inf", "b", float("inf"))]
    table = spark.createDataFrame(rows, "id string, category string, weight double").withColumn("key", F.lit("x"))
    found = weighted_subset(table, 333, F.col("weight"), share=F.sqrt("available"), most_at_edge=most)
    assert found.columns == table.columns
    good = defaultdict(list)
    for name, category, weight in rows:
        if weight and 0 < weight < float("inf"):
            good[category].append((draw(name, weight), name))
    quota = slow_quotas({c: (len(x), math.sqrt(len(x))) for c, x in good.items()}, 333)
    want = sorted(name for c, x in good.items() for _, name in sorted(x)[: quota[c]])
    assert sorted(r["id"] for r in found.collect()) == want and len(want) == 333


def test_subset_of_awkward_tables(spark):
    schema = "id string, category string, low long"
    rows = [(None, "a", 1)] * 4 + [("x", "a", 2)] * 3 + [(None, None, 3)]
    table = spark.createDataFrame(rows, schema)
    assert weighted_subset(table, 100).count() == 8
    assert weighted_subset(table, 5).count() == 5
    assert weighted_subset(table, 0).collect() == [] == weighted_subset(spark.createDataFrame([], schema), 3).collect()
    with pytest.raises(ValueError, match="size"):
        weighted_subset(table, -1)


def test_heavy_records_are_drawn_more_often(spark):
    table = spark.range(4000).selectExpr("CAST(id AS string) id", "'c' AS category", "CASE WHEN id % 2 = 0 THEN 9.0D ELSE 1.0D END AS w")
    heavy = weighted_subset(table, 400, F.col("w")).filter("w > 5").count()
    assert 330 <= heavy <= 385

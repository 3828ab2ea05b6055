"""Spark queries, one or more per operator; each reads whole tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views
from promptmill.functions import encoder_from, estimate_tokens, tokens
from promptmill.operators import chat, epochs, evaluate, order, profile, subset, templates
from promptmill.operators import records as rec
from promptmill.plans import (
    PrepareConfig,
    prepare,
    prepare_files,
    training_text,
    write_training_shards,
)
from promptmill.plans import training_blocks as make_blocks
from promptmill.sinks import check_bundle, read_bundle, write_bundle, write_chat, write_sidecar
from promptmill.sinks.writers import write_report
from promptmill.sources import discovery
from promptmill.sources import lines as src
from promptmill.sources.chat import read_chat, read_prompts
from promptmill.staging import scratch_dir, stage

SYSTEM = "Be brief."
WANTED = "EN-Code, fr-general"
SEED = 42
CAP = 100
MAX_LEN = 512
BLOCK = 256
PER_CATEGORY = 5
WORLD = 4
PROMPTS_PER_FILE = 50
EPOCHS, PER_DEVICE, ACCUMULATION = 3, 1, 8
SUBSET, FLATTEN = 40, 0.85
LIMIT_STEP = 16
FORMS = {"chatml_assistant": templates.CHATML_ASSISTANT, "inst": templates.INST, "turns": templates.TURNS}

REPORT_TIME = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]


def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.require_fields(views.records(spark, sf_dir))


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as training text."""
    return chat.render_chat(rec.to_messages(complete(spark, sf_dir), SYSTEM))


def ordered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and token counts of the training text in seeded order, with their running total.

    The text is read and counted once; the order is made from the staged counts.
    """
    counted = stage(chat.with_token_count(rendered(spark, sf_dir)).select("id", "n_tokens"), "counts")
    return in_packing_order(counted)


def in_packing_order(counted: DataFrame) -> DataFrame:
    sized = counted.withColumn("size", chat.packed_size())
    return order.seeded_order(sized, SEED, sums={"offset": "size"})


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "documents")


def flat_messages(df: DataFrame) -> DataFrame:
    return df.select("id", F.posexplode("messages").alias("idx", "m")).select("id", "idx", "m.*")


# Sources


def parse_lines(spark, sf_dir):
    return src.parse_lines(views.lines(spark, sf_dir)).select(
        "id",
        "instruction",
        "output",
        F.try_variant_get("metadata", "$.difficulty", "string").alias("difficulty"),
    )


def quarantine_reasons(spark, sf_dir):
    rejected = src.quarantine(src.tag_lines(views.lines(spark, sf_dir)))
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))


def sniff_shape(spark, sf_dir):
    return discovery.sniff_shape(views.lines(spark, sf_dir), ["conv_id", "turn"])


def discover_sources(spark, sf_dir):
    """Which of the written folders hold records, and how many lines they have."""
    root = scratch_dir(spark, "discover")
    complete(spark, sf_dir).select("id", "instruction", "output").write.json(f"{root}/records")
    views.prompts(spark, sf_dir).write.json(f"{root}/prompts")
    verdicts = discovery.candidate_files(spark, root)
    found = spark.createDataFrame(list(verdicts.items()), "file string, valid boolean")
    lines = spark.read.text(root, recursiveFileLookup=True)
    folder = F.element_at(F.split("file", "/"), -2)
    return (
        lines.groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("n"))
        .join(found, "file")
        .groupBy(folder.alias("folder"), "valid")
        .agg(F.sum("n").alias("n"))
    )


def written_chat(spark: SparkSession, sf_dir: str) -> str:
    """Both splits of the records as chat lines; returns the folder."""
    root = scratch_dir(spark, "chat")
    split = order.split_train_val(stage(complete(spark, sf_dir), "complete"), seed=SEED)
    table = rec.to_messages(split, SYSTEM).select("split", "pos", "messages")
    staged = f"{root}/staged"
    table.write.partitionBy("split").parquet(staged)
    table = spark.read.parquet(staged)
    for name in ("train", "val"):
        write_chat(table.filter(F.col("split") == name), f"{root}/attached/{name}.jsonl")
    return root


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"), F.sum(F.size("messages")).alias("n_msgs"))


def resolve_split(spark, sf_dir):
    """Find the training file one level down, since it is not where it was expected."""
    root = written_chat(spark, sf_dir)
    path = discovery.resolve_split(spark, "train.jsonl", f"{root}/train.jsonl", root)
    return split_sizes(read_chat(spark, path))


def read_chat_splits(spark, sf_dir):
    root = written_chat(spark, sf_dir)
    return split_sizes(read_chat(spark, f"{root}/attached/train.jsonl", f"{root}/attached/val.jsonl"))


def read_prompt_arrays(spark, sf_dir):
    """Prompts written as JSON arrays of 50, one file each, and read back in order."""
    path = scratch_dir(spark, "prompts")
    item = F.struct("ord", F.to_json(F.struct("id", "category", "prompt")).alias("text"))
    arrays = views.prompts(spark, sf_dir).groupBy(F.expr(f"ord div {PROMPTS_PER_FILE}").alias("part"))
    items = F.transform(F.array_sort(F.collect_list(item)), lambda i: i["text"])
    text = F.concat(F.lit("["), F.array_join(items, ",\n"), F.lit("]")).alias("value")
    arrays.agg(text).write.partitionBy("part").text(path)
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("bigint")
    prompts = read_prompts(spark, path, with_file=True)
    return prompts.withColumn("ord", part * PROMPTS_PER_FILE + F.col("ord")).drop("file")


# Records


def require_fields(spark, sf_dir):
    return complete(spark, sf_dir).select("id", "instruction", "input", "output")


def filter_category(spark, sf_dir):
    return rec.filter_category(views.records(spark, sf_dir), WANTED).select("id", "category")


def compose_user(spark, sf_dir):
    return complete(spark, sf_dir).select("id", rec.compose_user().alias("content"))


def to_messages(spark, sf_dir):
    return flat_messages(rec.to_messages(complete(spark, sf_dir), SYSTEM))


def to_messages_no_system(spark, sf_dir):
    return flat_messages(rec.to_messages(complete(spark, sf_dir), ""))


def prompt_messages(spark, sf_dir):
    return flat_messages(rec.prompt_messages(views.prompts(spark, sf_dir), SYSTEM))


def render_chat(spark, sf_dir):
    return rendered(spark, sf_dir).select("id", "text")


def render_prompt(spark, sf_dir):
    asked = rec.prompt_messages(views.prompts(spark, sf_dir), SYSTEM)
    return chat.render_chat(asked, add_generation_prompt=True).select("id", "text")


def select_text(spark, sf_dir):
    text = stage(rendered(spark, sf_dir).select("id", "text"), "text")
    return chat.select_text(order.split_train_val(text, seed=SEED))


def truncate_tokens(spark, sf_dir):
    cut = chat.truncate_tokens(documents(spark, sf_dir), MAX_LEN)
    kept = F.md5(F.array_join("tokens", " ")).alias("kept_md5")
    return cut.select("doc_id", "n", "n_kept", "n_dropped", kept)


def estimate_tokens_query(spark, sf_dir):
    return chat.with_token_count(documents(spark, sf_dir)).select("doc_id", "n_tokens")


def word_counter():
    """A counter of the kind a tokenizer would be plugged in with."""

    @F.pandas_udf("bigint")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.str.count(r"[^ \t\n\r\f]+")

    return count


def token_counter_hook(spark, sf_dir):
    counted = chat.with_token_count(documents(spark, sf_dir), counter=word_counter())
    return counted.select("doc_id", "n_tokens")


def piece_encoder():
    """An encoder of the kind a subword tokenizer is: words in pieces of four characters, ids from their digests."""

    def make():
        word = re.compile(r"[^ \t\n\r\f]+")

        def spans(text):
            cuts = [(i, min(i + 4, m.end())) for m in word.finditer(text) for i in range(m.start(), m.end(), 4)]
            ids = [int(hashlib.md5(text[a:b].encode()).hexdigest()[:7], 16) for a, b in cuts]
            return ids, [a for a, _ in cuts], [b for _, b in cuts]

        return spans

    return encoder_from(make)


def joined_ids(ids: str):
    return F.md5(F.array_join(ids, " ")).alias("ids_md5")


def truncate_ids(spark, sf_dir):
    cut = chat.truncate_encoded(documents(spark, sf_dir).select("doc_id", "text"), piece_encoder(), MAX_LEN)
    return cut.select("doc_id", "n", "n_kept", "n_dropped", "text_end", joined_ids("ids"))


def render_templates(spark, sf_dir):
    """Three public template forms, with a system message and without."""
    records = stage(complete(spark, sf_dir), "complete")
    parts = [
        rec.to_messages(records, prompt).select("id", F.lit(bool(prompt)).alias("system"), F.lit(name).alias("form"), form.text(F.col("messages")).alias("text"))
        for prompt in (SYSTEM, "")
        for name, form in FORMS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Order and split


def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once, since ordering looks at its input twice."""
    return stage(views.records(spark, sf_dir).select("id"), "ids")


def partly_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("conv_id") % 4
    name = F.concat_ws("-", "conv_id", "turn")
    id_ = F.when(turn == 0, None).when(turn == 1, F.lit("same")).otherwise(name)
    return stage(views.records(spark, sf_dir).select(id_.alias("id"), name.alias("name")), "ids")

def seeded_order(spark, sf_dir):
    return order.seeded_order(record_ids(spark, sf_dir), SEED)


def seeded_order_no_id(spark, sf_dir):
    """A quarter of the records without id and a quarter with ids that repeat, told apart by their text."""
    return order.seeded_order(partly_named(spark, sf_dir), SEED, digest=F.md5("name"))


def seeded_order_hot(spark, sf_dir):
    """The same with every id that repeats on the way of those that stand on very many records."""
    return order.seeded_order(partly_named(spark, sf_dir), SEED, digest=F.md5("name"), hot_rows=2)


def cap_examples(spark, sf_dir):
    return order.cap_examples(record_ids(spark, sf_dir), CAP, SEED)


def split_train_val(spark, sf_dir):
    return order.split_train_val(record_ids(spark, sf_dir), seed=SEED)


def assign_shards(spark, sf_dir):
    sharded = order.assign_shards(ordered_text(spark, sf_dir), WORLD)
    return sharded.groupBy("rank").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))


def epoch_shards(spark, sf_dir):
    """Each worker's examples in three epochs, every one in an order of its own."""
    placed = stage(order.seeded_order(record_ids(spark, sf_dir), SEED), "placed")
    n = placed.count()
    runs = [epochs.epoch_shards(placed, WORLD, epoch, SEED, n).withColumn("epoch", F.lit(epoch)) for epoch in range(EPOCHS)]
    return reduce(DataFrame.unionByName, runs).select("epoch", "rank", "step", "pos", "id")


def epoch_shards_dropped(spark, sf_dir):
    placed = stage(order.seeded_order(record_ids(spark, sf_dir), SEED), "placed")
    shards = epochs.epoch_shards(placed, WORLD, epoch=0, seed=SEED, drop_last=True)
    return shards.groupBy("rank").agg(F.count("*").alias("n"), F.countDistinct("pos").alias("n_pos"), F.max("step").alias("last_step"))


def weighted_subset(spark, sf_dir):
    """Records drawn by the length of their answers, out of categories whose shares are flattened."""
    records = complete(spark, sf_dir).select("id", "category", estimate_tokens(F.col("output")).alias("weight"))
    drawn = subset.weighted_subset(records, SUBSET, F.col("weight"), share=F.pow("available", F.lit(FLATTEN)), seed=SEED)
    return drawn.select("id", "category", "weight")


# Profiles


def category_distribution(spark, sf_dir):
    return profile.category_distribution(views.records(spark, sf_dir))


def top_categories(spark, sf_dir):
    return profile.top_categories(
        profile.category_distribution(documents(spark, sf_dir), F.concat_ws("-", "source", "lang"))
    )


def run_counters(spark, sf_dir):
    return prepare(views.lines(spark, sf_dir), PrepareConfig(seed=SEED)).counters


def run_counters_filtered(spark, sf_dir):
    config = PrepareConfig(seed=SEED, category_filter=WANTED, max_examples=CAP, val_split=0.1)
    return prepare(views.lines(spark, sf_dir), config).counters


def prepared_records(spark, sf_dir):
    """The whole preparation: position, split and user text of every record."""
    done = prepare(views.lines(spark, sf_dir), PrepareConfig(seed=SEED, system_prompt=SYSTEM))
    user = F.element_at("messages", -2)["content"]
    return done.records.select("id", "pos", "split", "written", user.alias("user"))


def prepared_categories(spark, sf_dir):
    return prepare(views.lines(spark, sf_dir), PrepareConfig(seed=SEED)).categories


def token_length_profile(spark, sf_dir):
    counted = chat.with_token_count(documents(spark, sf_dir).select("lang", "text")).drop("text")
    p = profile.token_length_profile(counted, ["lang"], MAX_LEN)
    rounded = [F.round(c, 4).alias(c) for c in ("p50", "p90", "mean")]
    return p.select("lang", "n", *rounded, "max", "over")


def balance_categories(spark, sf_dir):
    placed = stage(order.seeded_order(views.records(spark, sf_dir).select("id", "category"), SEED), "placed")
    balanced = profile.balance_categories(placed, PER_CATEGORY)
    return balanced.select("id", "category", F.round("weight", 4).alias("weight"))


def run_sizing(spark, sf_dir):
    split = order.split_train_val(record_ids(spark, sf_dir), seed=SEED)
    return profile.run_sizing(split, EPOCHS, PER_DEVICE, ACCUMULATION, WORLD)


def length_limits(spark, sf_dir):
    """Every limit up to the longest document of each language, and what it costs."""
    counted = chat.with_token_count(documents(spark, sf_dir).select("lang", "text")).drop("text")
    costs = profile.length_limits(counted, ["lang"], epochs=EPOCHS, per_device=PER_DEVICE, accumulation=ACCUMULATION, world_size=WORLD)
    return costs.withColumn("share_cut", F.round("share_cut", 6))


def length_limits_stepped(spark, sf_dir):
    """The same over all documents, at the multiples of a step."""
    counted = chat.with_token_count(documents(spark, sf_dir).select("text")).drop("text")
    costs = profile.length_limits(counted, [], step=LIMIT_STEP, epochs=EPOCHS, per_device=PER_DEVICE, accumulation=ACCUMULATION)
    return costs.withColumn("share_cut", F.round("share_cut", 6))


# Running totals


def conversation_usage(spark, sf_dir):
    return chat.conversation_usage(views.table(spark, sf_dir, "conversations"))


def pack_sequences(spark, sf_dir):
    pieces = chat.pack_sequences(ordered_text(spark, sf_dir), BLOCK, offset="offset")
    return pieces.select("block_id", "id", "start", "place", "length")


def packed_blocks(spark, sf_dir):
    """Blocks of tokens, put together from the pieces."""
    words = rendered(spark, sf_dir).select("id", tokens(F.col("text")).alias("tokens"), F.octet_length("text").alias("n_bytes"))
    counted = stage(words.withColumns({"n_tokens": F.size("tokens").cast("bigint"), "size": F.size("tokens")}), "tokens")
    placed = order.seeded_order(counted, SEED, digest=F.md5("id"), sums={"offset": "size"}, size="n_bytes")
    blocks = chat.packed_blocks(chat.pack_sequences(placed, BLOCK, offset="offset", tokens_col="tokens"))
    return blocks.select(
        "block_id",
        "n_segments",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("tokens", " ")).alias("tokens_md5"),
    )


def pack_by_position(spark, sf_dir):
    """The same pieces from positions alone, with the running total made from chunks."""
    placed = stage(ordered_text(spark, sf_dir).select("id", "pos", "n_tokens"), "placed")
    return chat.pack_sequences(placed, BLOCK).select("block_id", "id", "start", "place", "length")


def packing_report(spark, sf_dir):
    counted = chat.with_token_count(rendered(spark, sf_dir)).select("n_tokens")
    return chat.packing_report(counted, BLOCK)


def training_shards(spark, sf_dir):
    """Chat lines read back, ordered by their text, and written per worker."""
    root = written_chat(spark, sf_dir)
    text = training_text(read_chat(spark, f"{root}/attached/train.jsonl"), seed=SEED)
    write_training_shards(text, f"{root}/shards", WORLD)
    shards = spark.read.json(f"{root}/shards", schema="pos bigint, text string, rank int")
    return shards.select("rank", "pos", "text", estimate_tokens(F.col("text")).alias("n_tokens"))


def training_blocks(spark, sf_dir):
    """Chat lines of both splits read back, ordered, and packed into blocks of tokens."""
    root = written_chat(spark, sf_dir)
    chat_lines = read_chat(spark, f"{root}/attached/train.jsonl", f"{root}/attached/val.jsonl")
    parts = []
    for split in ("train", "validation"):
        blocks = make_blocks(training_text(chat_lines, split, seed=SEED), BLOCK)
        digest = F.md5(F.array_join("tokens", " ")).alias("tokens_md5")
        parts.append(blocks.select(F.lit(split).alias("split"), "block_id", "n_segments", digest))
    return parts[0].unionByName(parts[1])


def encoded_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat lines of both splits read back, encoded, ordered, and packed into blocks of ids."""
    root = written_chat(spark, sf_dir)
    chat_lines = read_chat(spark, f"{root}/attached/train.jsonl", f"{root}/attached/val.jsonl")
    parts = [
        make_blocks(training_text(chat_lines, split, seed=SEED, encoder=piece_encoder()), BLOCK).withColumn("split", F.lit(split))
        for split in ("train", "validation")
    ]
    return parts[0].unionByName(parts[1])


def training_block_ids(spark, sf_dir):
    blocks = encoded_blocks(spark, sf_dir)
    places = F.md5(F.array_join("position_ids", " ")).alias("places_md5")
    return blocks.select("split", "block_id", "n_segments", joined_ids("tokens"), places)


def block_segments(spark, sf_dir):
    """Every example put together again from the blocks and their segments."""
    whole = chat.segment_examples(stage(encoded_blocks(spark, sf_dir), "blocks"), by=("split",))
    return whole.select("split", "pos", F.size("tokens").cast("bigint").alias("n_tokens"), joined_ids("tokens"))


# Evaluation


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(evaluate.eval_results(views.prompts(spark, sf_dir), views.responses(spark, sf_dir), SYSTEM), "results")


def eval_results(spark, sf_dir):
    return results(spark, sf_dir).select("run", "id", "category", "prompt_tokens", "completion_tokens")


def eval_report(spark, sf_dir):
    return evaluate.eval_report(results(spark, sf_dir))


def compare_runs(spark, sf_dir):
    table = results(spark, sf_dir)
    both = evaluate.compare_runs(table.filter("run = 'a'"), table.filter("run = 'b'"))
    return both.select("id", "status", "delta_tokens")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = results(spark, sf_dir).filter("response IS NOT NULL")
    both = evaluate.compare_runs(table.filter("run = 'a'"), table.filter("run = 'b'"))
    return evaluate.answer_changes(both)


def answer_changes(spark, sf_dir):
    """Kept, added and removed words of every answer of both runs."""
    return changes(spark, sf_dir)


def answer_changes_rebuilt(spark, sf_dir):
    """Both answers put together again from the spans."""
    spans = stage(changes(spark, sf_dir), "changes")
    sides = {"before": ("kept", "removed"), "after": ("kept", "added")}
    said = {
        side: F.array_sort(F.collect_list(F.when(F.col("kind").isin(*kinds), F.struct("span", "words"))))
        for side, kinds in sides.items()
    }
    whole = spans.groupBy("id").agg(*[said[side].alias(side) for side in sides])
    return whole.select("id", *[F.md5(F.array_join(f"{side}.words", " ")).alias(f"{side}_md5") for side in sides])


# Sinks


def write_chat_roundtrip(spark, sf_dir):
    root = written_chat(spark, sf_dir)
    table = read_chat(spark, f"{root}/attached/train.jsonl", f"{root}/attached/val.jsonl")
    flat = table.select("split", F.explode("messages").alias("m"))
    return flat.groupBy("split").agg(
        F.count("*").alias("n"), F.sum(F.length("m.content")).alias("n_chars")
    )


def write_sidecar_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "sidecar")
    write_sidecar(prepare(views.lines(spark, sf_dir), PrepareConfig(seed=SEED)).split("train"), path)
    line = F.from_json("value", "id string, pos bigint, metadata variant").alias("m")
    category = F.try_variant_get("m.metadata", "$.category", "string")
    return spark.read.text(path).select(line).select("m.id", "m.pos", category.alias("category"))


def prepare_files_roundtrip(spark, sf_dir):
    """Lines in a file, prepared and written; chat and sidecar lines joined by their position."""
    root = scratch_dir(spark, "prepare")
    views.lines(spark, sf_dir).select("value").write.text(f"{root}/lines.jsonl")
    config = PrepareConfig(seed=SEED, system_prompt=SYSTEM)
    prepare_files(spark, f"{root}/out", f"{root}/lines.jsonl", config=config, ordered=True)
    meta = spark.read.json(f"{root}/out/train_meta.jsonl", schema="id string, pos bigint")
    chat_lines = spark.read.json(f"{root}/out/train.jsonl", schema="pos bigint, messages array<struct<content:string>>")
    user = F.element_at("messages", -2)["content"]
    return meta.join(chat_lines, "pos").select("id", "pos", user.alias("user"))


def bundle(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "bundle")
    done = prepare(views.lines(spark, sf_dir), PrepareConfig(seed=SEED, system_prompt=SYSTEM))
    write_bundle(done.records, done.quarantine, root, ordered=True)
    return root


def write_bundle_roundtrip(spark, sf_dir):
    """All outputs written in one pass; chat and sidecar lines joined by their position."""
    root = bundle(spark, sf_dir)
    meta = read_bundle(spark, root, "train_meta.jsonl").select(F.from_json("value", "id string, pos bigint").alias("m"))
    schema = "pos bigint, messages array<struct<content:string>>"
    said = read_bundle(spark, root, "train.jsonl").select(F.from_json("value", schema).alias("c"))
    joined = meta.select("m.*").join(said.select("c.*"), "pos")
    return joined.select("id", "pos", F.element_at("messages", -2)["content"].alias("user"))


def bundle_manifest(spark, sf_dir):
    """Lines of every output as the manifest has them, and whether the files agree with it."""
    return check_bundle(spark, bundle(spark, sf_dir)).select("file", "n_lines", "ok")


def write_report_roundtrip(spark, sf_dir):
    """Both runs' reports written and read back as lines."""
    path = scratch_dir(spark, "reports")
    sections = evaluate.eval_report(results(spark, sf_dir))
    read = []
    for run in ("a", "b"):
        report = write_report(sections.filter(F.col("run") == run), f"{path}/{run}", f"model {run}", REPORT_TIME)
        lines = spark.read.text(report).select(F.lit(run).alias("run"), "value")
        read.append(lines)
    return (
        read[0]
        .unionByName(read[1])
        .groupBy("run")
        .agg(F.count("*").alias("n_lines"), F.sum(F.length("value")).alias("n_chars"))
    )


QUERIES: dict[str, Query] = {
    "parse_lines": parse_lines,
    "quarantine_reasons": quarantine_reasons,
    "sniff_shape": sniff_shape,
    "discover_sources": discover_sources,
    "resolve_split": resolve_split,
    "read_chat": read_chat_splits,
    "read_prompts": read_prompt_arrays,
    "require_fields": require_fields,
    "filter_category": filter_category,
    "compose_user": compose_user,
    "to_messages": to_messages,
    "to_messages_no_system": to_messages_no_system,
    "prompt_messages": prompt_messages,
    "render_chat": render_chat,
    "render_prompt": render_prompt,
    "select_text": select_text,
    "truncate_tokens": truncate_tokens,
    "estimate_tokens": estimate_tokens_query,
    "token_counter_hook": token_counter_hook,
    "truncate_ids": truncate_ids,
    "render_templates": render_templates,
    "seeded_order": seeded_order,
    "seeded_order_no_id": seeded_order_no_id,
    "seeded_order_hot": seeded_order_hot,
    "cap_examples": cap_examples,
    "split_train_val": split_train_val,
    "assign_shards": assign_shards,
    "epoch_shards": epoch_shards,
    "epoch_shards_dropped": epoch_shards_dropped,
    "weighted_subset": weighted_subset,
    "category_distribution": category_distribution,
    "top_categories": top_categories,
    "run_counters": run_counters,
    "run_counters_filtered": run_counters_filtered,
    "prepared_records": prepared_records,
    "prepared_categories": prepared_categories,
    "token_length_profile": token_length_profile,
    "balance_categories": balance_categories,
    "run_sizing": run_sizing,
    "length_limits": length_limits,
    "length_limits_stepped": length_limits_stepped,
    "conversation_usage": conversation_usage,
    "pack_sequences": pack_sequences,
    "pack_by_position": pack_by_position,
    "packed_blocks": packed_blocks,
    "packing_report": packing_report,
    "training_shards": training_shards,
    "training_blocks": training_blocks,
    "training_block_ids": training_block_ids,
    "block_segments": block_segments,
    "eval_results": eval_results,
    "eval_report": eval_report,
    "compare_runs": compare_runs,
    "answer_changes": answer_changes,
    "answer_changes_rebuilt": answer_changes_rebuilt,
    "write_chat_roundtrip": write_chat_roundtrip,
    "write_sidecar_roundtrip": write_sidecar_roundtrip,
    "prepare_files_roundtrip": prepare_files_roundtrip,
    "write_bundle_roundtrip": write_bundle_roundtrip,
    "bundle_manifest": bundle_manifest,
    "write_report_roundtrip": write_report_roundtrip,
}

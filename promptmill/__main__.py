"""Command line, for spark-submit or ``python -m promptmill``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from promptmill.operators.chat import conversation_usage
from promptmill.operators.evaluate import compare_runs, eval_report, eval_results
from promptmill.operators.profile import top_categories
from promptmill.operators.records import SYSTEM_PROMPT
from promptmill.plans import (
    PrepareConfig,
    prepare_files,
    training_blocks,
    training_text,
    write_training_blocks,
    write_training_shards,
)
from promptmill.sinks import ROWS_PER_FILE, write_report
from promptmill.sources.chat import read_chat, read_prompts


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="promptmill")
    sub = ap.add_subparsers(dest="command", required=True)

    p = sub.add_parser("prepare", help="instruction JSONL to train/val chat JSONL")
    p.add_argument("--input")
    p.add_argument("--input_root", help="folder to look in when --input is not given")
    p.add_argument("--output_dir", required=True)
    p.add_argument("--val_split", type=float, default=PrepareConfig.val_split)
    p.add_argument("--system_prompt", default=SYSTEM_PROMPT)
    p.add_argument("--category_filter")
    p.add_argument("--max_examples", type=int)
    p.add_argument("--seed", type=int, default=PrepareConfig.seed)
    p.add_argument("--ordered", action="store_true", help="write files in seeded order")
    p.add_argument("--bundle", action="store_true", help="write all outputs in one pass, with a manifest")

    p = sub.add_parser("text", help="chat JSONL to rendered training text per worker")
    p.add_argument("--train_file", required=True)
    p.add_argument("--validation_file")
    p.add_argument("--max_seq_length", type=int, help="also write token blocks of at most this length")
    p.add_argument("--packing", action="store_true", help="lay examples end to end in the blocks")
    p.add_argument("--output_dir", required=True)
    p.add_argument("--world_size", type=int, default=1)
    p.add_argument("--rows_per_file", type=int, default=ROWS_PER_FILE)
    p.add_argument("--seed", type=int, default=42)

    p = sub.add_parser("report", help="prompts and responses to a Markdown report")
    p.add_argument("--prompts_file", required=True)
    p.add_argument("--responses", required=True, help="JSONL of id, response")
    p.add_argument("--model", required=True)
    p.add_argument("--system_prompt", default=SYSTEM_PROMPT)
    p.add_argument("--output_dir", required=True)

    p = sub.add_parser("compare", help="two response files against the same prompts")
    p.add_argument("--prompts_file", required=True)
    p.add_argument("--before", required=True)
    p.add_argument("--after", required=True)
    p.add_argument("--output_dir", required=True)

    p = sub.add_parser("usage", help="token usage per reply of a conversations table (Parquet)")
    p.add_argument("--conversations", required=True)
    p.add_argument("--output_dir", required=True)
    return ap


def results(spark: SparkSession, prompts_file: str, responses: str, system_prompt: str = SYSTEM_PROMPT):
    answers = spark.read.schema("id string, response string").json(responses)
    return eval_results(read_prompts(spark, prompts_file), answers, system_prompt)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("promptmill").getOrCreate()
    if args.command == "prepare":
        config = PrepareConfig(
            args.val_split, args.system_prompt, args.category_filter, args.max_examples, args.seed
        )
        done = prepare_files(spark, args.output_dir, args.input, args.input_root, config, args.ordered, args.bundle)
        done.counters.show()
        top_categories(done.categories).show(truncate=False)
        done.quarantine.groupBy("file", "reason").count().show(truncate=False)
    elif args.command == "text":
        chat = read_chat(spark, args.train_file, args.validation_file)
        for split in ("train", "validation") if args.validation_file else ("train",):
            folder = args.output_dir if split == "train" else f"{args.output_dir.rstrip('/')}-{split}"
            text = training_text(chat, split, seed=args.seed)
            write_training_shards(text, folder, args.world_size, args.rows_per_file)
            if args.max_seq_length:
                blocks = training_blocks(text, args.max_seq_length, args.packing)
                write_training_blocks(blocks, f"{folder.rstrip('/')}-blocks", args.world_size)
    elif args.command == "report":
        table = results(spark, args.prompts_file, args.responses, args.system_prompt)
        now = datetime.now(timezone.utc)
        print(write_report(eval_report(table), args.output_dir, args.model, now))
    elif args.command == "compare":
        answered = F.col("response").isNotNull()
        before, after = (
            results(spark, args.prompts_file, path).filter(answered) for path in (args.before, args.after)
        )
        compare_runs(before, after).write.mode("overwrite").json(args.output_dir)
    elif args.command == "usage":
        usage = conversation_usage(spark.read.parquet(args.conversations))
        usage.write.mode("overwrite").parquet(args.output_dir)


if __name__ == "__main__":
    main()

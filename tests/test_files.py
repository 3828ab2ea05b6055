import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from promptmill.__main__ import main
from promptmill.operators.chat import render_chat
from promptmill.operators.evaluate import compare_runs, eval_report, eval_results
from promptmill.plans import (
    PrepareConfig,
    prepare,
    prepare_files,
    training_blocks,
    training_text,
    write_training_shards,
)
from promptmill.sinks import write_chat, write_report, write_sidecar
from promptmill.sources import discovery
from promptmill.sources.chat import read_chat, read_prompts
from promptmill.sources.lines import read_lines, tag_lines


def text_of(path):
    """The part files of a written folder, put together."""
    return "".join(p.read_text("utf-8") for p in sorted(Path(path).glob("part-*")))


def records(n, **extra):
    return [
        {"id": f"r{i}", "instruction": f"ask {i}", "input": "", "output": "" if i % 7 == 0 else f"say é {i}",
         "metadata": {"category": "Code" if i % 2 else "Talk", "estimated_tokens": "abc", "n": i}, **extra}
        for i in range(n)
    ]


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows) + "\n", "utf-8")
    return str(path)


def test_line_ends(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"a":1}\n{"a":2}\r\n{"a":3}\r{"a":4}')
    assert read_lines(spark, str(tmp_path / "a.jsonl")).count() == 4


def test_line_numbers_across_splits(spark, tmp_path):
    rows = ["" if i % 5 == 0 else f"{{bad {i}" if i % 3 == 0 else '{"instruction":"a"}' for i in range(1, 3001)]
    write_lines(tmp_path / "in" / "a.txt", rows)
    write_lines(tmp_path / "in" / "b.txt", ["{}", "{bad b"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = read_lines(spark, str(tmp_path / "in"))
        assert lines.rdd.getNumPartitions() > 3
        done = prepare(lines)
        got = {(r.file.rsplit("/", 1)[-1], r.line_no): r.value for r in done.quarantine.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {**{("a.txt", i): v for i, v in enumerate(rows, 1) if "bad" in v}, ("b.txt", 2): "{bad b"}
    c = done.counters.first()
    assert (c.loaded, c.malformed, c.unusable) == (sum("instr" in v for v in rows) + 1, len(got), 0)


GOOD = json.dumps({"instruction": "a", "output": "b"})


@pytest.mark.parametrize(
    "rows, ok",
    [
        ([GOOD, "", GOOD, GOOD, "{bad"], True),
        ([GOOD, "{bad", GOOD], False),
        (["", "  "], False),
        ([json.dumps({"a": 1})], False),
        ([json.dumps({"messages": []})], True),
        ([GOOD], True),
        (["[1]"], False),
        ([json.dumps({"instruction": None, "output": None})], True),
    ],
)
def test_sniff(spark, tmp_path, rows, ok):
    path = write_lines(tmp_path / "a.jsonl", rows)
    assert discovery.sniff_file(spark, path) is ok


@pytest.mark.parametrize("count", [1, 100])
def test_one_verdict_rule_for_any_number_and_size_of_files(spark, tmp_path, count):
    """The first three lines decide, though they lie in the second split, and a later bad line does not."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    root = tmp_path / "a b"
    for i in range(count - 1):
        write_lines(root / f"{i} + é%20.jsonl", [GOOD] if i % 2 else ["{bad"])
    write_lines(root / "blank-start.jsonl", [""] * 9_000 + [GOOD] * 3 + ["{bad"])
    write_lines(root / "late.jsonl", [GOOD, " " * 9_000, GOOD, "{bad"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        verdicts = {path.rsplit("/", 1)[-1]: ok for path, ok in discovery.candidate_files(spark, str(root)).items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(verdicts) == count + 1
    assert verdicts["blank-start.jsonl"] is True and verdicts["late.jsonl"] is False
    assert all(ok == (int(name.split()[0]) % 2 == 1) for name, ok in verdicts.items() if name[0].isdigit())


def test_sniff_bad_bytes(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"instruction":"\xff","output":"x"}\n')
    assert discovery.sniff_file(spark, str(tmp_path / "a.jsonl")) is False


def test_discovery(spark, tmp_path):
    root = tmp_path / "in"
    with pytest.raises(FileNotFoundError, match="no .json or .jsonl"):
        discovery.discover_sources(spark, str(root))
    write_lines(root / "x" / "config.json", ['{"a": 1}'])
    write_lines(root / "x" / "dataset-metadata.json", [GOOD])
    with pytest.raises(FileNotFoundError, match="config.json"):
        discovery.discover_sources(spark, str(root))
    write_lines(root / "x" / "deep" / "data.json", [GOOD])
    assert discovery.discover_sources(spark, str(root)).endswith("/x/deep/data.json")
    write_lines(root / "other.jsonl", [GOOD])
    with pytest.raises(FileNotFoundError, match="(?s)several.*other.jsonl.*data.json"):
        discovery.discover_sources(spark, str(root))


def test_resolve_split(spark, tmp_path):
    here = write_lines(tmp_path / "train.jsonl", [GOOD])
    root = tmp_path / "in"
    assert discovery.resolve_split(spark, "train.jsonl", here, str(root)) == here
    absent = str(tmp_path / "absent.jsonl")
    with pytest.raises(FileNotFoundError, match="0 matches"):
        discovery.resolve_split(spark, "train.jsonl", absent, str(root))
    write_lines(root / "a" / "train.jsonl", [GOOD])
    assert discovery.resolve_split(spark, "train.jsonl", absent, str(root)).endswith("/in/a/train.jsonl")
    for i in range(3):
        write_lines(root / "b" / "train.jsonl" / f"part-{i}.txt", [GOOD])
    with pytest.raises(FileNotFoundError, match="2 matches"):
        discovery.resolve_split(spark, "train.jsonl", absent, str(root))


def test_resolve_split_of_part_files(spark, tmp_path):
    for i in range(3):
        write_lines(tmp_path / "in" / "b" / "train.jsonl" / f"part-{i}.txt", [GOOD])
    found = discovery.resolve_split(spark, "train.jsonl", str(tmp_path / "none"), str(tmp_path / "in"))
    assert found.endswith("/in/b/train.jsonl")


def test_prompts_keep_their_order(spark, tmp_path):
    items = [{"id": f"p{i}", "category": "c", "prompt": f"ask {i}", "more": 1} for i in (3, 1, 2)]
    (tmp_path / "p.json").write_text(json.dumps(items, indent=2))
    got = read_prompts(spark, str(tmp_path / "p.json")).orderBy("ord").collect()
    assert [(r.ord, r.id, r.prompt) for r in got] == [(0, "p3", "ask 3"), (1, "p1", "ask 1"), (2, "p2", "ask 2")]


def test_chat_files(spark, tmp_path):
    line = json.dumps({"messages": [{"role": "user", "content": "é"}]})
    train = write_lines(tmp_path / "train.jsonl", [line, line])
    absent = str(tmp_path / "val.jsonl")
    assert {r.split for r in read_chat(spark, train, absent).collect()} == {"train"}
    val = write_lines(tmp_path / "val.jsonl", [line])
    rows = read_chat(spark, train, val).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in rows} == {"train": 2, "validation": 1}


def test_prepare_files(spark, tmp_path):
    rows = records(100) + ["{bad", "[1]", "", json.dumps({"messages": []}), {"instruction": "x", "output": "y"}]
    source = write_lines(tmp_path / "in" / "data.jsonl", rows)
    out = str(tmp_path / "out")
    done = prepare_files(spark, out, source, config=PrepareConfig(system_prompt=""), ordered=True)
    c = done.counters.first()
    assert (c.loaded, c.malformed, c.unusable, c.kept) == (102, 1, 1, 102)
    assert c.train + c.val + c.skipped == 102
    assert c.skipped == 16
    assert {(r.line_no, r.reason) for r in done.quarantine.collect()} == {(101, "malformed"), (102, "not_object")}
    train = [json.loads(line) for line in text_of(f"{out}/train.jsonl").splitlines()]
    meta = [json.loads(line) for line in text_of(f"{out}/train_meta.jsonl").splitlines()]
    val = text_of(f"{out}/val.jsonl").splitlines()
    assert (len(train), len(val)) == (c.train, c.val)
    assert "é" in text_of(f"{out}/train.jsonl")
    positions = [m["pos"] for m in meta]
    assert positions == sorted(positions) and len(train) == len(meta)
    for t, m in zip(train, meta):
        user = t["messages"][0]
        assert user["role"] == "user"
        if m["id"] is None:
            assert m["metadata"] == {} and user["content"] == "x"
        else:
            i = int(m["id"][1:])
            assert user["content"] == f"ask {i}"
            assert m["metadata"] == {"category": "Code" if i % 2 else "Talk", "estimated_tokens": "abc", "n": i}


def test_prepare_does_not_depend_on_partitions(spark):
    lines = spark.createDataFrame([(json.dumps(r),) for r in records(300)], "value string")
    config = PrepareConfig(category_filter="code, x", max_examples=60, val_split=0.1)
    a, b = (prepare(df, config) for df in (lines.coalesce(1), lines.repartition(11)))
    assert sorted(map(tuple, a.records.select("id", "pos", "split", "written").collect())) == sorted(
        map(tuple, b.records.select("id", "pos", "split", "written").collect())
    )
    c = a.counters.first()
    assert (c.loaded, c.kept, c.train + c.val + c.skipped) == (300, 150, 60)
    assert a.records.filter("split = 'val'").count() == 6
    assert {r.category: r.n for r in a.categories.collect()} == {"Code": 60}


def test_prepare_nothing(spark):
    done = prepare(spark.createDataFrame([], "value string"))
    assert tuple(done.counters.first()) == (0,) * 7
    assert done.records.count() == 0


def test_ids_pass_through(spark, tmp_path):
    rows = [{"id": 5, "instruction": "a", "output": "b", "metadata": None}, {"instruction": "c", "output": "d"}]
    tagged = tag_lines(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))
    write_sidecar(tagged.withColumn("pos", F.lit(1)), str(tmp_path / "m"), with_pos=False)
    got = [json.loads(line) for line in text_of(tmp_path / "m").splitlines()]
    assert sorted(got, key=str) == [{"id": 5, "metadata": None}, {"id": None, "metadata": {}}]


def test_write_chat_round_trip(spark, tmp_path):
    rows = [(i, [("user", f"q{i}"), ("assistant", 'ä "x"\n')]) for i in range(50)]
    df = spark.createDataFrame(rows, "pos bigint, messages array<struct<role:string,content:string>>").repartition(4)
    write_chat(df, str(tmp_path / "c"), ordered=True)
    back = [json.loads(line)["messages"] for line in text_of(tmp_path / "c").splitlines()]
    assert [m[0]["content"] for m in back] == [f"q{i}" for i in range(50)]
    same = read_chat(spark, str(tmp_path / "c")).select("messages")
    assert same.exceptAll(df.select("messages")).count() == 0 and same.count() == 50


def test_training_shards(spark, tmp_path):
    line = [json.dumps({"messages": [{"role": "user", "content": f"q {i % 30}"}]}) for i in range(90)]
    text = training_text(read_chat(spark, write_lines(tmp_path / "t.jsonl", line)))
    assert sorted((r.pos, r.offset) for r in text.collect()) == [(i, 2 * i + i) for i in range(90)]
    write_training_shards(text, str(tmp_path / "s"), 3, rows_per_file=10)
    back = spark.read.json(str(tmp_path / "s"))
    assert {r["rank"]: r["count"] for r in back.groupBy("rank").count().collect()} == {0: 30, 1: 30, 2: 30}
    assert back.filter("pos % 3 <> rank").count() == 0


NOW = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def evaluation(spark):
    prompts = spark.createDataFrame(
        [(0, "p0", "code", " ask it "), (1, "p1", "talk", "hello"), (2, "p2", "talk", "none")],
        "ord bigint, id string, category string, prompt string",
    )
    answers = spark.createDataFrame(
        [("a", "p1", "hi there"), ("a", "p0", "100% sure\nyes"), ("b", "p1", "hi"), ("b", "p2", "new")],
        "run string, id string, response string",
    )
    return eval_results(prompts, answers, "S")


def test_report(spark, tmp_path):
    results = evaluation(spark)
    counts = {(r.run, r.id): (r.prompt_tokens, r.completion_tokens) for r in results.collect()}
    # <|im_start|>system / S<|im_end|> / <|im_start|>user / prompt words / <|im_start|>assistant
    assert counts[("a", "p1")] == (5, 2)
    assert counts[("a", "p0")] == (7, 3)
    path = write_report(eval_report(results.filter("run = 'a'")), str(tmp_path), "m1", NOW)
    assert path.endswith("/20240102_030405_eval.md")
    assert text_of(path) == (
        "# Eval Report\n\n**Model:** m1\n\n**Generated:** 2024-01-02T03:04:05+00:00\n\n---\n\n"
        "## [code] p0\n\n**Prompt:**  ask it \n\n**Response:**\n\n100% sure\nyes\n\n"
        "*(7 prompt tokens, 3 completion tokens)*\n\n---\n\n"
        "## [talk] p1\n\n**Prompt:** hello\n\n**Response:**\n\nhi there\n\n"
        "*(5 prompt tokens, 2 completion tokens)*\n\n---\n\n"
    )


def test_unanswered_prompts_stay_in_results(spark):
    answered = evaluation(spark).filter("run = 'a' OR run IS NULL")
    assert {r.id for r in answered.collect()} == {"p0", "p1"}


def test_compare(spark):
    results = evaluation(spark)
    got = compare_runs(results.filter("run = 'a'"), results.filter("run = 'b'")).collect()
    assert {r.id: (r.status, r.delta_tokens) for r in got} == {
        "p0": ("removed", None),
        "p1": ("changed", -1),
        "p2": ("added", None),
    }


def test_repeated_ids_are_an_error(spark):
    results = evaluation(spark).filter("run = 'a'")
    with pytest.raises(Exception, match="repeats within a run"):
        compare_runs(results.union(results), results).collect()
    prompts = spark.createDataFrame([(0, "p", "c", "x"), (1, "p", "c", "y")], "ord bigint, id string, category string, prompt string")
    answers = spark.createDataFrame([("p", "z")], "id string, response string")
    with pytest.raises(Exception, match="prompt id repeats: p"):
        eval_results(prompts, answers).collect()


def test_render(spark):
    df = spark.createDataFrame([([("user", "a"), ("assistant", "b")],)], "messages array<struct<role:string,content:string>>")
    text = "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert render_chat(df).first().text == text
    assert render_chat(df, add_generation_prompt=True).first().text == text + "<|im_start|>assistant\n"


def test_command_line(spark, tmp_path, capsys):
    source = write_lines(tmp_path / "in" / "data.jsonl", records(60))
    out = str(tmp_path / "out")
    main(["prepare", "--input_root", str(Path(source).parent), "--output_dir", out, "--val_split", "0.1"])
    assert "Code" in capsys.readouterr().out
    main(["text", "--train_file", f"{out}/train.jsonl", "--output_dir", f"{out}/text", "--world_size", "2"])
    assert set(p.name for p in Path(f"{out}/text").glob("rank=*")) == {"rank=0", "rank=1"}
    prompts = tmp_path / "p.json"
    prompts.write_text(json.dumps([{"id": "p0", "category": "c", "prompt": "ask"}]))
    a, b = (write_lines(tmp_path / f"{n}.jsonl", [{"id": "p0", "response": n}]) for n in "ab")
    main(["report", "--prompts_file", str(prompts), "--responses", a, "--model", "m", "--output_dir", f"{out}/reports"])
    assert len(list(Path(f"{out}/reports").glob("*_eval.md"))) == 1
    main(["compare", "--prompts_file", str(prompts), "--before", a, "--after", b, "--output_dir", f"{out}/diff"])
    assert json.loads(text_of(f"{out}/diff"))["status"] == "changed"
    main(["usage", "--conversations", "/root/testdata/sf0.001/conversations.parquet", "--output_dir", f"{out}/usage"])
    assert spark.read.parquet(f"{out}/usage").count() == 34


def test_chat_line_without_messages_is_an_error(spark, tmp_path):
    write_lines(tmp_path / "c.jsonl", ['{"other": 1}'])
    with pytest.raises(Exception, match="without messages"):
        read_chat(spark, str(tmp_path / "c.jsonl")).collect()


def test_missing_content_is_empty_text(spark):
    kind = "messages array<struct<role:string,content:string>>"
    df = spark.createDataFrame([([("user", None), ("assistant", "x")],)], kind)
    assert render_chat(df).first().text == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"


def test_blocks_with_and_without_packing(spark):
    rows = [(0, "a b c", 3, 0), (1, "d e", 2, 3), (2, "f g h i", 4, 5)]
    text = spark.createDataFrame(rows, "pos bigint, text string, n_tokens bigint, offset bigint")
    packed = {r.block_id: r.tokens for r in training_blocks(text, 4).collect()}
    assert packed == {0: list("abcd"), 1: list("efgh"), 2: list("i")}
    single = {r.block_id: r.tokens for r in training_blocks(text, 3, packing=False).collect()}
    assert single == {0: list("abc"), 1: list("de"), 2: list("fgh")}


def test_rejected_lines_are_written(spark, tmp_path):
    write_lines(tmp_path / "in.jsonl", [GOOD, "{bad", GOOD, "[1]"])
    prepare_files(spark, str(tmp_path / "out"), str(tmp_path / "in.jsonl"))
    rows = spark.read.json(str(tmp_path / "out" / "rejected.jsonl")).collect()
    assert sorted((r.line_no, r.reason) for r in rows) == [(2, "malformed"), (4, "not_object")]

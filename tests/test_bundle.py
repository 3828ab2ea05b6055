"""Outputs written in one pass, their manifest, and counts made while writing."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from promptmill.__main__ import main
from promptmill.plans import PrepareConfig, prepare, prepare_files
from promptmill.plans.prepare import run_counters
from promptmill.sinks import check_bundle, read_bundle, read_manifest, write_bundle
from tests.test_plans import plan


def lines(n=200):
    good = [json.dumps({"id": f"r{i}", "instruction": f"say {i} ä", "output": "o" if i % 7 else "", "metadata": {"k": i}}) for i in range(n)]
    return [*good, "{broken", "[1]", "", '{"instruction": 1}']


@pytest.fixture()
def source(tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(lines()) + "\n", encoding="utf-8")
    return str(path)


def test_bundle_is_what_single_files_are(spark, tmp_path, source):
    config = PrepareConfig(val_split=0.1)
    prepare_files(spark, str(tmp_path / "single"), source, config=config, ordered=True)
    prepare_files(spark, str(tmp_path / "bundle"), source, config=config, ordered=True, bundle=True)
    for name in ("train.jsonl", "val.jsonl", "train_meta.jsonl", "rejected.jsonl"):
        texts = [
            "".join(p.read_text(encoding="utf-8") for p in sorted(Path(folder).glob("part-*")))
            for folder in (tmp_path / "single" / name, tmp_path / "bundle" / f"file={name}")
        ]
        # Rejected lines have no order.
        assert texts[0] == texts[1] if name != "rejected.jsonl" else sorted(texts[0].split("\n")) == sorted(texts[1].split("\n"))
        got = [r.value for r in read_bundle(spark, str(tmp_path / "bundle"), name).collect()]
        assert sorted(got) == sorted(texts[1].splitlines())
    assert all(r.ok for r in check_bundle(spark, str(tmp_path / "bundle")).collect())


def test_order_across_part_files(spark, tmp_path, source, monkeypatch):
    monkeypatch.setattr("promptmill.sinks.writers.ROWS_PER_FILE", 16)
    prepare_files(spark, str(tmp_path / "out"), source, ordered=True, bundle=True)
    parts = sorted((tmp_path / "out" / "file=train.jsonl").glob("part-*"))
    places = [json.loads(line)["pos"] for p in parts for line in p.read_text(encoding="utf-8").splitlines()]
    assert len(parts) > 5 and places == sorted(places)


def test_half_written_bundle_is_refused(spark, tmp_path, source):
    out = str(tmp_path / "out")
    done = prepare_files(spark, out, source, bundle=True)
    counts = {r.file: r.n_lines for r in read_manifest(spark, out).collect()}
    whole = sum(1 for i in range(200) if i % 7)
    assert counts["train.jsonl"] + counts["val.jsonl"] == whole
    assert counts["train_meta.jsonl"] == counts["train.jsonl"] and counts["rejected.jsonl"] == 3

    @F.udf("string")
    def fail(text):
        raise ValueError("lost")

    broken = done.records.withColumn("id_value", F.parse_json(fail(F.lit("1"))))
    with pytest.raises(Exception, match="lost"):
        write_bundle(broken, None, out)
    with pytest.raises(FileNotFoundError, match="no manifest"):
        read_bundle(spark, out, "train.jsonl")
    with pytest.raises(FileNotFoundError, match="no manifest"):
        check_bundle(spark, str(tmp_path / "nowhere"))


def test_changed_and_unknown_outputs_are_found(spark, tmp_path, source):
    out = str(tmp_path / "out")
    prepare_files(spark, out, source, bundle=True)
    part = next(p for p in (tmp_path / "out" / "file=val.jsonl").glob("part-*") if p.stat().st_size)
    part.write_text(part.read_text(encoding="utf-8").replace("say", "yas"), encoding="utf-8")
    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    shutil.rmtree(tmp_path / "out" / "file=train_meta.jsonl")
    ok = {r.file: r.ok for r in check_bundle(spark, out).collect()}
    assert ok == {"train.jsonl": True, "val.jsonl": False, "train_meta.jsonl": False, "rejected.jsonl": True}
    with pytest.raises(FileNotFoundError, match="only rejected.jsonl"):
        read_bundle(spark, out, "test.jsonl")


def test_empty_input(spark, tmp_path):
    done = prepare(spark.createDataFrame([], "value string"))
    assert tuple(done.counters.first()) == (0,) * 7
    table = write_bundle(done.records, done.quarantine, str(tmp_path / "out"))
    assert {r.n_lines for r in table.collect()} == {0}
    assert read_bundle(spark, str(tmp_path / "out"), "train.jsonl").collect() == []
    assert all(r.ok for r in check_bundle(spark, str(tmp_path / "out")).collect())


def test_counters_cost_no_scan(spark, source):
    from promptmill.sources.lines import read_lines

    for config in (PrepareConfig(), PrepareConfig(max_examples=50, category_filter="x")):
        done = prepare(read_lines(spark, source), config)
        assert "Scan" not in plan(done.counters).replace("LocalTableScan", "").replace("Scan ExistingRDD", "")
        assert done.counters.columns == ["loaded", "malformed", "unusable", "kept", "train", "val", "skipped"]
    parsed = prepare(read_lines(spark, source)).counters.first()
    assert (parsed.loaded, parsed.malformed, parsed.unusable, parsed.train + parsed.val + parsed.skipped) == (200, 1, 2, 200)


AGAIN = """
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from promptmill.staging import stage_counted

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()

@F.udf("bigint")
def once(value):
    if TaskContext.get().attemptNumber() == 0 and value == 9:
        raise ValueError("lost")
    return value

table, counts = stage_counted(spark.range(0, 10, 1, 2).select(once("id").alias("id")), "again", {"n": F.count("*")})
assert counts == {"n": 10} and table.count() == 10, counts
print("counted once")
"""


def test_run_again_counts_once():
    """A task that fails after rows of it were counted is run again, and counts once."""
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", AGAIN], cwd=root, capture_output=True, text=True, timeout=120)
    assert "counted once" in done.stdout, done.stderr[-2000:]


def test_counts_over_tables_agree(spark, source):
    from promptmill.sources.lines import read_lines, tag_lines

    tagged = tag_lines(read_lines(spark, source), keep_blank=True)
    done = prepare(read_lines(spark, source), PrepareConfig(val_split=0.1))
    assert run_counters(tagged, done.records).collect() == done.counters.collect()


def test_command_line(spark, tmp_path, source, capsys):
    main(["prepare", "--input", source, "--output_dir", str(tmp_path / "out"), "--bundle"])
    assert read_manifest(spark, str(tmp_path / "out")).count() == 4

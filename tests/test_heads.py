"""Heads of many files: as Spark's reader has the lines, in a number of jobs that does not grow."""

import pytest

from promptmill.sources import discovery
from promptmill.sources.heads import can_open, file_system, read_heads

RECORD = b'{"instruction": "a", "output": "b"}\n'
FILES = {
    "good.jsonl": RECORD * 5,
    "carriage.jsonl": RECORD.replace(b"\n", b"\r") * 2 + RECORD.replace(b"\n", b"\r\n") * 2,
    "late.jsonl": b"\n \n\xe2\x80\x83\n" + RECORD * 3 + b"{broken\n",
    "third.jsonl": RECORD * 2 + b"{broken\n",
    "mark.jsonl": b"\xef\xbb\xbf" + RECORD,
    "bytes.jsonl": RECORD + b'{"instruction": "\xff", "output": "b"}\n',
    "array.json": b"[" + RECORD + b"]",
    "empty.json": b"",
    "blank.json": b"\n\r\n  \n",
    "open end 100%25.jsonl": RECORD.strip(),
    "long.jsonl": b'{"instruction": "' + b"x" * 3_000_000 + b'", "output": ""}\n' + RECORD,
}


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in" / "deep er").mkdir(parents=True)
    for i, (name, content) in enumerate(FILES.items()):
        (tmp_path / "in" / ("deep er" if i % 2 else "") / name).write_bytes(content)
    return str(tmp_path / "in")


def test_heads_are_those_of_sparks_reader(spark, folder):
    paths = discovery._list_files(spark, folder, "*.{json,jsonl}")
    assert can_open(paths)
    # Spark doesn't list files without a byte.
    assert {p.rsplit("/", 1)[-1] for p in paths} == set(FILES) - {"empty.json"}
    paths.append(next(p for p in paths if p.endswith("array.json")).replace("array.json", "deep er/empty.json"))
    ours = {(r.file, r.row, bytes(r.value)) for r in read_heads(spark, paths).collect()}
    assert ours == {(r.file, r.row, bytes(r.value)) for r in discovery._heads(spark, paths).collect()}


def test_verdicts(spark, folder, monkeypatch):
    want = {"good.jsonl", "carriage.jsonl", "late.jsonl", "mark.jsonl", "open end 100%25.jsonl", "long.jsonl"}
    for opens in (True, False):  # by the head reader, then as where only Spark opens the files
        if not opens:
            monkeypatch.setattr(discovery, "can_open", lambda paths: False)
        verdicts = discovery.candidate_files(spark, folder)
        assert {path.rsplit("/", 1)[-1] for path, ok in verdicts.items() if ok} == want
        assert len(verdicts) == len(FILES) - 1


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    """Ten files and two thousand take the same number of jobs."""
    jobs = []
    for n in (10, 2_000):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.jsonl").write_bytes(RECORD if i == 7 else b"x\n")
        paths = discovery._list_files(spark, str(folder), "*.jsonl")
        spark.sparkContext.setJobGroup(f"sniff-{n}", "heads")
        verdicts = discovery.sniff_files(spark, paths)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"sniff-{n}")))
        assert len(verdicts) == n and sum(verdicts.values()) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0


def test_unknown_stores(spark):
    assert not can_open(["viewfs://cluster/a/b.jsonl"]) and can_open(["file:/a/b.jsonl", "file:///c.jsonl"])
    assert file_system("file:///a b/c%20.jsonl")[1] == "/a b/c%20.jsonl"
    assert discovery.sniff_files(spark, []) == {}

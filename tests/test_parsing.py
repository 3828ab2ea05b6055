import json

import pytest
from pyspark.sql import functions as F

from promptmill.functions import WHITESPACE, category_key, category_label, strip
from promptmill.operators.profile import category_distribution
from promptmill.operators.records import (
    filter_category,
    is_complete,
    parse_categories,
    require_fields,
    to_messages,
)
from promptmill.sources.lines import accepted, quarantine, tag_lines


def tagged(spark, *values):
    return tag_lines(spark.createDataFrame([(v,) for v in values], "value string"))


def reasons(spark, *values):
    rows = tagged(spark, *values).select("value", "reason").collect()
    return {r.value: r.reason for r in rows}


def record(**fields):
    return json.dumps({"instruction": "i", "output": "o", **fields}, ensure_ascii=False)


def test_strip_matches_unicode(spark):
    every = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert set(every) == set(WHITESPACE)
    df = spark.createDataFrame([("　\t x y \u0085\n ",), (every + "a" + every,)], "v string")
    assert [r[0] for r in df.select(strip(F.col("v"))).collect()] == ["x y", "a"]


@pytest.mark.parametrize(
    "line",
    ["{bad", "{'a':1}", '{"a":1,}', '{"a":01}', '{"a":1} x', '{"a":1},{"b":2}', '{"a":1}],[2', '{"a":1}}',
     '{"a":NaN}', "]", '{"a":1}]', '{"a":[1]} ]', '{"a":1},', '{"r":1},"x":{"y":1}'],
)
def test_malformed(spark, line):
    assert reasons(spark, line) == {line: "malformed"}


def test_good_and_not_object(spark):
    found = reasons(spark, '{"a":1}', '{"a":[1,{"b":"]"}]}', "[1]", "5", "null", '"x"', '  {"a":1}　')
    assert found == {
        '{"a":1}': None,
        '{"a":[1,{"b":"]"}]}': None,
        "[1]": "not_object",
        "5": "not_object",
        "null": "not_object",
        '"x"': "not_object",
        '  {"a":1}　': None,
    }


def test_blank_lines_are_ignored(spark):
    assert reasons(spark, "", "   ", "　", "\t") == {}


def test_invalid_utf8(spark):
    lines = spark.createDataFrame([(b'{"a":"\xff"}',)], "b binary").select(F.col("b").cast("string").alias("value"))
    assert [r.reason for r in tag_lines(lines).collect()] == ["bad_encoding"]


def test_last_of_repeated_keys_wins(spark):
    rows = accepted(tagged(spark, '{"instruction":"a","instruction":"b","output":"o"}')).collect()
    assert rows[0].instruction == "b"


@pytest.mark.parametrize("value", [None, "", "  ", 0, 0.0, -0.0, False, [], {}])
def test_empty_values_become_empty_text(spark, value):
    rows = accepted(tagged(spark, record(instruction=value))).withColumn("ok", is_complete()).collect()
    assert [(r.instruction, r.ok) for r in rows] == [("", False)]


@pytest.mark.parametrize("value", [5, 0.5, True, [0], [None], {"a": None}])
def test_other_types_are_set_aside(spark, value):
    assert [r.reason for r in quarantine(tagged(spark, record(output=value))).collect()] == ["bad_type"]


def test_metadata_that_is_no_object(spark):
    assert set(reasons(spark, record(metadata="x"), record(metadata=[1])).values()) == {"bad_type"}
    assert set(reasons(spark, record(metadata=None), record(metadata={})).values()) == {None}


def test_categories(spark):
    df = accepted(
        tagged(
            spark,
            record(id="missing", metadata={}),
            record(id="none"),
            record(id="null", metadata={"category": None}),
            record(id="space", metadata={"category": " Code"}),
            record(id="upper", metadata={"category": "CODE"}),
        )
    )
    counts = {r.category: r.n for r in category_distribution(df, category_label()).collect()}
    assert counts == {"unknown": 2, None: 1, " Code": 1, "CODE": 1}
    kept = filter_category(df, "code", category_key()).collect()
    assert [r.id for r in kept] == ["upper"]
    assert {r.id for r in filter_category(df, "code,", category_key()).collect()} == {"upper", "missing", "none", "null"}
    assert filter_category(df, "", category_key()).count() == 5


def test_parse_categories():
    assert parse_categories(None) is None
    assert parse_categories("") is None
    assert parse_categories(" B, a ,") == ["", "a", "b"]


def test_messages(spark):
    rows = [("a", " do ", "", "done"), ("b", "do", " this\n", "done"), ("c", "do", None, " "), ("d", None, "x", "y")]
    df = require_fields(spark.createDataFrame(rows, "id string, instruction string, input string, output string"))
    with_system = {r.id: r.messages for r in to_messages(df, "S").collect()}
    assert [tuple(m) for m in with_system["a"]] == [("system", "S"), ("user", "do"), ("assistant", "done")]
    assert with_system["b"][1].content == "do\n\nthis"
    assert set(with_system) == {"a", "b"}
    assert [len(r.messages) for r in to_messages(df, "").collect()] == [2, 2]


def test_lines_of_any_length_and_deep_ones(spark):
    long = '{"instruction":"' + "x" * 21_000_000 + '","output":"y"}'
    deep = '{"instruction":"a","output":"b","metadata":{"m":' + "[" * 1200 + "]" * 1200 + "}}"
    rows = tag_lines(spark.createDataFrame([(long,), (deep,)], "value string")).select("reason", F.length("instruction").alias("n")).collect()
    assert {r.n for r in rows if r.reason is None} == {21_000_000} and {r.reason for r in rows} == {None, "too_deep"}


def test_many_brackets_side_by_side_are_not_deep(spark):
    flat = '{"instruction":"a","m":[' + ",".join(["[]"] * 1200) + "], x}"
    quoted = '{"instruction":"' + "[" * 1500 + '\\"' + '", x}'
    deep = "[" * 1200 + "x" + "]" * 1200
    rows = tag_lines(spark.createDataFrame([(flat, 1), (quoted, 2), (deep, 3)], "value string, i int")).select("i", "reason").collect()
    assert {r.i: r.reason for r in rows} == {1: "malformed", 2: "malformed", 3: "too_deep"}

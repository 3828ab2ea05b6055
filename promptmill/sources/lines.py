"""Instruction records from JSON lines: strict parsing, with rejects kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions.fields import configure, field, once, text_value
from promptmill.functions.text import WHITESPACE_SQL

RECORD_COLUMNS = ["id", "id_value", "instruction", "input", "output", "metadata", "digest", "n_bytes"]


# Where a line stands: file, start of the split it was read in, running id within the split.
PLACE = ["file", "split_start", "row"]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files as ``file, split_start, row, value``.

    One task reads a split in file order, so ``row`` counts up along it;
    :func:`number_lines` makes line numbers from that.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def number_lines(rows: DataFrame, every_line: DataFrame) -> DataFrame:
    """Add ``line_no`` to ``rows``, some of the lines of ``every_line``.

    A line's number is the lines in the file's earlier splits, plus its place in
    its own. Both must come from one staged copy of the lines, so that the splits
    are the same.
    """
    splits = every_line.groupBy("file", "split_start").agg(
        F.count("*").alias("_lines"), F.min("row").alias("_first")
    )
    offsets = splits.selectExpr(
        "file",
        "split_start",
        """coalesce(sum(_lines) OVER (PARTITION BY file ORDER BY split_start
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - _first + 1 AS _shift""",
    )
    return (
        rows.join(offsets, ["file", "split_start"])
        .withColumn("line_no", F.col("row") + F.col("_shift"))
        .drop("split_start", "row", "_shift")
    )


# The parser's own limits are lifted for text and numbers; it goes as deep as this.
DEEPEST = 1_000


def parsed_json(text: str) -> str:
    """SQL: the VARIANT of a JSON text of any length, NULL if it is not JSON."""
    options = """map('maxStringLen', '2147483647', 'maxNumLen', '2147483647',
        'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"""
    return f"from_json({text}, 'variant', {options})"


def in_array(line: str) -> str:
    return parsed_json(f"concat('[', {line}, ']')")


def is_single_value(line: str, wrapped: str) -> str:
    """SQL: the line is one JSON value and nothing else.

    The parser ignores what follows the first complete value. Inside brackets, a
    second value shows as a second element, and any other rest is an error unless
    the line itself closes the bracket; such lines must also fit inside braces.
    """
    in_object = parsed_json(f"""concat('{{"r":', {line}, '}}')""")
    return f"""{wrapped} IS NOT NULL AND try_variant_get({wrapped}, '$[1]', 'variant') IS NULL
        AND CASE WHEN contains({line}, ']') THEN {in_object} IS NOT NULL ELSE true END"""


def nesting(line: Column) -> Column:
    """How deep the brackets of a JSON text lie in each other, those inside strings left out."""
    bare = F.regexp_replace(F.regexp_replace(line, r"(?s)\\.", ""), '"[^"]*"', "")
    brackets = F.split(F.regexp_replace(bare, r"[^\[\]{}]+", ""), "")

    def step(at: Column, bracket: Column) -> Column:
        now = at["now"] + F.when(bracket.isin("[", "{"), 1).when(bracket.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(at["most"], now).alias("most"))

    return F.aggregate(brackets, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda at: at["most"])


def tag_lines(lines: DataFrame, value: str = "value", keep_blank: bool = False) -> DataFrame:
    """Parse every non-blank line once and say why it was rejected, if it was.

    Adds ``id, id_value, instruction, input, output, metadata, digest, n_bytes``
    and ``reason``: NULL for a good record, else ``bad_encoding``, ``malformed``,
    ``too_deep`` (brackets nested 1,000 deep and not parsed), ``not_object`` or ``bad_type``. With ``keep_blank`` blank lines stay, as
    ``blank``, so that lines can be numbered.
    """
    configure(lines.sparkSession)
    texts = ["instruction", "input", "output"]
    found = once(lines, _line=f"btrim(`{value}`, {WHITESPACE_SQL})")
    found = found if keep_blank else found.filter("_line <> ''")
    single = once(once(found, _wrapped=in_array("_line")), _single=is_single_value("_line", "_wrapped"))
    record = "CASE WHEN _single AND startswith(_line, '{') THEN try_variant_get(_wrapped, '$[0]', 'variant') END"
    fields = once(
        once(single, _record=record),
        id=field("_record", "id", "string"),
        id_value=field("_record", "id"),
        metadata=field("_record", "metadata"),
        digest="md5(_line)",
        n_bytes="octet_length(_line)",
        **{f"_{name}": field("_record", name) for name in texts},
    )
    typed = once(
        fields,
        **{name: text_value(f"_{name}") for name in texts},
        _usable="coalesce(schema_of_variant(metadata) RLIKE '^(OBJECT<|VOID$)', true)",
    )
    # Few lines have so many brackets; only theirs are followed one by one.
    many = F.expr(f"NOT _single AND length(_line) - length(translate(_line, '[{{', '')) >= {DEEPEST - 1}")
    deep = F.when(many, nesting(F.col("_line")) >= DEEPEST - 1).otherwise(False)
    reason = F.expr("""CASE
        WHEN _line = '' THEN 'blank'
        WHEN NOT is_valid_utf8(_line) THEN 'bad_encoding'
        WHEN _deep THEN 'too_deep'
        WHEN NOT _single THEN 'malformed'
        WHEN _record IS NULL THEN 'not_object'
        WHEN instruction IS NULL OR input IS NULL OR output IS NULL OR NOT _usable THEN 'bad_type'
        END""")
    return typed.withColumn("_deep", deep).withColumn("reason", reason).select(*lines.columns, *RECORD_COLUMNS, "reason")


def accepted(tagged: DataFrame) -> DataFrame:
    """The good records of :func:`tag_lines`."""
    return tagged.filter(F.col("reason").isNull()).select(*RECORD_COLUMNS)


def quarantine(tagged: DataFrame, value: str = "value") -> DataFrame:
    """The rejected lines: raw text and reason, with file and line number if ``tagged`` has all lines of files."""
    rejected = tagged.filter("reason <> 'blank'")
    if set(PLACE) <= set(tagged.columns):
        rejected = number_lines(rejected.select(*PLACE, value, "reason"), tagged.select(*PLACE))
        return rejected.select("file", "line_no", value, "reason")
    return rejected.select(*[c for c in ("file",) if c in tagged.columns], value, "reason")


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Good records only; use :func:`tag_lines` to keep the rejects."""
    return accepted(tag_lines(lines, value))

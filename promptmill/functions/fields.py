"""Reading open JSON records held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions.text import WHITESPACE_SQL


def configure(spark: SparkSession) -> None:
    """Session settings the parsing rules rely on; set when a plan is built,
    since the caller owns the session."""
    # A repeated key keeps its last value instead of failing the line.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def once(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns (SQL expressions) that later filters must not compute again.

    A filter on a plain computed column is moved below it and repeats its
    expression; it is not moved below a generated row.
    """
    fields = ", ".join(f"{sql} AS `{name}`" for name, sql in columns.items())
    return df.selectExpr("*", f"inline(array(struct({fields})))")


def field(record: str, name: str, kind: str = "variant") -> str:
    """SQL for a field of a VARIANT. As VARIANT it is SQL NULL when the key is
    missing, and a VARIANT null for a JSON null."""
    return f"try_variant_get({record}, '$.{name}', '{kind}')"


def text_value(value: str) -> str:
    """SQL for the stripped text of a field's VARIANT.

    Missing, null and empty values of any type (``0``, ``false``, ``[]``, ``{}``)
    give ``''``; a value that is neither text nor empty gives NULL.
    """
    kind, text = f"schema_of_variant({value})", f"try_variant_get({value}, '$', 'string')"
    return f"""CASE
        WHEN {value} IS NULL THEN ''
        WHEN {kind} = 'STRING' THEN btrim({text}, {WHITESPACE_SQL})
        WHEN {kind} IN ('VOID', 'OBJECT<>') THEN ''
        WHEN {kind} = 'ARRAY<VOID>' AND {text} = '[]' THEN ''
        WHEN {kind} = 'BOOLEAN' AND {text} = 'false' THEN ''
        WHEN {kind} RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)' AND try_cast({text} AS DOUBLE) = 0 THEN ''
        END"""


def category_label(metadata: str = "metadata") -> Column:
    """Category as counted: ``unknown`` when the key is missing, NULL for a JSON null."""
    missing = f"{field(metadata, 'category')} IS NULL"
    return F.expr(f"CASE WHEN {missing} THEN 'unknown' ELSE {field(metadata, 'category', 'string')} END")


def category_key(metadata: str = "metadata") -> Column:
    """Category as filtered: ``''`` when missing or null."""
    return F.expr(f"coalesce({field(metadata, 'category', 'string')}, '')")

"""Views over the test tables that have the shape of the operators' inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions import configure

NEIGHBOUR_CHUNK = 4_096

# Which conversations have damaged lines, and how. First fit wins.
CUT, TRAILING, WRAPPED = 13, 17, 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_neighbours(conversations: DataFrame, chunk: int = NEIGHBOUR_CHUNK) -> DataFrame:
    """Add role and text of the turn before and after.

    Turns are numbered without gaps. A conversation is cut into chunks of turns,
    and the rows at a cut are also sent to the chunk next door, so that a
    conversation of any length spreads over many groups.
    """
    homes = f"array_distinct(array(turn div {chunk}, greatest(turn - 1, 0) div {chunk}, (turn + 1) div {chunk}))"
    rows = conversations.selectExpr("*", f"explode({homes}) AS home")
    over = "OVER (PARTITION BY conv_id, home ORDER BY turn)"
    sides = [
        f"{way}({col}) {over} AS {prefix}{col}"
        for way, prefix in (("lag", "p"), ("lead", "n"))
        for col in ("role", "text")
    ]
    return rows.selectExpr("*", *sides).filter(f"home = turn div {chunk}").drop("home")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instruction record per user turn; the answer is the assistant turn that follows."""
    return spark.sql(
        """
        SELECT concat('C', conv_id, '-', turn) AS id,
               t.text AS instruction,
               CASE WHEN prole = 'system' THEN ptext ELSE '' END AS input,
               CASE WHEN nrole = 'assistant' THEN ntext END AS output,
               lang AS language,
               CASE WHEN conv_id % 11 <> 0
                    THEN concat(upper(lang), '-', CASE WHEN conv_id % 3 = 0 THEN 'Code' ELSE 'General' END)
               END AS category,
               source AS topic,
               CASE quality WHEN 1 THEN 'Advanced' WHEN 0 THEN 'Basic' ELSE 'Unrated' END AS difficulty,
               conv_id, turn
        FROM {turns} t
        LEFT JOIN {documents} d ON d.doc_id = t.conv_id
        LEFT JOIN {labels} l ON l.doc_id = t.conv_id
        WHERE role = 'user'
        """,
        turns=with_neighbours(table(spark, sf_dir, "conversations")),
        documents=table(spark, sf_dir, "documents"),
        labels=table(spark, sf_dir, "labels"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as JSON text, some of it damaged."""
    text = """to_json(struct(id, instruction, input, output,
        struct(language, category, topic, difficulty) AS metadata)) AS value"""
    damaged = f"""CASE
        WHEN conv_id % {CUT} = 0 THEN substring(value, 1, length(value) div 2)
        WHEN conv_id % {TRAILING} = 0 THEN concat(value, ' x')
        WHEN conv_id % {WRAPPED} = 0 THEN concat('[', value, ']')
        ELSE value END AS value"""
    return (
        records(spark, sf_dir)
        .selectExpr("conv_id", "turn", text)
        .selectExpr("conv_id % 5 AS file", "conv_id", "turn", damaged)
    )


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("ord"),
        F.concat(F.lit("p"), "item_id").alias("id"),
        F.concat(F.lit("cat"), F.col("item_id") % 7).alias("category"),
        F.col("text").alias("prompt"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of two runs, ``a`` and ``b``; each leaves some prompts out, and some answers differ."""
    run, ord_ = F.col("run"), F.col("ord")
    asked = (
        prompts(spark, sf_dir)
        .select("id", "ord", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("run"))
        .filter(~((run == "a") & (ord_ % 10 == 1)) & ~((run == "b") & (ord_ % 10 == 2)))
        .withColumn("doc_id", ord_ + F.when((run == "b") & (ord_ % 3 == 0), 1).otherwise(0))
    )
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("response"))
    return asked.join(d, "doc_id").select("run", "id", "response")

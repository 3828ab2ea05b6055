"""The training corpus pipeline: stages over ``documents``, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All
but the last return the columns of ``docs``, extra ones included. Empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptmill.llm.language_id import fit_languages, label_languages
from promptmill.llm.mixing import estimated_tokens, mix, topic_of
from promptmill.llm.packing import Capacity, pack_best_fit
from promptmill.llm.repeats import remove_repeats
from promptmill.llm.shipping import shipped
from promptmill.llm.simhash import simhash_groups
from promptmill.llm.tokenizing import token_pieces
from promptmill.staging import stage

LEAST_SCORE = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def plain_names(apply: Callable) -> Callable:
    """Columns that the stages don't know go under names of no meaning meanwhile, so that no operator takes one for its own."""

    @wraps(apply)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        hidden = {c: f"extra{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = apply(spark, docs.withColumnsRenamed(hidden), sf_dir)
        return out.withColumnsRenamed({plain: c for c, plain in hidden.items()})

    return run


@shipped
@plain_names
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go, NULL texts among them, and those of which no language has half.

    A missing ``lang`` is filled with the prediction. Without any labelled row nothing can be
    predicted, and only texts without a letter go.
    """
    lettered = docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    model = fit_languages(docs, F.lit(True))
    if not model.languages:
        return lettered
    named = label_languages(docs, model).filter(
        (F.col("_language.lang") != "und") & (F.col("_language.score") >= LEAST_SCORE)
    )
    return named.withColumn("lang", F.coalesce("lang", "_language.lang")).select(*docs.columns)


@shipped
@plain_names
def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays.

    Rows without doc_id are in no group and stay. Of the rows with this doc_id only those stay whose own
    text is in the group, one for each fingerprint: that of the smallest text.
    """
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    groups = stage(simhash_groups(keyed, words=4, radius=4, carry=["text_key"]), "groups")
    heads = groups.filter("doc_id = component_id").groupBy("doc_id", "text_key", "bits").agg(F.count("*").alias("rows"))
    kept = keyed.join(heads, ["doc_id", "text_key"])
    several = heads.groupBy("doc_id", "bits").agg(F.sum("rows").alias("rows")).filter("rows > 1")
    if several.limit(1).count():  # else every row is the first of its fingerprint
        order = Window.partitionBy("doc_id", "bits").orderBy("text", *[F.col(c) for c in docs.columns if c in COLUMNS[2:]])
        kept = kept.withColumn("row", F.row_number().over(order)).filter("row = 1")
    return kept.select(*docs.columns).union(docs.filter("doc_id IS NULL"))


@shipped
@plain_names
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur again are cut out, in whole characters; ``n_chars`` follows.

    Documents of which no more than white space is left go; texts without a repeat stay as they are.
    """
    found = remove_repeats(docs, length=200, characters=True)
    cut = F.size("_repeats.spans") > 0
    text = F.when(cut, F.decode("_repeats.kept", "UTF-8")).otherwise(F.col("text"))
    left = found.withColumns({"text": text, "_cut": cut})
    chars = F.when(F.col("_cut"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    blank = F.col("_cut") & (F.length(F.trim(F.col("text"))) == 0)
    return left.filter(~blank).withColumn("n_chars", chars).select(*docs.columns)


@shipped
@plain_names
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources, languages and topics are drawn towards even shares; three quarters of the tokens stay."""
    by = {"source": F.col("source"), "language": F.col("lang"), "topic": topic_of(F.col("text"))}
    return mix(docs, by, estimated_tokens(F.col("text"))).filter("_mix.sampled").select(*docs.columns)


@shipped
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in sequences of 1,024 tokens, with the digest of its ids."""
    pieces = token_pieces(docs.select("doc_id", "text"), length=1024, end_id=2)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_best_fit(digests, Capacity(tokens=1024))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing to target weights", mixing),
    ("best-fit packing", packing),
]
ORACLE_SQL = None  # tokenizers, Viterbi and suffix matches are beyond SQL; tests/llm compares the operators with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs

"""The queries of this subpackage over the test tables. Only the columns an operator needs are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.ann_tree import nearest_neighbours
from promptmill.llm.bit_clusters import cluster_vectors
from promptmill.llm.embedding_dedup import near_vectors
from promptmill.llm.language_id import fit_languages, label_languages
from promptmill.llm.mixing import estimated_tokens, mix, topic_of
from promptmill.llm.packing import Capacity, pack_best_fit
from promptmill.llm.repeats import remove_repeats
from promptmill.llm.sharding import minimax_shards
from promptmill.llm.shipping import shipped
from promptmill.llm.simhash import simhash_groups
from promptmill.llm.spelling import spelling_variants, word_counts
from promptmill.llm.token_counts import context_limits, length_histogram
from promptmill.llm.tokenizing import token_pieces
from promptmill.llm.toxicity import fit_toxicity, score_toxicity
from promptmill.llm.url_reputation import Rule, host_of, judge_urls

RULES = [
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = nearest_neighbours(vectors, F.col("vec_id") % 100 == 0, k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score", "leaves")


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), threshold=0.9)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), length=1024, end_id=2)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack_best_fit(digests, Capacity(tokens=1024)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("text").alias("group"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return minimax_shards(rows, 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = fit_languages(docs, ~held_out)
    return label_languages(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), F.col("_language.lang").alias("lang_pred"), "_language.score"
    )


def url_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose number ends its path; it is bad if that one is toxic or of low quality."""
    number = F.regexp_extract("url", r"://[^/?#]*/[a-z]+/([0-9]+)", 1)
    numbered = table(spark, sf_dir, "pages").select("url", number.alias("n"))
    shown = numbered.selectExpr("url", "try_cast(n AS bigint) AS doc_id")
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)
    labels = table(spark, sf_dir, "labels").filter("toxic is not null or quality is not null").select("doc_id", bad.alias("bad"))
    return shown.join(labels, "doc_id").select(host_of(F.col("url")).alias("host"), "bad")


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, url_outcomes(spark, sf_dir), RULES).select("page_id", "host", "path", "rule", "verdict")


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)
    return found.select(
        "doc_id",
        "_repeats.n_bytes",
        (F.col("_repeats.n_bytes") - F.length("_repeats.kept")).alias("n_removed"),
        F.size("_repeats.spans").cast("bigint").alias("n_spans"),
        F.sha2("_repeats.kept", 256).alias("kept_sha256"),
    )


def mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    sized = docs.select(
        "doc_id", "lang", "source", topic_of(F.col("text")).alias("topic"), estimated_tokens(F.col("text")).alias("tokens")
    )
    by = {"source": F.col("source"), "language": F.col("lang"), "topic": F.col("topic")}
    return mix(sized, by, F.col("tokens")).select(
        "doc_id",
        "_mix.source",
        "_mix.language",
        "_mix.topic",
        "tokens",
        F.round("_mix.probability", 6).alias("probability"),
        "_mix.sampled",
    )


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash_groups(docs, words=4, radius=4)
    hexed = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_limits(length_histogram(table(spark, sf_dir, "documents").select("text")))


def spelled_words(docs: DataFrame) -> DataFrame:
    """``word``: each run of seven letters or more, one letter short where its hash with the id says so.

    A row without doc_id hashes as one with an empty id. Shorter runs can't become words of seven letters.
    """
    runs = F.regexp_extract_all("text", F.lit("[A-Za-z\u00C0-\u00FF]{7,}"), F.lit(0))
    lowered = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", lowered.alias("run"))
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hashed = runs.withColumn("h", F.crc32(F.concat(number, F.lit(":"), "run").cast("binary")))
    place = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    return hashed.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))


def spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelled_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling_variants(word_counts(words, least_length=7, least_count=2), ratio=10)


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


_ALL = {
    "op1_nearest_vectors": nearest_vectors,
    "op2_embedding_near_dedup": embedding_near_dedup,
    "op3_best_fit_packing": best_fit_packing,
    "op4_minimax_sharding": minimax_sharding,
    "op5_language_id": language_id,
    "op6_url_filters": url_filters,
    "op7_suffix_array_dedup": suffix_array_dedup,
    "op8_mixing_weights": mixing_weights,
    "op9_simhash_near_dedup": simhash_near_dedup,
    "op10_token_counts": token_counts,
    "op11_spelling_variants": spelling_groups,
    "op12_centroid_clusters": centroid_clusters,
    "op13_toxicity": toxicity,
}

QUERIES = {name: shipped(query) for name, query in _ALL.items()}

"""Chat records to ordered, counted training text and per-worker shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.functions.encoding import Encoder
from promptmill.functions.text import estimate_tokens, tokens
from promptmill.operators.chat import (
    TokenCounter,
    pack_sequences,
    packed_blocks,
    render_chat,
    select_text,
    with_segments,
    with_token_count,
)
from promptmill.operators.order import assign_shards, seeded_order
from promptmill.operators.templates import CHATML, Template
from promptmill.sinks.writers import ROWS_PER_FILE, write_shards
from promptmill.staging import stage


def training_text(
    chat: DataFrame,
    split: str = "train",
    seed: int = 42,
    template: Template = CHATML,
    counter: TokenCounter = estimate_tokens,
    encoder: Encoder | None = None,
) -> DataFrame:
    """``pos, text, n_tokens, offset`` of one split, in seeded order, staged.

    Rendering and counting happen once, before the order is made. ``offset`` is
    the number of tokens before the example, ready for packing. With an ``encoder`` the
    text is encoded there and then: ``encoding`` holds the ids with their places in the
    text, and the counts are those of the ids.
    """
    rendered = select_text(render_chat(chat.filter(F.col("split") == split), template), keep=())
    n_bytes = F.octet_length("text")
    if encoder:
        sized = rendered.withColumn("encoding", encoder(F.col("text")))
        sized, n_bytes = sized.withColumn("n_tokens", F.size("encoding").cast("bigint")), n_bytes + 12 * F.size("encoding")
    else:
        sized = with_token_count(rendered, counter=counter)
    ordered = seeded_order(
        stage(sized.withColumn("n_bytes", n_bytes), "text"),
        seed,
        id_col="text",
        digest=F.md5("text"),
        sums={"offset": "n_tokens"},
        size="n_bytes",
    )
    return stage(ordered.drop("n_bytes"), "ordered-text")


def _laid(text: DataFrame) -> DataFrame:
    """``pos, n_tokens, offset, tokens``: the ids if the text was encoded, else its words."""
    if "encoding" in text.columns:
        return text.select("pos", "n_tokens", "offset", F.col("encoding.id").alias("tokens"))
    words = F.coalesce(tokens(F.col("text")), F.array().cast("array<string>"))
    # Words placed by counts of something else would overlap or get lost.
    wrong = F.raise_error(F.lit("token counts are not those of the words: give training_text an encoder, not a counter"))
    agreed = F.when(F.size("tokens") == F.col("n_tokens"), F.col("tokens")).otherwise(wrong.cast("array<string>"))
    return text.select("pos", "n_tokens", "offset", words.alias("tokens")).withColumn("tokens", agreed)


def training_blocks(text: DataFrame, max_seq_length: int = 2048, packing: bool = True) -> DataFrame:
    """``block_id, n_segments, tokens, segments, position_ids`` from :func:`training_text`: what a trainer takes in at once.

    With ``packing`` the examples are laid end to end and cut after every
    ``max_seq_length`` tokens; without, each example is a block, cut there. Tokens are ids if the
    text was encoded, else words; words that were counted in another way are an error.
    ``segments`` say which part of which example stands where, and positions begin anew in each.
    """
    if max_seq_length < 1:
        raise ValueError("max_seq_length must be positive")
    laid = _laid(text)
    if packing:
        return packed_blocks(pack_sequences(laid, max_seq_length, offset="offset", tokens_col="tokens"), order="pos")
    cut = laid.select("pos", F.slice("tokens", 1, max_seq_length).alias("tokens"))
    zero, n = F.lit(0).cast("bigint"), F.size("tokens").cast("bigint")
    part = F.struct("pos", zero.alias("start"), zero.alias("place"), n.alias("length"))
    blocks = cut.select(F.col("pos").alias("block_id"), F.lit(1).cast("bigint").alias("n_segments"), "tokens", F.array(part).alias("_parts"))
    return with_segments(blocks, "_parts").drop("_parts")


def write_training_blocks(blocks: DataFrame, path: str, world_size: int, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Blocks as JSON lines, dealt to workers in turn, in order below ``rank=<r>``; one file per worker and cut."""
    dealt = assign_shards(blocks.withColumnRenamed("block_id", "pos"), world_size)
    write_shards(dealt, path, rows_per_file, columns=("pos", "tokens", *[c for c in ("segments",) if c in blocks.columns]))


def write_training_shards(
    text: DataFrame, path: str, world_size: int, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write each worker's share of the ordered text."""
    write_shards(assign_shards(text, world_size), path, rows_per_file)

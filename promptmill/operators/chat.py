"""Chat text: rendering, truncation, packing and per-turn token usage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.encoding import Encoder
from promptmill.functions.text import estimate_tokens, strip, tokens
from promptmill.operators.running import CHUNK, chunk_of, running_totals
from promptmill.operators.templates import CHATML, Template
from promptmill.staging import stage

TokenCounter = Callable[[Column], Column]


def render_chat(
    df: DataFrame, template: Template = CHATML, add_generation_prompt: bool = False
) -> DataFrame:
    """Add ``text``: without the generation prompt for training, with it for answering."""
    return df.withColumn("text", template.text(F.col("messages"), add_generation_prompt))


def select_text(df: DataFrame, keep: tuple[str, ...] = ("split", "pos")) -> DataFrame:
    """Only the rendered text, with the keys that place it."""
    return df.select(*[c for c in keep if c in df.columns], "text")


def with_token_count(
    df: DataFrame, text: str = "text", counter: TokenCounter = estimate_tokens, out: str = "n_tokens"
) -> DataFrame:
    """Add a token count; ``counter`` maps a text column to a count column (a pandas UDF will do)."""
    return df.withColumn(out, counter(F.col(text)).cast("bigint"))


def truncate_tokens(df: DataFrame, max_seq_length: int = 2048, text: str = "text") -> DataFrame:
    """Cap each example at ``max_seq_length`` tokens: ``tokens`` kept, and the counts."""
    words, limit = tokens(F.col(text)), F.lit(max_seq_length)
    n = F.col("n")
    return (
        df.withColumn("_words", F.coalesce(words, F.array().cast("array<string>")))
        .withColumn("n", F.size("_words").cast("bigint"))
        .withColumns(
            {
                "n_kept": F.least(n, limit).cast("bigint"),
                "n_dropped": F.greatest(n - limit, F.lit(0)).cast("bigint"),
                "tokens": F.slice("_words", 1, max_seq_length),
            }
        )
        .drop("_words")
    )


def truncate_encoded(df: DataFrame, encoder: Encoder, max_seq_length: int = 2048, text: str = "text") -> DataFrame:
    """Cap each example at ``max_seq_length`` ids: ``ids`` kept, ``text_end``, and the counts.

    ``text_end`` is the number of code points that the kept ids cover, so that
    ``substring(text, 1, text_end)`` is the text that is left. The text is encoded once.
    """
    n, limit = F.size("_spans").cast("bigint"), F.lit(max_seq_length)
    kept = F.slice("_spans", 1, max_seq_length)
    return (
        df.withColumn("_spans", encoder(F.col(text)))
        .withColumns(
            {
                "n": n,
                "n_kept": F.least(n, limit).cast("bigint"),
                "n_dropped": F.greatest(n - limit, F.lit(0)).cast("bigint"),
                "ids": kept["id"],
                "text_end": F.coalesce(F.array_max(kept["end"]), F.lit(0)).cast("bigint"),
            }
        )
        .drop("_spans")
    )


def packed_size(n_tokens: str = "n_tokens", separator: int = 0) -> Column:
    """Tokens an example takes up in the blocks; none if it is empty."""
    n = F.col(n_tokens)
    return F.when(n > 0, n + separator).otherwise(0).cast("bigint")


def pack_sequences(
    df: DataFrame,
    length: int,
    order: str = "pos",
    n_tokens: str = "n_tokens",
    separator: int = 0,
    offset: str | None = None,
    tokens_col: str | None = None,
    **options,
) -> DataFrame:
    """Lay examples end to end and cut the row of tokens into blocks of ``length``.

    One row per piece: ``block_id``, where the piece begins in the example
    (``start``), where in the block (``place``) and its ``length``. Each example
    is followed by ``separator`` extra tokens. Examples without tokens take no
    place. ``offset`` names the running total of :func:`packed_size` if ``df``
    has it already, as ``order_records(sums=...)`` gives it. ``tokens_col`` names an
    array of the example's tokens: each piece then carries its own part of it only.
    """
    sized = df.withColumn("_size", packed_size(n_tokens, separator)).filter(F.col("_size") > 0)
    if offset:
        placed = sized.withColumn("_off", F.col(offset))
    else:
        placed = running_totals(sized, [], order, {"_off": F.col("_size")}, **options)
    begin, end = f"greatest(b * {length} - _off, 0)", f"least((b + 1) * {length} - _off, _size)"
    fields = f"""b AS block_id, {begin} AS start, greatest(_off - b * {length}, 0) AS place, {end} - {begin} AS length"""
    if tokens_col:
        fields += f", slice(`{tokens_col}`, CAST({begin} AS int) + 1, CAST({end} - {begin} AS int)) AS `{tokens_col}`"
    # Pieces are cut before rows are made, so a long example is not copied to each of them.
    blocks = f"sequence(_off div {length}, (_off + _size - 1) div {length})"
    kept = [f"`{c}`" for c in df.columns if c != tokens_col]
    return placed.selectExpr(*kept, f"inline(transform({blocks}, b -> struct({fields})))")


def packed_blocks(pieces: DataFrame, tokens_col: str = "tokens", order: str | None = None) -> DataFrame:
    """Blocks with their tokens, from packed pieces that carry their part of the tokens.

    A block holds ``length`` tokens at most, so its group is bounded. Separator
    positions beyond an example's tokens give no token here. With ``order``, the column that numbers the examples,
    a block also has its ``segments``, by which a trainer keeps attention inside an example:
    the example, where in it the piece begins, its place and length in the block. ``position_ids``
    count from 0 in every segment.
    """
    named = [F.col(order).alias("pos"), "start", F.size(tokens_col).cast("bigint").alias("length")] if order else []
    piece = F.struct("place", F.col(tokens_col).alias("tokens"), *named)
    parts = F.array_sort(F.collect_list(piece))
    blocks = pieces.groupBy("block_id").agg(parts.alias("_parts")).select(
        "block_id",
        F.size("_parts").cast("bigint").alias("n_segments"),
        F.flatten(F.transform("_parts", lambda p: p["tokens"])).alias("tokens"),
        "_parts",
    )
    return with_segments(blocks, "_parts").drop("_parts") if order else blocks.drop("_parts")


def with_segments(blocks: DataFrame, parts: str) -> DataFrame:
    """Add ``segments`` and ``position_ids`` from the parts of each block, in the order of their places."""

    def counted(part: Column) -> Column:
        return F.when(part["length"] > 0, F.sequence(F.lit(0).cast("bigint"), part["length"] - 1)).otherwise(F.array().cast("array<bigint>"))

    return blocks.withColumns(
        {
            "segments": F.transform(parts, lambda p: F.struct(p["pos"].alias("pos"), p["start"].alias("start"), p["place"].alias("place"), p["length"].alias("length"))),
            "position_ids": F.flatten(F.transform(parts, counted)),
        }
    )


def segment_examples(blocks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``pos, tokens`` of every example, put together again from the blocks that hold its segments."""
    part = F.struct("s.start", F.slice("tokens", (F.col("s.place") + 1).cast("int"), F.col("s.length").cast("int")).alias("tokens"))
    cut = blocks.select(*by, "tokens", F.explode("segments").alias("s")).select(*by, F.col("s.pos").alias("pos"), part.alias("part"))
    joined = cut.groupBy(*by, "pos").agg(F.array_sort(F.collect_list("part")).alias("_parts"))
    return joined.select(*by, "pos", F.flatten(F.transform("_parts", lambda p: p["tokens"])).alias("tokens"))


def packing_report(df: DataFrame, length: int, n_tokens: str = "n_tokens") -> DataFrame:
    """Blocks and padding with packing, against one (truncated) example per block without."""
    n = F.col(n_tokens)
    totals = df.filter(n > 0).agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(n), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.least(n, F.lit(length))), F.lit(0)).alias("_kept"),
    )
    blocks = F.ceil(F.col("tokens") / length).cast("bigint")
    return totals.select(
        "n",
        "tokens",
        blocks.alias("blocks"),
        (F.col("n") * length - F.col("_kept")).cast("bigint").alias("padding_unpacked"),
        (blocks * length - F.col("tokens")).cast("bigint").alias("padding_packed"),
    )


def conversation_usage(
    df: DataFrame,
    counter: TokenCounter = estimate_tokens,
    message_overhead: int = 0,
    generation_overhead: int = 0,
    chunk: int = CHUNK,
) -> DataFrame:
    """Tokens per reply and running total per conversation.

    Input rows are ``conv_id, turn, role, text`` with ``turn`` unique in its
    conversation. The prompt of a reply is everything said before it, sent again
    each time; the session total adds up prompts and replies so far. A user
    message ``exit`` or ``quit`` ends the session. The overheads are what the
    template adds per message and for the generation prompt.

    Turns are cut into chunks so that a conversation of any length spreads over
    tasks. Texts are counted once: the counts are written out, and conversations
    that reach into a second chunk are looked at again from there.
    """
    said = F.when(F.col("role") == "user", strip(F.col("text"))).otherwise(F.col("text"))
    reply = F.col("role") == "assistant"
    turns = df.select(
        "conv_id",
        "turn",
        reply.alias("_reply"),
        chunk_of("turn", chunk).alias("_chunk"),
        counter(said).cast("bigint").alias("_said"),
        F.coalesce(
            (F.col("role") == "user") & F.lower(said).isin("exit", "quit"), F.lit(False)
        ).alias("_exit"),
    )

    turns = stage(turns.withColumn("_n", F.col("_said") + message_overhead), "turns")

    inside = Window.partitionBy("conv_id", "_chunk").orderBy("turn")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)

    def local(rows: DataFrame) -> DataFrame:
        """Totals that know only their own chunk."""
        seen = rows.withColumns(
            {
                "_prompt": F.coalesce(F.sum("_n").over(before), F.lit(0)) + generation_overhead,
                "_replies": F.sum(F.col("_reply").cast("int")).over(upto),
                "_over": F.max("_exit").over(upto),
            }
        )
        turn_total = F.when(F.col("_reply"), F.col("_prompt") + F.col("_said")).otherwise(F.lit(0))
        return seen.withColumn("_session", F.sum(turn_total).over(upto))

    # Only conversations that reach a second chunk are read again for chunk sums.
    ends = turns.groupBy("conv_id").agg((F.min("_chunk") < F.max("_chunk")).alias("_long"))
    long = ends.filter("_long").select("conv_id")
    sums = (
        local(turns.join(long, "conv_id", "left_semi"))
        .groupBy("conv_id", "_chunk")
        .agg(
            F.sum("_n").alias("_n"),
            F.max("_replies").alias("_replies"),
            F.max("_session").alias("_session"),
            F.max("_exit").alias("_exit"),
        )
    )
    chunks = Window.partitionBy("conv_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    history = F.coalesce(F.sum("_n").over(chunks), F.lit(0))
    carried = (
        sums.withColumns({"_c_n": history, "_c_over": F.max("_exit").over(chunks)})
        .withColumn("_part", F.col("_session") + F.col("_c_n") * F.col("_replies"))
        .select(
            "conv_id",
            "_chunk",
            "_c_n",
            "_c_over",
            F.sum("_part").over(chunks).alias("_c_session"),
        )
    )

    history = F.coalesce("_c_n", F.lit(0))
    prompt = F.col("_prompt") + history
    done = F.col("_over") | F.coalesce("_c_over", F.lit(False))
    return (
        local(turns)
        .filter(F.col("_reply"))
        .join(carried, ["conv_id", "_chunk"], "left")
        .filter(~done)
        .select(
            "conv_id",
            "turn",
            prompt.alias("prompt_tokens"),
            F.col("_said").alias("completion_tokens"),
            (prompt + F.col("_said")).alias("turn_total"),
            (
                F.col("_session") + history * F.col("_replies") + F.coalesce("_c_session", F.lit(0))
            ).alias("session_total"),
        )
    )

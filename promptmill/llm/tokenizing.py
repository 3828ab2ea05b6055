"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import base64
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DEFINITION = public_tokenizers.path("byte_bpe_50k.json")
LONG = 1 << 20  # characters encoded at a time


class TextEncoder:
    """Texts to ids, as little-endian unsigned 32-bit bytes.

    The ranks are the vocabulary of ``byte_bpe_50k.json``; the ids are the same. A special token
    of the definition that stands in a text gets its own id, and what is around it is encoded apart.
    """

    def __init__(self, ranks_path: str = RANKS, definition_path: str = DEFINITION):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        with open(definition_path, encoding="utf-8") as file:
            self.special = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.encoder = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        out, begin = [], 0
        for found in self.split.finditer(text) if self.split else ():
            out += [self._plain(text[begin : found.start()]), array("I", [self.special[found[0]]]).tobytes()]
            begin = found.end()
        return b"".join([*out, self._plain(text[begin:] if begin else text)])

    def _plain(self, text: str) -> bytes:
        return b"".join(array("I", self.encoder.encode_ordinary(part)).tobytes() for part in _cuts(text))


def _cuts(text: str) -> Iterator[str]:
    """A long text in parts; a space between other characters always begins a new pre-token."""
    begin = 0
    if len(text) > LONG:
        for found in re.finditer(r"(?<=\S) (?=\S)", text):
            if found.start() - begin >= LONG:
                yield text[begin : found.start()]
                begin = found.start()
    yield text[begin:] if begin else text


@lru_cache(maxsize=2)
def text_encoder(ranks_path: str) -> TextEncoder:
    return TextEncoder(ranks_path)


def small_runs(batch: pa.RecordBatch, texts: pa.Array, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose texts together stay near ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // most
    starts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(starts, starts[1:], strict=False):
        if end > begin:
            yield batch.slice(begin, end - begin)


def token_pieces(
    docs: DataFrame,
    length: int = 1024,
    end_id: int = 2,
    text: str = "text",
    doc_id: str = "doc_id",
    ranks_path: str = RANKS,
) -> DataFrame:
    """Cut every document's ids, closed by ``end_id``, into pieces of at most ``length``.

    Only documents over ``length`` ids are cut; all their pieces but the first are
    full. One row per piece: ``doc_id``, ``piece``, ``start`` (ids before it),
    ``length`` and ``ids`` (little-endian unsigned 32-bit). NULL text counts as
    empty: one piece that holds ``end_id`` alone. Repeated rows give repeated pieces.
    """
    kind = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    closing = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(ranks_path).encode
        for whole in batches:
            for batch in small_runs(whole, whole.column("_text")):
                rows, piece, start, ids = [], [], [], []
                for row, text in enumerate(batch.column("_text").to_pylist()):
                    raw = encode(text) + closing
                    n = len(raw) // 4
                    first = (n - 1) % length + 1
                    for i in range(1 + (n - first) // length):
                        begin = 0 if i == 0 else first + (i - 1) * length
                        rows.append(row)
                        piece.append(i)
                        start.append(begin)
                        ids.append(raw[4 * begin : 4 * (first + i * length)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(cut, schema)


def token_lengths(docs: DataFrame, text: str = "text", ranks_path: str = RANKS) -> DataFrame:
    """One row ``n_tokens`` per document: the number of its ids, 0 for NULL or empty text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(ranks_path).encode
        for whole in batches:
            for batch in small_runs(whole, whole.column("_text")):
                lengths = [len(encode(text)) // 4 for text in batch.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["n_tokens"])

    return docs.select(F.col(text).alias("_text")).mapInArrow(count, "n_tokens bigint")

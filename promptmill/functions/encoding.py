"""Token ids with the places in the text they come from.

An encoder maps a text column to ``array<struct<id, start, end>>``: the ids in order,
each with the code points it covers, ``end`` not included. Counts, truncation and packing
are all cut from this one array, so they can't disagree. It is what a plan takes when ids matter; a plain
count needs only a counter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

Encoder = Callable[[Column], Column]
#: A text to three lists of like length: ids, starts, ends.
Spans = Callable[[str], tuple[list[int], list[int], list[int]]]

ENCODING = "array<struct<id:int,start:int,end:int>>"
#: Ids after which the rows so far are sent on.
IDS_SENT = 1 << 16


def encoder_from(make: Callable[[], Spans]) -> Encoder:
    """An Arrow UDF around an encoder of single texts; ``make`` is called once in every task.

    NULL text gives no ids. Batches come and go as Arrow arrays, and ids are laid end to end, so
    that no row of Python objects is made. A batch of many or long texts goes back in several
    arrays, so a task holds the ids of one text and ``IDS_SENT`` more beside its batch.
    """

    def listed(ids: list[int], starts: list[int], ends: list[int], cuts: list[int]) -> pa.Array:
        columns = [pa.array(values, pa.int32()) for values in (ids, starts, ends)]
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(columns, ["id", "start", "end"]))

    @F.arrow_udf(ENCODING)
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spans = make()
        for batch in texts:
            ids, starts, ends, cuts = [], [], [], [0]
            for text in batch:
                if text.is_valid:
                    found = spans(text.as_py())
                    ids.extend(found[0])
                    starts.extend(found[1])
                    ends.extend(found[2])
                cuts.append(len(ids))
                if len(ids) >= IDS_SENT:
                    yield listed(ids, starts, ends, cuts)
                    ids, starts, ends, cuts = [], [], [], [0]
            if len(cuts) > 1:
                yield listed(ids, starts, ends, cuts)

    return lambda text: F.coalesce(encode(text), F.array().cast(ENCODING))


def tokenizer_encoder(path: str) -> Encoder:
    """The encoder of a ``tokenizers`` JSON file, without special tokens of its own.

    The file is read on the driver and travels with the function, so executors need no copy. Special
    tokens that stand in a text are found as the file says.
    """
    definition = Path(path).read_text(encoding="utf-8")

    def make() -> Spans:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)

        def spans(text: str) -> tuple[list[int], list[int], list[int]]:
            found = tokenizer.encode(text, add_special_tokens=False)
            return found.ids, [begin for begin, _ in found.offsets], [end for _, end in found.offsets]

        return spans

    return encoder_from(make)


def encoded_count(encoder: Encoder) -> Callable[[Column], Column]:
    """The token counter that belongs to an encoder."""
    return lambda text: F.size(encoder(text)).cast("bigint")

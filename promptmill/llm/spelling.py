"""Spelling variants: words at one edit, found through the one-edit neighbourhoods of words in a reduced alphabet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.staging import stage

SYMBOLS = 6
CELLS = 1 << 19  # letters, or neighbours, handled at a time


def reduced(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words as rows of symbols 1 to ``symbols``, one matrix per length, with the numbers of its rows."""
    sizes = np.array([len(word) for word in words])
    for length in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == length)
        step = max(1, CELLS // max(length, 1))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            points = np.frombuffer("".join(words[i] for i in part.tolist()).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            mixed = (points.astype(np.uint64) * np.uint64(2654435761)) >> np.uint64(9)
            yield part, (mixed % np.uint64(symbols) + np.uint64(1)).reshape(len(part), length)


def _powers(base: int, count: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[1], np.full(count, base)]).astype(np.uint64), dtype=np.uint64)


def codes(symbols: np.ndarray, base: int) -> np.ndarray:
    """Each row read as a number in the given base, modulo 2**64: the same for equal rows, and seldom for others."""
    return (symbols * _powers(base, symbols.shape[1])[: symbols.shape[1]][::-1]).sum(axis=1, dtype=np.uint64)


def neighbourhood(symbols: np.ndarray, base: int) -> Iterator[np.ndarray]:
    """The codes of all rows at one edit from each row, as columns: one deleted, replaced or inserted symbol.

    Every neighbour comes once: deleting, or inserting next to, an equal symbol gives
    the same row as its neighbour does and is marked out by the row's own code, which comes too.
    """
    rows, length = symbols.shape
    power = _powers(base, length + 1)
    high = np.zeros((rows, length + 1), dtype=np.uint64)
    low = np.zeros((rows, length + 1), dtype=np.uint64)
    for i in range(length):
        high[:, i + 1] = high[:, i] * np.uint64(base) + symbols[:, i]
        low[:, length - 1 - i] = low[:, length - i] + symbols[:, length - 1 - i] * power[i]
    own = high[:, length]
    yield own[:, None]
    for i in range(length + 1):
        out = []
        if i < length:
            again = symbols[:, i] == symbols[:, i - 1] if i else np.zeros(rows, dtype=bool)
            out.append(np.where(again, own, high[:, i] * power[length - 1 - i] + low[:, i + 1]))
        for symbol in range(1, base):
            if i < length:
                out.append(own + (np.uint64(symbol) - symbols[:, i]) * power[length - 1 - i])
            put = (high[:, i] * np.uint64(base) + np.uint64(symbol)) * power[length - i] + low[:, i]
            out.append(np.where(symbols[:, i] == symbol, own, put) if i < length else put)
        yield np.stack(out, axis=1)


def _coded(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        code, form = np.zeros(len(words), dtype=np.uint64), np.empty(len(words), dtype=object)
        for rows, matrix in reduced(words, symbols):
            code[rows] = codes(matrix, symbols + 1)
            letters = (matrix + np.uint64(96)).astype(np.uint8)
            form[rows] = [row.tobytes().decode("ascii") for row in letters]
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), pa.array(code.view(np.int64)), pa.array(form.tolist(), pa.string())],
            ["word", "n", "code", "reduced"],
        )


def _neighbours(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[pa.RecordBatch]:
    """``code, near``: of the full neighbourhood of every reduced word what is not smaller than its own code.

    Neighbourhoods are mutual, so the pair is found from the word with the smaller code.
    """
    for batch in batches:
        words = batch.column("reduced").to_pylist()
        sizes = np.array([len(word) for word in words])
        for length in np.unique(sizes).tolist():
            chosen = [words[i] for i in np.flatnonzero(sizes == length).tolist()]
            step = max(1, CELLS // (2 * (length + 1)))
            for at in range(0, len(chosen), step):
                part = chosen[at : at + step]
                raw = np.frombuffer("".join(part).encode("ascii"), dtype=np.uint8).reshape(len(part), length)
                yield from _emitted(raw.astype(np.uint64) - np.uint64(96), symbols + 1)


def _emitted(matrix: np.ndarray, base: int) -> Iterator[pa.RecordBatch]:
    own, held, count = codes(matrix, base).view(np.int64), [], 0

    def batch() -> pa.RecordBatch:
        code, near = (np.concatenate(parts) for parts in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(near)], ["code", "near"])

    for number, block in enumerate(neighbourhood(matrix, base)):
        near = block.view(np.int64)
        later = near > own[:, None] if number else np.ones(near.shape, dtype=bool)
        rows, columns = np.nonzero(later)
        held.append((own[rows], near[rows, columns]))
        count += len(rows)
        if count >= CELLS:
            yield batch()
            held, count = [], 0
    if held:
        yield batch()


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``word, n, other, other_n``: all ordered pairs of different words at exactly one edit, each once.

    ``words`` has ``word`` (distinct, not NULL) and ``n``. Letters are hashed to ``symbols``
    symbols. The full one-edit neighbourhood of every distinct reduced word, itself
    included, meets the reduced vocabulary; words behind a match are verified on their own letters.
    """
    coded = words.select("word", F.col("n").cast("bigint").alias("n"))
    coded = stage(coded.mapInArrow(lambda b: _coded(b, symbols), "word string, n bigint, code bigint, reduced string"), "coded")
    forms = coded.select("reduced").distinct()
    around = forms.mapInArrow(lambda b: _neighbours(b, symbols), "code bigint, near bigint")
    met = around.join(coded.select(F.col("code").alias("near")).distinct(), "near", "left_semi")
    left = coded.select("code", "word", "n")
    right = coded.select(F.col("code").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    tried = met.join(left, "code").join(right, "near").filter((F.col("code") != F.col("near")) | (F.col("word") < F.col("other")))
    one = tried.filter(F.levenshtein("word", "other", 1) == 1)
    mirrored = F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")),
    )
    # Codes of words over some 20 letters may coincide, and a pair is then met twice.
    return one.select(F.inline(mirrored)).repartition("word").dropDuplicates(["word", "other"])


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words that have a form: forms are followed to the last, twice as far in every round."""
    current = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        following = current.join(ahead, "root", "left")
        following = stage(following.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        current = following.select("word", "root")
        if not following.filter("moved").limit(1).count():
            return current


def spelling_variants(counts: DataFrame, ratio: int = 10, symbols: int = SYMBOLS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``counts`` (``word, n``).

    Words are near if they differ by exactly one inserted, deleted or replaced code
    point. A word's form is its most frequent near word, the smallest in code-point order
    among equals, if that is at least ``ratio`` times as frequent; else NULL, and ``form_n`` too. The root is the
    last of the forms that follow each other, the word itself if it has none. Counts rise from form to
    form, so no chain closes or is long. Rows of one word are added up, NULL words
    and counts left out; no rows give none.
    """
    words = counts.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))
    words = stage(words, "words")
    best = F.min(F.struct((-F.col("other_n")).alias("order"), "other"))
    near = near_words(words, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    fits = -F.col("best.order") >= F.col("n") * ratio
    known = stage(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(fits, F.col("best.other")).alias("form"),
            F.when(fits, -F.col("best.order")).cast("bigint").alias("form_n"),
        ),
        "near",
    )
    roots = _roots(known.filter("form IS NOT NULL"))
    rooted = known.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def word_counts(words: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """``word, n`` of a column ``word``: those of so many code points and occurrences at least."""
    counted = words.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)

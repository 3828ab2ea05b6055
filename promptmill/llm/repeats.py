"""Bytes covered by strings that occur elsewhere in the corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.llm.run_index import build
from promptmill.llm.tokenizing import small_runs
from promptmill.staging import stage

GRAM = 32  # bytes whose hash may stand for a window
CHUNK = 1 << 20  # windows looked at together
BLOCK = 1 << 18  # bytes indexed together
MOST_SEGMENTS = 256  # of one anchor that are indexed together
HOT, MOST_HOT, SALTS = 1 << 14, 100_000, 64  # rows of a key that go to several tasks; such keys at most; parts
STRIDE = 16  # windows of a common anchor that are counted as one run first
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class RollingHash:
    """Hashes of all stretches of a byte string: sums of bytes times powers, modulo 2**64."""

    _powers = np.ones(1, dtype=np.uint64)
    _inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, data: bytes):
        size = len(data) + 1
        if len(RollingHash._powers) < size:
            powers, inverses = np.full(size, _BASE, dtype=np.uint64), np.full(size, _INVERSE, dtype=np.uint64)
            powers[0] = inverses[0] = 1
            RollingHash._powers, RollingHash._inverses = np.cumprod(powers), np.cumprod(inverses)
        codes = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        self.sums = np.zeros(size, dtype=np.uint64)
        np.cumsum(codes * self._powers[: size - 1], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[begin]) * self._inverses[begin])

    def windows(self, width: int) -> np.ndarray:
        count = len(self.sums) - width
        return _mixed((self.sums[width:] - self.sums[:-width]) * self._inverses[:count])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, from minima towards both ends of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(back[:count], forth[width - 1 : width - 1 + count])


@dataclass
class Segments:
    """Runs of windows with one anchor, ``length`` at most: its hash, the digest of the bytes, first window and number of windows."""

    anchor: np.ndarray
    digest: np.ndarray
    begin: np.ndarray
    windows: np.ndarray


def segments_of(data: bytes, length: int) -> Segments:
    """Cut all windows of ``length`` bytes into runs by their anchor: the smallest hash of a gram inside.

    Equal windows have equal anchors wherever they stand, so they can be looked for anchor by anchor.
    """
    found = []
    gram = min(GRAM, length)
    for at in range(0, max(len(data) - length + 1, 0), CHUNK):
        part = data[at : at + CHUNK + length - 1]
        rolling = RollingHash(part)
        grams = rolling.windows(gram)
        least = sliding_minimum(grams, length - gram + 1)
        # A run ends where the anchor changes or its first place is left behind.
        ends = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
        first = np.flatnonzero(np.concatenate([[True], ends]))
        count = np.diff(np.append(first, len(least)))
        digest = rolling.of(first, first + count + length - 1)
        found.append((least[first].view(np.int64), digest.view(np.int64), first + at, count))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Segments(none, none, none, none)
    return Segments(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _runs(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"s": int(a), "e": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


_FLAGS = "a bigint, d bigint, runs array<struct<s:int,e:int>>"


def _indexed_block(block: pd.DataFrame, length: int) -> pd.DataFrame:
    """Which windows of a block's segments occur elsewhere in the block."""
    index, begins = build(block["bytes"].tolist())
    long = index.matching_statistics() >= length
    runs = [_runs(long[b : b + w]) for b, w in zip(begins.tolist(), block["w"].tolist(), strict=True)]
    out = pd.DataFrame({"a": block["a"].to_numpy(), "d": block["d"].to_numpy(), "runs": runs})
    return out[out["runs"].map(len) > 0]


def _indexed(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor; whole anchors are gathered until a block is full."""
    waiting, held = [], 0
    for batch in batches:
        for _, group in batch.groupby("a", sort=False):
            begins_new = not waiting or waiting[-1]["a"].iloc[-1] != group["a"].iloc[0]
            if held >= BLOCK and begins_new:
                yield _indexed_block(pd.concat(waiting), length)
                waiting, held = [], 0
            waiting.append(group)
            held += int(group["bytes"].map(len).sum())
    if waiting:
        yield _indexed_block(pd.concat(waiting), length)


def _pieces(data: bytes, anchor: int, length: int, stride: int) -> pd.DataFrame:
    """A segment's windows in runs by the anchor's place in them, ``stride`` places a run.

    Equal windows have their anchor at the same place, so they meet in runs of one ``b`` that
    agree in ``core``, the bytes which every window of such a run has in common.
    """
    rolling = RollingHash(data)
    hashes = rolling.windows(length).view(np.int64)
    grams = rolling.windows(min(GRAM, length)).view(np.int64)
    place = int(np.argmax(grams == anchor)) - np.arange(len(hashes))
    b = place // stride
    s = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
    n = np.diff(np.append(s, len(b)))
    core = int(place[0]) - b[s] * stride
    return pd.DataFrame(
        {
            "b": b[s],
            "core": rolling.of(core, core + length - stride + 1).view(np.int64),
            "j": place[s],
            "n": n,
            "digest": rolling.of(s, s + n + length - 1).view(np.int64),
            "s": s,
            "h": np.split(hashes, s[1:]),
        }
    )


def _counted_windows(segments: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many different segments: windows are counted.

    Runs of windows are counted first; equal runs go on as one. Only where different runs
    have a core in common are their windows counted one by one.
    """
    stride = min(STRIDE, length)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 1_000):
                rows = whole.iloc[at : at + 1_000][["a", "d", "bytes"]].itertuples(index=False)
                yield pd.concat([_pieces(data, a, length, stride).assign(a=a, d=d) for a, d, data in rows])

    schema = "b int, core bigint, j int, n int, digest bigint, s int, h array<bigint>, a bigint, d bigint"
    pieces = stage(segments.mapInPandas(cut, schema), "runs")
    key = ["a", "b", "core", "j", "n", "digest"]
    kinds = pieces.groupBy(*key).agg(
        F.count("*").alias("m"), F.min("d").alias("d"), F.min("s").alias("s"), F.first("h").alias("h")
    )
    kinds = stage(kinds, "kinds-of-runs")
    equal = pieces.join(kinds.filter("m > 1").select(*key), key, "left_semi")
    mixed = kinds.groupBy("a", "b", "core").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    opened = kinds.join(mixed.select("a", "b", "core"), ["a", "b", "core"], "left_semi")
    opened = stage(opened.select("a", "d", "s", "m", F.posexplode("h").alias("i", "x")), "windows")
    again = opened.groupBy("a", "x").agg(F.count("*").alias("n")).filter("n > 1").select("a", "x")
    hit = opened.filter("m = 1").join(again, ["a", "x"], "left_semi").withColumn("s", F.col("s") + F.col("i"))
    every = equal.select("a", "d", "s", (F.col("s") + F.col("n")).alias("e")).union(
        hit.select("a", "d", "s", (F.col("s") + 1).alias("e"))
    )

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs = [merged([(r["s"], r["e"]) for r in found]) for found in batch["runs"]]
            runs = [[{"s": s, "e": e} for s, e in found] for found in runs]
            yield pd.DataFrame({"a": batch["a"], "d": batch["d"], "runs": runs})

    return every.groupBy("a", "d").agg(F.collect_list(F.struct("s", "e")).alias("runs")).mapInPandas(joined, _FLAGS)


def _anchors(keyed: DataFrame, length: int) -> DataFrame:
    """``a, d, k, cp, w`` for each segment of each text; ``cp`` is the text's checksum and the place of the segment."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (run for whole in batches for run in small_runs(whole, whole.column("text"))):
            parts, rows = [], []
            for row, text in enumerate(batch.column("text")):
                part = segments_of(text.as_py().encode(), length)
                parts.append(part)
                rows.append(np.full(len(part.begin), row))
            row = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
            if not len(row):
                continue
            check = batch.column("c").to_numpy()[row] << 32
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([p.anchor for p in parts])),
                    pa.array(np.concatenate([p.digest for p in parts])),
                    pa.array(batch.column("k").to_numpy()[row]),
                    pa.array(check | np.concatenate([p.begin for p in parts])),
                    pa.array(np.concatenate([p.windows for p in parts]).astype(np.int32)),
                ],
                ["a", "d", "k", "cp", "w"],
            )

    return keyed.select("text", "k", "c").mapInArrow(cut, "a bigint, d bigint, k bigint, cp bigint, w int")


def _fetched(keyed: DataFrame, owners: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted segments, cut from the one row that stands for their text."""
    item = F.struct(F.col("cp").bitwiseAND((1 << 32) - 1).alias("p"), "w", "a", "d", "multi", "hot")
    lists = wanted.groupBy("k", F.shiftrightunsigned("cp", 32).alias("c")).agg(F.collect_list(item).alias("items"))
    lists = lists.join(owners.select("k", "c", "owner"), ["k", "c"])
    met = _own_rows(keyed, lists, "inner").select("text", "items")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "d", "multi", "hot", "w", "bytes"]
        for batch in (run for whole in batches for run in small_runs(whole, whole.column("text"))):
            for text, items in zip(batch.column("text"), batch.column("items"), strict=True):
                data, items = text.as_py().encode(), items.values
                p, w = items.field("p").to_numpy(), items.field("w").to_numpy()
                cuts = [data[a : a + b + length - 1] for a, b in zip(p.tolist(), w.tolist(), strict=True)]
                kept = [items.field(x) for x in ("a", "d", "multi", "hot")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(w), pa.array(cuts, pa.binary())], names)

    return met.mapInArrow(cut, "a bigint, d bigint, multi boolean, hot boolean, w int, bytes binary")


def _own_rows(keyed: DataFrame, owners: DataFrame, how: str) -> DataFrame:
    """Join each text's facts to the row that stands for it. The row's id keeps copies apart in the shuffle."""
    named = owners.withColumnsRenamed({"k": "_k", "c": "_c"})
    same = (F.col("k") == F.col("_k")) & (F.col("c") == F.col("_c")) & F.col("id").eqNullSafe(F.col("owner"))
    return keyed.join(named, same, how)


def _spread(rows: DataFrame, facts: DataFrame, on: list[str], total: int) -> DataFrame:
    """Join ``facts`` (one row a key, ``n`` rows of ``rows`` have it) to its rows; ``o`` deals those of a hot key.

    A key is hot if it has over ``HOT`` rows and over a ``MOST_HOT``-th of all, so that there
    are no more than ``MOST_HOT`` such keys, which are broadcast.
    """
    hot = F.col("n") > max(HOT, total // MOST_HOT)
    keys = F.broadcast(facts.filter(hot).select(*on, F.lit(SALTS).alias("parts")))
    part = F.pmod("o", F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    dealt = rows.join(keys, on, "left").select(*rows.columns, part)
    parts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(facts.withColumn("part", F.explode(parts)).drop("n"), [*on, "part"]).drop("part")


def _joined(spans: DataFrame) -> DataFrame:
    """``k, c, spans``: the spans of each text that overlap or touch are made one before they are gathered."""
    text = Window.partitionBy("k", "c").orderBy("start", "end")
    reached = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    begins = spans.withColumn("begins", F.when(F.col("start") <= reached, 0).otherwise(1))
    runs = begins.withColumn("run", F.sum("begins").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("k", "c", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("k", "c").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def repeated_spans(keyed: DataFrame, owners: DataFrame, length: int) -> DataFrame:
    """``k, c, spans``: the bytes of each single text that a repeated window covers."""
    anchors = stage(_anchors(keyed, length), "anchors").withColumn("o", F.xxhash64("k", "cp"))
    several = F.min("o") != F.max("o")
    again = stage(anchors.groupBy("a").agg(several.alias("s"), F.count("*").alias("n")).filter("s").select("a", "n"), "anchors-again")
    seen = stage(_spread(anchors, again, ["a"], anchors.count()), "occurrences")
    kinds = stage(
        seen.groupBy("a", "d").agg(
            several.alias("multi"), F.min("k").alias("k"), F.min_by("cp", "k").alias("cp"), F.min("w").alias("w"), F.count("*").alias("n")
        ),
        "segments",
    )
    sizes = stage(kinds.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").withColumn("hot", F.col("n") > MOST_SEGMENTS), "sizes")
    wanted = _spread(kinds.drop("n").withColumn("o", F.col("d")), sizes, ["a"], kinds.count()).drop("o")
    texts = stage(_fetched(keyed, owners, wanted, length), "segment-bytes")
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cold = texts.filter("NOT hot").select("a", "d", "multi", "w", "bytes").repartition(tasks, "a").sortWithinPartitions("a")
    found = cold.mapInPandas(lambda batches: _indexed(batches, length), _FLAGS)
    counted = _counted_windows(texts.filter("hot"), length)
    whole = kinds.filter("multi").select(
        "a", "d", F.array(F.struct(F.lit(0).alias("s"), F.col("w").alias("e"))).alias("runs"), "n"
    )
    part = found.union(counted).join(kinds.filter("NOT multi").select("a", "d", "n"), ["a", "d"])
    flagged = stage(whole.union(part), "flagged")
    at = F.col("cp").bitwiseAND((1 << 32) - 1)
    spans = (
        _spread(seen, flagged, ["a", "d"], seen.count())
        .select("k", F.shiftrightunsigned("cp", 32).alias("c"), at.alias("p"), F.inline("runs"))
        .select("k", "c", (F.col("p") + F.col("s")).alias("start"), (F.col("p") + F.col("e") + (length - 1)).alias("end"))
    )
    single = owners.filter("n = 1").select("k", "c")
    return _joined(spans.join(single, ["k", "c"], "left_semi"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans drawn in to the edges of UTF-8 characters."""

    def inner(byte: int) -> bool:
        return byte < len(data) and data[byte] & 0xC0 == 0x80

    out = []
    for start, end in spans:
        while inner(start):
            start += 1
        while inner(end):
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def remove_repeats(
    docs: DataFrame,
    length: int = 200,
    text: str = "text",
    doc_id: str = "doc_id",
    characters: bool = False,
    out: str = "_repeats",
) -> DataFrame:
    """Every row with ``out``: a struct ``n_bytes, spans, kept``.

    A byte is in a span if a string of ``length`` bytes over it also starts anywhere else:
    in another row, or at another place of the same one. Texts are looked at as UTF-8
    bytes; NULL counts as empty. Matches do not run over the end of a text, and are judged
    on the input. ``kept`` is what remains; with ``characters`` the spans are drawn in to
    whole characters first, so that it stays text.

    Texts that stand in several rows are covered whole. Of the others, windows are cut into
    segments by content, so that equal windows come under one anchor. Equal segments are
    counted; where an anchor has different ones, their bytes are fetched and put, anchor by
    anchor, into blocks, each with a run-compressed Burrows-Wheeler index whose matching
    statistics tell the windows that occur again. Anchors with more than ``MOST_SEGMENTS``
    different segments are counted window by window instead, which spreads over tasks.
    Equality of texts, segments and counted windows is that of 96 to 128 bits of hashes.
    """
    columns = [c for c in docs.columns if c != out]
    body = F.coalesce(F.col(text), F.lit(""))
    keys: dict[str, Column] = {"k": F.xxhash64(body), "c": F.crc32(body.cast("binary"))}
    keyed = docs.select(F.col(doc_id).alias("id"), body.alias("text"), *[v.alias(n) for n, v in keys.items()])
    owners = stage(keyed.groupBy("k", "c").agg(F.min("id").alias("owner"), F.count("*").alias("n")), "texts")
    spans = stage(repeated_spans(keyed, owners, length), "spans")
    facts = owners.filter("n = 1").join(spans, ["k", "c"], "left").select("k", "c", "owner", "spans", F.lit(True).alias("single"))
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    carried = docs.select(row.alias("row"), F.col(doc_id).alias("id"), *[v.alias(n) for n, v in keys.items()])
    met = _own_rows(carried, facts, "left").select("row", "spans", "single")
    kind = "struct<n_bytes:bigint,spans:array<struct<start:bigint,end:bigint>>,kept:binary>"
    schema = T.StructType([carried.schema["row"], T.StructField(out, T.DataType.fromDDL(kind))])
    result = pa.struct(
        [
            ("n_bytes", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("kept", pa.binary()),
        ]
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (run for whole in batches for run in small_runs(whole, whole.column("row").field(text))):
            answers = []
            bodies = batch.column("row").field(text)
            for body, found, single in zip(bodies, batch.column("spans"), batch.column("single"), strict=True):
                data = (body.as_py() or "").encode()
                cuts = merged([(s["start"], s["end"]) for s in found.as_py() or ()])
                if single.as_py() is None and len(data) >= length:
                    cuts = [(0, len(data))]
                if characters:
                    cuts = whole_characters(data, cuts)
                edges = [0, *(x for cut in cuts for x in cut), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                answers.append({"n_bytes": len(data), "spans": [{"start": a, "end": b} for a, b in cuts], "kept": kept})
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(answers, result)], ["row", out])

    return met.mapInArrow(remove, schema).select("row.*", out)

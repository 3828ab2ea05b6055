"""Language of texts, and of the spans of mixed ones."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.llm.tokenizing import small_runs

FEATURES = 1 << 15
SAMPLE_DOCS = 2_000  # labelled documents per language that the model is fitted on, about
LONGEST = 4  # characters of an n-gram
REMEMBERED = 200_000  # words whose scores a worker remembers
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")

# First and last code points of scripts, from the Unicode block list.
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("ethiopic", 0x1200, 0x137F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7A3),
)
_FIRST, _LAST = (np.array([row[i] for row in SCRIPTS]) for i in (1, 2))
_NAMES = sorted({name for name, _, _ in SCRIPTS})
_NUMBER = np.array([_NAMES.index(name) for name, _, _ in SCRIPTS])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed character n-grams of words with their ends marked: feature, and number of its word; and scripts.

    A word's script is that of its first letter, ``len(_NAMES)`` outside the ranges.
    """
    text = ("<" + "><".join(words) + ">").lower()
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    begins = np.flatnonzero(code == ord("<"))
    ends = np.append(begins[1:], len(code)) - 1
    owner = np.repeat(np.arange(len(begins)), ends - begins + 1)
    left = ends[owner] - np.arange(len(code))
    grams, owners, rolled = [], [], np.zeros(len(code), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        shifted = code[n - 1 :]
        rolled = (rolled[: len(shifted)] + shifted + np.uint64(1)) * _MIX
        rolled ^= rolled >> np.uint64(29)
        inside = left[: len(shifted)] >= n - 1
        grams.append(rolled[inside] >> np.uint64(64 - FEATURES.bit_length() + 1))
        owners.append(owner[: len(shifted)][inside])
    first = code[begins + 1].astype(np.int64)
    at = np.searchsorted(_FIRST, first, "right") - 1
    script = np.where((at >= 0) & (first <= _LAST[at]), _NUMBER[at], len(_NAMES))
    return np.concatenate(grams).astype(np.int64), np.concatenate(owners), script


@dataclass
class LanguageModel:
    """Scores of features per language, and which languages use a script."""

    languages: list[str]
    scores: np.ndarray  # features x languages
    scripts: np.ndarray  # scripts x languages, and a last row for the rest
    penalty: float = 12.0
    memory: dict[str, int] = field(default_factory=dict)
    rows: np.ndarray | None = None
    letters: np.ndarray | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods of words relative to the best language. N-grams overlap, so each counts for a quarter.

        Languages that don't use a word's script are out of question for it, unless none does.
        """
        feature, owner, script = word_features(words)
        columns = range(len(self.languages))
        total = np.stack([np.bincount(owner, self.scores[feature, k], len(words)) for k in columns], axis=1) / LONGEST
        held = self.scripts[script]
        held |= ~held.any(axis=1, keepdims=True)
        total = np.where(held, total, total.min(axis=1, keepdims=True) - self.penalty)
        return total - total.max(axis=1, keepdims=True)

    def _places(self, words: list[str]) -> np.ndarray:
        if self.rows is None:
            self.rows = np.zeros((REMEMBERED, len(self.languages)))
            self.letters = np.zeros(REMEMBERED, dtype=np.int64)
        memory = self.memory
        new = list(set(words).difference(memory))
        if len(memory) + len(new) > REMEMBERED:
            memory.clear()
            new = list(set(words))
        if new:
            at = len(memory)
            self.rows[at : at + len(new)] = self.word_scores(new)
            self.letters[at : at + len(new)] = [len(word) for word in new]
            memory.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(memory.__getitem__, words), dtype=np.int64, count=len(words))

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and letters of each word, in runs that fit into the memory."""
        scores, letters = [], []
        for at in range(0, len(words), REMEMBERED // 4):
            places = self._places(words[at : at + REMEMBERED // 4])
            scores.append(self.rows[places])
            letters.append(self.letters[places])
        return np.concatenate(scores), np.concatenate(letters)

    def label(self, text: str | None) -> tuple[str, float, list[tuple[int, int, str]]]:
        """Language, score and spans ``(start, end, language)`` in characters.

        The language is the one with most letters; the score is its share of the
        letters times its posterior against the others over its own words.
        """
        words = _WORD.findall(text) if text and self.languages else []
        if not words:
            return UNKNOWN, 0.0, []
        emitted, letters = self.emissions(words)
        path = viterbi(emitted, self.penalty)
        shares = np.bincount(path, weights=letters, minlength=len(self.languages))
        best = int(shares.argmax())
        sums = emitted[path == best].sum(axis=0)
        posterior = 1 / np.exp(np.minimum(sums - sums[best], 700.0)).sum()
        return (
            self.languages[best],
            float(shares[best] / shares.sum() * posterior),
            [(a, b, self.languages[k]) for a, b, k in _spans(text, path)],
        )


def viterbi(emitted: np.ndarray, penalty: float) -> np.ndarray:
    """The best labels of a row of words, if every change of language costs ``penalty``.

    If no stretch of words gains half of ``penalty`` in any other language over the best
    single language, then that language is the answer for all words: a path with ``m``
    stretches in other languages has one change at least, and ``m - 1``, so ``m / 2``.
    """
    single = int(emitted.sum(axis=0).argmax())
    lead = np.cumsum(emitted[:, [single]] - emitted, axis=0)
    highest = np.maximum.accumulate(np.vstack([np.zeros((1, lead.shape[1])), lead[:-1]]), axis=0)
    if (highest - lead).max() < penalty / 2:
        return np.full(len(emitted), single)
    rows = emitted.tolist()
    best, back = rows[0], []
    for row in rows[1:]:
        top = max(best)
        source = best.index(top)
        switch = top - penalty
        stay = [value >= switch for value in best]
        back.append([i if s else source for i, s in enumerate(stay)])
        best = [(v if s else switch) + e for v, s, e in zip(best, stay, row, strict=True)]
    at = best.index(max(best))
    path = [at]
    for step in reversed(back):
        at = step[at]
        path.append(at)
    return np.array(path[::-1])


def _spans(text: str, path: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of words with one label; a single run needs its first and last letter only."""
    edges = np.flatnonzero(np.diff(path)) + 1
    if not len(edges):
        end = len(text)
        while not _WORD.match(text[end - 1]):
            end -= 1
        yield _WORD.search(text).start(), end, int(path[0])
        return
    bounds = [m.span() for m in _WORD.finditer(text)]
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(path)], strict=True):
        yield bounds[a][0], bounds[b - 1][1], int(path[a])


def fit_languages(
    docs: DataFrame,
    training: Column,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = SAMPLE_DOCS,
    penalty: float = 12.0,
) -> LanguageModel:
    """Fit n-gram scores on about ``per_language`` labelled rows of each language where ``training`` holds.

    Which rows are taken is decided by a hash of ``doc_id``. The driver gets the counts of
    ``FEATURES`` features per language, whatever the size of the table. No labelled rows: a
    model without languages, which answers ``und``.
    """
    labelled = docs.filter(training & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((FEATURES, 0)), np.zeros((len(_NAMES) + 1, 0), dtype=bool), penalty)
    number = {name: i for i, name in enumerate(languages)}
    part = F.lit(0.0)
    for name in languages:
        part = F.when(F.col(lang) == name, F.lit(min(1.0, per_language / sizes[name]))).otherwise(part)
    drawn = F.pmod(F.xxhash64(F.col(doc_id), F.lit(3)), F.lit(1 << 20)) < part * (1 << 20)
    sample = labelled.filter(drawn).select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = FEATURES + len(_NAMES) + 1
        found = np.zeros((len(languages), size))
        for batch in batches:
            for body, name in zip(batch["text"], batch["lang"], strict=True):
                times = Counter(_WORD.findall(body))
                if times:
                    feature, owner, script = word_features(list(times))
                    weight = np.array(list(times.values()), dtype=np.float64)
                    letters = weight * [len(word) for word in times]
                    found[number[name]] += np.bincount(feature, weight[owner], size)
                    found[number[name]] += np.bincount(FEATURES + script, letters, size)
        at, key = np.nonzero(found)
        yield pd.DataFrame({"key": key, "at": at, "n": found[at, key].astype(np.int64)})

    sums = sample.mapInPandas(count, "key bigint, at bigint, n bigint").groupBy("key", "at").agg(F.sum("n").alias("n"))
    table, counts = sums.toPandas(), np.zeros((FEATURES + len(_NAMES) + 1, len(languages)))
    counts[table["key"], table["at"]] = table["n"]
    grams, letters = counts[:FEATURES], counts[FEATURES:]
    scores = np.log(grams + 0.5) - np.log(grams.sum(axis=0) + 0.5 * FEATURES)
    scripts = letters >= np.maximum(0.01 * letters.sum(axis=0), 1)
    scripts[-1] = False
    return LanguageModel(languages, scores, scripts, penalty)


def label_languages(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "_language") -> DataFrame:
    """Every row with ``out``: a struct ``lang, score, spans``; one pass, nothing is shuffled.

    Whole texts are read. NULL text, or text without a letter, is ``und`` with
    score 0 and no spans. A column named like ``out`` is replaced.
    """
    columns = [c for c in docs.columns if c != out]
    span = T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]
    )
    fields = [("lang", T.StringType()), ("score", T.DoubleType()), ("spans", T.ArrayType(span))]
    kind = T.StructType([T.StructField(*f) for f in fields])
    schema = T.StructType([*[docs.schema[c] for c in columns], T.StructField(out, kind)])
    arrow = pa.struct(
        [
            ("lang", pa.string()),
            ("score", pa.float64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in (run for whole in batches for run in small_runs(whole, whole.column("_text"))):
            answers = []
            for value in batch.column("_text"):
                name, score, spans = model.label(value.as_py())
                parts = [{"start": a, "end": b, "lang": k} for a, b, k in spans]
                answers.append({"lang": name, "score": score, "spans": parts})
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(answers, arrow)], [*columns, out])

    return docs.select(*columns, F.col(text).alias("_text")).mapInArrow(label, schema)

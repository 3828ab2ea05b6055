"""Toxicity scores from a linear classifier that must not care which group a sentence names."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.llm.tokenizing import small_runs
from promptmill.staging import stage

#: Terms that name groups, class by class, in the languages of the corpus. Terms of a class may stand for each other;
#: the last one of each class names no group in particular. A parameter of the fit, not a list of bad words.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "people"),
    ("woman", "man", "girl", "boy", "lesbian", "person"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "people"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "person"),
    ("black", "white", "asian", "african", "latino", "arab", "european", "american", "some"),
    ("gay", "straight", "bisexual", "queer", "heterosexual", "some"),
    ("immigrants", "refugees", "foreigners", "natives", "people"),
    ("frauen", "männer", "mädchen", "jungen", "ausländer", "flüchtlinge", "menschen"),
    ("femmes", "hommes", "filles", "garçons", "étrangers", "réfugiés", "personnes"),
    ("mujeres", "hombres", "chicas", "chicos", "extranjeros", "refugiados", "personas"),
)
WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of features; ``bias`` alone scores a text without any of them."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)


def features(words: set[str]) -> set[str]:
    """The words themselves, and how those that go on begin."""
    out = set(words)
    for word in words:
        out.update(f"{word[:k]}-" for k in PREFIXES if len(word) > k)
    return out


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def counterfactuals(words: set[str], terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> list[set[str]]:
    """The same words with each identity term swapped for the next of its class, and for the one that names no group."""
    swaps: dict[str, tuple[str, ...]] = {}
    for group in terms:
        for at, term in enumerate(group[:-1]):
            swaps.setdefault(term, (group[(at + 1) % (len(group) - 1)], group[-1]))
    named = [word for word in words if word in swaps]
    if not named:
        return []
    rest = words.difference(named)
    return [rest | {swaps[word][which] for word in named} for which in range(2)]


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, seed: int) -> tuple[DataFrame, dict[int, int]]:
    """``key, label, text`` of about ``per_class`` documents of either label, and how many ids have each label.

    Ids are drawn by hash, so the drawn ones are few enough to be sent to where the texts
    are, and texts that were not drawn move nowhere. Equal texts count once for each label.
    """
    known = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("label") > 0).cast("int")).alias("label"))
    known = stage(known, "labels")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    limits = F.lit(0.0)
    for label, n in counts.items():
        limits = F.when(F.col("label") == label, min(1.0, per_class / n)).otherwise(limits)
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    drawn = docs.select("doc_id", "text").join(F.broadcast(known.filter(place < limits)), "doc_id")
    text = F.coalesce("text", F.lit(""))
    return drawn.select("label", text.alias("text"), F.xxhash64(text).alias("key")).dropDuplicates(["key", "label"]), counts


def _expanded(batches: Iterator[pa.RecordBatch], terms: tuple[tuple[str, ...], ...]) -> Iterator[pa.RecordBatch]:
    """``key, label, kind, features``: kind 0 is the text itself, 1 and 2 are its swapped versions, if it names a group."""
    for whole in batches:
        for batch in small_runs(whole, whole.column("text")):
            rows, kinds, found = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                versions = [words, *counterfactuals(words, terms)]
                for kind, version in enumerate(versions):
                    rows.append(row)
                    kinds.append(kind)
                    found.append(sorted(features(version)))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(take),
                    batch.column("label").take(take),
                    pa.array(kinds, pa.int32()),
                    pa.array(found, pa.list_(pa.string())),
                ],
                ["key", "label", "kind", "features"],
            )


def informative(expanded: DataFrame, most: int, least_gain: float, least_texts: int = 3) -> list[str]:
    """The ``most`` features of the labelled texts that tell the labels apart best; ties by name.

    The gain is their mutual information times the number of texts; twice that follows a chi-square law by
    chance, so that ``least_gain`` keeps out what only happens to differ.
    """
    texts = expanded.filter("kind = 0")
    sizes = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")).first()
    n, bad = F.lit(float(sizes["n"])), F.lit(float(sizes["bad"]))
    seen = texts.select("label", F.explode("features").alias("feature")).groupBy("feature")
    seen = seen.agg(F.count("*").cast("double").alias("with"), F.sum("label").cast("double").alias("hit"))

    def part(joint: Column, left: Column, right: Column) -> Column:
        return F.when(joint > 0, joint * F.log(joint * n / (left * right))).otherwise(0.0)

    having, hit = F.col("with"), F.col("hit")
    gain = (
        part(hit, having, bad)
        + part(having - hit, having, n - bad)
        + part(bad - hit, n - having, bad)
        + part(n - bad - having + hit, n - having, n - bad)
    )
    seen = seen.filter(having >= least_texts).select("feature", gain.alias("gain")).filter(F.col("gain") >= least_gain)
    best = seen.orderBy(F.desc("gain"), "feature").limit(most)
    return sorted(row["feature"] for row in best.select("feature").collect())


class _Rows:
    """Rows of feature numbers, laid end to end."""

    def __init__(self, rows: list[list[int]], width: int):
        self.width, self.count = width, len(rows)
        self.index = np.array([i for row in rows for i in row], dtype=np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(row) for row in rows]) if rows else np.zeros(0, dtype=np.int64)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.index], minlength=self.count)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, weights=values[self.row], minlength=self.width)


def fit_weights(
    rows: list[list[int]],
    labels: np.ndarray,
    importance: np.ndarray,
    before: list[list[int]],
    after: list[list[int]],
    width: int,
    penalty: float,
    decay: float,
    steps: int,
) -> tuple[np.ndarray, float]:
    """Logistic regression whose loss also has ``penalty`` times the mean squared change of the score under a swap.

    ``before`` and ``after`` are the texts with identity terms and their swapped versions. Scores are
    compared before the logistic function, so that a change counts at any height. The minimum of this convex
    loss is approached by Adam with a falling rate.
    """
    x, a, b = _Rows(rows, width), _Rows(before, width), _Rows(after, width)
    w, bias = np.zeros(width), 0.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    share = importance / importance.sum()
    for step in range(1, steps + 1):
        z = x.times(w) + bias
        error = share * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels)
        gradient = x.back(error) + decay * w
        if before:
            change = (2 * penalty / len(before)) * (a.times(w) - b.times(w))
            gradient += a.back(change) - b.back(change)
        whole = np.append(gradient, error.sum())
        m = 0.9 * m + 0.1 * whole
        v = 0.999 * v + 0.001 * whole * whole
        rate = 0.1 * (1 - step / (steps + 1))
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    penalty: float = 10.0,
    per_class: int = 4_000,
    most_features: int = 4_096,
    least_gain: float = 6.0,
    decay: float = 3e-5,
    steps: int = 300,
    seed: int = 7,
) -> ToxicityModel:
    """Learn from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, label``, 1 if toxic).

    The fit uses about ``per_class`` documents of each label, drawn by a hash of the id, and the
    ``most_features`` words and word beginnings of theirs that tell most; both bounds limit what
    reaches the driver. Each label then weighs as much as it has ids. Every text that
    names a group comes with swapped versions, and the score change between them is penalised.
    Words are compared without regard to case. Of several labels of one id the highest
    counts; rows with a NULL id or label are left out, and NULL texts are empty. With labels of one
    kind only, all texts get the score 1 or 0 of that kind, and 0 without any label.
    """
    sampled, counts = labelled_sample(docs, labels, per_class, seed)
    schema = "key bigint, label int, kind int, features array<string>"
    if len(counts) < 2:
        return ToxicityModel(30.0 if counts.get(1) else -30.0)
    expanded = stage(sampled.mapInArrow(lambda batches: _expanded(batches, terms), schema), "toxicity-texts")
    names = informative(expanded, most_features, least_gain)
    table = expanded.sparkSession.createDataFrame(
        [(name, i) for i, name in enumerate(names)], T.StructType([T.StructField("feature", T.StringType()), T.StructField("i", T.IntegerType())])
    )
    each = expanded.select("key", "label", "kind", F.explode("features").alias("feature")).join(F.broadcast(table), "feature")
    numbered = each.groupBy("key", "label", "kind").agg(F.sort_array(F.collect_list("i")).alias("index"))
    found = {(r["key"], r["label"], r["kind"]): r["index"] for r in numbered.collect()}
    keys = sorted((r["key"], r["label"], r["kind"]) for r in expanded.select("key", "label", "kind").collect())
    texts = [key for key in keys if key[2] == 0]
    labels = np.array([key[1] for key in texts], dtype=float)
    weight = {c: n / max(int((labels == c).sum()), 1) for c, n in counts.items()}
    swapped = [key for key in keys if key[2] > 0]
    w, bias = fit_weights(
        [found.get(key, []) for key in texts],
        labels,
        np.array([weight[key[1]] for key in texts]),
        [found.get((*key[:2], 0), []) for key in swapped],
        [found.get(key, []) for key in swapped],
        len(names),
        penalty,
        decay,
        steps,
    )
    return ToxicityModel(bias, {name: float(x) for name, x in zip(names, w.tolist(), strict=True) if x})


class Scorer:
    """Scores of texts; what a word adds is looked up once per worker."""

    def __init__(self, model: ToxicityModel, most_words: int = 200_000):
        self.model, self.most = model, most_words
        self.seen: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: str | None) -> float:
        weights, seen, found = self.model.weights, self.seen, set()
        for word in words_of(text):
            hits = seen.get(word)
            if hits is None:
                if len(seen) >= self.most:
                    seen.clear()
                hits = seen[word] = tuple(name for name in features({word}) if name in weights)
            found.update(hits)
        z = self.model.bias + math.fsum(weights[name] for name in found)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, score`` for every row, repeated ones too: 0 to 1, higher if more likely toxic.

    Whole texts are scored by the words and word beginnings that occur in them. NULL and empty
    texts get the score of a text without any known word.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for whole in batches:
            for batch in small_runs(whole, whole.column("_text")):
                scores = [scorer(x.as_py()) for x in batch.column("_text")]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(score, schema)

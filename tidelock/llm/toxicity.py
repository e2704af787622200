"""Toxicity by classifier chains.

Categories are predicted one after another; the linear model of each sees the
text's features and the probabilities of all categories before it.  In training
those probabilities are out of fold: features are chosen, categories derived and
the model of a category fitted on four fifths of the sample to predict the last
one, so that later models learn from predictions such as they will get, not from
fitted labels.

The labels have one category, toxic, which the chain ends with.  The two before it
are derived from the labels: features that hardly ever stand in texts that are
not toxic are markers; toxic texts with a marker are `marked`, others `unmarked`.

Features are the lower-cased words of a text and their first bytes (4 to 7),
which also catch inflected and compounded words, as 64-bit hashes.  Scoring is a
scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import Scratch, only, utf8

_U = np.uint64
#: Labelled documents that the chain is trained on, at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 12_000
#: Documents of the sample that a feature must stand in, and the chi-square that it must reach (one in a thousand by chance).
LEAST_DOCS, LEAST_CHI = 3, 10.8
#: A marker's share of toxic texts among those that it stands in, at least.
MARKER_SHARE = 0.9
FOLDS = 5
PREFIXES = (4, 5, 6, 7)
#: A category is assigned from this probability.
TOXIC_FROM = 0.4
#: In the chain's order.
CATEGORIES = ("marked", "unmarked", "toxic")


def text_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all texts and the text of each, repeats included."""
    buf = tv.lower_ascii(buf)
    runs = tv.Runs(buf, offsets, tv.ALNUM)
    text, length = runs.text_of(), runs.ends - runs.starts
    keys, owners = [tv.span_hashes(buf, runs.starts, runs.ends)], [text]
    for n in PREFIXES:
        long = length > n
        keys.append(tv.span_hashes(buf, runs.starts[long], runs.starts[long] + n) ^ _U(n))
        owners.append(text[long])
    return np.concatenate(keys), np.concatenate(owners)


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def probabilities(self, rows: np.ndarray, columns: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        """rows, columns: the features that each of n texts has; before: probabilities of earlier categories."""
        score = np.bincount(rows, self.weights[columns], n) + self.bias
        if before.shape[1]:
            score = score + before @ self.weights[-before.shape[1] :]
        return 1 / (1 + np.exp(-np.clip(score, -40, 40)))


def fit_linear(rows: np.ndarray, columns: np.ndarray, n_features: int, before: np.ndarray, y: np.ndarray, rounds: int = 200, ridge: float = 1e-3, rate: float = 0.1) -> Linear:
    """Logistic regression with a ridge, by Adam over the whole sample; both classes weigh alike."""
    n, k = before.shape
    w, bias = np.zeros(n_features + k), 0.0
    positive = max(1.0, y.sum())
    weight = np.where(y > 0, n / (2 * positive), n / (2 * max(1.0, n - positive)))
    first, second, step = np.zeros(n_features + k + 1), np.zeros(n_features + k + 1), 0
    for step in range(1, rounds + 1):
        p = Linear(w, bias).probabilities(rows, columns, n, before)
        error = weight * (p - y) / n
        gradient = np.concatenate((np.bincount(columns, error[rows], n_features), error @ before, [error.sum()]))
        gradient[:-1] += ridge * w
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        change = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - change[:-1], bias - change[-1]
    return Linear(w, float(bias))


@dataclass
class Chain:
    categories: tuple[str, ...]
    keys: np.ndarray  # sorted feature hashes
    models: list[Linear]

    def columns(self, keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The known features of texts, each once."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        pairs = np.unique(text[known] * len(self.keys) + at[known])
        return pairs // len(self.keys), pairs % len(self.keys)

    def probabilities(self, keys: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        rows, columns = self.columns(keys, text)
        out = np.zeros((n, 0))
        for model in self.models:
            out = np.column_stack((out, model.probabilities(rows, columns, n, out)))
        return out


@dataclass
class Choice:
    """Features that go with toxic texts in a part of the sample, and which of them are markers there."""

    chosen: np.ndarray
    markers: np.ndarray

    @classmethod
    def of(cls, docs: np.ndarray, toxic: np.ndarray, n: int, n_toxic: int) -> Choice:
        """docs, toxic: how many of the part's n texts, and of its n_toxic toxic ones, each feature stands in."""
        share = n_toxic / max(n, 1)
        expected = docs * share
        chi = (toxic - expected) ** 2 / np.maximum(expected * (1 - share) * np.maximum(1 - docs / max(n, 1), 1e-9), 1e-9)
        chosen = (docs >= LEAST_DOCS) & (chi > LEAST_CHI)
        return cls(chosen, chosen & (toxic >= MARKER_SHARE * docs))

    def labels(self, rows: np.ndarray, columns: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """A column for each of CATEGORIES."""
        marked = np.bincount(rows, self.markers[columns], len(toxic)) > 0
        return np.column_stack((toxic & marked, toxic & ~marked, toxic)).astype(float)


def fit_chain(keys: np.ndarray, choices: list[Choice], texts: list[np.ndarray], toxic: np.ndarray, fold: np.ndarray) -> Chain:
    """keys: sorted feature hashes; choices: of the whole sample, then without each fold; texts: which features (by number) each labelled text has."""
    n = len(texts)
    rows = np.repeat(np.arange(n), [len(t) for t in texts])
    columns = np.concatenate(texts).astype(np.int64) if n else np.zeros(0, np.int64)
    known = np.flatnonzero(choices[0].chosen)
    chain, before = Chain(CATEGORIES, keys[known], []), np.zeros((n, 0))
    labels = [c.labels(rows, columns, toxic) for c in choices]
    for k in range(len(CATEGORIES)):
        use = choices[0].chosen[columns]
        chain.models.append(fit_linear(rows[use], np.searchsorted(known, columns[use]), len(known), before, labels[0][:, k]))
        held_out = np.zeros(n)
        for f, choice in enumerate(choices[1:]):
            inside, number, use = fold != f, np.cumsum(fold != f) - 1, choice.chosen[columns]
            own = use & inside[rows]
            model = fit_linear(number[rows[own]], columns[own], len(keys), before[inside], labels[f + 1][inside, k])
            held_out[fold == f] = model.probabilities(rows[use], columns[use], n, before)[fold == f]
        before = np.column_stack((before, held_out))
    return chain


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, buf, offsets in tv.steps(batches, "text"):
        keys, text = tv.distinct(*text_features(buf, offsets))
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array([keys[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], names=["doc_id", "hash", "label", "keys"])


_COUNTS = [f"{kind}_{f}" for f in range(FOLDS) for kind in ("docs", "toxic")]


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts, and toxic ones, that a feature stands in, in each fold."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            some = batch.slice(at, 500)
            keys = [np.frombuffer(k, _U) for k in some.column("keys").to_pylist()]
            sizes = [len(k) for k in keys]
            fold, toxic = np.repeat(some.column("fold").to_numpy(), sizes), np.repeat(some.column("label").to_numpy() > 0, sizes)
            distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
            sums = [np.bincount(which[part], minlength=len(distinct)).astype(np.int32) for f in range(FOLDS) for part in (fold == f, (fold == f) & toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), *map(pa.array, sums)], names=["key", *_COUNTS])


def _numbered(batches: Iterator[pa.RecordBatch], kept: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The numbers of the kept features that each text has."""
    for batch in batches:
        found = [np.flatnonzero(np.isin(kept, np.frombuffer(k, _U))).astype(np.int32).tobytes() for k in batch.column("keys").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "label", "fold")), pa.array(found, pa.binary())], names=["doc_id", "label", "fold", "numbers"])


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, bound: int = TRAIN_ROWS) -> Chain | None:
    """A chain for labels.toxic from at most `bound` labelled documents; None where labels lack a class.

    A doc_id counts once: toxic if any of its labels says so, and with that of its texts that has the smallest hash.
    Features are counted over the cluster; the driver gets those that pass the test in some part of the sample, which the
    sample bounds, and their numbers in each of its texts.
    """
    picked = only(labels, doc_id=F.col("doc_id").cast("long"), label=F.col("toxic").cast("int")).where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # two numbers a row and at most `bound` rows
    sample = only(docs, doc_id=F.col("doc_id").cast("long"), text=utf8("text")).join(F.broadcast(picked), "doc_id").select("doc_id", F.xxhash64("text").alias("hash"), "label", "text")
    sample = sample.mapInArrow(_training_rows, "doc_id long, hash long, label int, keys binary").groupBy("doc_id").agg(F.min(F.struct("hash", "label", "keys")).alias("one"))
    sample = scratch.keep(sample.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"), "one.label", "one.keys"), "sample")
    held = np.zeros((FOLDS, 2), np.int64)
    for row in sample.groupBy("fold").agg(F.count("*").alias("n"), F.count_if(F.col("label") > 0).alias("toxic")).collect():
        held[row.fold] = row.n, row.toxic
    n, n_toxic = held.sum(0)
    if n < 2 * FOLDS or n_toxic in (0, n):
        return None
    counts = sample.mapInArrow(_feature_counts, "key long, " + ", ".join(f"{c} int" for c in _COUNTS)).groupBy("key").agg(*(F.sum(c).cast("int").alias(c) for c in _COUNTS))
    counts = counts.where(" + ".join(f"docs_{f}" for f in range(FOLDS)) + f" >= {LEAST_DOCS}")
    keys, found = _passing(counts, held)
    choices = [Choice.of(found[:, :, 0].sum(1), found[:, :, 1].sum(1), n, n_toxic)]
    for f in range(FOLDS):
        rest = np.arange(FOLDS) != f
        choices.append(Choice.of(found[:, rest, 0].sum(1), found[:, rest, 1].sum(1), *held[rest].sum(0)))
    rows = sample.mapInArrow(lambda b: _numbered(b, keys), "doc_id long, label int, fold int, numbers binary").toPandas().sort_values("doc_id")
    return fit_chain(keys, choices, [np.frombuffer(x, np.int32) for x in rows["numbers"]], rows["label"].to_numpy() > 0, rows["fold"].to_numpy())


def _passing(counts: DataFrame, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted features that pass the test in the sample or without one of its folds, and their counts by fold (texts, toxic ones)."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = np.stack([batch.column(c).to_numpy() for c in _COUNTS], 1).reshape(-1, FOLDS, 2)
            passes = np.zeros(len(each), bool)
            for left_out in range(-1, FOLDS):
                rest = np.arange(FOLDS) != left_out
                passes |= Choice.of(each[:, rest, 0].sum(1), each[:, rest, 1].sum(1), *held[rest].sum(0)).chosen
            yield batch.filter(pa.array(passes))

    found = counts.mapInArrow(test, counts.schema).toArrow().sort_by("key")
    keys = found.column("key").to_numpy().view(_U)
    order = np.argsort(keys)
    return keys[order], np.stack([found.column(c).to_numpy() for c in _COUNTS], 1).reshape(-1, FOLDS, 2)[order]


def _score(batches: Iterator[pa.RecordBatch], chain: Chain | None, toxic_from: float) -> Iterator[pa.RecordBatch]:
    categories = chain.categories if chain else CATEGORIES
    for batch, buf, offsets in tv.steps(batches, "text"):
        p = chain.probabilities(*text_features(buf, offsets), batch.num_rows) if chain else np.zeros((batch.num_rows, len(categories)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, k]) for k in range(p.shape[1])), pa.array(p[:, -1] >= toxic_from)], names=["doc_id", *(f"p_{c}" for c in categories), "toxic"])


def judge(docs: DataFrame, chain: Chain | None, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """Per row: doc_id, a probability for each category and toxic.

    Null and empty texts have no features and get the models' base rates.  Without a chain nothing is toxic.  Rows that
    repeat a doc_id are judged each for itself.  Other columns are not read.  An empty table gives no rows.
    """
    source = only(docs, doc_id=F.col("doc_id").cast("long"), text=utf8("text"))
    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in (chain.categories if chain else CATEGORIES)) + ", toxic boolean"
    return source.mapInArrow(lambda b: _score(b, chain, toxic_from), schema)

"""Quality rules: document statistics, judged by gradient-boosted trees with monotonic constraints.

The statistics of a whole text are made in one vectorised pass; the trees are
trained on a bounded sample of labelled documents and score in the same pass,
so judging the corpus is a scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from . import textvec as tv
from .shared import only, packed, utf8

#: Labelled documents that the trees are trained on, at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 20_000
#: The base rule: fewer words, or a larger share (in percent) of words in repeated windows, fails.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: A document is kept from this probability of good quality.
KEEP_FROM = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Model features and how the score may move with each: -1 only down, 0 either way.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "mark_share": -1,
    "bar_share": -1, "same_next_share": -1, "distinct_share": 0, "line_words": 0, "digit_share": 0, "comma_share": 0, "stop_share": 0,
}

_table = lambda chars: tv.is_byte_in(*[(ord(c), ord(c)) for c in chars])
SYMBOLS, MARKS, BARS, COMMAS, STOPS = _table("#*$%&|<>"), _table("!?"), _table("|"), _table(","), _table(".")
UPPER, DIGITS, NEWLINE = tv.is_byte_in((65, 90)), tv.is_byte_in((48, 57)), tv.is_byte_in((10, 10))
LEADING = ~tv.is_byte_in((0x80, 0xBF))


def _per_text(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes are marked in each text."""
    sums = np.concatenate(([0], np.cumsum(marked, dtype=np.int64)))
    return np.diff(sums[offsets])


def _again(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which items occur more than once in their text, and which of them are not the first."""
    order = np.lexsort((keys, text))
    k, t = keys[order], text[order]
    same = np.concatenate(([False], (k[1:] == k[:-1]) & (t[1:] == t[:-1])))
    out, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    out[order] = same | np.concatenate((same[1:], [False]))
    later[order] = same
    return out, later


def statistics(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the counts of COUNTS and the values of FEATURES."""
    texts = len(offsets) - 1
    runs = tv.Runs(buf, offsets, tv.SPACED)
    words, text = tv.span_hashes(buf, runs.starts, runs.ends), runs.text_of()
    n = runs.count
    word_chars = _per_text(LEADING[buf] & tv.SPACED[buf], offsets)
    symbols = _per_text(SYMBOLS[buf], offsets)

    lines = tv.Runs(buf, offsets, ~NEWLINE)
    with_word = np.searchsorted(runs.starts, lines.ends) > np.searchsorted(runs.starts, lines.starts)
    line_text = lines.text_of()[with_word]
    _, later = _again(tv.span_hashes(buf, lines.starts[with_word], lines.ends[with_word]), line_text)
    dup_lines, n_lines = np.bincount(line_text[later], minlength=texts), np.bincount(line_text, minlength=texts)

    at, window_text = tv.window_starts(runs.first, n, WINDOW)
    twice, _ = _again(tv.window_hashes(words, WINDOW)[at], window_text)
    change = np.zeros(len(words) + 1, np.int64)
    change[at[twice]] += 1
    np.add.at(change, at[twice] + WINDOW, -1)
    repeated = np.bincount(text[np.cumsum(change[:-1]) > 0], minlength=texts)

    same_next = np.bincount(text[1:][(words[1:] == words[:-1]) & (text[1:] == text[:-1])], minlength=texts)
    _, distinct_text = tv.distinct(words, text)
    counts = np.stack([n, word_chars, symbols, dup_lines, repeated], 1).astype(np.int64)
    w, c, b = np.maximum(n, 1), np.maximum(word_chars, 1), buf
    features = np.stack(
        [
            np.log1p(n), word_chars / w, symbols / c, symbols / w, dup_lines / np.maximum(n_lines, 1), repeated / w, _per_text(UPPER[b], offsets) / c, _per_text(MARKS[b], offsets) / w,
            _per_text(BARS[b], offsets) / w, same_next / w, np.bincount(distinct_text, minlength=texts) / w, n / np.maximum(n_lines, 1), _per_text(DIGITS[b], offsets) / c, _per_text(COMMAS[b], offsets) / w, _per_text(STOPS[b], offsets) / w,
        ],
        1,
    )
    return counts, features


def _base_failed(counts: np.ndarray) -> np.ndarray:
    n, repeated = counts[:, 0], counts[:, 4]
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


JUDGED = ", ".join(f"{c} long" for c in ("doc_id", *COUNTS)) + ", base_failed boolean, score double, kept boolean"


def _judge(batches: Iterator[pa.RecordBatch], model: boosting.FlatTrees | None, keep_from: float) -> Iterator[pa.RecordBatch]:
    for batch, buf, offsets in tv.steps(batches, "text"):
        counts, features = statistics(buf, offsets)
        failed = _base_failed(counts)
        score = model.probabilities(features) if model else np.ones(len(counts))
        columns = [batch.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep_from))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "score", "kept"])


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, buf, offsets in tv.steps(batches, "text"):
        counts, features = statistics(buf, offsets)
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(_base_failed(counts)), pa.array(features.tolist(), pa.list_(pa.float64()))], names=["doc_id", "hash", "good", "failed", "features"])


def labelled(docs: DataFrame, labels: DataFrame, column: str, bound: int) -> DataFrame:
    """The texts of at most `bound` labelled documents (doc_id, hash, label, text), those with the smallest hashes of their ids.

    A doc_id with several labels has the least of them.
    """
    picked = only(labels, doc_id=F.col("doc_id").cast("long"), label=F.col(column).cast("int")).where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    # two numbers a row and at most `bound` rows
    return only(docs, doc_id=F.col("doc_id").cast("long"), text=utf8("text")).join(F.broadcast(picked), "doc_id").select("doc_id", F.xxhash64("text").alias("hash"), "label", "text")


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS, **settings) -> boosting.FlatTrees | None:
    """Trees for labels.quality; None, which keeps all that passes the base rule, where labels lack a class.

    A doc_id counts once: with the least of its labels, and of its texts that with the smallest hash.
    """
    rows = labelled(docs, labels, "quality", bound).mapInArrow(_training_rows, "doc_id long, hash long, good int, failed boolean, features array<double>")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("hash", "good", "failed", "features")).alias("one")).select("one.*").where("not failed").toPandas()
    rows = rows.iloc[rows["features"].map(tuple).argsort(kind="stable").to_numpy()] if len(rows) else rows
    y = rows["good"].to_numpy(float)
    if len(rows) < 20 or y.min() == y.max():
        return None
    return boosting.fit(np.stack(rows["features"].to_numpy()), y, np.array(list(FEATURES.values())), **settings)


def judge(docs: DataFrame, model: boosting.FlatTrees | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, score (probability of good quality) and kept.

    Null and empty texts have no words and fail the base rule.  Rows that repeat a doc_id are judged each for
    itself.  Other columns are not read.  An empty table gives no rows.
    """
    source = only(docs, doc_id=F.col("doc_id").cast("long"), text=utf8("text"))
    return source.mapInArrow(lambda batches: _judge(batches, model, keep_from), JUDGED)


def keep_documents(docs: DataFrame, model: boosting.FlatTrees | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of docs, with all their columns, that judge() keeps; nothing is joined or shuffled, and Python gets texts alone."""

    def keep(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.bool_())]
        for _, _, buf, offsets in tv.text_steps(texts):
            counts, features = statistics(buf, offsets)
            score = model.probabilities(features) if model else np.ones(len(counts))
            parts.append(pa.array(~_base_failed(counts) & (score >= keep_from)))
        return pa.concat_arrays(parts)

    return packed(docs, text=utf8("text")).where(F.arrow_udf(keep, "boolean")("text")).select("row.*")

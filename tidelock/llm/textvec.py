"""Vectorised word and line work over the UTF-8 buffers of Arrow columns.

Texts stay in one byte buffer; words are found with a 256-entry byte table and
hashed eight bytes at a time, all words of a step at once, so no Python object
is made per word.  Hashes are chains of a bijective mixing step, which no
structure in the input (such as the sums of powers have) makes collide.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

#: Bytes of text that one step works on (a longer single text is one step).
STEP_BYTES = 1 << 20

_U = np.uint64
#: Bytes that are hashed in a chain; longer spans are hashes of the hashes of such blocks.
BLOCK_BYTES = 64


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the public SplitMix64 generator: a bijection of 64-bit values."""
    z = x + _U(0x9E3779B97F4A7C15)
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


def is_byte_in(*ranges: tuple[int, int]) -> np.ndarray:
    """Byte table that is true within the given inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Words of `[^\x20\x09-\x0D]+`.
SPACED = ~is_byte_in((0x20, 0x20), (0x09, 0x0D))
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in text whose A-Z are lower-cased.
ALNUM = ~is_byte_in((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


_kept: dict = {"stage": None}


def _stage() -> int | None:
    context = TaskContext.get()
    return context.stageId() if context else None


def kept_for_stage(key, make):
    """What a Python worker keeps between tasks of one stage; workers live on, so other stages' things go."""
    if _kept["stage"] != _stage():
        _kept.clear()
        _kept["stage"] = _stage()
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def steps(batches, column: str, limit: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most `limit` bytes of text (one row at least).

    Yields (slice, bytes, offsets): row i's text is bytes[offsets[i]:offsets[i + 1]]; null is empty.
    """
    for batch in batches:
        for at, end, data, offsets in text_steps(batch.column(batch.schema.get_field_index(column)), limit):
            yield batch.slice(at, end - at), data, offsets
        give_back()


@cache
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def give_back() -> None:
    """Gives memory that is free to the system: workers live on between tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


def text_steps(col: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of slices of a column, as in steps."""
    if _kept["stage"] != _stage():
        _kept.clear()
        _kept["stage"] = _stage()
    if not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    if not len(col):
        return
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and col.buffers()[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(col))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class Runs:
    """Maximal runs of bytes that a table marks, none across two texts."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        mark = np.zeros(len(buf) + 1, bool)
        np.take(table, buf, out=mark[:-1])
        edge = np.zeros(len(buf) + 1, bool)
        edge[offsets] = True
        before = np.concatenate(([False], mark[:-1]))
        self.starts = np.flatnonzero(mark & (~before | edge))
        self.ends = np.flatnonzero(before & (~mark | edge))
        #: text i has the words first[i] to first[i + 1]
        self.first = np.searchsorted(self.starts, offsets)
        self.count = np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span; other seeds give independent ones."""
    size = ends - starts
    out = splitmix(size.astype(_U) + _U(seed << 48))
    eight = np.ndarray((len(buf) + 1,), "<u8", np.concatenate((buf, np.zeros(8, np.uint8))), strides=(1,))
    live = np.flatnonzero((size > 0) & (size <= BLOCK_BYTES))
    at = 0
    while len(live):
        left = size[live] - at
        out[live] = splitmix(out[live] ^ eight[starts[live] + at] & _KEEP[np.minimum(left, 8)])
        at += 8
        live = live[left > 8]
    long = np.flatnonzero(size > BLOCK_BYTES)
    if len(long):
        blocks = -(-size[long] // BLOCK_BYTES)
        first = np.concatenate(([0], np.cumsum(blocks)))
        begin = np.repeat(starts[long] - first[:-1] * BLOCK_BYTES, blocks) + np.arange(first[-1]) * BLOCK_BYTES
        each = span_hashes(buf, begin, np.minimum(begin + BLOCK_BYTES, np.repeat(ends[long], blocks)), seed)
        out[long] = splitmix(out[long] ^ span_hashes(each.view(np.uint8), first[:-1] * 8, first[1:] * 8, seed))
    return out


def sequence_hashes(words: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each range of word hashes."""
    return span_hashes(words.view(np.uint8), first * 8, last * 8, seed)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive word hashes; item i is the window that starts at word i.

    Windows of twice the length are made from two of the length before, and n from those of its binary digits.
    """
    if len(words) < n:
        return np.zeros(0, _U)
    out, done, power, size = None, 0, words, 1
    while True:
        if n & size:
            part = power[done : done + len(words) - n + 1]
            out = part if out is None else _joined(out, part)
            done += size
        size *= 2
        if size > n:
            return splitmix(out)
        power = _joined(power[: len(power) - size // 2], power[size // 2 :])


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return splitmix(a * _U(0xD6E8FEB86659FD93) + b)


def window_starts(first: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which a window of n words fits in its text, and the text of each."""
    fits = np.maximum(count - n + 1, 0)
    text = np.repeat(np.arange(len(count)), fits)
    within = np.arange(fits.sum()) - np.repeat(np.cumsum(fits) - fits, fits)
    return first[:-1][text] + within, text


def distinct(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, key) pairs, ordered by text and then key."""
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[new], text[new]

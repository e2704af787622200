"""Packing: shortest-pack-first over the length histogram.

Documents are cut into pieces of at most a sequence; the pieces' lengths are
counted into a histogram, which has as many bins as a sequence has tokens
however large the corpus is.  Bins are placed longest first, each into the
packs with the most room left, and only counts of packing patterns are kept.
Patterns are joined back to pieces by the pieces' rank among those of their
length, which is found without gathering the pieces of a length anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import Scratch, only, utf8
from .tokens import ENCODE_BYTES, Vocabulary

SEQUENCE_TOKENS = 2048
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long"


def shortest_pack_first(counts: np.ndarray, room: int) -> list[tuple[int, list[int]]]:
    """Patterns (count, lengths in order) for a histogram: counts[n] pieces of length n.

    Each length, longest first, goes to the pack with the most room left that it fits, a new one if there is none;
    packs of one pattern move together.
    """
    open_packs: dict[int, list[tuple[int, list[int]]]] = {}  # by room left
    full: list[tuple[int, list[int]]] = []
    for length in range(min(room, len(counts) - 1), 0, -1):
        left = int(counts[length])
        while left:
            top = max(open_packs, default=0)
            if top < length:
                put, pattern, space = left, [], room
            else:
                count, pattern = open_packs[top].pop()
                if not open_packs[top]:
                    del open_packs[top]
                put, space = min(left, count), top
                if count > put:
                    open_packs.setdefault(top, []).append((count - put, pattern))
            left -= put
            pack = (put, [*pattern, length])
            if space == length:
                full.append(pack)
            else:
                open_packs.setdefault(space - length, []).append(pack)
    return full + [p for space in sorted(open_packs) for p in open_packs[space]]


class Places:
    """Where the pieces of each length go: ranges of ranks with the first one's sequence, their offset, and how often the
    length stands in the pattern.

    A pattern has at most 63 different lengths, whose sum is a sequence's 2048 tokens at most, and every bin adds at
    most two patterns, so there are below 260,000 ranges of 40 bytes however large the corpus is.
    """

    def __init__(self, patterns: list[tuple[int, list[int]]]):
        rows, used, sequence = [], {}, 0
        for count, lengths in patterns:
            offset = 0
            for length, same in groupby(lengths):
                times, rank = len(list(same)), used.get(length, 0)
                rows.append((length, rank, sequence, offset, times))
                used[length] = rank + count * times
                offset += length * times
            sequence += count
        rows.sort()
        self.length, self.rank, self.sequence, self.offset, self.times = np.array(rows, np.int64).reshape(-1, 5).T
        self.first = np.searchsorted(self.length, np.arange(self.length.max(initial=0) + 2))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        order = np.lexsort((rank, length))
        at = np.empty(len(length), np.int64)
        n, r = length[order], rank[order]
        edges = np.searchsorted(n, np.unique(n))
        for a, b in zip(edges, [*edges[1:], len(n)], strict=True):
            lo, hi = self.first[n[a]], self.first[n[a] + 1]
            at[order[a:b]] = lo + np.searchsorted(self.rank[lo:hi], r[a:b], "right") - 1
        nth = rank - self.rank[at]
        return self.sequence[at] + nth // self.times[at], self.offset[at] + nth % self.times[at] * length


def _cut(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, end_id: int, room: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder, part, seen = vocabulary.encoder(), TaskContext.get().partitionId(), np.zeros(room + 1, np.int64)
    end = np.array([end_id], "<u4")
    names = [f.split()[0] for f in PIECES.split(", ")]
    for batch, buf, offsets in tv.steps(batches, "text", ENCODE_BYTES):
        all_ids, at = encoder.encode(buf, offsets)
        rows, ids = [], []
        for doc_id, a, b in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
            data = np.concatenate((all_ids[a:b].astype("<u4"), end))
            for start in range(0, len(data), room):
                piece = data[start : start + room]
                rows.append((doc_id, start, len(piece), zlib.crc32(piece), len(data), part, int(seen[len(piece)])))
                seen[len(piece)] += 1
                if with_ids:
                    ids.append(piece.tobytes())
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        if with_ids:
            columns.append(pa.array(ids, pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)


def pack(docs: DataFrame, vocabulary: Vocabulary, end_id: int, scratch: Scratch, room: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset (and its ids, little-endian, if asked for).

    A null text is empty and has the end id alone.  Rows that repeat a doc_id, and rows whose doc_id is null, are
    packed each for itself.  Other columns are not read.  An empty table has no pieces.
    """
    source = only(docs, doc_id=F.col("doc_id").cast("long"), text=utf8("text"))
    schema = PIECES + ", ids binary" * with_ids
    pieces = scratch.keep(source.mapInArrow(lambda b: _cut(b, vocabulary, end_id, room, with_ids), schema), "pieces")
    held = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # at most `room` rows, each a count
    histogram = np.zeros(room + 1, np.int64)
    for row in held.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row.length] = row.n
    patterns = shortest_pack_first(histogram, room)
    # as many rows as patterns have lengths, which the number of bins bounds and the corpus does not
    places = pieces.sparkSession.sparkContext.broadcast(Places(patterns))
    # a task has at most one row a length here, and each window has a row a task
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = scratch.keep(held.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "base")
    ranked = pieces.join(base.hint("merge"), ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = places.value.find(b.column("length").to_numpy(), b.column("rank").to_numpy())
            kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept[:5]), pa.array(sequence), pa.array(offset), *(b.column(c) for c in kept[5:])], names=[*kept[:5], "sequence_id", "offset", *kept[5:]])

    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences (sequence_id, ids, piece_starts) of pieces with ids; a group is one sequence."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(inside.alias("p")).select("sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"), F.col("p.offset").alias("piece_starts"))

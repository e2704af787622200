"""Benchmark decontamination: an FM-index over each shard of training text.

A shard is one step of texts in a task.  Its words become ids of the test
phrases' vocabulary; the suffixes of that id sequence are sorted, their
preceding symbols go into a wavelet matrix, and all phrases are searched
backward at once by ranks.  Occurrences are located by walking to sampled
suffix positions, and what they cover is merged into removal spans.

A word outside the vocabulary can't be part of an occurrence and neither can a
run of vocabulary words that is shorter than the shortest phrase.  Both stand
as one separator, which keeps the index small without losing an occurrence.
Documents are not shuffled.  Phrases are broadcast in blocks of a checked size,
one at a time: where a benchmark takes several, each pass is written before the
next one's phrases are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import Marks, Scratch, only, packed, utf8

#: Phrases (windows of test items) that are searched in one pass over the documents.
PHRASES_PER_PASS = 200_000
WINDOW_WORDS = 10
#: Every so manieth position of a shard keeps its place, and so do the starts of runs.
SAMPLE_EVERY = 16


class WaveletMatrix:
    """Ranks of symbols in a sequence, over bit vectors of 64-bit words with block counts."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.levels = len(symbols), []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            words = np.zeros((self.n >> 6) + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            blocks = np.concatenate(([0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)))
            zeros = self.n - int(bit.sum())
            self.levels.append((level, words, blocks, zeros))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    @staticmethod
    def _ones(words: np.ndarray, blocks: np.ndarray, at: np.ndarray) -> np.ndarray:
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return blocks[at >> 6] + np.bitwise_count(words[at >> 6] & below)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        start = np.zeros_like(at)
        for level, words, blocks, zeros in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            s, e = self._ones(words, blocks, start), self._ones(words, blocks, at)
            start = np.where(one, zeros + s, start - s)
            at = np.where(one, zeros + e, at - e)
        return at - start


class FMIndex:
    """Full-text index of a sequence of ids; id 0 is a separator, no two of which are alike."""

    def __init__(self, ids: np.ndarray, sample_every: int = SAMPLE_EVERY):
        n = len(ids)
        suffixes = self._suffixes(ids)
        before = np.where(suffixes > 0, ids[suffixes - 1], 0)
        self.bwt, self.n = before, n
        self.bits = max(1, int(ids.max(initial=0)).bit_length())
        self.wavelet = WaveletMatrix(before, self.bits)
        counts = np.bincount(ids, minlength=(1 << self.bits) + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.sampled = (suffixes % sample_every == 0) | (before == 0)
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = suffixes[self.sampled]

    @staticmethod
    def _suffixes(ids: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling; it takes log2 of the longest run's rounds."""
        n = len(ids)
        if not n:
            return np.zeros(0, np.int64)
        sep = ids == 0
        rank = np.where(sep, np.cumsum(sep) - 1, ids + int(sep.sum())).astype(np.int64)
        width = 1
        while True:
            after = np.full(n, -1, np.int64)
            after[: max(0, n - width)] = rank[width:]
            after[sep] = -1
            key = rank * (2 * n + int(ids.max()) + 3) + after + 1
            order = np.argsort(key, kind="stable")
            new = np.concatenate(([False], key[order][1:] != key[order][:-1]))
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            if rank[order[-1]] == n - 1:
                return order
            width *= 2

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of phrases, whose ids stand at the right of each row."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        width = phrases.shape[1]
        for back in range(1, width + 1):
            live = np.flatnonzero((lengths >= back) & (hi > lo))
            if not len(live):
                break
            c = phrases[live, width - back]
            known = c < len(self.first) - 1
            c = np.where(known, c, 0)
            inside = known & (c >> self.bits == 0)
            lo_c = self.first[c] + self.wavelet.rank(c, lo[live])
            hi_c = self.first[c] + self.wavelet.rank(c, hi[live])
            lo[live], hi[live] = lo_c, np.where(inside, hi_c, lo_c)
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by walking back to the next sampled one."""
        rows, walked = rows.copy(), np.zeros(len(rows), np.int64)
        while len(open_ := np.flatnonzero(~self.sampled[rows])):
            c = self.bwt[rows[open_]]
            rows[open_] = self.first[c] + self.wavelet.rank(c, rows[open_])
            walked[open_] += 1
        return self.samples[self.sample_rank[rows]] + walked


class Phrases:
    """Windows of test items as word-id sequences, and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW_WORDS):
        vocabulary: dict[bytes, int] = {}
        held: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            data = tv.lower_ascii(np.frombuffer((text or "").encode(), np.uint8))
            runs = tv.Runs(data, np.array([0, len(data)]), tv.ALNUM)
            raw = data.tobytes()
            ids = [vocabulary.setdefault(raw[a:b], len(vocabulary) + 1) for a, b in zip(runs.starts, runs.ends, strict=True)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                held.setdefault(tuple(ids[at : at + window]), set()).add(item)
        data = b"".join(vocabulary)
        ends = np.cumsum([len(w) for w in vocabulary], dtype=np.int64)
        hashes = tv.span_hashes(np.frombuffer(data, np.uint8), np.concatenate(([0], ends[:-1])).astype(np.int64), ends) if vocabulary else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order + 1
        #: a first look by 18 bits of the hash
        self.seen = np.zeros(1 << 18, bool)
        self.seen[(hashes >> np.uint64(46)).astype(np.int64)] = True
        self.lengths = np.array([len(p) for p in held], np.int64)
        self.matrix = np.zeros((len(held), window), np.int64)
        for row, p in enumerate(held):
            self.matrix[row, window - len(p) :] = p
        self.items = [sorted(i for i in x if i is not None) for x in held.values()]
        self.shortest = int(self.lengths.min(initial=window))

    def ids_of(self, words: np.ndarray) -> np.ndarray:
        """Vocabulary ids of word hashes; 0 where there is none."""
        out = np.zeros(len(words), np.int64)
        if len(self.hashes):
            maybe = np.flatnonzero(self.seen[(words >> np.uint64(46)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, words[maybe]), len(self.hashes) - 1)
            found = self.hashes[at] == words[maybe]
            out[maybe[found]] = self.ids[at[found]]
        return out


def _occurrences(ids: np.ndarray, text: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and phrase numbers of all occurrences in a shard."""
    none = np.zeros(0, np.int64)
    inside = ids > 0
    edge = np.ones(len(ids) + 1, bool)
    if len(ids):
        edge[1:-1] = text[1:] != text[:-1]
    before = np.concatenate(([False], inside))[: len(ids)]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False]))[: len(ids)]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    long = ends - starts >= phrases.shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return none, none
    sizes = ends - starts + 1  # and a separator
    total = int(sizes.sum())
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.repeat(starts, sizes) + np.arange(total) - base
    last = np.cumsum(sizes) - 1
    shard = ids[np.minimum(place, len(ids) - 1)]
    shard[last] = 0
    index = FMIndex(shard)
    lo, hi = index.search(phrases.matrix, phrases.lengths)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return none, none
    n = hi[found] - lo[found]
    phrase = np.repeat(found, n)
    rows = np.repeat(lo[found], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return place[index.locate(rows)], phrase


FOUND = "doc_id long, text_md5 string, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int,word:int,end_word:int>>"


_SPANS = pa.list_(pa.struct([(k, pa.int32()) for k in ("start", "end", "word", "end_word")]))


def _found(rows: int, buf: np.ndarray, offsets: np.ndarray, phrases: Phrases) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """n_words, n_hit, items and spans of the texts of one shard."""
    buf = tv.lower_ascii(buf)
    runs = tv.Runs(buf, offsets, tv.ALNUM)
    text = runs.text_of()
    place, phrase = _occurrences(phrases.ids_of(tv.span_hashes(buf, runs.starts, runs.ends)), text, phrases)
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + phrases.lengths[phrase], -1)
    hit = np.cumsum(change[:-1]) > 0
    n_hit = np.bincount(text[hit], minlength=rows)
    items: list[set[str]] = [set() for _ in range(rows)]
    seen = np.unique(np.stack([text[place], phrase], 1), axis=0) if len(place) else np.zeros((0, 2), np.int64)
    for t, p in seen.tolist():
        items[t].update(phrases.items[p])
    spans: list[list[dict]] = [[] for _ in range(rows)]
    first = hit & np.concatenate(([True], ~hit[:-1] | (text[1:] != text[:-1])))[: len(hit)]
    last = hit & np.concatenate((~hit[1:] | (text[1:] != text[:-1]), [True]))[: len(hit)]
    for a, b in zip(np.flatnonzero(first).tolist(), np.flatnonzero(last).tolist(), strict=True):
        t = int(text[a])
        spans[t].append({"start": int(runs.starts[a] - offsets[t]), "end": int(runs.ends[b] - offsets[t]), "word": a - int(runs.first[t]), "end_word": b + 1 - int(runs.first[t])})
    return pa.array(runs.count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(spans, _SPANS)


def _search(batches: Iterator[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    for batch, buf, offsets in tv.steps(batches, "text"):
        columns = _found(batch.num_rows, buf, offsets, phrases)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "text_md5", "n_words", "n_hit", "items", "spans"])


def _blocks(benchmark: DataFrame, phrases_per_pass: int) -> Iterator[list[tuple[str | None, str]]]:
    """The test items in their order by id, in blocks of about so many words; one block if there are none."""
    rows = only(benchmark, item_id=F.col("item_id").cast("string"), text=F.col("text").cast("string")).where("text is not null").orderBy("item_id", "text").toLocalIterator(prefetchPartitions=False)
    block, size, none = [], 0, True
    for item in rows:
        block.append((item.item_id, item.text))
        size += item.text.count(" ") + item.text.count("\n") + 1
        if size >= phrases_per_pass:
            yield block
            block, size, none = [], 0, False
    if block or none:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW_WORDS, phrases_per_pass: int = PHRASES_PER_PASS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted ids) and spans (merged, in bytes of the UTF-8 text).

    Null and empty texts have no words and no hits; rows that repeat a doc_id are judged each for itself; other
    columns of either table are not read; an empty benchmark finds nothing.  An item whose id is null is searched like
    others, but adds no id to items.  Items come to the driver in blocks of phrases_per_pass words.  A larger benchmark
    takes more passes, each written before the next begins, never more at once; the spans of several passes are merged by
    document.  text_md5 tells rows of one doc_id apart.
    """
    source = only(docs, doc_id=F.col("doc_id").cast("long"), text_md5=F.md5("text"), text=utf8("text"))
    blocks = _blocks(benchmark, phrases_per_pass)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        return _pass(source, Phrases(block, window))[0]
    passes = []
    while block is not None:
        found, shared = _pass(source, Phrases(block, window))
        passes.append(scratch.keep(found, f"pass-{len(passes)}"))
        shared.destroy()
        block, following = following, next(blocks, None)
    return _merge(passes)


def _pass(source: DataFrame, phrases: Phrases) -> tuple[DataFrame, object]:
    shared = source.sparkSession.sparkContext.broadcast(phrases)
    return source.mapInArrow(lambda batches: _search(batches, shared.value), FOUND), shared


def _merge(blocks: list[DataFrame]) -> DataFrame:
    """One row per document from the rows that the passes found; equal rows of one doc_id stay as many as they were."""
    union = blocks[0]
    for b in blocks[1:]:
        union = union.unionByName(b)
    covered = """aggregate(array_sort(flatten(collect_set(spans))), cast(array() as array<struct<start:int,end:int,word:int,end_word:int>>),
        (acc, x) -> if(size(acc) > 0 and element_at(acc, -1).end_word >= x.word,
            concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, x.end), 'word', element_at(acc, -1).word, 'end_word', greatest(element_at(acc, -1).end_word, x.end_word)))),
            concat(acc, array(x))))"""
    # rows of equal texts found the same in each pass: a set has one of them a pass, however many there are
    grouped = union.groupBy("doc_id", "text_md5").agg(
        F.first("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.expr(covered).alias("spans"), F.count("*").alias("_rows")
    )
    hit = F.expr("aggregate(spans, 0L, (n, x) -> n + x.end_word - x.word)")
    return grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("_rows") / len(blocks)).cast("int")))).select("doc_id", "text_md5", "n_words", hit.alias("n_hit"), "items", "spans")


def _without(rows: DataFrame) -> DataFrame:
    """The rows with spans cut out of their texts, all that lies between them joined."""
    left = F.expr("""array_join(transform(sequence(0, size(spans)), k -> decode(substring(text,
        if(k = 0, 0, spans[k - 1].end) + 1, if(k = size(spans), length(text), spans[k].start) - if(k = 0, 0, spans[k - 1].end)), 'UTF-8')), '')""")
    return rows.withColumn("row", F.col("row").withField("text", F.when(F.size("spans") > 0, left).otherwise(F.col("row.text")))).select("row.*")


def remove_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with the spans cut out of their texts; others stay as they are, and all columns do.

    found: find_contamination's result as a written table.  Only documents with spans are shuffled.
    """
    cut = found.where(F.size("spans") > 0).groupBy("doc_id", "text_md5").agg(F.first("spans").alias("spans"))
    rows = packed(docs, id=F.col("doc_id").cast("long"), md5=F.md5("text"), text=utf8("text")).withColumn("cut", Marks(cut, "doc_id", "text_md5").has("id", "md5"))
    known = cut.select(F.col("doc_id").alias("of"), F.col("text_md5").alias("of_md5"), "spans").hint("merge")
    joined = rows.where("cut").join(known, (F.col("md5") == F.col("of_md5")) & F.col("id").eqNullSafe(F.col("of")), "left")
    return rows.where("not cut").select("row.*").unionByName(_without(joined))


def remove_contamination(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW_WORDS, phrases_per_pass: int = PHRASES_PER_PASS) -> DataFrame:
    """The documents without the words that windows of test items cover, with all their columns; rows as in find_contamination.

    Where one pass holds all items, texts are searched and cut where they are read; else the passes' spans are joined.
    """
    blocks = _blocks(benchmark, phrases_per_pass)
    block, following = next(blocks), next(blocks, None)
    if following is not None:
        return remove_spans(docs, scratch.keep(find_contamination(docs, benchmark, scratch, window, phrases_per_pass), "found"))
    shared = docs.sparkSession.sparkContext.broadcast(Phrases(block, window))

    def spans(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], _SPANS), *(_found(end - at, buf, offsets, shared.value)[3] for at, end, buf, offsets in tv.text_steps(texts))])

    spans_of = F.arrow_udf(spans, "array<struct<start:int,end:int,word:int,end_word:int>>")
    return _without(packed(docs, text=utf8("text")).withColumn("spans", spans_of("text")))

"""Substring dedup: repeated units of lines, and repeated runs of words wherever they begin and end.

Lines are broken at sentence ends into units.  A unit is normalised to its lower-cased letters and digits and gets a 128-bit
digest.  Digests are grouped over the whole corpus, the earliest occurrence by
(doc_id, place) stays and all later ones are marked.  Marked units that follow
one another in a document make a passage; passages of enough words are removed,
and their original offsets are kept.  Shorter repeats, such as a stock phrase or
a licence line that happens to stand in many documents, are no passages.

Runs of words know no units: each window of RUN_WORDS words that an earlier
place has too is repeated, and the union of such windows is removed.  So that
not all windows of the corpus are dealt out, a window is looked up by the least
hash among its shorter grams, which equal windows share: only windows whose
least gram also stands elsewhere are compared, and these by 96 bits of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import Marks, Scratch, has_hashes, only, packed, utf8

#: Words of the fewest whole units in a row that are removed.
LEAST_WORDS = 30
#: Words of the shortest run that is removed wherever it begins and ends.
RUN_WORDS = 51
#: Places of a gram whose windows are compared in one task; windows of more frequent ones are aggregated first.
HOT_PLACES = 65_536
#: Words of a gram; a window of RUN_WORDS has 1 << _DOUBLINGS of them.
_GRAM_WORDS, _DOUBLINGS = 20, 5
_STOP = tv.is_byte_in((ord("."), ord(".")), (ord("!"), ord("!")), (ord("?"), ord("?")))
_LEADING = ~tv.is_byte_in((0x80, 0xBF))
_U = np.uint64


def _ends(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets after which a unit ends: after a line feed, after a space behind `.!?`, and at the end of a text."""
    cut = buf == 10
    if len(buf) > 1:
        cut[1:] |= (buf[1:] == 32) & _STOP[buf[:-1]]
    return np.union1d(np.flatnonzero(cut) + 1, offsets)


def units(buf: np.ndarray, offsets: np.ndarray):
    """Per unit that has words: text, number in its text, digest (two columns), words, first word, start and end in code points."""
    low = tv.lower_ascii(buf)
    runs = tv.Runs(low, offsets, tv.ALNUM)
    edges = _ends(buf, offsets)
    first = np.searchsorted(runs.starts, edges)  # a word never reaches over an edge
    n_words = np.diff(first)
    full = np.flatnonzero(n_words)
    text = np.searchsorted(offsets, edges[:-1][full], "right") - 1
    # two hashes of the words, each with its own hashes of them
    digests = [tv.sequence_hashes(tv.span_hashes(low, runs.starts, runs.ends, seed), first[full], first[full + 1], seed).view(np.int64) for seed in (0, 1)]
    chars = np.concatenate(([0], np.cumsum(_LEADING[buf], dtype=np.int64)))
    base = chars[offsets[text]]
    number = np.arange(len(full)) - np.searchsorted(text, np.arange(len(offsets)))[text]
    return text, number, digests[0], digests[1], n_words[full], first[full] - runs.first[text], chars[edges[:-1][full]] - base, chars[edges[1:][full]] - base


def _versions(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of one doc_id are told apart by their texts."""
    return (tv.span_hashes(buf, offsets[:-1], offsets[1:]) >> _U(33)).astype(np.int64)


UNITS = "h1 long, h2 long, doc_id long, place long, words int, word int, start int, end int"


def _units(batches: Iterator[pa.RecordBatch], full: bool, repeated=None) -> Iterator[pa.RecordBatch]:
    """The units of texts; with a bitmap of the hashes of those that repeat, these alone."""
    for batch, buf, offsets in tv.steps(batches, "text"):
        found = units(buf, offsets)
        if repeated is not None:
            kept = has_hashes(repeated.value, found[2])
            found = tuple(x[kept] for x in found)
        text, number, h1, h2, n_words, word, start, end = found
        doc = batch.column(0).to_numpy()[text]
        version = _versions(buf, offsets)[text]
        columns = {"h1": h1, "h2": h2, "doc_id": doc, "place": version << 32 | number}
        if full:
            columns |= {"words": n_words.astype(np.int32), "word": word.astype(np.int32), "start": start.astype(np.int32), "end": end.astype(np.int32)}
        yield pa.RecordBatch.from_pydict(columns)


def _source(docs: DataFrame) -> DataFrame:
    """doc_id and text, each once: rows that repeat both are one document, so no window of one document gets them all."""
    source = only(docs, doc_id=F.col("doc_id").cast("long"), text=utf8("text")).where("doc_id is not null")
    twice = source.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    return source.distinct() if twice else source


def repeated_passages(docs: DataFrame, scratch: Scratch, least_words: int = LEAST_WORDS) -> DataFrame:
    """A row per passage of whole units: doc_id, version, start, end (code points), n_words, n_units, first_doc_id and first_word.

    first_doc_id: the smallest document that one of its units was first seen in.  first_word: the number of words before
    it in its text.  Null and empty texts have no units.
    Rows that repeat a doc_id with the same text count as one document, with other texts as further ones (version
    tells them apart); rows whose doc_id is null neither remove nor are removed.  Other columns are not read.
    An empty table gives no rows.
    """
    return _repeated_passages(_source(docs), scratch, least_words)


def _repeated_passages(source: DataFrame, scratch: Scratch, least_words: int) -> DataFrame:
    short = source.mapInArrow(lambda b: _units(b, False), "h1 long, h2 long, doc_id long, place long")
    seen = short.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max(F.struct("doc_id", "place")).alias("last"))
    seen = scratch.keep(seen.where("first <> last").select("h1", "h2", F.col("first.doc_id").alias("first_doc_id"), F.col("first.place").alias("first_place")), "seen")
    # most units stand only once: they go before they are shuffled
    repeated = Marks(seen, "h1", hashed=True).shared
    later = source.mapInArrow(lambda b: _units(b, True, repeated), UNITS).join(seen.hint("merge"), ["h1", "h2"]).where("doc_id <> first_doc_id or place <> first_place")
    later = later.drop("h1", "h2", "first_place")
    later = later.withColumn("version", F.expr("shiftright(place, 32)")).withColumn("number", F.expr("place & 4294967295L"))
    inside = Window.partitionBy("doc_id", "version").orderBy("number")
    later = later.withColumn("island", F.col("number") - F.row_number().over(inside))
    passages = later.groupBy("doc_id", "version", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.count("*").alias("n_units"), F.min("first_doc_id").alias("first_doc_id"), F.min("word").alias("first_word")
    )
    return passages.where(F.col("n_words") >= least_words).drop("island")


class Windows:
    """The windows of RUN_WORDS words of texts, none across two texts, and the grams that they are looked up by."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        low = tv.lower_ascii(buf)
        self.runs = tv.Runs(low, offsets, tv.ALNUM)
        self.words = tv.span_hashes(low, self.runs.starts, self.runs.ends)
        self.grams = tv.window_hashes(self.words, _GRAM_WORDS)
        #: first word (counted over all texts) and text of each window
        self.at, self.text = tv.window_starts(self.runs.first, self.runs.count, RUN_WORDS)
        least = self.grams
        for k in range(_DOUBLINGS):
            least = np.minimum(least[: -(1 << k)], least[1 << k :])
        self.least = least[self.at]

    def chosen(self) -> np.ndarray:
        """Positions of the grams that are the least of a window, ties included."""
        if not len(self.at):
            return np.zeros(0, np.int64)
        size = 1 << _DOUBLINGS
        most = np.zeros(len(self.grams) + size - 1, _U)
        most[self.at + size - 1] = self.least
        for k in range(_DOUBLINGS):
            most = np.maximum(most[: -(1 << k)], most[1 << k :])
        return np.flatnonzero(most == self.grams)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, buf, offsets in tv.steps(batches, "text"):
        windows = Windows(buf, offsets)
        at = windows.chosen()
        text = np.searchsorted(windows.runs.first, at, "right") - 1
        place = _versions(buf, offsets)[text] << 32 | (at - windows.runs.first[text])
        yield pa.RecordBatch.from_pydict({"gram": windows.grams[at].view(np.int64), "doc_id": batch.column(0).to_numpy()[text], "place": place})


BLOCKS = "gram long, hot boolean, doc_id long, place long, digests array<long>, starts array<int>, ends array<int>"


def _of_row(lists: pa.Array) -> np.ndarray:
    """The items of a list column, each mixed with the number of its row."""
    row = tv.splitmix(np.arange(len(lists), dtype=_U))
    return lists.flatten().to_numpy().view(_U) ^ np.repeat(row, lists.value_lengths().to_numpy())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows whose least gram is one of the row's `grams`; those that follow one another and share it are a row."""
    for batch, buf, offsets in tv.steps(batches, "text"):
        windows = Windows(buf, offsets)
        mixed = windows.least ^ tv.splitmix(np.arange(batch.num_rows, dtype=_U))[windows.text]
        hit = np.flatnonzero(np.isin(mixed, _of_row(batch.column(2))))
        at, text, least = windows.at[hit], windows.text[hit], windows.least[hit]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(text) != 0) | (least[1:] != least[:-1])
        head = np.flatnonzero(new)
        lists = pa.array(np.append(head, len(at)), pa.int32())
        chars = np.concatenate(([0], np.cumsum(_LEADING[buf], dtype=np.int64)))
        base = chars[offsets[text]]
        place = _versions(buf, offsets)[text[head]] << 32 | (at[head] - windows.runs.first[text[head]])
        values = (
            tv.window_hashes(windows.words, RUN_WORDS)[at].view(np.int64),
            (chars[windows.runs.starts[at]] - base).astype(np.int32),
            (chars[windows.runs.ends[at + RUN_WORDS - 1]] - base).astype(np.int32),
        )
        digests, starts, ends = (pa.ListArray.from_arrays(lists, pa.array(v)) for v in values)
        hot = np.isin(mixed[hit][head], _of_row(batch.column(3)))
        yield pa.RecordBatch.from_pydict({"gram": least[head].view(np.int64), "hot": hot, "doc_id": batch.column(0).to_numpy()[text[head]], "place": place, "digests": digests, "starts": starts, "ends": ends})


def _windows(blocks: DataFrame) -> DataFrame:
    """A row per window of blocks."""
    found = blocks.select("gram", "doc_id", "place", F.posexplode(F.arrays_zip("digests", "starts", "ends")).alias("k", "w"))
    return found.select("gram", "doc_id", (F.col("place") + F.col("k")).alias("place"), F.col("w.digests").alias("digest"), F.col("w.starts").alias("start"), F.col("w.ends").alias("end"))


def repeated_runs(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per piece of a repeated run of words: the columns of repeated_passages, n_units being 0.  Pieces overlap.

    A window is repeated if an earlier document has the same RUN_WORDS words, or the same one has them earlier and
    apart from it; a piece is the words of repeated windows that follow one another.  start and end are those of its
    first and last word.  Rows as in repeated_passages.
    """
    return _repeated_runs(_source(docs), scratch)


def _repeated_runs(source: DataFrame, scratch: Scratch, hot_places: int = HOT_PLACES) -> DataFrame:
    place = F.struct("doc_id", "place")
    grams = scratch.keep(source.mapInArrow(_grams, "gram long, doc_id long, place long"), "all-grams")
    # grams that stand at two places, and how many places these are
    twice = grams.groupBy("gram").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("places")).where("first <> last")
    twice = scratch.keep(twice.select("gram", (F.col("places") > hot_places).alias("hot")), "twice")
    seen = grams.join(twice.hint("merge"), "gram").groupBy("doc_id").agg(F.collect_set("gram").alias("grams"), F.collect_set(F.when(F.col("hot"), F.col("gram"))).alias("hot"))
    seen = scratch.keep(seen, "grams")
    scratch.drop("all-grams")
    # texts without such a gram stay where they are
    marked = source.where(Marks(seen, "doc_id").has("doc_id"))
    blocks = marked.join(seen.hint("merge"), "doc_id").select("doc_id", "text", "grams", "hot").mapInArrow(_blocks, BLOCKS)
    if twice.where("hot").limit(1).count():
        blocks = scratch.keep(blocks, "blocks")
        pieces = _pieces(_firsts_of_few(blocks.where("not hot"))).unionByName(_pieces(_firsts_of_many(blocks.where("hot"), scratch)))
    else:
        pieces = _pieces(_firsts_of_few(blocks))
    return scratch.keep(pieces, "runs")


def _firsts_of_few(blocks: DataFrame) -> DataFrame:
    """The windows with their first place, where the at most HOT_PLACES places of a gram come to one task as lists and are compared there."""
    same = Window.partitionBy("gram", "digest").orderBy("doc_id", "place")
    return _windows(blocks.repartition("gram")).withColumn("first", F.first(F.struct("doc_id", "place")).over(same.rowsBetween(Window.unboundedPreceding, 0)))


def _firsts_of_many(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """The same for grams of any number of places: first places by a partial aggregate, written and joined back, which AQE may split."""
    found = _windows(blocks)
    place = F.struct("doc_id", "place")
    firsts = found.groupBy("gram", "digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    firsts = scratch.keep(firsts, "firsts")
    return found.join(firsts.hint("merge"), ["gram", "digest"])


def _pieces(found: DataFrame) -> DataFrame:
    """Windows that are not the first ones, those that follow one another as one piece."""
    own = (F.col("first.doc_id") == F.col("doc_id")) & F.expr("shiftright(first.place, 32) = shiftright(place, 32)")
    later = found.where(~own | (F.col("place") - F.col("first.place") >= RUN_WORDS))
    later = later.select("gram", "doc_id", "place", "start", "end", F.col("first.doc_id").alias("first_doc_id"))
    later = later.withColumn("island", F.col("place") - F.row_number().over(Window.partitionBy("gram", "doc_id").orderBy("place")))
    pieces = later.groupBy("gram", "doc_id", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("place").alias("place"), F.max("place").alias("last"), F.min("first_doc_id").alias("first_doc_id"))
    return pieces.select(
        "doc_id", F.expr("shiftright(place, 32)").alias("version"), "start", "end", (F.col("last") - F.col("place") + RUN_WORDS).alias("n_words"), F.lit(0).cast("long").alias("n_units"), "first_doc_id", F.expr("int(place & 4294967295L)").alias("first_word")
    )


def passages(docs: DataFrame, scratch: Scratch, least_words: int = LEAST_WORDS) -> DataFrame:
    """All that is to be removed: passages of whole units and runs of words, those that meet made one; columns of repeated_passages.

    least_words=1 removes every later unit, however short.
    """
    source = _source(docs)
    found = _repeated_runs(source, scratch).unionByName(_repeated_passages(source, scratch, least_words))
    stop = F.col("first_word") + F.col("n_words")
    before = Window.partitionBy("doc_id", "version").orderBy("first_word", "start").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("new", F.coalesce(F.col("first_word") > F.max(stop).over(before), F.lit(False)).cast("int"))
    found = found.withColumn("island", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    whole = found.groupBy("doc_id", "version", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max(stop) - F.min("first_word")).alias("n_words"), F.sum("n_units").alias("n_units"), F.min("first_doc_id").alias("first_doc_id"), F.min("first_word").alias("first_word")
    )
    return whole.drop("island")


def _without(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    """The texts without their cuts (lists of version, start and end in code points), a step of them at a time."""
    parts = [pa.array([], pa.string())]
    for at, end, buf, offsets in tv.text_steps(texts):
        lists, n = cuts.slice(at, end - at), end - at
        spans = lists.flatten()
        text = np.repeat(np.arange(n), lists.value_lengths().fill_null(0).to_numpy())
        version, start, stop = (spans.field(k).to_numpy() for k in range(3))
        own = version == _versions(buf, offsets)[text]
        # where each code point begins
        char = np.append(np.flatnonzero(_LEADING[buf]), len(buf))
        first = np.searchsorted(char, offsets[:-1])[text[own]]
        change = np.zeros(len(buf) + 1, np.int32)
        np.add.at(change, char[first + start[own]], 1)
        np.add.at(change, char[first + stop[own]], -1)
        keep = np.cumsum(change[:-1]) == 0
        left = np.concatenate(([0], np.cumsum(keep)))[offsets].astype(np.int32)
        done = pa.StringArray.from_buffers(n, pa.py_buffer(left), pa.py_buffer(buf[keep]))
        parts.append(pc.if_else(texts.slice(at, n).is_valid(), done, pa.scalar(None, pa.string())) if texts.null_count else done)
    return pa.concat_arrays(parts)


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """The documents without the passages, a written table; others stay as they are, and all columns do.

    Only documents with passages are shuffled and go through Python.  Rows whose doc_id is null are never cut.
    """
    cut = passages.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("version", "start", "end")).alias("cuts"))
    rows = packed(docs, id=F.col("doc_id").cast("long"), text=utf8("text")).withColumn("cut", Marks(passages, "doc_id").has("id") & F.col("id").isNotNull())
    cutter = F.arrow_udf(lambda t, c: _without(t, c), "string")
    cut_rows = rows.where("cut").join(cut.hint("merge"), "id", "left").withColumn("cuts", F.coalesce("cuts", F.expr("cast(array() as array<struct<version:bigint,start:int,end:int>>)")))
    cut_rows = cut_rows.withColumn("row", F.col("row").withField("text", cutter("text", "cuts")))
    return rows.where("not cut").select("row.*").unionByName(cut_rows.select("row.*"))

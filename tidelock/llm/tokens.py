"""Token ids of texts, and shards of ids with Elias-Fano document boundaries.

A shard is two files: `.ids` holds the ids of its documents one after another
(2 or 4 bytes each, little-endian), `.ef` the documents' starts and their
doc_ids as Elias-Fano sequences, whose select finds a document's offset in
about 2 + log2(mean length) bits a document, without a table of 64-bit offsets.
Tasks write files under names of their own attempt; only the files that the
manifest, a table that Spark commits, lists belong to the result, so a lost
executor or a repeated task leaves nothing but unlisted files.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import Scratch, only, utf8

#: How the files' pre-tokenizers treat white space, across which they never join: "kept", a space belongs to the next
#: word and the rest of a run is a piece of its own, or "dropped".  Texts are cut there and each piece is encoded once.
CUTS = {"byte_bpe_50k.json": "kept", "word_bpe_49k.json": "dropped"}
#: White space outside ASCII in UTF-8 (fixed values); a text that has it is encoded as a whole.
FAR_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: A vocabulary file is sent to the tasks; a larger one is refused.
VOCABULARY_BYTES = 64 << 20
#: Pieces whose ids a task remembers.
REMEMBERED = 1_500_000
#: Texts or pieces in a call of the library.
LIBRARY_TEXTS = 2048
#: Bytes of text that are cut into pieces at once: the more, the more of them are repeats.
ENCODE_BYTES = 2 << 20
#: Ids in a shard, at most, but for a single longer document.
SHARD_IDS = 16 << 20
#: Documents whose places a reading task looks up at once.
READ_DOCS = 4096


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of a tokenizers file, as the library gives them for whole texts.

    Each piece of text goes through the library once and is then known by 128 bits of hashes.  Texts that may hold one
    of the file's added tokens, such as an end mark in plain letters, go through it as a whole.
    """

    def __init__(self, definition: str, cut: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_padding(), self.tokenizer.no_truncation()
        self.cut = cut
        # the beginnings of added tokens in either case: normalisers may change the rest
        marks = {t["content"][:2] for t in json.loads(definition).get("added_tokens", ()) if t["content"]}
        odd = [FAR_SPACE.pattern, *(re.escape(m.encode()) for m in sorted(marks))]
        self.whole = re.compile(b"|".join(odd), re.I)
        self._forget()

    def _forget(self) -> None:
        # sorted hashes, a second hash, and the place and number of each piece's ids in the pool: about 50 bytes a piece
        self.keys, self.checks, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _library(self, texts: list[bytes]) -> list[list[int]]:
        """Few texts at once, as the library keeps far more than their ids for each."""
        some = (texts[k : k + LIBRARY_TEXTS] for k in range(0, len(texts), LIBRARY_TEXTS))
        return [e.ids for part in some for e in self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in part], add_special_tokens=False)]

    def _pieces(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of all texts, in order."""
        words = tv.Runs(buf, offsets, tv.SPACED)
        if self.cut == "dropped":
            return words.starts, words.ends
        before = np.append(buf, 0)[words.starts - 1] if len(words.starts) else words.starts
        edge = np.zeros(len(buf) + 1, bool)
        edge[offsets] = True
        inside = ~edge[words.starts]  # has a byte of its text before it
        starts = words.starts - (inside & (before == 0x20))
        # what is left of the runs of white space: all but the last character, and the last where it is no space
        gaps = tv.Runs(buf, offsets, ~tv.SPACED)
        at_end = edge[gaps.ends]
        last = gaps.ends - 1
        space = buf[last] == 0x20
        lead_ends = np.where(at_end, gaps.ends, last)
        lead = lead_ends > gaps.starts
        single = ~at_end & ~space
        all_starts = np.concatenate((starts, gaps.starts[lead], last[single]))
        all_ends = np.concatenate((words.ends, lead_ends[lead], gaps.ends[single]))
        order = np.argsort(all_starts, kind="stable")
        return all_starts[order], all_ends[order]

    def _learn(self, keys: np.ndarray, checks: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: bytes) -> None:
        """Encodes those of the distinct, sorted keys that are not known yet."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if not len(new):
            return
        parts = [(np.zeros(0, np.uint32), np.zeros(0, np.uint32))]
        for k in range(0, len(new), LIBRARY_TEXTS):
            some = new[k : k + LIBRARY_TEXTS]
            ids = self._library([data[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)])
            parts.append((np.fromiter(map(len, ids), np.uint32, len(ids)), np.fromiter(chain.from_iterable(ids), np.uint32)))
        sizes, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(max(len(flat), len(self.pool) // 2), np.uint32)))
        self.pool[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(sizes, dtype=np.int64) - sizes
        self.used += len(flat)
        # one array after another, so that few copies are held at once
        self.keys = np.concatenate((self.keys, keys[new]))
        order = np.argsort(self.keys, kind="stable").astype(np.uint32)
        for name, more in (("keys", None), ("checks", checks[new]), ("start", begin.astype(np.uint32)), ("size", sizes)):
            whole = getattr(self, name) if more is None else np.concatenate((getattr(self, name), more))
            setattr(self, name, whole[order])
            del whole

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the offsets at which each text's ids begin."""
        data = buf.tobytes()
        if not self.cut or self.whole.search(data):
            texts = [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            odd = [k for k, t in enumerate(texts) if not self.cut or self.whole.search(t)]
            return self._some_whole(buf, offsets, texts, odd)
        return self._cut_and_encode(buf, offsets, data)

    def _some_whole(self, buf: np.ndarray, offsets: np.ndarray, texts: list[bytes], odd: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The texts with the odd numbers are not cut, the others are."""
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for k, ids in zip(odd, self._library([texts[k] for k in odd]), strict=True):
            parts[k] = np.array(ids, np.uint32)
        plain = np.ones(len(texts), bool)
        plain[odd] = False
        if plain.any():
            lengths = np.where(plain, np.diff(offsets), 0)
            ids, at = self._cut_and_encode(buf[np.repeat(plain, np.diff(offsets))], np.concatenate(([0], np.cumsum(lengths))), b"".join(t for t, p in zip(texts, plain, strict=True) if p))
            for k in np.flatnonzero(plain).tolist():
                parts[k] = ids[at[k] : at[k + 1]]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.cumsum([0, *map(len, parts)])

    def _cut_and_encode(self, buf: np.ndarray, offsets: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        starts, ends = self._pieces(buf, offsets)
        keys, first, which = np.unique(tv.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        checks = tv.span_hashes(buf, starts, ends, 1)
        if len(self.keys) + len(keys) > REMEMBERED:
            self._forget()
        self._learn(keys, checks[first], starts[first], ends[first], data)
        number = np.searchsorted(self.keys, keys)[which]
        begin, sizes = self.start[number].astype(np.int64), self.size[number].astype(np.int64)
        done = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.pool[np.repeat(begin - done[:-1], sizes) + np.arange(done[-1])]
        at = done[np.searchsorted(starts, offsets)]
        other = self.checks[number] != checks
        if not other.any():
            return ids, at
        # pieces whose first hash another piece has: their texts go through the library
        texts = np.unique(np.searchsorted(offsets, starts[other], "right") - 1).tolist()
        parts = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        for k, found in zip(texts, self._library([data[offsets[k] : offsets[k + 1]] for k in texts]), strict=True):
            parts[k] = np.array(found, np.uint32)
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


class Vocabulary:
    """A tokenizers file for the tasks: its text is broadcast, as the path may exist on the driver alone."""

    def __init__(self, spark, path: str, cut: str | None = None):
        if os.path.getsize(path) > VOCABULARY_BYTES:
            raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
        with open(path, encoding="utf-8") as f:
            text = f.read()
        self.text = spark.sparkContext.broadcast(text)
        self.text_hash = zlib.crc32(text.encode())
        self.cut = CUTS.get(os.path.basename(path)) if cut is None else cut
        top = max((int(i) for i in re.findall(r'":\s*(\d+)', text)), default=0)
        self.id_bytes = 2 if top < 1 << 16 else 4

    def encoder(self) -> Encoder:
        return tv.kept_for_stage((self.text_hash, self.cut), lambda: Encoder(self.text.value, self.cut))


class EliasFano:
    """A non-decreasing sequence of n values below `limit`: low bits packed, high bits in unary with select samples."""

    EVERY = 512  # bits between counts of ones

    def __init__(self, n: int, limit: int, low: np.ndarray, high: np.ndarray):
        self.n, self.limit = n, limit
        self.bits = self.low_bits(n, limit)
        self.low, self.high = low, high
        words = np.zeros(-(-max(len(high), 1) // 64) * 64, np.uint8)
        words[: len(high)] = high
        self.words = words.view("<u8")
        ones = np.bitwise_count(self.words).reshape(-1, 8).sum(1)
        self.ones = np.concatenate(([0], np.cumsum(ones))).astype(np.uint32 if n < 1 << 32 else np.uint64)

    @staticmethod
    def low_bits(n: int, limit: int) -> int:
        return max(0, (limit // max(n, 1)).bit_length() - 1)

    @classmethod
    def of(cls, values: np.ndarray, limit: int) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, bits = len(values), cls.low_bits(len(values), limit)
        low = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        high = np.zeros(n + (limit >> bits) + 1, np.uint8)
        high[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = 1
        return cls(n, limit, np.packbits(low.ravel(), bitorder="little"), np.packbits(high, bitorder="little"))

    def select(self, i: int) -> int:
        """Value i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        return int(self.select_many(np.array([i]))[0])

    def select_many(self, i: np.ndarray) -> np.ndarray:
        """Values by their numbers, each from the counts of ones and one block of 512 bits."""
        block = np.searchsorted(self.ones, i, "right") - 1
        left = i - self.ones[block].astype(np.int64)
        words = self.words[block[:, None] * 8 + np.arange(8)]
        before = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        word = (before <= left[:, None]).sum(1)
        left = left - np.where(word > 0, np.take_along_axis(before, np.maximum(word - 1, 0)[:, None], 1)[:, 0], 0)
        bits = np.unpackbits(np.take_along_axis(words, word[:, None], 1).view(np.uint8), axis=1, bitorder="little")
        bit = (np.cumsum(bits, axis=1, dtype=np.int64) <= left[:, None]).sum(1)
        value = (block * self.EVERY + word * 64 + bit - i) << self.bits
        at = i[:, None] * self.bits + np.arange(self.bits)
        return value | (((self.low[at >> 3].astype(np.int64) >> (at & 7)) & 1) << np.arange(self.bits)).sum(1)

    def to_bytes(self) -> bytes:
        return struct.pack("<QQQQ", self.n, self.limit, len(self.low), len(self.high)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        n, limit, low, high = struct.unpack_from("<QQQQ", data)
        raw = np.frombuffer(data, np.uint8, low + high, 32)
        return cls(n, limit, raw[:low], raw[low:]), 32 + low + high


MAGIC = b"TLEF0001"


class _Shard:
    """Files of one shard that is being written."""

    def __init__(self, folder: str, id_bytes: int):
        self.fs, at = filesystem(folder)
        self.fs.create_dir(at, recursive=True)
        self.path = f"{at}/shard-{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(f"{self.path}.ids")
        self.id_bytes, self.doc_ids, self.lengths, self.ids = id_bytes, [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.id_bytes}").tobytes())
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.ids += len(ids)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        nulls = sum(x is None for x in self.doc_ids)  # these sort first
        known = np.array(self.doc_ids[nulls:], np.int64)
        least = int(known[0]) if len(known) else 0
        limit = int(known[-1]) - least + 1 if len(known) else 1
        starts = np.cumsum([0, *self.lengths[:-1]])
        head = json.dumps({"id_bytes": self.id_bytes, "docs": len(self.lengths), "ids": self.ids, "null_doc_ids": nulls, "least_doc_id": least}).encode()
        with self.fs.open_output_stream(f"{self.path}.ef") as f:
            f.write(MAGIC + struct.pack("<I", len(head)) + head)
            f.write(EliasFano.of(starts, self.ids + 1).to_bytes())
            f.write(EliasFano.of(known - least, limit).to_bytes())
        return self.path, len(self.lengths), self.ids


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path that has its scheme; Hadoop's names of S3 are known as such."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _write(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, end_id: int, folder: str, shard_ids: int) -> Iterator[pa.RecordBatch]:
    encoder, end, part = vocabulary.encoder(), np.array([end_id], np.uint32), TaskContext.get().partitionId()
    shard, done = None, []
    for batch, buf, offsets in tv.steps(batches, "text", ENCODE_BYTES):
        ids, at = encoder.encode(buf, offsets)
        for doc_id, a, b in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
            if shard and shard.ids and shard.ids + b - a >= shard_ids:
                done.append(shard.close())
                shard = None
            shard = shard or _Shard(folder, vocabulary.id_bytes)
            shard.add(doc_id, np.concatenate((ids[a:b], end)))
    if shard:
        done.append(shard.close())
    yield pa.RecordBatch.from_pydict({"part": [part] * len(done), "shard": list(range(len(done))), "path": [x[0] for x in done], "docs": [x[1] for x in done], "ids": [x[2] for x in done]}, schema=pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))


def write_ids(docs: DataFrame, vocabulary: Vocabulary, end_id: int, folder: str, scratch: Scratch, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes shards in ascending doc_id order and returns their manifest: path, docs, ids and base (ids in shards before).

    Documents are dealt by ranges of doc_id and then of the hash of the text, in which they are ordered, too, so that not
    even a doc_id that very many rows have, or null, is one task's.
    A null doc_id sorts first; a null text is empty and has the end id alone; other columns are not read; an empty
    table writes no shard.
    """
    source = only(docs, doc_id=F.col("doc_id").cast("long"), text=utf8("text"))
    source = source.withColumn("hash", F.xxhash64("text"))
    ordered = source.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    listed = scratch.keep(ordered.mapInArrow(lambda b: _write(b, vocabulary, end_id, folder, shard_ids), "part long, shard long, path string, docs long, ids long"), "manifest")
    # a row a shard, of millions of ids each
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


class Shard:
    """A written shard."""

    def __init__(self, folder: str, path: str):
        fs, _ = filesystem(folder)
        with fs.open_input_stream(f"{path}.ef") as f:
            data = memoryview(f.read())
        if bytes(data[:8]) != MAGIC:
            raise ValueError(f"{path}.ef is no shard index")
        (size,) = struct.unpack_from("<I", data, 8)
        self.head = json.loads(bytes(data[12 : 12 + size]))
        self.starts, used = EliasFano.from_bytes(data[12 + size :])
        self.known, _ = EliasFano.from_bytes(data[12 + size + used :])
        with fs.open_input_stream(f"{path}.ids") as f:
            self.ids = np.frombuffer(f.read(), f"<u{self.head['id_bytes']}")

    def document(self, i: int) -> np.ndarray:
        """The ids of document i, its place found by select."""
        end = self.starts.select(i + 1) if i + 1 < self.head["docs"] else self.head["ids"]
        return self.ids[self.starts.select(i) : end]

    def places(self, a: int, b: int) -> tuple[pa.Array, np.ndarray]:
        """doc_ids of documents a to b, and their starts with the end of the last, all by select."""
        number = np.arange(a, b)
        null = number < self.head["null_doc_ids"]
        known = np.zeros(b - a, np.int64)
        known[~null] = self.known.select_many(number[~null] - self.head["null_doc_ids"]) + self.head["least_doc_id"]
        end = self.starts.select(b) if b < self.head["docs"] else self.head["ids"]
        return pa.array(known, pa.int64(), mask=null), np.append(self.starts.select_many(number), end)


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(folder, row["path"])
            for a in range(0, shard.head["docs"], READ_DOCS):
                doc_ids, at = shard.places(a, min(a + READ_DOCS, shard.head["docs"]))
                crcs = [zlib.crc32(shard.ids[x:y].astype("<u4")) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(at[:-1] + row["base"]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the shards: doc_id, start (ids of all documents before), n_tokens and ids_crc32."""
    shards = manifest.count()
    return manifest.select("path", "base").repartition(max(1, min(shards, 10_000))).mapInArrow(lambda b: _read(b, folder), "doc_id long, start long, n_tokens long, ids_crc32 long")

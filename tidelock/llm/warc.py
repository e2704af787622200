"""WARC archives: a writer that makes repeated payloads revisits, and a splittable reader.

Every record is a gzip member of its own.  A reading task gets a range of bytes,
looks for gzip magic, takes a candidate for a member only if it decodes to WARC
headers (and, where it is read, to its end with the right checksum), and owns
the records that start in its range, of which the last may end behind it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Marks, Scratch, only
from .tokens import filesystem

#: Bytes after which a task begins another archive file, and bytes of a file that a reading task looks through.
FILE_BYTES, SPLIT_BYTES = 256 << 20, 16 << 20
#: Shares of a group of equal payloads, so that a payload of very many pages meets in no single task.
SALTS = 32
MAGIC = b"\x1f\x8b\x08"
#: Enough of a member to see its first line.
_LOOK = 4096
_MORE = 1 << 20


def _id(page_id: int | None) -> str:
    return f"<urn:tidelock:page:{'' if page_id is None else page_id}>"


def _record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(size).encode() + b"\r\n\r\n"
    if kind == "response":
        block += payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_id(page_id)}", "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {re.sub('[\r\n]', ' ', url)}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324  as WARC has it


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    fs, at = filesystem(folder)
    fs.create_dir(at, recursive=True)
    part, out, size, done = TaskContext.get().partitionId(), None, 0, []
    rows = (row for batch in batches for k in range(0, batch.num_rows, 200) for row in zip(*(c.to_pylist() for c in batch.slice(k, 200).columns), strict=True))
    for page_id, url, payload, refers_to in rows:
        payload = payload or b""
        kind = "response" if refers_to is None else "revisit"
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = pack.compress(_record(kind, page_id, url, payload, base32_sha1(payload), len(payload), refers_to)) + pack.flush()
        if out is None:
            path, size = f"{at}/{part:06d}-{uuid.uuid4().hex}.warc.gz", 0
            out = fs.open_output_stream(path, compression=None)
        out.write(member)
        size += len(member)
        if size >= file_bytes:
            out.close()
            done.append((path, size))
            out = None
    if out is not None:
        out.close()
        done.append((path, size))
    yield pa.RecordBatch.from_pydict({"path": pa.array([x[0] for x in done], pa.string()), "size": pa.array([x[1] for x in done], pa.int64())})


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a record per row of pages (page_id, url, html) and returns the manifest (path, size) of the files.

    Of equal payloads of at least least_bytes, the one with the largest page_id is a response, and the others are
    revisits that refer to it; rows that repeat that page_id are responses too.  Null html is an empty payload; a row
    whose page_id is null is a response that nothing refers to.  Other columns are not read; an empty table writes
    nothing.  Files of lost or repeated tasks are not in the manifest.
    """
    source = only(pages, page_id=F.col("page_id").cast("long"), url=F.col("url").cast("string"), payload=F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")))
    source = source.withColumn("key", F.unhex(F.sha2("payload", 256)))
    named = (F.length("payload") >= least_bytes) & F.col("page_id").isNotNull()
    repeated = source.where(named).groupBy("key").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1")
    repeated = scratch.keep(repeated.select("key", "response"), "repeated")
    # payloads that stand once are written where they are read; the others meet their group's largest id, in shares
    told = source.withColumn("again", Marks(repeated, "key").has("key") & named)
    salted = told.where("again").withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    repeated = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = salted.join(repeated.hint("merge"), ["key", "salt"], "left").select("page_id", "url", "payload", F.when(F.col("page_id") != F.col("response"), F.col("response")).alias("refers_to"))
    told = told.where("not again").select("page_id", "url", "payload", F.lit(None).cast("long").alias("refers_to")).unionByName(joined)
    return scratch.keep(told.mapInArrow(lambda b: _write(b, folder, file_bytes), "path string, size long"), "manifest")


class _Range:
    """Bytes of a file from a place on, read as far as they are asked for."""

    def __init__(self, file, start: int, end: int, size: int):
        self.file, self.at, self.size = file, start, size
        self.data = file.read_at(min(end + _LOOK, size) - start, start)

    def more(self) -> bool:
        have = self.at + len(self.data)
        if have >= self.size:
            return False
        self.data += self.file.read_at(min(_MORE, self.size - have), have)
        return True


def members(file, start: int, end: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the WARC members that start within [start, end)."""
    window = _Range(file, start, end, size)
    at = 0
    while True:
        at = window.data.find(MAGIC, at)
        if at < 0 or start + at >= end:
            return
        taken = _member(window, at)
        if taken is None:
            at += 1
            continue
        content, length = taken
        yield start + at, content
        at += length


def _member(window: _Range, at: int) -> tuple[bytes, int] | None:
    """Content and length of the member at a candidate; None if it is none."""
    unpack = zlib.decompressobj(31)
    try:
        parts = [unpack.decompress(window.data[at : at + _LOOK], _LOOK)]
        if not re.match(rb"WARC/\d\.\d\r\n", parts[0][:10]):
            return None
        fed = at + _LOOK
        parts.append(unpack.decompress(unpack.unconsumed_tail))
        while not unpack.eof:
            if fed >= len(window.data) and not window.more():
                return None
            piece = window.data[fed : fed + _MORE]
            parts.append(unpack.decompress(piece))
            fed += len(piece)
    except zlib.error:
        return None
    return b"".join(parts), min(fed, len(window.data)) - len(unpack.unused_data) - at


def parse(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers (lower-case names), HTTP head and payload of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    block = rest[: int(headers.get("content-length", len(rest)))]
    if not headers.get("content-type", "").startswith("application/http"):
        return headers, b"", block
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def _page(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<urn:tidelock:page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None


RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, path string, at long"


def _read(batches: Iterator[pa.RecordBatch], folder: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    fs, _ = filesystem(folder)
    schema = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("path", pa.string()), ("at", pa.int64())]
    schema = pa.schema(schema + [("payload", pa.binary())] * with_payload)
    for batch in batches:
        for split in batch.to_pylist():
            rows, held = [], 0
            with fs.open_input_file(split["path"]) as file:
                for offset, content in members(file, split["start"], split["end"], split["size"]):
                    headers, http, payload = parse(content)
                    kind = headers.get("warc-type")
                    stated = re.search(rb"(?i)content-length: *(\d+)", http)
                    size = int(stated[1]) if kind == "revisit" and stated else len(payload)
                    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") if kind == "revisit" else base32_sha1(payload)
                    row = (_page(headers.get("warc-record-id")), headers.get("warc-target-uri"), kind, size, digest, _page(headers.get("warc-refers-to")), split["path"], offset)
                    rows.append((*row, payload) if with_payload else row)
                    held += len(payload)
                    if len(rows) >= 2000 or with_payload and held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_archives(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """A row per record of the files; payload_bytes and payload_digest are of the full payload, for a revisit as it states them."""
    splits = manifest.where("size > 0").select("path", "size", F.explode(F.expr(f"sequence(0L, size - 1, {split_bytes}L)")).alias("start"))
    splits = splits.withColumn("end", F.least(F.col("start") + split_bytes, F.col("size")))
    n = splits.count()
    return splits.repartition(max(1, min(n, 10_000))).mapInArrow(lambda b: _read(b, folder, with_payload), RECORDS + ", payload binary" * with_payload)

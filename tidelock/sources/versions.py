"""Immutable table versions under one root; a version comes to be by one rename.

A version is a JSON file that names, for every table, the Parquet folders that hold
its rows, with watermarks and fingerprint beside them.  Writers only ever add
folders; what no version names is not there for any reader.  So a run that fails, at
whatever point, leaves nothing to see and nothing that a rerun could read twice, and
every old version stays as it was.  The numbered file itself is the commit: it is
written under another name and then renamed, which fails if the number is taken.

Keyed tables are dealt into buckets of their key, and a version names the folder of
each bucket, so a merge writes anew only those buckets that its delta touches.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a bucket, about, when a table is first written, and buckets of a table, at most.
BUCKET_ROWS, MOST_BUCKETS = 2_000_000, 65_536


@dataclass(frozen=True)
class Version:
    number: int = 0
    #: per table its schema and either parts (a list of folders) or key, buckets and at (a folder by bucket)
    tables: dict[str, dict] = field(default_factory=dict)
    watermarks: dict[str, int] = field(default_factory=dict)
    fingerprint: str | None = None
    run_id: int = 0


@dataclass(frozen=True)
class Merged:
    """What a merge wrote: the table's entry, the rows that its touched buckets had, and how many these are."""

    entry: dict
    before: DataFrame
    rewritten: int
    buckets: int


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # versions

    def numbers(self) -> list[int]:
        """Committed versions; temporary names are none."""
        folder = self._path(f"{self.root}/_versions")
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n)))

    def current(self) -> Version:
        found = self.numbers()
        return self.at(found[-1]) if found else Version()

    def at(self, number: int) -> Version:
        path = self._path(f"{self.root}/_versions/{number:08d}.json")
        if not self._fs.exists(path):
            raise LookupError(f"no version {number}")
        stream = self._fs.open(path)
        try:
            return Version(**json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def commit(self, old: Version, **changes) -> Version:
        """Makes the next version current; refuses if another writer was first."""
        new = replace(old, number=old.number + 1, **changes)
        if self.current().number != old.number:
            raise RuntimeError(f"version {old.number} is no longer current")
        temporary = f"{self.root}/_versions/.{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(temporary), False)
        stream.write(bytearray(json.dumps(asdict(new)).encode()))
        stream.close()
        self._publish(temporary, f"{self.root}/_versions/{new.number:08d}.json", old)
        return new

    def _publish(self, temporary: str, final: str, old: Version) -> None:
        whole = lambda p: self._path(self._fs.makeQualified(self._path(p)).toString())
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri())
        modes = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        modes[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(whole(temporary), whole(final), modes)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                raise RuntimeError(f"version {old.number} is no longer current") from e
            raise

    # tables

    def table(self, version: Version, name: str) -> DataFrame | None:
        """Rows of a table as of a version; None if it has none yet."""
        return self.read(version.tables[name]) if name in version.tables else None

    def read(self, entry: dict) -> DataFrame:
        folders = entry["parts"] if "parts" in entry else list(entry["at"].values())
        return self._rows(entry, folders)

    def _rows(self, entry: dict, folders: list[str]) -> DataFrame:
        schema = _schema(entry)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def write(self, name: str, df: DataFrame) -> dict:
        """A table of one part, which no version names yet."""
        return self.append(name, None, df)

    def append(self, name: str, entry: dict | None, df: DataFrame) -> dict:
        """The table with one more part; the entry that it had stays what it was."""
        folder = f"{name}/{uuid.uuid4().hex}"
        df = _cast(df, entry) if entry else df
        df.write.parquet(f"{self.root}/{folder}")
        return {"schema": df.schema.json(), "parts": [*(entry["parts"] if entry else []), folder]}

    def write_keyed(self, name: str, df: DataFrame, key: list[str], rows: int, bucket_rows: int = BUCKET_ROWS) -> dict:
        """A table in buckets of its key, of about `bucket_rows` rows each."""
        buckets = max(1, min(MOST_BUCKETS, -(-rows // bucket_rows)))
        return {"schema": df.schema.json(), "key": key, "buckets": buckets, "at": self._write_buckets(name, df, key, buckets)}

    def merge(self, name: str, entry: dict, delta: DataFrame, change) -> Merged:
        """The table after a delta: change(rows, delta) of the buckets that the delta's keys lie in, all others as they were."""
        key, buckets = entry["key"], entry["buckets"]
        touched = sorted(r[0] for r in delta.select(_bucket(delta, key, buckets).alias("b")).distinct().collect())
        old = self._rows(entry, [entry["at"][str(b)] for b in touched if str(b) in entry["at"]])
        new = self._write_buckets(name, _cast(change(old, delta), entry), key, buckets)
        at = {b: f for b, f in entry["at"].items() if int(b) not in set(touched)} | new
        return Merged({**entry, "at": at}, old, len(touched), buckets)

    def drop(self, entry: dict) -> None:
        """Deletes the rows of an entry that no version names."""
        for folder in entry["parts"]:
            self._fs.delete(self._path(f"{self.root}/{folder}"), True)

    def _write_buckets(self, name: str, df: DataFrame, key: list[str], buckets: int) -> dict[str, str]:
        """Folders by bucket; a large bucket is several tasks' and files'."""
        folder = f"{name}/{uuid.uuid4().hex}"
        dealt = df.withColumn("_bucket", _bucket(df, key, buckets))
        dealt = dealt.repartition("_bucket", F.pmod(F.xxhash64(*key, F.lit("file")), F.lit(16)))
        dealt.write.partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        found = (s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}")))
        return {m[1]: f"{folder}/{n}" for n in found if (m := re.fullmatch(r"_bucket=(\d+)", n))}


def _schema(entry: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema"]))


def _cast(df: DataFrame, entry: dict) -> DataFrame:
    """All files of a table have the types that it was first written with; a value that does not fit is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _schema(entry)])


def _bucket(df: DataFrame, key: list[str], buckets: int) -> Column:
    """By the key's text, so that a delta whose keys have another integer type meets the same bucket."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).cast("int")

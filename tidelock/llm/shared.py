"""The shared folder for intermediate tables and files, and small helpers of all operators."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, as in tests, a new local one that becomes it."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("tidelock.shared.dir", None)
    if not root:
        root = f"file://{tempfile.mkdtemp(prefix='tidelock-')}"
        spark.conf.set("tidelock.shared.dir", root)
        sc.setCheckpointDir(root)
    return root


#: Rows of an Arrow batch between Spark and Python in these operators: whole texts are large rows.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@cache
def _own(spark: SparkSession, settings: frozenset) -> SparkSession:
    """A new session for each state of the settings: one that was made before a change would go on without it."""
    own = spark.newSession()
    mine = dict(own.conf.getAll)
    for key, value in settings:
        if mine.get(key) != value and (not key.startswith("spark.") or own.conf.isModifiable(key)):
            own.conf.set(key, value)
    return own


def own_session(spark: SparkSession) -> SparkSession:
    """A session for these operators: the settings that the given one has now, but smaller batches, which it does not see."""
    if spark.conf.get("tidelock.own.session", None):
        return spark
    theirs = dict(spark.conf.getAll)
    theirs["tidelock.own.session"] = "true"
    rows = int(theirs.get(_BATCH, spark.conf.get(_BATCH)))
    theirs[_BATCH] = str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)
    return _own(spark, frozenset(theirs.items()))


def moved(df: DataFrame) -> DataFrame:
    """The table in the session of these operators."""
    own = own_session(df.sparkSession)
    if own is df.sparkSession:
        return df
    name = f"tidelock_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return own.table(f"global_temp.{name}")
    finally:
        own.catalog.dropGlobalTempView(name)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without belongs to the cluster's default file system, not to a local one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return re.sub(r"^file:/+", "file:///", full)


class Scratch:
    """A folder of one run in the shared folder; its tables survive lost executors.

    Tables go with drop(), or else when the driver ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = own_session(spark), qualified(spark, f"{shared_root(spark)}/tidelock-{name}-{uuid.uuid4().hex}")
        atexit.register(self.drop)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a table and reads it back, which cuts its lineage."""
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the driver's JVM is gone: nothing more can be deleted  # noqa: BLE001, S110
            pass


class Marks:
    """A bitmap of the hashes of a table's rows, which tells most other rows apart before they are shuffled.

    It has 16 bits a row, but 64 MB at most.  Rows that meet in a bit cost some shuffle and no result: where it matters
    a join decides.  Beyond some 10**8 rows it lets ever more through, up to all of them.
    """

    MOST_BITS = 1 << 29

    def __init__(self, rows: DataFrame, *columns: str, hashed: bool = False):
        """hashed: the one column holds hashes itself, which Python code looks up with has_hashes."""
        self.hashed = hashed
        n = rows.count()
        self.bits = min(self.MOST_BITS, 1 << max(16, (16 * n).bit_length()))
        at = self.slot(*columns).alias("at")
        found = rows.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
        bitmap = np.zeros(self.bits >> 6, np.int64)
        bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
        self.shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def slot(self, *columns: str) -> Column:
        if self.hashed:
            return F.col(columns[0]).bitwiseAND(F.lit(self.bits - 1))
        return F.pmod(F.xxhash64(*columns), F.lit(self.bits))

    def has(self, *columns: str) -> Column:
        """Whether a row may be one of them: false only if it is not.  Python gets the hash alone."""
        shared = self.shared

        def marked(slot: pa.Array) -> pa.Array:
            at = slot.to_numpy()
            return pa.array((shared.value[at >> 6] >> (at & 63)) & 1 == 1)

        return F.arrow_udf(marked, "boolean")(self.slot(*columns))


def has_hashes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a bitmap of Marks may have, for code that runs in Python anyway."""
    at = hashes & (len(bitmap) * 64 - 1)
    return (bitmap[at >> 6] >> (at & 63)) & 1 == 1


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of a table as one, `row`, beside the operator's own, which its names can't clash with."""
    return moved(df).select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(k) for k, c in columns.items()])


def only(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Just these columns, under these names: further columns of the input can't clash with the operator's own."""
    return moved(df).select(*[(F.col(_quoted(c)) if isinstance(c, str) else c).alias(k) for k, c in columns.items()])


def _quoted(name: str) -> str:
    return name if re.fullmatch(r"\w+(\.\w+)*", name) else f"`{name}`"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """The UTF-8 bytes of a string column."""
    return F.encode(F.col(column).cast("string"), "UTF-8")

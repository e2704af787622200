"""Reading a source at one version: snapshots, net change feeds and bounded windows of ids."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .manifest import TableSpec
from .versions import Store


@dataclass
class Snapshot:
    """Every table of a source as of one version, which is stamped before any row is read.

    changes: per table a log of (version, _op, key..., values...); a log starts after the seed, so that the first run is a
    snapshot and never a replay from nothing.
    """

    spark: SparkSession
    version: int
    fingerprint: str
    tables: dict[str, DataFrame]
    changes: dict[str, DataFrame] = field(default_factory=dict)
    #: per table the version after which its log, which may be empty, has all changes
    logged_since: dict[str, int] = field(default_factory=dict)
    _ceilings: dict[str, int | None] = field(default_factory=dict)

    @classmethod
    def of(cls, store: Store) -> Snapshot:
        """The current version of a source that is kept as a store: its files are those that the version names, whatever is written meanwhile."""
        now = store.current()
        tables = {n: store.table(now, n) for n in now.tables if not n.startswith("_")}
        return cls(store.spark, now.number, now.fingerprint, tables, {n: store.table(now, f"_changes_{n}") for n in tables if f"_changes_{n}" in now.tables}, {n: now.watermarks[f"_log_{n}"] for n in tables if f"_log_{n}" in now.watermarks})

    def oldest_answerable(self, table: str) -> int:
        """The earliest mark from which the retained log can tell all changes."""
        if table in self.logged_since:
            return self.logged_since[table]
        first = self.changes[table].agg(F.min("version")).first()[0] if table in self.changes else None
        return self.version if first is None else first - 1

    def full(self, spec: TableSpec) -> DataFrame:
        return spec.project(self.tables[spec.name])

    def ceiling(self, spec: TableSpec) -> int | None:
        """The largest id of the whole table, asked for once a snapshot; None where it is empty."""
        if spec.name not in self._ceilings:
            self._ceilings[spec.name] = self.tables[spec.name].agg(F.max(spec.watermark)).first()[0]
        return self._ceilings[spec.name]

    def window(self, spec: TableSpec, since: int | None, ceiling: int | None) -> DataFrame:
        """Rows with ids in (since, ceiling], from the least id without a mark; nothing is read where that is empty."""
        rows = spec.project(self.tables[spec.name])
        if ceiling is None or since is not None and ceiling <= since:
            return self.spark.createDataFrame([], rows.schema)
        below = F.col(spec.watermark) <= ceiling
        return rows.where(below if since is None else (F.col(spec.watermark) > since) & below)

    def net_changes(self, spec: TableSpec, since: int) -> DataFrame:
        """One row a changed key since a mark: _op, key and, but for deletes, the values that it has now; none without a log."""
        if spec.name not in self.changes:
            return self.full(spec).limit(0).select(F.lit("I").alias("_op"), *spec.columns)
        log = self.changes[spec.name].where((F.col("version") > since) & (F.col("version") <= self.version))
        return change_feed(net_ops(log, list(spec.key)), self.full(spec), spec)


def net_ops(log: DataFrame, key: list[str]) -> DataFrame:
    """What a sequence of operations on each key comes to: nothing for an insert that was deleted again."""
    order = Window.partitionBy(*key).orderBy("version")
    ends = log.select(*key, "version", "_op").withColumn("first", F.first("_op").over(order)).withColumn("rn", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("version")))).where("rn = 1")
    net = F.when(F.col("_op") == "D", F.when(F.col("first") != "I", "D")).when(F.col("first") == "I", "I").otherwise("U")
    return ends.select(net.alias("_op"), *key).where("_op is not null")


def change_feed(ops: DataFrame, base: DataFrame, spec: TableSpec) -> DataFrame:
    """Operations with the base's values beside them: a left join, which keeps deletes, whose values are null."""
    values = [c for c in spec.columns if c not in spec.key]
    joined = ops.join(base, list(spec.key), "left")
    return joined.select("_op", *spec.key, *[F.when(F.col("_op") != "D", F.col(c)).alias(c) for c in values])


def seen_by_time_mark(before: DataFrame, after: DataFrame, key: str, time: str) -> DataFrame:
    """How many rows changed between two versions, and how many of these a mark on their time of change would see.

    A change is any other value in a column but the time; it is seen if the time has moved past the latest one before.
    """
    values = [c for c in after.columns if c not in (key, time)]
    old = before.select(key, F.struct(*values).alias("_old"))
    # the other side is one row
    changed = after.join(old, key).where(~F.struct(*values).eqNullSafe(F.col("_old"))).crossJoin(F.broadcast(before.agg(F.max(time).alias("_mark"))))
    return changed.agg(F.count("*").alias("changed"), F.count_if(F.col(time) > F.col("_mark")).alias("seen"))


def lost_to_time_mark(rows: DataFrame, key: str, time: str, id_mark: int) -> DataFrame:
    """Rows above an id mark that a mark on time would not see: not later than the latest time at or below it."""
    latest = rows.where(F.col(key) <= id_mark).agg(F.max(time).alias("_latest"))
    # the other side is one row
    return rows.where(F.col(key) > id_mark).crossJoin(F.broadcast(latest)).where(F.col(time) <= F.col("_latest")).drop("_latest")

"""Keyed upserts and deletes as copy-on-write transforms, updates from a join, and whole runs of them as one commit."""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.bookkeeping import LOAD_RUN
from ..sources.capture import Snapshot
from ..sources.manifest import CHANGE_FEED, Manifest, TableSpec
from ..sources.versions import BUCKET_ROWS, Store, Version
from .aggregates import duplicate_keys, payload_bytes


def merge(target: DataFrame, delta: DataFrame, key: list[str]) -> DataFrame:
    """Target after a delta (_op, key, values): rows of touched keys go, upserts come in.

    One shuffle by key, of which AQE makes a broadcast where the delta turns out small.
    """
    kept = target.join(delta.select(*key), key, "left_anti")
    return kept.unionByName(delta.where("_op <> 'D'").select(*target.columns))


def merge_counts(target: DataFrame, delta: DataFrame, key: list[str]) -> DataFrame:
    """inserted, updated (an insert whose key exists counts as one) and deleted (only keys that were there)."""
    known = delta.join(target.select(*key).withColumn("_there", F.lit(True)), key, "left").withColumn("_there", F.coalesce("_there", F.lit(False)))
    up = F.col("_op") != "D"
    return known.agg(F.count_if(up & ~F.col("_there")).alias("inserted"), F.count_if(up & F.col("_there")).alias("updated"), F.count_if(~up & F.col("_there")).alias("deleted"))


def update_from(target: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """UPDATE .. FROM .. JOIN: rows whose key has a change take its columns, null ones too; all others stay."""
    news = [c for c in changes.columns if c not in key]
    new = changes.select(*key, F.struct(*news).alias("_new"))
    joined = target.join(new, key, "left")
    return joined.select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in news else F.col(c) for c in target.columns])


def insert_from(target: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """INSERT .. SELECT of rows whose key the target has not yet."""
    return target.unionByName(rows.select(*target.columns).join(target.select(*key), key, "left_anti"))


def violations(df: DataFrame, key: list[str], not_null: list[str], allowed: dict[str, list], parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """How often each declared constraint is broken: key, not-null, allowed values, parents."""
    out = duplicate_keys(df, key).agg(F.count("*").alias("violations")).select(F.lit("primary_key").alias("rule"), "violations")
    checks: dict[str, Column] = {f"not_null_{c}": F.col(c).isNull() for c in not_null} | {f"check_{c}": ~F.col(c).isin(values) for c, values in allowed.items()}
    one = df.agg(*[F.count_if(c).alias(k) for k, c in checks.items()])
    out = out.unionByName(one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("violations")) for k in checks]))))
    for c, (parent, parent_key) in parents.items():
        orphans = df.where(F.col(c).isNotNull()).join(parent.select(F.col(parent_key).alias(c)), c, "left_anti")
        out = out.unionByName(orphans.agg(F.count("*").alias("violations")).select(F.lit(f"foreign_key_{c}").alias("rule"), "violations"))
    return out


@dataclass
class RunStats:
    run_id: int
    table: str
    mode: str
    rows_read: int
    inserted: int
    updated: int
    deleted: int
    payload_bytes: int
    watermark_before: int | None
    watermark_after: int | None
    wall_ms: int
    notes: str = ""
    buckets_rewritten: int = 0
    buckets: int = 0


def load(snapshot: Snapshot, store: Store, manifest: Manifest, bucket_rows: int = BUCKET_ROWS) -> tuple[Version, list[RunStats]]:
    """One incremental run over all tables of a snapshot, committed as a whole or not at all.

    Guards: another incarnation of the source forgets all marks; a mark older than the retained log reloads that table.
    Marks move even where nothing has changed; an empty table's mark stays.  Rows, marks and the run log (a table of its
    own, _load_run) become current together.
    """
    old = store.current()
    run_id, known, note = old.run_id + 1, dict(old.watermarks), ""
    tables, marks, stats, deltas = dict(old.tables), {}, [], []
    if old.fingerprint is not None and old.fingerprint != snapshot.fingerprint:
        known, note = {}, f"source changed from {old.fingerprint} to {snapshot.fingerprint}: full reload"
        tables = {n: e for n, e in tables.items() if n == "_load_run"}
    for spec in manifest.tables:
        began, before, why, key = time.time(), known.get(spec.name), note, list(spec.key)
        if spec.strategy == CHANGE_FEED and before is not None and before < snapshot.oldest_answerable(spec.name):
            why, before = f"mark {before} is older than the retained changes: table reloaded", None
        if before is None:
            tables.pop(spec.name, None)
        mode, after, delta = _delta(snapshot, spec, before)
        deltas.append(store.write(f"_delta_{spec.name}", delta))
        read = store.read(deltas[-1])
        if duplicate_keys(read, key).limit(1).count():
            raise ValueError(f"{spec.name}: the delta has a key twice")
        rows, size = read.count(), payload_bytes(read.select(*spec.columns)).first()[0]
        counts, written = (rows, 0, 0), (0, 0)
        if spec.strategy == CHANGE_FEED and spec.name in tables:
            counts, written = (0, 0, 0), (0, tables[spec.name]["buckets"])
            if rows:
                merged = store.merge(spec.name, tables[spec.name], read, lambda t, d, key=key: merge(t, d, key))
                counts = tuple(merge_counts(merged.before, read, key).first())
                tables[spec.name], written = merged.entry, (merged.rewritten, merged.buckets)
        elif spec.strategy == CHANGE_FEED:
            tables[spec.name] = store.write_keyed(spec.name, read.select(*spec.columns), key, rows, bucket_rows)
            written = (tables[spec.name]["buckets"],) * 2
        elif rows or spec.name not in tables:
            tables[spec.name] = store.append(spec.name, tables.get(spec.name), read.select(*spec.columns))
        marks[spec.name] = after
        stats.append(RunStats(run_id, spec.name, mode, rows, *counts, size, before, after, int(1000 * (time.time() - began)), why, *written))
    log = store.spark.createDataFrame([tuple(asdict(s).values()) for s in stats], LOAD_RUN)
    tables["_load_run"] = store.append("_load_run", tables.get("_load_run"), log.coalesce(1))
    version = store.commit(old, tables=tables, watermarks={**{n: m for n, m in known.items() if n not in manifest.names}, **marks}, fingerprint=snapshot.fingerprint, run_id=run_id)
    for entry in deltas:
        store.drop(entry)
    return version, stats


def _delta(snapshot: Snapshot, spec: TableSpec, before: int | None) -> tuple[str, int, DataFrame]:
    """How a table is read from its mark, the mark after it, and what is read."""
    if spec.strategy == CHANGE_FEED and before is None:
        return "full_snapshot", snapshot.version, snapshot.full(spec).withColumn("_op", F.lit("I"))
    if spec.strategy == CHANGE_FEED:
        return "change_feed", snapshot.version, snapshot.net_changes(spec, before)
    ceiling = snapshot.ceiling(spec)
    return "high_water", (before or 0) if ceiling is None else max(ceiling, before or 0), snapshot.window(spec, before, ceiling).withColumn("_op", F.lit("I"))


def run_totals(log: DataFrame) -> DataFrame:
    """Rows read by table, and all of them as TOTAL."""
    return log.rollup("table_name").agg(F.sum("rows_read").alias("rows_read"), F.count("*").alias("entries")).withColumn("table_name", F.coalesce("table_name", F.lit("TOTAL")))


def reset(store: Store, *names: str) -> Version:
    """Forgets the rows and marks of some tables, or of all: the next run reads them from the start.  The run log stays."""
    old = store.current()
    gone = set(names) or set(old.tables) - {"_load_run"}
    return store.commit(old, tables={n: e for n, e in old.tables.items() if n not in gone}, watermarks={n: m for n, m in old.watermarks.items() if n not in gone})

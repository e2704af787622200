"""A source that changes day by day, kept as a store: seed, days of churn, point updates, and a race of two writers.

All changes follow from keys and the number of the day, so that two runs of a day
are the same day.  Every day is one version of the source; what changed in keyed
tables goes into their change logs, which start after the seed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.capture import Snapshot
from ..sources.manifest import CHANGE_FEED, HIGH_WATER, Manifest, TableSpec
from ..sources.versions import Store, Version
from .apply import load, update_from

#: Of so many keys one is deleted, updated and new on a day; of the updated ones only every third, about, has its time moved.
EVERY = {"delete": 331, "update": 97, "insert": 211}
#: Of so many appended rows one is dated back.
BACKDATED = 20


def seed(store: Store, tables: dict[str, DataFrame], manifest: Manifest) -> Version:
    """The first version: the listed tables, and a fingerprint that no other source has."""
    now = store.current()
    if now.number:
        raise ValueError("the source is seeded already")
    entries = {s.name: _whole(store, s, s.project(tables[s.name])) for s in manifest.tables}
    logs = {f"_log_{s.name}": now.number + 1 for s in manifest.tables if s.strategy == CHANGE_FEED}
    return store.commit(now, tables=entries, watermarks=logs, fingerprint=f"source|{uuid.uuid4().hex}")


def _whole(store: Store, spec: TableSpec, rows: DataFrame) -> dict:
    return store.write_keyed(spec.name, rows, list(spec.key), rows.count()) if spec.strategy == CHANGE_FEED else store.write(spec.name, rows)


def _picked(kind: str, key: str, day: int) -> Column:
    """Keys of a day's changes of one kind; the day moves them, and a key has one kind a day."""
    place = F.pmod(F.xxhash64(F.col(key), F.lit(day)), F.lit(1 << 30))
    kinds = list(EVERY)
    before = [F.pmod(place, F.lit(EVERY[k])) != kinds.index(k) for k in kinds[: kinds.index(kind)]]
    mine = F.pmod(place, F.lit(EVERY[kind])) == kinds.index(kind)
    for other in before:
        mine = mine & other
    return mine


def keyed_changes(rows: DataFrame, spec: TableSpec, day: int, text: str, free: int, time: str | None = None) -> DataFrame:
    """A day's operations on a keyed table (_op, key, values): deletes, updates of a text column, and inserts above `free`.

    Most writers forget the time of change: a mark on it would not see what they did.
    """
    key = spec.key[0]
    gone = rows.where(_picked("delete", key, day)).select(F.lit("D").alias("_op"), key, *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in spec.columns if c != key])
    changed = rows.where(_picked("update", key, day)).withColumn(text, F.concat(F.coalesce(text, F.lit("")), F.lit(f"~{day}")))
    if time:
        latest = rows.agg(F.max(time)).first()[0]
        changed = changed.withColumn(time, F.when(F.pmod(F.xxhash64(key, F.lit("time")), F.lit(3)) == 0, F.lit(latest).cast(rows.schema[time].dataType) + F.expr(f"INTERVAL '{day}' DAY")).otherwise(F.col(time)))
    changed = changed.select(F.lit("U").alias("_op"), key, *[c for c in spec.columns if c != key])
    new = rows.where(_picked("insert", key, day)).withColumn(key, (F.col(key) + free).cast(rows.schema[key].dataType)).select(F.lit("I").alias("_op"), key, *[c for c in spec.columns if c != key])
    return gone.unionByName(changed).unionByName(new)


def appended(rows: DataFrame, spec: TableSpec, day: int, time: str | None) -> DataFrame:
    """A day's new rows of an append-only table, above its largest id; some of them dated back."""
    least, top = rows.agg(F.min(spec.watermark), F.max(spec.watermark)).first()
    new = rows.where(_picked("insert", spec.watermark, day)).withColumn(spec.watermark, F.col(spec.watermark) + F.lit((top or 0) - (least or 0) + 1))
    if time:
        back = F.pmod(F.xxhash64(spec.watermark), F.lit(BACKDATED)) == 0
        new = new.withColumn(time, F.when(back, F.col(time) - F.expr("INTERVAL '90' DAY")).otherwise(F.col(time) + F.expr(f"INTERVAL '{day}' DAY")))
    return new.select(*spec.columns)


#: Text columns that a day's updates change, and times of change, or of appended rows.
TEXTS = {"customer": "c_mktsegment", "orders": "o_orderpriority"}
TIMES = {"events": "ts", "orders": "o_orderdate"}


def churn(store: Store, manifest: Manifest, texts: dict[str, str] = TEXTS, times: dict[str, str] = TIMES) -> Version:
    """One day: a version with the changes of every table, and their change logs a day longer."""
    now = store.current()
    day, entries = now.number, dict(now.tables)
    for spec in manifest.tables:
        rows = store.table(now, spec.name)
        if spec.strategy == HIGH_WATER:
            entries[spec.name] = store.append(spec.name, entries[spec.name], appended(rows, spec, day, times.get(spec.name)))
            continue
        key = list(spec.key)
        free = (rows.agg(F.max(spec.key[0])).first()[0] or 0) + 1
        ops = store.read(store.write(f"_day_{spec.name}", keyed_changes(rows, spec, day, texts[spec.name], free, times.get(spec.name))))
        merged = store.merge(spec.name, entries[spec.name], ops, lambda old, d, key=key: old.join(d.select(*key), key, "left_anti").unionByName(d.where("_op <> 'D'").select(*old.columns)))
        entries[spec.name] = merged.entry
        log = f"_changes_{spec.name}"
        entries[log] = store.append(log, entries.get(log), ops.select(F.lit(now.number + 1).cast("long").alias("version"), "_op", *spec.key))
    return store.commit(now, tables=entries)


def forget_changes(store: Store, manifest: Manifest, until: int) -> Version:
    """Drops change logs up to a version: marks below it can't be answered any more, and their tables are reloaded."""
    now = store.current()
    entries, logs = dict(now.tables), dict(now.watermarks)
    for spec in manifest.tables:
        log = f"_changes_{spec.name}"
        if log in entries:
            entries[log] = store.write(log, store.read(entries[log]).where(F.col("version") > until))
            logs[f"_log_{spec.name}"] = max(until, logs[f"_log_{spec.name}"])
    return store.commit(now, tables=entries, watermarks=logs)


def set_values(store: Store, spec: TableSpec, values: DataFrame) -> Version:
    """Point updates of the source (key and new values) that no log tells of; read again and verified, else nothing is committed."""
    now, key = store.current(), list(spec.key)
    columns = [c for c in values.columns if c not in key]
    entry = now.tables[spec.name]
    new = _whole(store, spec, update_from(store.read(entry), values, key))
    again = store.read(new).join(values.select(*key, F.struct(*columns).alias("_wanted")), key)
    wrong = again.where(~F.struct(*columns).eqNullSafe(F.col("_wanted"))).count()
    if wrong or again.count() != values.count():
        raise ValueError(f"{spec.name}: {wrong} rows do not hold what they were set to, or are missing")
    return store.commit(now, tables={**now.tables, spec.name: new})


def watermark_race(rows: DataFrame, spec: TableSpec, visible_at: str, store: Store, times: tuple[int, int] = (1, 2)) -> DataFrame:
    """What a mark on ids loses if ids become visible out of order: rows that no run has read although the mark is past them.

    rows have a further column, the time at which their writer commits.  A run at the first time moves the mark to the
    largest visible id; smaller ids that are committed later are behind it for good.
    """
    manifest = Manifest((spec,))
    for at in times:
        seen = rows.where(F.col(visible_at) <= at).select(*spec.columns)
        load(Snapshot(rows.sparkSession, at, "race", {spec.name: seen}), store, manifest)
    now = store.current()
    behind = rows.where((F.col(visible_at) <= times[-1]) & (F.col(spec.watermark) <= now.watermarks[spec.name]))
    return behind.select(*spec.columns).join(store.table(now, spec.name).select(*spec.key), list(spec.key), "left_anti")

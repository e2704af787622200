"""Structured Streaming over the same operators: idempotent upserts by micro-batch, and what a time mark would drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregates import running_max_before
from ..operators.apply import merge
from ..sources.versions import Store


def latest_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest order of each key, whole; partial aggregates go before the shuffle."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_r")).select(key, "_r.*").select(*rows.columns)


def upsert_batch(store: Store, name: str, key: str, order: str, batch: DataFrame, batch_id: int) -> None:
    """Merges a micro-batch into the buckets that it touches and commits rows and batch id together; a batch that is in already is skipped."""
    old = store.current()
    if old.watermarks.get(f"_batch_{name}", -1) >= batch_id:
        return
    delta = latest_per_key(batch, key, order)
    if name in old.tables:
        entry = store.merge(name, old.tables[name], delta, lambda rows, new: _newer(rows, new, key, order)).entry
    else:
        entry = store.write_keyed(name, delta, [key], delta.count())
    store.commit(old, tables={**old.tables, name: entry}, watermarks={**old.watermarks, f"_batch_{name}": batch_id})


def _newer(rows: DataFrame, delta: DataFrame, key: str, order: str) -> DataFrame:
    """The rows after a batch, of which a late row does not put back what is newer."""
    have = rows.select(key, F.col(order).alias("_have"))
    delta = delta.join(have, key, "left").where(F.col("_have").isNull() | (F.col("_have") < F.col(order))).drop("_have")
    return merge(rows, delta.withColumn("_op", F.lit("U")), [key])


def mirror_stream(spark: SparkSession, source: str, schema, store: Store, name: str, key: str, order: str, checkpoint: str, files_per_batch: int = 1) -> StreamingQuery:
    """Reads what is new under `source` in micro-batches, merges all of it and stops."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.writeStream.foreachBatch(lambda batch, batch_id: upsert_batch(store, name, key, order, batch, batch_id)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, delay: str, width: str, group: str) -> DataFrame:
    """Counts by event-time window, which drop rows later than the delay: the counter-example to id marks."""
    return stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", delay).groupBy(F.window("_t", width), group).agg(F.count("*").alias("n"))


def late_rows(rows: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Rows that come later than a watermark of `delay` behind the latest time seen before them would let in."""
    return running_max_before(rows, key, time, "_seen").where(F.col(time) < F.col("_seen") - F.expr(delay)).drop("_seen")

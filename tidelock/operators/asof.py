"""Nearest-key lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import bucket_width

#: Width of a bucket of the key space, at least.
BUCKET_KEYS = 4096


def next_key(left: DataFrame, at: str, keys: DataFrame, key: str, name: str, bucket_keys: int | None = None) -> DataFrame:
    """Each row of left with the least key that is not below its `at`; null where there is none.

    Both sides are dealt into buckets of the key space, in which one sorted sweep finds the next key; where a bucket has
    none, the first key of a later bucket is it, which a table of one row a bucket tells.  Hot values of `at` are swept
    once, as distinct values, and joined back.
    """
    bucket_keys = bucket_keys or bucket_width(keys, key, BUCKET_KEYS)
    least, most = keys.agg(F.min(key), F.max(key)).first()
    bucket = lambda c: F.floor(F.col(c) / bucket_keys).cast("long")
    # points below the least key are in its bucket, however far below; those above the largest have no next key
    points = left.select(F.col(at).alias("v")).where("v is not null" if most is None else F.col(at) <= most).distinct()
    points = points.withColumn("b", bucket("v") if least is None else F.floor(F.greatest("v", F.lit(least)) / bucket_keys).cast("long"))
    both = points.withColumn("k", F.lit(None).cast(keys.schema[key].dataType)).unionByName(keys.select(F.col(key).cast(left.schema[at].dataType).alias("v"), F.col(key).alias("k")).withColumn("b", bucket("v")).select("v", "b", "k"))
    ahead = Window.partitionBy("b").orderBy("v").rangeBetween(0, Window.unboundedFollowing)
    inside = both.withColumn("n", F.min("k").over(ahead)).where("k is null").select("v", "b", "n")
    firsts = keys.groupBy(bucket(key).alias("b")).agg(F.min(key).alias("first"))
    # one row a bucket, however many keys there are
    used = points.select("b").distinct().join(firsts, "b", "full_outer")
    later = used.withColumn("later", F.min("first").over(Window.orderBy("b").rowsBetween(1, Window.unboundedFollowing))).select("b", "later")
    found = inside.join(later, "b", "left").select(F.col("v").alias(at), F.coalesce("n", "later").alias(name))
    return left.join(found, at, "left")

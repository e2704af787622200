"""Breaks that a mirror must notice, and one that no aggregate can."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Added to two old rows; they must not cancel out.
REWRITES = (7_919, -2_003)


def pick_rows(df: DataFrame, key: str, value: str, mark: int) -> DataFrame:
    """The oldest row at or below a mark, and the next oldest whose value differs."""
    oldest = df.where(F.col(key) <= mark).select(key, value)
    first = oldest.orderBy(key).limit(1)
    other = oldest.join(F.broadcast(first.select(F.col(value).alias("_v"))), F.col(value) != F.col("_v")).orderBy(key).limit(1).select(key, value)
    return first.unionByName(other)


def rewrite(df: DataFrame, key: str, value: str, changes: dict[int, float]) -> DataFrame:
    """A later version of a table in which some rows were changed where no mark looks."""
    new = F.col(value)
    for k, by in changes.items():
        new = F.when(F.col(key) == k, F.col(value) + by).otherwise(new)
    return df.withColumn(value, new)


def swap(df: DataFrame, key: str, value: str, a: int, b: int) -> DataFrame:
    """A later version in which two rows have each other's value."""
    pair = df.where(F.col(key).isin(a, b)).select((F.lit(a + b) - F.col(key)).alias(key), F.col(value).alias("_v"))
    return df.join(F.broadcast(pair), key, "left").withColumn(value, F.coalesce("_v", value)).drop("_v")

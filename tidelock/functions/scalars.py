"""Scalar helpers that several plans share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_scalar(x: Column, kind: str) -> Column:
    """A value as both sides of a comparison write it: booleans as integers, times to the second, dates in ISO form."""
    if kind == "boolean":
        return x.cast("int")
    if kind.startswith("timestamp"):
        return F.date_format(F.date_trunc("second", x), "yyyy-MM-dd HH:mm:ss")
    if kind == "date":
        return F.date_format(x, "yyyy-MM-dd")
    if kind.startswith("decimal"):
        return F.when(x == F.floor(x), F.floor(x)).cast("long")
    return x


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where there is no whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / F.when(whole != 0, whole))


def hash_order(df: DataFrame, key: str) -> DataFrame:
    """A stable order that is unrelated to the key's own."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key)

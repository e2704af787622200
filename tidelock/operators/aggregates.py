"""Aggregates that reconciliation is made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the driver's tables by kind, for the SQL side of type-directed aggregates.
KINDS = {
    "orders": {"o_orderkey": "number", "o_custkey": "number", "o_orderstatus": "text", "o_orderdate": "date", "o_orderpriority": "text"},
    "events": {"event_id": "number", "ts": "date", "user_id": "number", "event_type": "text", "props": "text"},
    "lineitem": {"l_orderkey": "number", "l_partkey": "number", "l_suppkey": "number", "l_linenumber": "number", "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "date"},
    "customer": {"c_custkey": "number", "c_name": "text", "c_nationkey": "number", "c_mktsegment": "text"},
}


def kind_of(dtype: T.DataType) -> str:
    """inexact types are left out of value parity: no two engines need add them up alike."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "inexact"
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return "number"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "text" if isinstance(dtype, T.StringType) else "other"


def _text(c: Column, kind: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind == "date" else c.cast("string")


def exact_sum(c: Column, dtype: T.DataType) -> Column:
    """The sum of whole or decimal numbers: all digits of the fraction, and room for more rows than there can be."""
    return F.sum(c.cast(T.DecimalType(38, dtype.scale if isinstance(dtype, T.DecimalType) else 0)))


def column_aggregates(name: str, dtype: T.DataType) -> list[tuple[str, Column]]:
    """(label, aggregate as text) of a column by its kind; none for inexact ones."""
    kind, c = kind_of(dtype), F.col(name)
    out = [("count", F.count(c).cast("string"))]
    if kind == "inexact":
        return []
    if kind == "number":
        out += [("sum", exact_sum(c, dtype).cast("string")), ("min", _text(F.min(c), kind)), ("max", _text(F.max(c), kind))]
    elif kind == "bool":
        out += [("sum", F.sum(c.cast("long")).cast("string"))]
    elif kind == "date":
        out += [("min", _text(F.min(c), kind)), ("max", _text(F.max(c), kind))]
    elif kind == "text":
        out += [("chars", F.sum(F.char_length(c).cast("long")).cast("string"))]
    return out


def type_directed(df: DataFrame) -> DataFrame:
    """All aggregates of a table in one scan, a row each: column_name, label, value."""
    parts = [(f.name, label, agg) for f in df.schema for label, agg in column_aggregates(f.name, f.dataType)]
    one = df.agg(*[agg.alias(f"_{k}") for k, (_, _, agg) in enumerate(parts)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(label).alias("label"), F.col(f"_{k}").alias("value")) for k, (n, label, _) in enumerate(parts)])))


def type_directed_sql(table: str) -> str:
    text = {"number": "CAST({} AS VARCHAR)", "date": "strftime({}, '%Y-%m-%d %H:%M:%S')"}
    rows = []
    for c, kind in KINDS[table].items():
        rows.append((c, "count", f"CAST(count({c}) AS VARCHAR)"))
        if kind == "number":
            rows.append((c, "sum", f"CAST(sum({c}) AS VARCHAR)"))
        if kind in text:
            rows += [(c, k, text[kind].format(f"{k}({c})")) for k in ("min", "max")]
        if kind == "text":
            rows.append((c, "chars", f"CAST(CAST(sum(length({c})) AS BIGINT) AS VARCHAR)"))
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{label}' AS label, {e} AS value FROM {table}" for c, label, e in rows)


def key_scalars(df: DataFrame, key: str) -> DataFrame:
    """Count, sum (as text, which holds any size), least and largest key."""
    c = F.col(key).cast("long")
    return df.agg(F.count("*").alias("n_rows"), exact_sum(c, T.LongType()).cast("string").alias("key_sum"), F.min(c).alias("key_min"), F.max(c).alias("key_max"))


def frozen_sums(df: DataFrame, key: str, mark: int, columns: list[str]) -> DataFrame:
    """Count and sums, as text, of what lies at or below a mark."""
    return df.where(F.col(key) <= mark).agg(F.count("*").alias("n_rows"), *[exact_sum(F.col(c), df.schema[c].dataType).cast("string").alias(f"sum_{c}") for c in columns])


def window_density(df: DataFrame, key: str) -> DataFrame:
    """Rows of a window of ids against its span."""
    span = F.max(key) - F.min(key) + 1
    return df.agg(F.count("*").alias("n_rows"), F.min(key).alias("lo"), F.max(key).alias("hi"), span.alias("span"), (span - F.count("*")).alias("gaps"))


def null_evidence(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """How many rows of each column are null, in one scan."""
    one = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.select(F.lit(name).alias("table_name"), F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n_rows"), F.col(c).alias("nulls")) for c in columns])))


def payload_bytes(df: DataFrame) -> DataFrame:
    """Value bytes: 8 a number, 1 a boolean, UTF-8 length of all else as text, 0 a null."""

    def size(f: T.StructField) -> Column:
        c = F.col(f.name)
        fixed = 1 if isinstance(f.dataType, T.BooleanType) else 8 if isinstance(f.dataType, T.NumericType) else None
        return F.when(c.isNull(), F.lit(0)).otherwise(F.lit(fixed) if fixed else F.octet_length(c.cast("string"))).cast("long")

    total = size(df.schema[0])
    for f in df.schema[1:]:
        total = total + size(f)
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("payload_bytes"))


def id_sample(df: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """Per group the exact count and the least `n` keys as csv; partitions pass on no more than n keys of a group."""
    least = df.select(group, key).withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(key))).where(F.col("_r") <= n)
    sample = least.groupBy(group).agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string"))).alias("sample"))
    return df.groupBy(group).agg(F.count("*").alias("n")).join(sample, group).select(group, "sample", "n")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


#: Ids that one bucket of a running aggregate has, at least, and buckets that there are, at most.
RUN_BUCKET, RUN_BUCKETS = 1 << 16, 8192


def bucket_width(df: DataFrame, key: str, least: int = RUN_BUCKET) -> int:
    """Ids a bucket: so many that the table of buckets, which one task sorts, stays small at any size."""
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    return least if lo is None else max(least, (hi - lo) // RUN_BUCKETS + 1)


def running_max_before(df: DataFrame, key: str, value: str, name: str, bucket: int | None = None) -> DataFrame:
    """Adds the largest value of all rows with smaller keys.

    The running maximum is taken within buckets of ids and joined with the maximum of all buckets before, of which there is
    one row each, so that no task gets the whole table.
    """
    bucket = bucket or bucket_width(df, key)
    keyed = df.withColumn("_b", F.floor(F.col(key) / bucket))
    tops = keyed.groupBy("_b").agg(F.max(value).alias("_top"))
    earlier = tops.withColumn("_earlier", F.max("_top").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).drop("_top")
    inside = keyed.withColumn("_before", F.max(value).over(Window.partitionBy("_b").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)))
    return inside.join(earlier, "_b").withColumn(name, F.greatest("_before", "_earlier")).drop("_b", "_before", "_earlier")


def behind_running_max(df: DataFrame, key: str, value: str, bucket: int | None = None) -> DataFrame:
    """Rows whose value is below the largest of all rows with smaller keys."""
    return running_max_before(df, key, value, "_top", bucket).where(F.col(value) < F.col("_top")).drop("_top")


def global_rank(df: DataFrame, key: str, descending: bool = False) -> DataFrame:
    """Places in the total order by key: ranks within buckets of ids, after the rows of the buckets before."""
    sign = F.negative(F.col(key)) if descending else F.col(key)
    keyed = df.withColumn("_b", F.floor(sign / bucket_width(df, key)))
    sizes = keyed.groupBy("_b").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    order = F.col(key).desc() if descending else F.col(key)
    ranked = keyed.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(order)))
    return ranked.join(before, "_b").withColumn("place", F.col("_r") + F.col("_before")).drop("_b", "_r", "_before")

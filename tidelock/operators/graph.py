"""Connected components of a small residual graph, by least labels and pointer jumping."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 50


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's checkpoint folder, or, where none is set, as in tests, in a local one; it goes when the driver ends."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("tidelock.shared.dir", None)
    if not root:
        root = f"file://{tempfile.mkdtemp(prefix='tidelock-')}"
        spark.conf.set("tidelock.shared.dir", root)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    atexit.register(_drop, spark, path)
    return path


def _drop(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the driver's JVM is gone  # noqa: BLE001, S110
        pass


def written(df: DataFrame) -> DataFrame:
    """Cuts lineage: rows are worked out once, written and read back."""
    path = folder(df.sparkSession, "written")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of undirected edges (a, b); root is the least node that is reachable."""
    both = written(edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node")
    if not both.limit(1).count():
        return labels
    for _ in range(ROUNDS):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"], "left").select("node", F.least("root", F.coalesce("near", "root")).alias("root"), F.col("root").alias("was"))
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = written(lower.join(jump, "root", "left").select("node", F.least("root", F.coalesce("further", "root")).alias("root"), "was"))
        labels = after.select("node", "root")
        if not after.where("root <> was").limit(1).count():
            return labels
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")

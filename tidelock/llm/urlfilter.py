"""URL filters as a sort-merge range join, in DataFrame operations only.

A host is written from its end, label by label ("com.example.www."), so that a
host and all its subdomains are one interval of keys.  Rules open and close
such intervals, urls are points, and one sorted sweep over both finds the rule
that covers each url.  Intervals of prefixes are nested or apart, so the sweep
needs a stack of the rules that are open: the running count of opened less
closed ones is the stack's height, and the slot of each height holds the rule
that was opened last at that height, which a second window keeps.

Paths nest in the same way below each host.  A url gets a point for each length
that rule paths have, keyed by that prefix of its path before its host, and the
longest rule of its points wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import only

#: Rules that one sweep holds; more rules take more sweeps.
RULES_PER_SWEEP = 20_000
#: Urls are dealt to blocks of about so many points, by hash, so no host makes one of them large.
POINTS_PER_BLOCK = 500_000


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; empty without `://` or url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, a dot after each: a host's key is a prefix of its subdomains' keys."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _key(path: Column, host: Column) -> Column:
    """Bytes of a path, an end mark that no written path has, and bytes of a reversed host.

    NUL and the byte after it are written as two bytes each, so that the first NUL of a key ends its path.
    """
    written = F.replace(F.replace(path, F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01"))
    return F.concat(F.encode(written, "UTF-8"), F.lit(b"\x00"), F.encode(host, "UTF-8"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules (verdict, "host/path") as a table of literals."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(r.split("/", 1)[0]).alias("host"), F.lit("/" + r.split("/", 1)[1]).alias("path"), F.lit(r).alias("rule")) for v, r in rules]
    return spark.range(1).select(F.inline(F.array(*rows))) if rows else spark.sql("SELECT '' AS verdict, '' AS host, '' AS path, '' AS rule WHERE false")


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow", rules_per_sweep: int = RULES_PER_SWEEP) -> DataFrame:
    """Per row of urls (page_id, url): page_id, host, path, rule and verdict.

    The longest rule (characters of host and path) that fits decides, among equally long ones the first by text; rules
    that stand twice count once, a block before an allow.  Without a rule, `default` decides; so it does for null urls and
    urls without `://`, whose host and path are empty.  Rows that repeat a page_id are judged each for itself.  Other
    columns of either table are not read; empty tables are fine.
    """
    rules = only(rules, verdict="verdict", rule_host=F.lower("host"), rule_path="path", rule="rule").where("rule_host is not null and rule_path is not null")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.min("rule").alias("rule"), F.max("verdict").alias("rule_verdict"))
    size = rules.count()
    sweeps = max(1, -(-size // rules_per_sweep))
    spark = urls.sparkSession
    points = only(urls, page_id="page_id", url=F.col("url").cast("string")).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # a row number that a page_id can't clash in; it only tells rows apart
    points = points.withColumn("row", F.monotonically_increasing_id())
    lengths = [r[0] for r in rules.select(F.length("rule_path").alias("n")).distinct().orderBy("n").collect()]
    # by the number of urls, and no fewer than the cluster can run at once
    blocks = max(spark.sparkContext.defaultParallelism, -(-urls.count() * max(1, len(lengths)) // POINTS_PER_BLOCK))
    points = points.withColumn("block", F.pmod(F.xxhash64("row", "page_id"), F.lit(blocks)).cast("int"))
    best = None
    for k in range(sweeps):
        some = rules.where(F.pmod(F.xxhash64("rule_host", "rule_path"), F.lit(sweeps)) == k) if sweeps > 1 else rules
        found = _sweep(points, some, lengths, blocks)
        if best is not None:
            found = found.unionByName(best).groupBy("block", "row", "page_id", "host", "path").agg(F.min("won").alias("won"))
        best = found
    rule = F.col("won.rule")
    return best.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(F.col("won.rule_verdict"), F.lit(default)).alias("verdict"))


def _sweep(points: DataFrame, rules: DataFrame, lengths: list[int], blocks: int) -> DataFrame:
    """Each point with the longest rule that covers it."""
    none = F.lit(None)
    opened = F.struct("rule", "rule_verdict", (F.length("rule_host") + F.length("rule_path")).alias("n"))
    start = _key(F.col("rule_path"), reversed_host(F.col("rule_host")))
    spread = rules.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # at one key an interval opens before points pass; it ends behind every key that it is a prefix of
    event = lambda key, order, height, opens: spread.select(
        "block", none.cast("long").alias("row"), none.cast("long").alias("page_id"), none.cast("string").alias("host"), none.cast("string").alias("path"), key.alias("key"), F.lit(order).alias("order"), F.lit(height).alias("step"), (opened if opens else F.when(F.lit(False), opened)).alias("opened")
    )
    wanted = F.array(*[F.lit(n) for n in lengths] or [F.lit(1)])
    # the shortest prefix is there for every url, so that none is lost
    prefix = F.expr("substring(path, 1, n)")
    point = points.withColumn("n", F.explode(F.filter(wanted, lambda n: (n <= F.length("path")) | (n == (lengths or [1])[0]))))
    point = point.select("block", "row", F.col("page_id").cast("long"), "host", "path", _key(prefix, reversed_host(F.col("host"))).alias("key"), F.lit(1).alias("order"), F.lit(0).alias("step"), F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("rule_verdict"), F.lit(0).alias("n"))).alias("opened"))
    events = event(start, 0, 1, True).unionByName(event(F.concat(start, F.lit(b"\xff")), 2, -1, False)).unionByName(point)
    events = events.withColumn("height", F.sum("step").over(Window.partitionBy("block").orderBy("key", "order").rowsBetween(Window.unboundedPreceding, 0)))
    inner = F.last("opened", ignorenulls=True).over(Window.partitionBy("block", "height").orderBy("key", "order").rowsBetween(Window.unboundedPreceding, 0))
    swept = events.withColumn("inner", F.when(F.col("height") > 0, inner)).where("order = 1")
    # the least is the longest rule, of equally long ones the first by text
    fits = F.when(F.col("inner").isNotNull(), F.struct(F.negative("inner.n").alias("order"), F.col("inner.rule").alias("rule"), F.col("inner.rule_verdict").alias("rule_verdict")))
    return swept.groupBy("block", "row", "page_id", "host", "path").agg(F.min(fits).alias("won"))

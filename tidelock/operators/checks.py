"""Two-sided reconciliation: PASS < SOURCE-DIRTY < FAIL."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import column_aggregates, exact_sum, frozen_sums, key_scalars, type_directed, window_density

PASS, DIRTY, FAIL = "PASS", "SOURCE-DIRTY", "FAIL"
SEVERITY = {PASS: 0, DIRTY: 1, FAIL: 2}


def key_parity(source: DataFrame, mirror: DataFrame, key: str) -> DataFrame:
    """Counts of matched, missing and extra keys, which never cancel out, with the signed differences of the scalars."""
    s, m = source.select(F.col(key).alias("k"), F.lit(1).alias("s")), mirror.select(F.col(key).alias("k"), F.lit(1).alias("m"))
    both = s.join(m, "k", "full_outer")
    kind = F.when(F.col("m").isNull(), "missing").when(F.col("s").isNull(), "extra").otherwise("matched")
    return both.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), exact_sum(F.col("k"), both.schema["k"].dataType).cast("string").alias("key_sum"), F.min("k").alias("key_min"), F.max("k").alias("key_max"))


def scalars_agree(source: DataFrame, mirror: DataFrame, key: str) -> bool:
    """The cheap question first: keys are compared one by one only where four scalars differ."""
    return tuple(key_scalars(source, key).first()) == tuple(key_scalars(mirror, key).first())


def value_parity(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """Every aggregate of every exact column on both sides, and its verdict."""
    m = type_directed(mirror).withColumnRenamed("value", "mirror_value")
    same = F.col("source_value").eqNullSafe(F.col("mirror_value"))
    return type_directed(source).withColumnRenamed("value", "source_value").join(m, ["column_name", "label"], "full_outer").withColumn("verdict", F.when(same, PASS).otherwise(FAIL))


def value_diff(source: DataFrame, mirror: DataFrame, key: str, column: str) -> DataFrame:
    """Rows on both sides whose value differs, null-safely; keys on one side only belong to key parity."""
    s, m = source.select(key, F.col(column).alias("source_value")), mirror.select(key, F.col(column).alias("mirror_value"))
    return s.join(m, key).where(~F.col("source_value").eqNullSafe(F.col("mirror_value")))


def append_only(source: DataFrame, mirror: DataFrame, key: str, mark: int | None, columns: list[str]) -> DataFrame:
    """Rows at or below the mark may not have changed; without a mark there is nothing to check."""
    if mark is None:
        return source.sparkSession.createDataFrame([], "measure string, source_value string, mirror_value string, verdict string")
    names = ["n_rows", *[f"sum_{c}" for c in columns]]
    long = lambda df, side: frozen_sums(df, key, mark, columns).select(F.inline(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("string").alias(side)) for n in names])))
    both = long(source, "source_value").join(long(mirror, "mirror_value"), "measure")
    return both.withColumn("verdict", F.when(F.col("source_value").eqNullSafe(F.col("mirror_value")), PASS).otherwise(FAIL))


def contiguity_verdict(source: str, mirror: str) -> Column:
    """Windows differ: FAIL; empty: PASS; an id twice: FAIL; gaps: the source's; else dense."""
    differs = lambda c: ~F.col(f"{source}.{c}").eqNullSafe(F.col(f"{mirror}.{c}"))
    return F.when(differs("n_rows") | differs("lo") | differs("hi"), FAIL).when(F.col(f"{source}.n_rows") == 0, PASS).when(F.col(f"{source}.gaps") < 0, FAIL).when(F.col(f"{source}.gaps") > 0, DIRTY).otherwise(PASS)


def contiguity(source: DataFrame, mirror: DataFrame, key: str, low: int, high: int) -> DataFrame:
    inside = (F.col(key) > low) & (F.col(key) <= high)
    s, m = window_density(source.where(inside), key), window_density(mirror.where(inside), key)
    both = s.select(F.struct("*").alias("s")).crossJoin(m.select(F.struct("*").alias("m")))  # a row each
    return both.select(F.col("s.n_rows").alias("n_rows"), F.col("s.gaps").alias("gaps"), F.col("m.n_rows").alias("mirror_rows"), contiguity_verdict("s", "m").alias("verdict"))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys without a parent; null keys point at nothing."""
    return child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti").select(F.col(key).alias("k")).distinct()


def referential(source_child: DataFrame, mirror_child: DataFrame, key: str, source_parent: DataFrame, mirror_parent: DataFrame, parent_key: str) -> DataFrame:
    """Orphans by side: in both the source is dirty, in the mirror alone it has failed, in the source alone it is told."""
    s, m = orphans(source_child, key, source_parent, parent_key).withColumn("s", F.lit(1)), orphans(mirror_child, key, mirror_parent, parent_key).withColumn("m", F.lit(1))
    side = F.when(F.col("s").isNull(), "mirror_only").when(F.col("m").isNull(), "source_only").otherwise("both")
    return s.join(m, "k", "full_outer").groupBy(side.alias("side")).agg(F.count("*").alias("n_keys")).withColumn("verdict", F.when(F.col("side") == "mirror_only", FAIL).otherwise(DIRTY))


def worst(verdicts: DataFrame, column: str = "verdict") -> Column:
    """The worst verdict of a group; PASS where there is none."""
    rank = F.max(F.when(F.col(column) == FAIL, 2).when(F.col(column) == DIRTY, 1).otherwise(0))
    return F.when(rank == 2, FAIL).when(rank == 1, DIRTY).otherwise(PASS)


@dataclass
class Scorecard:
    outcomes: list[tuple[str, str, str]] = field(default_factory=list)  # check, verdict, detail

    def add(self, check: str, verdict: str, detail: str = "") -> None:
        self.outcomes.append((check, verdict, detail))

    @property
    def verdict(self) -> str:
        return max((v for _, v, _ in self.outcomes), key=SEVERITY.__getitem__, default=PASS)

    @property
    def exit_code(self) -> int:
        return int(self.verdict == FAIL)


BLIND_SPOT = "equal aggregates filter, they prove nothing: a swap of two values leaves all of them as they were"


def table_facts(df: DataFrame, key: str, mark: int | None) -> dict[str, str | None]:
    """All that the checks ask of one side of a table, in one scan: scalars of the key, aggregates of the exact columns, and
    for append-only tables sums and density of what lies at or below the mark."""
    k = F.col(key).cast("long")
    asked = {"rows": F.count("*"), "key:sum": exact_sum(k, T.LongType()), "key:min": F.min(k), "key:max": F.max(k)}
    asked |= {f"value:{f.name}:{label}": agg for f in df.schema for label, agg in column_aggregates(f.name, f.dataType)}
    if mark is not None:
        old = F.when(k <= mark, k)
        asked |= {"frozen:rows": F.count(old), "frozen:sum": exact_sum(old, T.LongType()), "frozen:min": F.min(old), "frozen:max": F.max(old)}
    row = df.agg(*[v.cast("string").alias(f"_{n}") for n, v in enumerate(asked.values())]).first()
    return dict(zip(asked, row, strict=True))


def _contiguity(source: dict, mirror: dict) -> str:
    """The verdict of contiguity_verdict from the facts of both sides."""
    if any(source[f"frozen:{x}"] != mirror[f"frozen:{x}"] for x in ("rows", "min", "max")):
        return FAIL
    rows = int(source["frozen:rows"])
    gaps = int(source["frozen:max"]) - int(source["frozen:min"]) + 1 - rows if rows else 0
    return FAIL if gaps < 0 else DIRTY if gaps else PASS


def run_scorecard(source: dict[str, DataFrame], mirror: dict[str, DataFrame], keys: dict[str, str], marks: dict[str, int], relations: list[tuple[str, str, str, str]]) -> Scorecard:
    """All checks over the tables of one snapshot; a table that the mirror lacks is noted, not failed.

    Each side of a table is scanned once; keys are compared one by one only where their scalars differ.
    """
    card = Scorecard()
    for name, key in keys.items():
        if name not in mirror:
            card.add(f"key_parity_{name}", PASS, "not in the mirror")
            continue
        s, m = (table_facts(side[name], key, marks.get(name)) for side in (source, mirror))
        differ = lambda part: sorted({x.split(":")[1] for x in s.keys() | m.keys() if x.startswith(part) and s.get(x) != m.get(x)})  # noqa: B023, E731
        agree = s["rows"] == m["rows"] and not differ("key:")
        drill = "" if agree else ", ".join(f"{r.kind} {r.n}" for r in key_parity(source[name], mirror[name], key).collect())
        card.add(f"key_parity_{name}", PASS if agree else FAIL, drill)
        bad = differ("value:")
        card.add(f"value_parity_{name}", FAIL if bad else PASS, f"differ: {', '.join(bad)}" if bad else BLIND_SPOT)
        if name in marks:
            card.add(f"append_only_{name}", FAIL if s["frozen:rows"] != m["frozen:rows"] or s["frozen:sum"] != m["frozen:sum"] else PASS)
            card.add(f"contiguity_{name}", _contiguity(s, m))
    for child, column, parent, parent_key in relations:
        rows = referential(source[child], mirror[child], column, source[parent], mirror[parent], parent_key).collect()
        card.add(f"referential_{child}_{column}", max((r.verdict for r in rows), key=SEVERITY.__getitem__, default=PASS), ", ".join(f"{r.side} {r.n_keys}" for r in rows))
    return card

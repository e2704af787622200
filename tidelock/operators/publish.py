"""Publishing a resolution: map, review queue and run history become current together, or nothing does."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.bookkeeping import CUSTOMER_MAP, IDENTITY_RUN, MERGE_REVIEW
from ..sources.versions import Store, Version
from . import identity as I


class PublishRefused(RuntimeError):
    """Guards that the written map violates; no version names it."""


def refused_edges(screening: I.Screening, manual: DataFrame) -> DataFrame:
    """Manual edges that can't be applied: which endpoint, and whether it is excluded as a test account or absent; who decided them."""
    ends = manual.select("*", F.explode(F.array("customer_id_a", "customer_id_b")).alias("customer_id"))
    out = screening.excluded.select("customer_id", F.concat(F.lit("excluded_test by rule "), "rules").alias("why"))
    ends = ends.join(screening.population.select("customer_id"), "customer_id", "left_anti").join(out, "customer_id", "left")
    return ends.select("customer_id_a", "customer_id_b", "decided_by", F.col("customer_id").alias("endpoint"), F.coalesce("why", F.lit("not in the mirror")).alias("why"))


def map_rows(screening: I.Screening, members: DataFrame, run_id: int, at: datetime) -> DataFrame:
    """The map with its evidence: what moved money of a merged or refused customer, and what excluded a test account."""
    known = members.select("customer_id", "evidence", F.lit(None).cast("string").alias("rules")).unionByName(screening.excluded.select("customer_id", F.lit(None).cast("string").alias("evidence"), "rules"))
    rows = I.customer_map(screening, members).join(known, "customer_id")
    evidence = F.when(F.col("resolution") == "excluded_test", F.concat(F.lit("rules "), "rules")).when(F.col("resolution") != "singleton", F.nullif("evidence", F.lit("")))
    rows = rows.withColumn("evidence", evidence).withColumn("run_id", F.lit(run_id)).withColumn("resolved_at", F.lit(at).cast("timestamp_ntz"))
    return _as(rows, CUSTOMER_MAP)


def _as(rows: DataFrame, schema: str) -> DataFrame:
    """Columns in the order and of the types of a schema."""
    wanted = [c.split() for c in schema.split(", ")]
    return rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in wanted])


def review_rows(screening: I.Screening, members: DataFrame, run_id: int, at: datetime) -> DataFrame:
    """The review queue of a run, each row with the money evidence of its members."""
    queue = I.review_queue(screening, members)
    each = queue.select("review_id", F.explode(F.split("customer_ids", ",").cast("array<bigint>")).alias("customer_id")).join(members.select("customer_id", "evidence"), "customer_id")
    told = each.groupBy("review_id").agg(F.concat_ws(" / ", F.transform(F.array_sort(F.collect_list(F.struct("customer_id", F.coalesce("evidence", F.lit("")).alias("line")))), lambda x: F.concat(x["customer_id"].cast("string"), F.lit(": "), x["line"]))).alias("evidence"))
    return _as(queue.join(told, "review_id", "left").withColumn("run_id", F.lit(run_id)).withColumn("created_at", F.lit(at).cast("timestamp_ntz")), MERGE_REVIEW)


def coverage(resolved: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers that a published map lacks, and those that it has and the mirror no longer does."""
    mapped, there = resolved.select(F.col("customer_id").cast("long")), customers.select(F.col("customer_id").cast("long"))
    lacks = there.join(mapped, "customer_id", "left_anti").select(F.lit("not in the map").alias("side"), "customer_id")
    return lacks.unionByName(mapped.join(there, "customer_id", "left_anti").select(F.lit("not in the mirror").alias("side"), "customer_id"))


def _history(store: Store, name: str, entry: dict | None, rows: DataFrame, run_id: int) -> dict:
    """History with a run's rows; a rerun takes the place of that run alone."""
    if entry and store.read(entry).where(F.col("run_id") == run_id).limit(1).count():
        return store.write(name, store.read(entry).where(F.col("run_id") != run_id).unionByName(rows))
    return store.append(name, entry, rows)


def resolve(store: Store, customers: DataFrame, advances: DataFrame, manual: DataFrame, at: datetime, run_id: int | None = None, variant: I.Variant = I.SHIPPED) -> Version:
    """Resolves from scratch and publishes: the map is replaced, review queue and run history keep earlier runs.

    Everything is written beside what is current and read again for the guards; if one is violated, nothing is published.
    `at` is the run's only clock.
    """
    old = store.current()
    if run_id is None:
        before = store.table(old, "identity_run")
        run_id = 1 + ((before.agg(F.max("run_id")).first()[0] or 0) if before is not None else 0)
    screening = I.screen(customers, advances, variant)
    members = I.written(I.grouped(screening, manual, variant))
    entries = dict(old.tables)
    entries["customer_map"] = store.write("customer_map", map_rows(screening, members, run_id, at))
    resolved = store.read(entries["customer_map"])
    n = customers.count()
    broken = [f"{r.guard} ({r.violations})" for r in I.publish_guards(resolved, n).where("violations > 0").collect()]
    if broken:
        raise PublishRefused(f"the map is not published: {', '.join(broken)}")
    entries["merge_review"] = _history(store, "merge_review", old.tables.get("merge_review"), review_rows(screening, members, run_id, at), run_id)
    refused = refused_edges(screening, manual)
    entries["manual_refused"] = store.write("manual_refused", refused.withColumn("run_id", F.lit(run_id).cast("long")))
    kinds = resolved.agg(
        F.count("*").alias("customers_in"), F.count_if(F.col("resolution") == "excluded_test").alias("excluded_test"), F.count_if((F.col("resolution") == "merged") & F.col("is_canonical")).alias("groups_formed"),
        F.count_if((F.col("resolution") == "merged") & ~F.col("is_canonical")).alias("rows_merged"), F.count_if("is_canonical").alias("canonical_out"),
    )
    reviews = store.read(entries["merge_review"]).where(F.col("run_id") == run_id).agg(F.count("*").alias("review_rows"))
    refusals = store.read(entries["manual_refused"]).select("customer_id_a", "customer_id_b").distinct().agg(F.count("*").alias("manual_decisions_refused"))
    bad = I.bad_contacts(screening.population.join(resolved.where("is_canonical").select("customer_id"), "customer_id", "left_semi")).agg(F.count("*").alias("canonical_with_bad_contact"))
    one = kinds.crossJoin(reviews).crossJoin(refusals).crossJoin(bad)  # a row each
    one = one.withColumn("manual_decisions_applied", F.lit(manual.count()) - F.col("manual_decisions_refused")).withColumn("run_id", F.lit(run_id)).withColumn("resolved_at", F.lit(at).cast("timestamp_ntz"))
    entries["identity_run"] = _history(store, "identity_run", old.tables.get("identity_run"), _as(one, IDENTITY_RUN).coalesce(1), run_id)
    return store.commit(old, tables=entries)

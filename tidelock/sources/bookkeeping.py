"""Tables that the engine keeps about its own runs and decisions, and their schemas."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from .versions import Store, Version

LOAD_RUN = (
    "run_id long, table_name string, read_mode string, rows_read long, rows_inserted long, rows_updated long, rows_deleted long, payload_bytes long, "
    "watermark_before long, watermark_after long, wall_ms long, notes string, buckets_rewritten long, buckets long"
)
CUSTOMER_MAP = (
    "customer_id long, canonical_customer_id long, is_canonical boolean, resolution string, rule string, group_key string, survivor_reason string, "
    "evidence string, run_id long, resolved_at timestamp_ntz"
)
MERGE_REVIEW = "review_id long, run_id long, group_key string, customer_ids string, reason string, evidence string, created_at timestamp_ntz"
MANUAL_MERGE = "customer_id_a long, customer_id_b long, decided_by string, decided_at timestamp_ntz, note string"
IDENTITY_RUN = (
    "run_id long, customers_in long, excluded_test long, groups_formed long, rows_merged long, canonical_out long, review_rows long, "
    "manual_decisions_applied long, manual_decisions_refused long, canonical_with_bad_contact long, resolved_at timestamp_ntz"
)
SCHEMAS = {"_load_run": LOAD_RUN, "customer_map": CUSTOMER_MAP, "merge_review": MERGE_REVIEW, "manual_merge": MANUAL_MERGE, "identity_run": IDENTITY_RUN}


def create_schema(store: Store) -> Version:
    """A version in which every bookkeeping table exists, if only empty; nothing that is there changes."""
    old = store.current()
    missing = {n: store.write(n, store.spark.createDataFrame([], s)) for n, s in SCHEMAS.items() if n not in old.tables}
    return store.commit(old, tables={**old.tables, **missing}) if missing else old


def decide(store: Store, customer_id_a: int, customer_id_b: int, decided_by: str, decided_at: datetime, note: str | None = None) -> Version:
    """Records that two customers are one person; a later decision on the same two takes the place of an earlier one."""
    old = store.current()
    a, b = sorted((customer_id_a, customer_id_b))
    row = store.spark.createDataFrame([(a, b, decided_by, decided_at, note)], MANUAL_MERGE)
    rows = row if "manual_merge" not in old.tables else row.unionByName(store.read(old.tables["manual_merge"]).join(row, ["customer_id_a", "customer_id_b"], "left_anti"))
    return store.commit(old, tables={**old.tables, "manual_merge": store.write("manual_merge", rows.coalesce(1))})


def decisions(store: Store) -> DataFrame:
    """All recorded decisions."""
    found = store.table(store.current(), "manual_merge")
    return store.spark.createDataFrame([], MANUAL_MERGE) if found is None else found


def require(version: Version, *names: str) -> None:
    """The tables that a command needs; one error names all that are missing."""
    if missing := sorted(set(names) - set(version.tables)):
        raise LookupError(f"the mirror has no {', '.join(missing)}; load and resolve make them")

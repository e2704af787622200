"""Sources, sinks and incremental runs as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import apply as P
from ..operators import churn as H
from ..operators.graph import folder
from ..sources.capture import Snapshot, change_feed, lost_to_time_mark, seen_by_time_mark
from ..sources.manifest import MANIFEST, Manifest
from ..sources.versions import Store
from ..streaming.microbatch import late_rows, mirror_stream
from .registry import Catalogue, Inputs

ORDERS, EVENTS = MANIFEST["orders"], MANIFEST["events"]
KEY = ["o_orderkey"]


def _snapshot(t: Inputs, version: int = 3, changes: dict | None = None, since: dict | None = None) -> Snapshot:
    return Snapshot(t.spark, version, "driver|synthetic|42", {"orders": t.orders, "events": t.events, "customer": t.customer}, changes or {}, since or {})


def _store(t: Inputs) -> Store:
    """A new mirror in the shared folder."""
    return Store(t.spark, folder(t.spark, "mirror"))


def _change_log(t: Inputs):
    """The feed as a log of five versions."""
    return t.feed_orders.select((F.col("o_orderkey") % 5 + 10).alias("version"), "_op", "o_orderkey")


def _log(store: Store):
    return store.table(store.current(), "_load_run")


def register(q: Catalogue) -> None:
    @q.add("src_high_water_window", "SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_id > 500 AND event_id <= (SELECT max(event_id) FROM events)")
    def _(t: Inputs):
        s = _snapshot(t)
        return s.window(EVENTS, 500, s.ceiling(EVENTS))

    @q.add("src_high_water_empty", "SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE false")
    def _(t: Inputs):
        s = _snapshot(t)
        return s.window(EVENTS, s.ceiling(EVENTS), s.ceiling(EVENTS))

    columns = "o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
    nulled = ", ".join(f"CASE WHEN f._op <> 'D' THEN o.{c} END AS {c}" for c in columns.split(", "))

    @q.add("src_change_feed", f"SELECT f._op, f.o_orderkey, {nulled} FROM @feed_orders f LEFT JOIN orders o ON f.o_orderkey = o.o_orderkey")
    def _(t: Inputs):
        return change_feed(t.feed_orders.select("_op", "o_orderkey"), t.orders, ORDERS)

    merged = f"SELECT o_orderkey, {columns} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM @feed_orders) UNION ALL SELECT o_orderkey, {columns} FROM @feed_orders WHERE _op <> 'D'"

    @q.add("snk_merge_upsert", merged)
    def _(t: Inputs):
        return P.merge(ORDERS.project(t.orders), t.feed_orders, KEY)

    @q.add("snk_merge_counts", "SELECT count(*) FILTER (_op <> 'D' AND o.o_orderkey IS NULL) AS inserted, count(*) FILTER (_op <> 'D' AND o.o_orderkey IS NOT NULL) AS updated, count(*) FILTER (_op = 'D' AND o.o_orderkey IS NOT NULL) AS deleted FROM @feed_orders f LEFT JOIN orders o ON f.o_orderkey = o.o_orderkey")
    def _(t: Inputs):
        return P.merge_counts(t.orders, t.feed_orders, KEY)

    @q.add("snk_keyed_delete", "SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM @feed_orders f WHERE f.o_orderkey = o.o_orderkey AND f._op = 'D')")
    def _(t: Inputs):
        return P.merge(t.orders.select("o_orderkey", "o_custkey"), t.feed_orders.where("_op = 'D'").select("_op", "o_orderkey", "o_custkey"), KEY)

    @q.add("snk_append_watermark", "SELECT count(*) AS n_rows, max(event_id) AS watermark, 2::BIGINT AS parts FROM events")
    def _(t: Inputs):
        # the source as it was at half of its ids, and as it is
        store, only = _store(t), Manifest((EVENTS,))
        half = t.events.agg(F.max("event_id")).first()[0] // 2
        for events in (t.events.where(F.col("event_id") <= half), t.events):
            now, _ = P.load(Snapshot(t.spark, 1, "half", {"events": events}), store, only)
        return store.table(now, "events").agg(F.count("*").alias("n_rows"), F.lit(now.watermarks["events"]).cast("long").alias("watermark"), F.lit(len(now.tables["events"]["parts"])).cast("long").alias("parts"))

    @q.add("snk_replace_map_keep_history", "SELECT 2 AS run_id, customer_id, person_id AS canonical FROM @id_truth UNION ALL SELECT 1, customer_id, customer_id FROM @id_truth")
    def _(t: Inputs):
        kept = t.id_truth.select(F.lit(1).alias("run_id"), "customer_id", F.col("customer_id").alias("canonical")).unionByName(t.id_truth.select(F.lit(2).alias("run_id"), "customer_id", F.lit(-1).alias("canonical")))
        # a rerun of run 2 replaces run 2 alone
        return kept.where("run_id <> 2").unionByName(t.id_truth.select(F.lit(2).alias("run_id"), "customer_id", F.col("person_id").alias("canonical")))

    first_run = "SELECT 'customer' AS table_name, 'full_snapshot' AS read_mode, count(*) AS rows_read, 3::BIGINT AS watermark_after FROM customer UNION ALL SELECT 'orders', 'full_snapshot', count(*), 3 FROM orders UNION ALL SELECT 'events', 'high_water', count(*), max(event_id) FROM events"

    @q.add("snk_run_log", first_run)
    def _(t: Inputs):
        store = _store(t)
        P.load(_snapshot(t), store, MANIFEST)
        return _log(store).select("table_name", "read_mode", "rows_read", "watermark_after")

    @q.add("snk_run_totals", f"SELECT coalesce(table_name, 'TOTAL') AS table_name, CAST(sum(rows_read) AS BIGINT) AS rows_read, count(*) AS entries FROM ({first_run}) x GROUP BY ROLLUP (table_name)")
    def _(t: Inputs):
        store = _store(t)
        P.load(_snapshot(t), store, MANIFEST)
        return P.run_totals(_log(store))

    @q.add("snk_reset", f"SELECT o_orderkey, {columns} FROM orders")
    def _(t: Inputs):
        store = _store(t)
        P.load(_snapshot(t), store, MANIFEST)
        gone = P.reset(store, "orders")
        if "orders" in gone.tables or "orders" in gone.watermarks:
            raise ValueError("a reset left something of its table")
        now, _ = P.load(_snapshot(t), store, MANIFEST)
        return store.table(now, "orders")

    rewritten = """SELECT o.o_orderkey, CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus FROM orders o LEFT JOIN (SELECT * FROM @feed_orders WHERE _op = 'U') u ON o.o_orderkey = u.o_orderkey
        WHERE o.o_orderkey NOT IN (SELECT o_orderkey FROM @feed_orders WHERE _op = 'D') UNION ALL SELECT o_orderkey, o_orderstatus FROM @feed_orders WHERE _op = 'I' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders)"""

    @q.add("snk_source_rewrite", rewritten)
    def _(t: Inputs):
        rows = t.orders.select("o_orderkey", "o_orderstatus")
        rows = P.update_from(rows, t.feed_orders.where("_op = 'U'").select("o_orderkey", "o_orderstatus"), KEY)
        rows = rows.join(t.feed_orders.where("_op = 'D'").select("o_orderkey"), "o_orderkey", "left_anti")
        return P.insert_from(rows, t.feed_orders.where("_op = 'I'"), KEY)

    @q.add(
        "snk_constraint_audit",
        """SELECT 'primary_key' AS rule, count(*) AS violations FROM (SELECT o_orderkey FROM @orphaned_orders GROUP BY 1 HAVING count(*) > 1) x
        UNION ALL SELECT 'not_null_o_custkey', count(*) FILTER (o_custkey IS NULL) FROM @orphaned_orders UNION ALL SELECT 'check_o_orderkey', count(*) FILTER (o_orderkey NOT IN (1, 2, 3)) FROM @orphaned_orders
        UNION ALL SELECT 'foreign_key_o_custkey', count(*) FROM @orphaned_orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)""",
    )
    def _(t: Inputs):
        return P.violations(t.orphaned_orders, KEY, ["o_custkey"], {"o_orderkey": [1, 2, 3]}, {"o_custkey": (t.customer, "c_custkey")})

    known = "SELECT f._op, f.o_orderkey FROM @feed_orders f JOIN orders o ON f.o_orderkey = o.o_orderkey"
    second = f"""WITH known AS ({known}), runs AS (SELECT 1::BIGINT AS run_id, table_name, read_mode, rows_read, rows_read AS rows_inserted, 0::BIGINT AS rows_updated, 0::BIGINT AS rows_deleted FROM ({first_run}) x
        UNION ALL SELECT 2, 'customer', 'change_feed', 0, 0, 0, 0 UNION ALL SELECT 2, 'events', 'high_water', 0, 0, 0, 0
        UNION ALL SELECT 2, 'orders', 'change_feed', count(*), 0, count(*) FILTER (_op <> 'D'), count(*) FILTER (_op = 'D') FROM known) SELECT * FROM runs"""

    @q.add("ir_modes", second)
    def _(t: Inputs):
        store = _store(t)
        P.load(_snapshot(t), store, MANIFEST)
        changes = t.feed_orders.join(t.orders.select("o_orderkey"), "o_orderkey", "left_semi").select(F.lit(4).cast("long").alias("version"), "_op", "o_orderkey")
        P.load(_snapshot(t, 4, {"orders": changes}, {"customer": 3}), store, MANIFEST)
        return _log(store).select("run_id", "table_name", "read_mode", "rows_read", "rows_inserted", "rows_updated", "rows_deleted")

    log = "SELECT o_orderkey % 5 + 10 AS version, _op, o_orderkey FROM @feed_orders"

    @q.add("ir_guard_expired", f"WITH log AS ({log}) SELECT mark, mark < (SELECT min(version) - 1 FROM log) AS expired FROM (VALUES (3::BIGINT), (9), (12)) v(mark)")
    def _(t: Inputs):
        s = _snapshot(t, 14, {"orders": _change_log(t)})
        return t.spark.createDataFrame([(3,), (9,), (12,)], "mark long").withColumn("expired", F.col("mark") < s.oldest_answerable("orders"))

    @q.add("ir_replay_zero", "SELECT * FROM (VALUES ('customer', 0::BIGINT, 0::BIGINT), ('orders', 0, 0), ('events', 0, 0)) v(table_name, rows_read, payload_bytes)")
    def _(t: Inputs):
        store = _store(t)
        for _ in range(2):
            P.load(_snapshot(t), store, MANIFEST)
        return _log(store).where("run_id = 2").select("table_name", "rows_read", "payload_bytes")

    @q.add("ir_identity_gap", "SELECT event_id, user_id FROM events WHERE event_id % 1000 = 700")
    def _(t: Inputs):
        # writers who have taken their ids and commit after the first run
        rows = t.events.withColumn("visible_at", F.when(F.col("event_id") % 1000 == 700, 2).otherwise(1))
        return H.watermark_race(rows, EVENTS, "visible_at", _store(t)).select("event_id", "user_id")

    @q.add("ir_snapshot_metadata", f"WITH log AS ({log}) SELECT 'driver|synthetic|42' AS fingerprint, 14::BIGINT AS version, min(version) - 1 AS oldest_answerable, (SELECT max(event_id) FROM events) AS ceiling FROM log")
    def _(t: Inputs):
        s = _snapshot(t, 14, {"orders": _change_log(t)})
        return t.spark.createDataFrame([(s.fingerprint, s.version, s.oldest_answerable("orders"), s.ceiling(EVENTS))], "fingerprint string, version long, oldest_answerable long, ceiling long")

    @q.add("ir_capture_start", f"WITH log AS ({log}) SELECT _op, count(*) AS n, count(o.o_custkey) FILTER (_op <> 'D') AS with_values FROM log LEFT JOIN orders o ON log.o_orderkey = o.o_orderkey WHERE version > 11 GROUP BY _op")
    def _(t: Inputs):
        found = _snapshot(t, 14, {"orders": _change_log(t)}).net_changes(ORDERS, 11)
        return found.groupBy("_op").agg(F.count("*").alias("n"), F.count("o_custkey").alias("with_values"))

    @q.add("ir_churn_day", "SELECT * FROM (VALUES ('customer', true, 0::BIGINT), ('orders', true, 0), ('events', true, 0)) v(table_name, changed, rows_that_differ)")
    def _(t: Inputs):
        # seed, load, a day of churn, load: the mirror is the source again, and the second run read less than all
        source, mirror = Store(t.spark, folder(t.spark, "source")), _store(t)
        H.seed(source, {s.name: getattr(t, s.name) for s in MANIFEST.tables}, MANIFEST)
        P.load(Snapshot.of(source), mirror, MANIFEST)
        H.churn(source, MANIFEST)
        now, stats = P.load(Snapshot.of(source), mirror, MANIFEST)
        out = None
        for s, spec in zip(stats, MANIFEST.tables, strict=True):
            there, here = source.table(source.current(), spec.name).select(*spec.columns), mirror.table(now, spec.name)
            differ = there.exceptAll(here).unionByName(here.exceptAll(there)).agg(F.count("*").alias("rows_that_differ"))
            one = differ.select(F.lit(spec.name).alias("table_name"), F.lit(0 < s.rows_read < here.count()).alias("changed"), "rows_that_differ")
            out = one if out is None else out.unionByName(one)
        return out

    @q.add("ir_updated_mark", """SELECT count(*) AS changed, count(*) FILTER (l.updated_at > (SELECT max(updated_at) FROM @id_customers)) AS seen FROM @id_customers_later l JOIN @id_customers c ON l.customer_id = c.customer_id
        WHERE l.email IS DISTINCT FROM c.email OR l.phone IS DISTINCT FROM c.phone""")
    def _(t: Inputs):
        columns = ["customer_id", "email", "phone", "updated_at"]
        return seen_by_time_mark(t.id_customers.select(*columns), t.id_customers_later.select(*columns), "customer_id", "updated_at")

    @q.add("ir_time_mark_loss", "SELECT event_id, posted_at FROM @events_backdated WHERE event_id > 600 AND posted_at <= (SELECT max(posted_at) FROM @events_backdated WHERE event_id <= 600)")
    def _(t: Inputs):
        return lost_to_time_mark(t.events_backdated, "event_id", "posted_at", 600).select("event_id", "posted_at")

    @q.add("st_microbatch_upsert", "SELECT user_id, event_id, event_type FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) x WHERE rn = 1")
    def _(t: Inputs):
        feed, store = folder(t.spark, "feed"), _store(t)
        t.events.repartitionByRange(3, "event_id").write.parquet(feed)
        mirror_stream(t.spark, feed, t.events.schema, store, "latest", "user_id", "event_id", folder(t.spark, "stream")).awaitTermination()
        return store.table(store.current(), "latest").select("user_id", "event_id", "event_type")

    @q.add("st_watermark_late", "SELECT event_id, posted_at FROM (SELECT event_id, posted_at, max(posted_at) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM @events_backdated) x WHERE posted_at < seen - INTERVAL '10' DAY")
    def _(t: Inputs):
        return late_rows(t.events_backdated, "event_id", "posted_at", "INTERVAL '10' DAY").select("event_id", "posted_at")

    @q.add("st_tumbling_counts", "SELECT time_bucket(INTERVAL '1 day', ts) AS day, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2")
    def _(t: Inputs):
        return t.events.groupBy(F.window("ts", "1 day")["start"].alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))

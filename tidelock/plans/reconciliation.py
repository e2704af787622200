"""Two-sided checks as queries: a source table against its damaged mirror."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import checks as C
from ..operators import scenario as S
from .registry import Catalogue, Inputs

KEYED = {"orders": "o_orderkey", "events": "event_id", "customer": "c_custkey"}


def _duck_key_parity(name: str, key: str) -> str:
    return f"""SELECT kind, count(*) AS n, CAST(sum(k) AS VARCHAR) AS key_sum, min(k) AS key_min, max(k) AS key_max FROM (
        SELECT coalesce(s.{key}, m.{key}) AS k, CASE WHEN m.{key} IS NULL THEN 'missing' WHEN s.{key} IS NULL THEN 'extra' ELSE 'matched' END AS kind FROM {name} s FULL JOIN @mirror_{name} m ON s.{key} = m.{key}) x GROUP BY kind"""


def _duck_value_parity(name: str) -> str:
    s, m = A.type_directed_sql(name), A.type_directed_sql(name).replace(f"FROM {name}", f"FROM @mirror_{name}")
    return f"SELECT s.column_name, s.label, s.value AS source_value, m.value AS mirror_value, CASE WHEN s.value IS NOT DISTINCT FROM m.value THEN 'PASS' ELSE 'FAIL' END AS verdict FROM ({s}) s JOIN ({m}) m ON s.column_name = m.column_name AND s.label = m.label"


def register(q: Catalogue) -> None:
    for name, key in KEYED.items():

        @q.add(f"rc_key_parity_{name}", _duck_key_parity(name, key))
        def _(t: Inputs, name=name, key=key):
            return C.key_parity(getattr(t, name), getattr(t, f"mirror_{name}"), key)

        @q.add(f"rc_value_parity_{name}", _duck_value_parity(name))
        def _(t: Inputs, name=name):
            return C.value_parity(getattr(t, name), getattr(t, f"mirror_{name}"))

    frozen = "SELECT CAST(count(*) AS VARCHAR) AS n_rows, CAST(sum(event_id) AS VARCHAR) AS sum_event_id, CAST(sum(user_id) AS VARCHAR) AS sum_user_id FROM {0} WHERE event_id <= 5000"
    measures = "SELECT 'n_rows' AS measure, s.n_rows AS source_value, m.n_rows AS mirror_value FROM s, m UNION ALL SELECT 'sum_event_id', s.sum_event_id, m.sum_event_id FROM s, m UNION ALL SELECT 'sum_user_id', s.sum_user_id, m.sum_user_id FROM s, m"

    @q.add("rc_append_only", f"WITH s AS ({frozen.format('events')}), m AS ({frozen.format('@mirror_events')}) SELECT *, CASE WHEN source_value IS NOT DISTINCT FROM mirror_value THEN 'PASS' ELSE 'FAIL' END AS verdict FROM ({measures}) x")
    def _(t: Inputs):
        return C.append_only(t.events, t.mirror_events, "event_id", 5000, ["event_id", "user_id"])

    density = "SELECT count(*) AS n_rows, min(event_id) AS lo, max(event_id) AS hi, max(event_id) - min(event_id) + 1 - count(*) AS gaps FROM {0} WHERE event_id > {1} AND event_id <= {2}"
    verdict = "CASE WHEN s.n_rows <> m.n_rows OR s.lo IS DISTINCT FROM m.lo OR s.hi IS DISTINCT FROM m.hi THEN 'FAIL' WHEN s.n_rows = 0 THEN 'PASS' WHEN s.gaps < 0 THEN 'FAIL' WHEN s.gaps > 0 THEN 'SOURCE-DIRTY' ELSE 'PASS' END"
    windows = {"dense": ("events", "events", 100, 800), "differs": ("events", "@mirror_events", 0, 2000), "dirty": ("@mirror_events", "@mirror_events", 0, 2000), "empty": ("events", "events", 90000000, 90000005)}

    @q.add("rc_contiguity", " UNION ALL ".join(f"SELECT '{w}' AS window_name, s.n_rows, s.gaps, m.n_rows AS mirror_rows, {verdict} AS verdict FROM ({density.format(a, lo, hi)}) s, ({density.format(b, lo, hi)}) m" for w, (a, b, lo, hi) in windows.items()))
    def _(t: Inputs):
        out = None
        for w, (a, b, lo, hi) in windows.items():
            one = C.contiguity(getattr(t, a.lstrip("@")), getattr(t, b.lstrip("@")), "event_id", lo, hi).select(F.lit(w).alias("window_name"), "*")
            out = one if out is None else out.unionByName(one)
        return out

    orphan = "SELECT DISTINCT o_custkey AS k FROM @orphaned_orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM {0})"
    referential = f"""SELECT side, count(*) AS n_keys, CASE side WHEN 'mirror_only' THEN 'FAIL' ELSE 'SOURCE-DIRTY' END AS verdict FROM (
        SELECT CASE WHEN s.k IS NULL THEN 'mirror_only' WHEN m.k IS NULL THEN 'source_only' ELSE 'both' END AS side FROM ({orphan.format('customer')}) s FULL JOIN ({orphan.format('@mirror_customer')}) m ON s.k = m.k) x GROUP BY side"""

    @q.add("rc_referential", referential)
    def _(t: Inputs):
        child = t.orphaned_orders
        return C.referential(child, child, "o_custkey", t.customer, t.mirror_customer, "c_custkey")

    @q.add("jn_orphans_both_sides", f"SELECT k, CASE WHEN in_source AND in_mirror THEN 'both' WHEN in_mirror THEN 'mirror_only' ELSE 'source_only' END AS side FROM (SELECT coalesce(s.k, m.k) AS k, s.k IS NOT NULL AS in_source, m.k IS NOT NULL AS in_mirror FROM ({orphan.format('customer')}) s FULL JOIN ({orphan.format('@mirror_customer')}) m ON s.k = m.k) x")
    def _(t: Inputs):
        child = t.orphaned_orders
        s, m = C.orphans(child, "o_custkey", t.customer, "c_custkey"), C.orphans(child, "o_custkey", t.mirror_customer, "c_custkey")
        both = s.intersect(m).withColumn("side", F.lit("both"))
        return both.unionByName(s.subtract(m).withColumn("side", F.lit("source_only"))).unionByName(m.subtract(s).withColumn("side", F.lit("mirror_only")))

    # what run_scorecard asks, check by check
    parts = [f"SELECT 'key_parity_{n}' AS check_name, CASE WHEN count(*) FILTER (kind <> 'matched') > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM ({_duck_key_parity(n, k)}) x" for n, k in KEYED.items()]
    parts += [f"SELECT 'value_parity_{n}', CASE WHEN count(*) FILTER (verdict = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END FROM ({_duck_value_parity(n)}) x" for n in KEYED]
    old = "SELECT count(*) AS n, sum(event_id) AS total, min(event_id) AS lo, max(event_id) AS hi, max(event_id) - min(event_id) + 1 - count(*) AS gaps, count(*) AS n_rows FROM {0} WHERE event_id <= (SELECT max(event_id) FROM events)"
    parts += [f"SELECT 'append_only_events', CASE WHEN s.n <> m.n OR s.total <> m.total THEN 'FAIL' ELSE 'PASS' END FROM ({old.format('events')}) s, ({old.format('@mirror_events')}) m"]
    parts += [f"SELECT 'contiguity_events', {verdict} FROM ({old.format('events')}) s, ({old.format('@mirror_events')}) m"]
    parts += [f"SELECT 'referential_child_o_custkey', CASE WHEN count(*) FILTER (verdict = 'FAIL') > 0 THEN 'FAIL' WHEN count(*) > 0 THEN 'SOURCE-DIRTY' ELSE 'PASS' END FROM ({referential}) y"]

    @q.add("rc_scorecard", " UNION ALL ".join(parts))
    def _(t: Inputs):
        source = {n: getattr(t, n) for n in KEYED} | {"child": t.orphaned_orders}
        mirror = {n: getattr(t, f"mirror_{n}") for n in KEYED} | {"child": t.orphaned_orders}
        marks = {"events": t.events.agg(F.max("event_id")).first()[0]}
        card = C.run_scorecard(source, mirror, KEYED, marks, [("child", "o_custkey", "customer", "c_custkey")])
        return t.spark.createDataFrame([x[:2] for x in card.outcomes], "check_name string, verdict string")

    drifted = "SELECT sum(user_id) AS was, sum(user_id) + " + str(sum(S.REWRITES)) + " AS became FROM events"

    @q.add("rc_break_checks", f"SELECT 'key_parity_events' AS check_name, 'PASS' AS verdict UNION ALL SELECT 'value_parity_events', CASE WHEN was <> became THEN 'FAIL' ELSE 'PASS' END FROM ({drifted}) UNION ALL SELECT 'append_only_events', 'PASS' UNION ALL SELECT 'contiguity_events', 'PASS'")
    def _(t: Inputs):
        # two old rows rewritten in the source: no run reads them, and only the sums of values tell
        mark = t.events.agg(F.max("event_id")).first()[0]
        picked = [r[0] for r in S.pick_rows(t.events, "event_id", "user_id", mark).collect()]
        changed = S.rewrite(t.events, "event_id", "user_id", dict(zip(picked, S.REWRITES, strict=True)))
        card = C.run_scorecard({"events": changed}, {"events": t.events}, {"events": "event_id"}, {"events": mark}, [])
        return t.spark.createDataFrame([x[:2] for x in card.outcomes], "check_name string, verdict string")

    cents = "CAST(sum(CAST(round({0} * 100) AS BIGINT)) AS BIGINT)"
    changed = "CASE o_orderkey WHEN 1 THEN o_totalprice + 500.0 WHEN 2 THEN o_totalprice - 123.45 ELSE o_totalprice END"

    @q.add("rc_break_rewrite", f"SELECT count(*) AS n_rows, {cents.format('o_totalprice')} AS source_cents, {cents.format(changed)} AS changed_cents, {cents.format(changed)} - {cents.format('o_totalprice')} AS drift_cents FROM orders")
    def _(t: Inputs):
        before = t.orders
        after = S.rewrite(before, "o_orderkey", "o_totalprice", {1: 500.0, 2: -123.45})
        total = F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))
        one = before.agg(F.count("*").alias("n_rows"), total.alias("source_cents")).crossJoin(after.agg(total.alias("changed_cents")))  # a row each
        return one.withColumn("drift_cents", F.col("changed_cents") - F.col("source_cents"))

    @q.add("rc_break_swap", f"SELECT count(*) AS n_rows, {cents.format('s.o_totalprice')} AS source_cents, (SELECT {cents.format('o_totalprice')} FROM @swapped_orders) AS swapped_cents, (SELECT count(*) FROM orders a JOIN @swapped_orders b ON a.o_orderkey = b.o_orderkey WHERE a.o_totalprice <> b.o_totalprice) AS rows_that_differ FROM orders s")
    def _(t: Inputs):
        before, after = t.orders, S.swap(t.orders, "o_orderkey", "o_totalprice", 1, 2)
        total = F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))
        one = before.agg(F.count("*").alias("n_rows"), total.alias("source_cents")).crossJoin(after.agg(total.alias("swapped_cents")))
        return one.crossJoin(C.value_diff(before, after, "o_orderkey", "o_totalprice").agg(F.count("*").alias("rows_that_differ")))

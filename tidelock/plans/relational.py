"""Scans, projections, filters, joins, aggregates, windows, sorts, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions.scalars import canonical_scalar, hash_order, ratio
from ..operators import aggregates as A
from ..operators.asof import next_key
from ..operators.identity import group_pairs
from ..sources.manifest import MANIFEST
from .registry import Catalogue, Inputs

CENTS = "cast(round({0} * 100) as bigint)"


def register(q: Catalogue) -> None:
    _scans(q), _filters(q), _joins(q), _aggregates(q), _windows(q), _sets(q), _functions(q)


def _scans(q: Catalogue) -> None:
    @q.add("src_project_allowlist", "SELECT c_custkey, c_name, c_nationkey FROM customer")
    def _(t: Inputs):
        return t.customer.select("c_custkey", "c_name", "c_nationkey")

    @q.add("src_range_numbers", "SELECT n, row_number() OVER (ORDER BY n DESC) AS back FROM range(1, 1001) r(n)")
    def _(t: Inputs):
        # a generator of fixed size, so one partition is enough
        return t.spark.range(1, 1001).select(F.col("id").alias("n")).withColumn("back", F.row_number().over(Window.orderBy(F.desc("n"))).cast("long"))

    @q.add("src_unmanaged_tables", f"SELECT name FROM (VALUES {', '.join(f'({x!r})' for x in ('customer', 'orders', 'events', 'part', 'supplier', 'labels'))}) v(name) WHERE name NOT IN ({', '.join(repr(x) for x in (*MANIFEST.names, *MANIFEST.excluded))})")
    def _(t: Inputs):
        found = MANIFEST.unmanaged(["customer", "orders", "events", "part", "supplier", "labels"])
        return t.spark.createDataFrame([(x,) for x in found], "name string")

    nulls = " UNION ALL ".join(f"SELECT '{tab}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS nulls FROM @{tab}" for tab, c in (("labels", "quality"), ("labels", "toxic"), ("documents", "text"), ("documents", "lang"), ("id_customers", "email"), ("id_customers", "ssn_last4"), ("id_customers", "updated_at")))

    @q.add("src_null_evidence", nulls)
    def _(t: Inputs):
        return A.null_evidence(t.labels, "labels", ["quality", "toxic"]).unionByName(A.null_evidence(t.documents, "documents", ["text", "lang"])).unionByName(A.null_evidence(t.id_customers, "id_customers", ["email", "ssn_last4", "updated_at"]))

    @q.add("prj_case_columns", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'partial' END AS status_text, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END * CAST(round(o_totalprice * 100) AS BIGINT) AS signed_cents FROM orders")
    def _(t: Inputs):
        status = F.when(F.col("o_orderstatus") == "F", "final").when(F.col("o_orderstatus") == "O", "open").otherwise("partial")
        return t.orders.select("o_orderkey", status.alias("status_text"), (F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(1) * F.round(F.col("o_totalprice") * 100).cast("long")).alias("signed_cents"))

    @q.add("prj_cte_chain", "WITH gap AS (SELECT o_custkey, max(o_orderkey) - min(o_orderkey) AS span FROM orders GROUP BY o_custkey), picked AS (SELECT o_custkey, span, span % 7 AS pick FROM gap WHERE span > 0) SELECT o_custkey, span, pick FROM picked WHERE pick < 3")
    def _(t: Inputs):
        gap = t.orders.groupBy("o_custkey").agg((F.max("o_orderkey") - F.min("o_orderkey")).alias("span"))
        return gap.where("span > 0").withColumn("pick", F.col("span") % 7).where("pick < 3")


def _filters(q: Catalogue) -> None:
    @q.add("flt_frozen_segment", "SELECT event_id, event_type FROM events WHERE event_id <= 800 AND event_type LIKE 'p%' AND user_id NOT BETWEEN 10 AND 20 AND props IS NOT NULL AND event_id NOT IN (3, 5)")
    def _(t: Inputs):
        return t.events.where((F.col("event_id") <= 800) & F.col("event_type").startswith("p") & ~F.col("user_id").between(10, 20) & F.col("props").isNotNull() & ~F.col("event_id").isin(3, 5)).select("event_id", "event_type")

    @q.add(
        "flt_naive_vs_anchored",
        """SELECT customer_id, coalesce(contains(lower(concat_ws(' ', first_name, last_name, email)), 'test'), false) AS naive,
            regexp_matches(split_part(lower(trim(coalesce(email, ''))), '@', 1), '^(test|qa|demo|dev|staging|automation)[._-]?[0-9]*$') AS anchored FROM @id_customers""",
    )
    def _(t: Inputs):
        from ..operators.identity import AUTOMATION_LOCAL, naive_detector

        local, _ = N.raw_email_parts(F.col("email"))
        return t.id_customers.select("customer_id", naive_detector().alias("naive"), local.rlike(AUTOMATION_LOCAL).alias("anchored"))

    @q.add("flt_artifact_literals", "SELECT advance_id, principal_amount FROM @id_advances WHERE principal_amount IN (0.0, 999999.99)")
    def _(t: Inputs):
        return t.id_advances.where(F.col("principal_amount").isin(0.0, 999999.99)).select("advance_id", "principal_amount")

    @q.add("flt_feed_split", "SELECT o_orderkey, 'upsert' AS branch FROM @feed_orders WHERE _op IN ('I', 'U') UNION ALL SELECT o_orderkey, 'delete' FROM @feed_orders WHERE _op = 'D'")
    def _(t: Inputs):
        feed = t.feed_orders
        return feed.where(F.col("_op").isin("I", "U")).select("o_orderkey", F.lit("upsert").alias("branch")).unionByName(feed.where(F.col("_op") == "D").select("o_orderkey", F.lit("delete").alias("branch")))


def _joins(q: Catalogue) -> None:
    @q.add("jn_inner_equi", "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
    def _(t: Inputs):
        # nation has 25 rows by the schema's definition
        return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")

    @q.add("jn_semi_exists", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')")
    def _(t: Inputs):
        return t.customer.join(t.orders.where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")

    @q.add("jn_anti_not_exists", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')")
    def _(t: Inputs):
        return t.customer.join(t.orders.where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")

    @q.add("jn_anti_not_in", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM @mirror_orders)")
    def _(t: Inputs):
        return t.orders.join(t.mirror_orders, "o_orderkey", "left_anti").select("o_orderkey")

    @q.add("jn_semi_in_top", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20)")
    def _(t: Inputs):
        top = t.customer.orderBy(F.desc("c_acctbal"), "c_custkey").limit(20).select("c_custkey")
        return t.orders.join(F.broadcast(top), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")

    @q.add("jn_theta_expand", "SELECT c_custkey, n FROM customer JOIN range(1, 5) r(n) ON n <= c_custkey % 4 + 1")
    def _(t: Inputs):
        return t.customer.select("c_custkey", F.explode(F.sequence(F.lit(1).cast("long"), F.col("c_custkey") % 4 + 1)).alias("n"))

    @q.add("jn_cross_families", "SELECT r_name, n_name FROM region CROSS JOIN nation")
    def _(t: Inputs):
        # 5 x 25 rows, a fixed product
        return t.region.crossJoin(F.broadcast(t.nation)).select("r_name", "n_name")

    @q.add("jn_asof_forward", "SELECT event_id, user_id, (SELECT min(c_custkey) FROM @mirror_customer m WHERE m.c_custkey >= user_id) AS next_key FROM events")
    def _(t: Inputs):
        return next_key(t.events.select("event_id", "user_id"), "user_id", t.mirror_customer.select("c_custkey"), "c_custkey", "next_key")

    @q.add("jn_scalar_lookup", "SELECT o_orderkey, (SELECT n_name FROM nation WHERE n_nationkey = o_orderkey % 30) AS picked FROM orders")
    def _(t: Inputs):
        return t.orders.select("o_orderkey", (F.col("o_orderkey") % 30).alias("i")).join(F.broadcast(t.nation), F.col("i") == F.col("n_nationkey"), "left").select("o_orderkey", F.col("n_name").alias("picked"))

    @q.add(
        "jn_two_left_conditional",
        "SELECT c_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS final_orders, count(o_orderkey) AS n_orders, max(n_name) AS nation FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY c_custkey",
    )
    def _(t: Inputs):
        per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("final_orders"), F.count("*").alias("n_orders"))
        out = t.customer.join(per, "c_custkey", "left").join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey"), "left")
        return out.select("c_custkey", F.coalesce("final_orders", F.lit(0)).alias("final_orders"), F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.col("n_name").alias("nation"))

    @q.add("jn_key_full_compare", "SELECT coalesce(s.o_orderkey, m.o_orderkey) AS o_orderkey, CASE WHEN m.o_orderkey IS NULL THEN 'missing' ELSE 'extra' END AS kind FROM orders s FULL JOIN @mirror_orders m ON s.o_orderkey = m.o_orderkey WHERE s.o_orderkey IS NULL OR m.o_orderkey IS NULL")
    def _(t: Inputs):
        s, m = t.orders.select("o_orderkey", F.lit(1).alias("s")), t.mirror_orders.select("o_orderkey", F.lit(1).alias("m"))
        return s.join(m, "o_orderkey", "full_outer").where("s is null or m is null").select("o_orderkey", F.when(F.col("m").isNull(), "missing").otherwise("extra").alias("kind"))

    @q.add("jn_value_diff", "SELECT s.o_orderkey, s.o_totalprice AS source_value, m.o_totalprice AS mirror_value FROM orders s JOIN @mirror_orders m ON s.o_orderkey = m.o_orderkey WHERE s.o_totalprice IS DISTINCT FROM m.o_totalprice")
    def _(t: Inputs):
        from ..operators.checks import value_diff

        return value_diff(t.orders, t.mirror_orders, "o_orderkey", "o_totalprice")

    @q.add("jn_collect_index", "SELECT o_custkey, part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS keys, count(*) AS n FROM (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 1000 AS part FROM orders) x GROUP BY o_custkey, part")
    def _(t: Inputs):
        # lists of at most 1,000 keys, so that no customer's orders are one value
        ranked = t.orders.select("o_custkey", "o_orderkey", F.floor((F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1) / 1000).alias("part"))
        keys = F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string"))
        return ranked.groupBy("o_custkey", "part").agg(F.concat_ws(",", keys).alias("keys"), F.count("*").alias("n"))

    @q.add("jn_star_edges", "SELECT d.doc_id, g.least FROM documents d JOIN (SELECT md5(text) AS h, min(doc_id) AS least FROM documents GROUP BY 1 HAVING count(*) > 1) g ON md5(d.text) = g.h WHERE d.doc_id <> g.least")
    def _(t: Inputs):
        keyed = t.documents.select("doc_id", F.md5("text").alias("h"))
        stars = keyed.groupBy("h").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
        return keyed.join(stars, "h").where("doc_id <> least").select("doc_id", "least")

    @q.add("jn_group_pairs", "SELECT x.customer_id AS a, y.customer_id AS b FROM @id_truth x JOIN @id_truth y ON x.person_id = y.person_id AND x.customer_id < y.customer_id")
    def _(t: Inputs):
        return group_pairs(t.id_truth, "person_id", "customer_id")

    @q.add("jn_map_indirection", "SELECT c.card_id, m.person_id AS canonical FROM @id_cards c JOIN @id_truth m ON c.customer_id = m.customer_id")
    def _(t: Inputs):
        return t.id_cards.join(t.id_truth, "customer_id").select("card_id", F.col("person_id").alias("canonical"))


def _aggregates(q: Catalogue) -> None:
    keyed = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id", "supplier": "s_suppkey", "part": "p_partkey"}

    @q.add("agg_key_scalars", " UNION ALL ".join(f"SELECT '{x}' AS table_name, count(*) AS n_rows, CAST(sum({k}) AS VARCHAR) AS key_sum, min({k}) AS key_min, max({k}) AS key_max FROM {x}" for x, k in keyed.items()))
    def _(t: Inputs):
        parts = [A.key_scalars(getattr(t, x), k).select(F.lit(x).alias("table_name"), "*") for x, k in keyed.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    for name in ("orders", "events", "lineitem", "customer"):

        @q.add(f"agg_type_directed_{name}", A.type_directed_sql(name))
        def _(t: Inputs, name=name):
            return A.type_directed(getattr(t, name))

    @q.add("agg_frozen_sums", "SELECT count(*) AS n_rows, CAST(sum(event_id) AS VARCHAR) AS sum_event_id, CAST(sum(user_id) AS VARCHAR) AS sum_user_id FROM events WHERE event_id <= 700")
    def _(t: Inputs):
        return A.frozen_sums(t.events, "event_id", 700, ["event_id", "user_id"])

    @q.add("agg_window_density", "SELECT count(*) AS n_rows, min(event_id) AS lo, max(event_id) AS hi, max(event_id) - min(event_id) + 1 AS span, max(event_id) - min(event_id) + 1 - count(*) AS gaps FROM @mirror_events WHERE event_id > 200 AND event_id <= 5000")
    def _(t: Inputs):
        return A.window_density(t.mirror_events.where("event_id > 200 and event_id <= 5000"), "event_id")

    @q.add("agg_distinct_collated", "SELECT count(DISTINCT status) AS spellings, count(DISTINCT lower(rtrim(status))) AS collated, count(DISTINCT repayment_account_hash) AS instruments, count(DISTINCT lower(rtrim(repayment_account_hash))) AS instruments_collated FROM @id_advances")
    def _(t: Inputs):
        loose = lambda c: F.collate(F.col(c), "UTF8_LCASE_RTRIM")
        return t.id_advances.agg(F.countDistinct("status").alias("spellings"), F.countDistinct(loose("status")).alias("collated"), F.countDistinct("repayment_account_hash").alias("instruments"), F.countDistinct(loose("repayment_account_hash")).alias("instruments_collated"))

    @q.add("agg_status_spellings", "SELECT status, count(*) AS n, min(lower(trim(status))) AS folded FROM @id_advances GROUP BY status")
    def _(t: Inputs):
        return t.id_advances.groupBy("status").agg(F.count("*").alias("n"), F.min(F.lower(F.trim("status"))).alias("folded"))

    @q.add("agg_shared_instruments", "SELECT lower(card_fingerprint) AS fingerprint, count(DISTINCT customer_id) AS owners FROM @id_cards GROUP BY 1 HAVING count(DISTINCT customer_id) > 1")
    def _(t: Inputs):
        return t.id_cards.groupBy(F.lower("card_fingerprint").alias("fingerprint")).agg(F.countDistinct("customer_id").alias("owners")).where("owners > 1")

    @q.add("agg_default_invariant", "SELECT count(*) AS customers, CAST(sum(CASE WHEN n <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM (SELECT customer_id, sum(CASE WHEN is_default THEN 1 ELSE 0 END) AS n FROM @id_cards GROUP BY customer_id) x")
    def _(t: Inputs):
        return t.id_cards.groupBy("customer_id").agg(F.count_if("is_default").alias("n")).agg(F.count("*").alias("customers"), F.count_if(F.col("n") != 1).alias("violations"))

    size = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))), 0)"
    customer_bytes = f"CAST(sum(8 + {size.format('c_name')} + 8 + CASE WHEN c_acctbal IS NULL THEN 0 ELSE 8 END + {size.format('c_mktsegment')}) AS BIGINT)"
    event_bytes = f"CAST(sum(8 + {size.format('event_type')} + 8 + CASE WHEN value IS NULL THEN 0 ELSE 8 END + {size.format('props')}) AS BIGINT)"

    @q.add("agg_payload_bytes", f"SELECT table_name, CAST(sum(payload_bytes) AS BIGINT) AS payload_bytes FROM (SELECT 'customer' AS table_name, {customer_bytes} AS payload_bytes FROM customer UNION ALL SELECT 'events', {event_bytes} FROM events) x GROUP BY ROLLUP (table_name)")
    def _(t: Inputs):
        c = A.payload_bytes(t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")).withColumn("table_name", F.lit("customer"))
        e = A.payload_bytes(t.events.select("event_id", "user_id", "event_type", "value", "props")).withColumn("table_name", F.lit("events"))
        return c.unionByName(e).rollup("table_name").agg(F.sum("payload_bytes").alias("payload_bytes"))

    @q.add("agg_distinct_keys", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL")
    def _(t: Inputs):
        return t.orders.where("o_custkey is not null").select("o_custkey").distinct()

    five = ("customer", "orders", "events", "part", "supplier")

    @q.add("agg_multi_scalar", "SELECT " + ", ".join(f"(SELECT count(*) FROM {x}) AS n_{x}" for x in five))
    def _(t: Inputs):
        out = None
        for x in five:  # one row each
            one = getattr(t, x).agg(F.count("*").alias(f"n_{x}"))
            out = one if out is None else out.crossJoin(one)
        return out

    @q.add("agg_cause_counts", "SELECT CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_orderstatus = 'P' THEN 'partial' ELSE 'plain' END AS cause, count(*) AS n FROM orders GROUP BY 1")
    def _(t: Inputs):
        return t.orders.groupBy(F.when(F.col("o_totalprice") > 300000, "large").when(F.col("o_orderstatus") == "P", "partial").otherwise("plain").alias("cause")).agg(F.count("*").alias("n"))


def _windows(q: Catalogue) -> None:
    @q.add("win_out_of_order", "SELECT event_id, posted_at FROM (SELECT event_id, posted_at, max(posted_at) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM @events_backdated) x WHERE posted_at < before")
    def _(t: Inputs):
        return A.behind_running_max(t.events_backdated, "event_id", "posted_at").select("event_id", "posted_at")

    @q.add("win_row_number_flag", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 3 AS among_first FROM orders")
    def _(t: Inputs):
        return t.orders.select("o_custkey", "o_orderkey", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")) <= 3).alias("among_first"))

    @q.add("win_freshest", "SELECT o_custkey, o_orderkey AS freshest FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) x WHERE rn = 1")
    def _(t: Inputs):
        return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", F.negative("o_orderkey"))).alias("freshest"))

    @q.add("topk_hash_sample", "SELECT o_orderkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 25")
    def _(t: Inputs):
        return hash_order(t.orders, "o_orderkey").limit(25).select("o_orderkey")

    @q.add("topk_first_pair", "SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN 0 WHEN o_totalprice <> (SELECT arg_min(o_totalprice, o_orderkey) FROM orders) THEN 1 ELSE 2 END, o_orderkey) AS rn FROM (SELECT * FROM orders WHERE o_orderkey <= 5000 ORDER BY o_orderkey LIMIT 20) y) x WHERE rn <= 2")
    def _(t: Inputs):
        from ..operators.scenario import pick_rows

        return pick_rows(t.orders, "o_orderkey", "o_totalprice", 5000)

    @q.add("topk_id_sample", "SELECT o_orderstatus, array_to_string(list_sort(list(o_orderkey))[1:12], ',') AS sample, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM @mirror_orders) GROUP BY o_orderstatus")
    def _(t: Inputs):
        return A.id_sample(t.orders.join(t.mirror_orders.select("o_orderkey"), "o_orderkey", "left_anti"), "o_orderstatus", "o_orderkey", 12)

    @q.add("topk_slot_cap", "SELECT c_custkey, slot FROM (SELECT c_custkey, n AS slot, row_number() OVER (ORDER BY n, c_custkey) AS rn FROM customer JOIN range(1, 4) r(n) ON n <= c_custkey % 3 + 1) x WHERE rn <= 200")
    def _(t: Inputs):
        slots = t.customer.select("c_custkey", F.explode(F.sequence(F.lit(1).cast("long"), F.col("c_custkey") % 3 + 1)).alias("slot"))
        return slots.orderBy("slot", "c_custkey").limit(200)

    @q.add("sort_total_order_rank", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey DESC) AS BIGINT) AS place FROM orders")
    def _(t: Inputs):
        return A.global_rank(t.orders.select("o_orderkey"), "o_orderkey", descending=True)


def _sets(q: Catalogue) -> None:
    pairs = "SELECT d.doc_id AS a, g.least AS b FROM documents d JOIN (SELECT md5(text) AS h, min(doc_id) AS least FROM documents GROUP BY 1) g ON md5(d.text) = g.h WHERE d.doc_id <> g.least"
    same = "SELECT x.doc_id AS a, g.b FROM documents x JOIN (SELECT source, n_chars, lang, min(doc_id) AS b FROM documents GROUP BY 1, 2, 3) g ON x.source = g.source AND x.n_chars = g.n_chars AND x.lang = g.lang WHERE x.doc_id <> g.b"

    @q.add("set_pairs_partition", f"WITH p AS ({pairs}), t AS ({same}) SELECT 'correct' AS kind, a, b FROM (SELECT * FROM p INTERSECT SELECT * FROM t) UNION ALL SELECT 'wrong', a, b FROM (SELECT * FROM p EXCEPT SELECT * FROM t) UNION ALL SELECT 'missed', a, b FROM (SELECT * FROM t EXCEPT SELECT * FROM p)")
    def _(t: Inputs):
        docs = t.documents.select("doc_id", "source", "n_chars", "lang", F.md5("text").alias("h"))
        least = docs.groupBy("h").agg(F.min("doc_id").alias("b"))
        p = docs.join(least, "h").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
        # stars around the least member of a group, never its pairs
        traits = ["source", "n_chars", "lang"]
        truth = docs.join(docs.groupBy(*traits).agg(F.min("doc_id").alias("b")), traits).where("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
        kind = F.when(F.col("p").isNotNull() & F.col("t").isNotNull(), "correct").when(F.col("t").isNull(), "wrong").otherwise("missed")
        return p.distinct().withColumn("p", F.lit(1)).join(truth.distinct().withColumn("t", F.lit(1)), ["a", "b"], "full_outer").select(kind.alias("kind"), "a", "b")

    @q.add("set_population_delta", "SELECT 'lost' AS side, c_custkey FROM (SELECT c_custkey FROM customer EXCEPT SELECT c_custkey FROM @mirror_customer) UNION ALL SELECT 'gained', c_custkey FROM (SELECT c_custkey FROM @mirror_customer EXCEPT SELECT c_custkey FROM customer)")
    def _(t: Inputs):
        a, b = t.customer.select("c_custkey"), t.mirror_customer.select("c_custkey")
        return a.subtract(b).select(F.lit("lost").alias("side"), "c_custkey").unionByName(b.subtract(a).select(F.lit("gained").alias("side"), "c_custkey"))

    @q.add("set_union_stages", "SELECT customer_id, 'pair' AS stage FROM @id_customers WHERE t >= 0 UNION ALL SELECT customer_id, 'single' FROM @id_customers WHERE t < 0")
    def _(t: Inputs):
        c = t.id_customers
        return c.where("t >= 0").select("customer_id", F.lit("pair").alias("stage")).unionByName(c.where("t < 0").select("customer_id", F.lit("single").alias("stage")))

    @q.add("set_instrument_overlap", "SELECT DISTINCT x.customer_id AS a, y.customer_id AS b FROM @id_cards x JOIN @id_cards y ON lower(x.card_fingerprint) = lower(y.card_fingerprint) AND x.customer_id < y.customer_id")
    def _(t: Inputs):
        c = t.id_cards.select("customer_id", F.lower("card_fingerprint").alias("f"))
        return group_pairs(c, "f", "customer_id").distinct()

    @q.add("set_unique_guard", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
    def _(t: Inputs):
        return A.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


def _functions(q: Catalogue) -> None:
    @q.add("fn_email_parts", "SELECT customer_id, split_part(lower(trim(coalesce(email, ''))), '@', 1) AS local_part, CASE WHEN contains(email, '@') THEN substr(lower(trim(email)), strpos(trim(email), '@') + 1) ELSE '' END AS domain, regexp_extract(split_part(lower(trim(coalesce(email, ''))), '@', 1), '^[^+]*[+](.*)$', 1) AS tag FROM @id_customers")
    def _(t: Inputs):
        local, domain = N.raw_email_parts(F.col("email"))
        return t.id_customers.select("customer_id", local.alias("local_part"), domain.alias("domain"), N.subaddress_tag(local).alias("tag"))

    @q.add("fn_ids_csv", "SELECT person_id, string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY customer_id) AS ids, 'C' || lpad(CAST(person_id AS VARCHAR), 7, '0') AS label FROM @id_truth GROUP BY person_id")
    def _(t: Inputs):
        ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("customer_id")), lambda x: x.cast("string")))
        return t.id_truth.groupBy("person_id").agg(ids.alias("ids")).withColumn("label", F.concat(F.lit("C"), F.lpad(F.col("person_id").cast("string"), 7, "0")))

    @q.add("fn_review_id", "SELECT customer_id, CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 15) AS BIGINT) AS review_id FROM @id_customers")
    def _(t: Inputs):
        from ..operators.identity import review_id

        return t.id_customers.select("customer_id", review_id(F.col("customer_id").cast("string")).alias("review_id"))

    @q.add("fn_freshness", "SELECT customer_id, coalesce(updated_at, created_at) AS freshness FROM @id_customers")
    def _(t: Inputs):
        return t.id_customers.select("customer_id", F.coalesce("updated_at", "created_at", F.raise_error(F.lit("neither updated_at nor created_at")).cast("timestamp_ntz")).alias("freshness"))

    @q.add("fn_norm_scalars", "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts_text, CAST(event_id % 2 = 0 AS INTEGER) AS flag, CAST(user_id AS BIGINT) AS user_id FROM events")
    def _(t: Inputs):
        return t.events.select("event_id", canonical_scalar(F.col("ts"), "timestamp_ntz").alias("ts_text"), canonical_scalar(F.col("event_id") % 2 == 0, "boolean").alias("flag"), canonical_scalar(F.col("user_id"), "bigint").alias("user_id"))

    @q.add("fn_hashes", "SELECT o_orderkey, md5(o_orderpriority) AS m, sha256(o_orderpriority) AS s, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM orders")
    def _(t: Inputs):
        return t.orders.select("o_orderkey", F.md5("o_orderpriority").alias("m"), F.sha2("o_orderpriority", 256).alias("s"), F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 8), 16, 10).cast("long").alias("h"))

    @q.add("fn_strings", "SELECT c_custkey, lower(c_name) AS low, upper(c_mktsegment) AS up, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS padded, left(c_name, 4) AS l, right(c_name, 3) AS r, repeat('ab', 2) AS rep, rtrim(c_name || '  ') AS rt, CAST(octet_length(encode(c_name)) AS INTEGER) AS bytes, '[' || c_name || ']' AS quoted FROM customer")
    def _(t: Inputs):
        name = F.col("c_name")
        return t.customer.select(
            "c_custkey", F.lower(name).alias("low"), F.upper("c_mktsegment").alias("up"), F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("padded"), F.left(name, F.lit(4)).alias("l"), F.right(name, F.lit(3)).alias("r"), F.repeat(F.lit("ab"), 2).alias("rep"),
            F.rtrim(F.concat(name, F.lit("  "))).alias("rt"), F.octet_length(name).alias("bytes"), F.concat(F.lit("["), name, F.lit("]")).alias("quoted"),
        )

    @q.add("fn_dates", "SELECT o_orderkey, o_orderdate + INTERVAL '3' DAY AS later, o_orderdate - INTERVAL '90' MINUTE AS earlier, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders")
    def _(t: Inputs):
        d = F.col("o_orderdate")
        return t.orders.select("o_orderkey", (d + F.expr("INTERVAL '3' DAY")).alias("later"), (d - F.expr("INTERVAL '90' MINUTE")).alias("earlier"), F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.year(d).alias("y"))

    @q.add("fn_math", "SELECT o_orderkey, o_orderkey % 7 AS m, abs(o_orderkey - 5000) AS a, o_orderkey // 13 AS d FROM orders")
    def _(t: Inputs):
        return t.orders.select("o_orderkey", F.pmod("o_orderkey", F.lit(7)).alias("m"), F.abs(F.col("o_orderkey") - 5000).alias("a"), F.expr("o_orderkey div 13").alias("d"))

    @q.add("fn_ratio", "SELECT o_custkey, CASE WHEN count(*) FILTER (o_orderstatus <> 'P') = 0 THEN 0.0::DOUBLE ELSE CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) FILTER (o_orderstatus <> 'P') END AS share FROM orders GROUP BY o_custkey")
    def _(t: Inputs):
        return t.orders.groupBy("o_custkey").agg(ratio(F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") != "P")).alias("share"))

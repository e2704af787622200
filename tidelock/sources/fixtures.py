"""Derived inputs: the other side of tables, change feeds and an identity population.

All are made from the driver's tables by integer arithmetic, as SQL that means
the same to Spark and DuckDB: `@name` stands for a table, `@TS` for a timestamp
without time zone, `@DIV` for integer division.  Residue classes of the keys
carry the cases that the operators must tell apart.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FIXTURES: dict[str, str] = {
    # the mirror of orders: some keys lost, some stale, two values changed
    "mirror_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CASE o_orderkey WHEN 1 THEN o_totalprice + 500.0 WHEN 2 THEN o_totalprice - 123.0 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
        FROM @orders WHERE o_orderkey % 997 <> 13
        UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM @orders WHERE o_orderkey % 991 = 7""",
    "mirror_events": """
        SELECT event_id, ts, user_id, event_type, CASE event_id WHEN 1 THEN value + 500.0 WHEN 2 THEN value - 123.0 ELSE value END AS value, props FROM @events WHERE event_id % 997 <> 13
        UNION ALL SELECT event_id + 10000000, ts, user_id, event_type, value, props FROM @events WHERE event_id % 991 = 7""",
    "mirror_customer": "SELECT * FROM @customer WHERE c_custkey % 101 <> 5",
    # two values swapped: every aggregate stays as it was
    "swapped_orders": """
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, coalesce(x.o_totalprice, o.o_totalprice) AS o_totalprice, o.o_orderdate, o.o_orderpriority
        FROM @orders o LEFT JOIN @orders x ON x.o_orderkey = 3 - o.o_orderkey AND o.o_orderkey IN (1, 2)""",
    # children of which some have lost their parents
    "orphaned_orders": "SELECT o_orderkey, CASE WHEN o_orderkey % 500 = 3 THEN o_custkey + 5000000 WHEN o_orderkey % 700 = 9 THEN NULL ELSE o_custkey END AS o_custkey FROM @orders",
    "feed_orders": """
        SELECT CASE o_orderkey % 101 WHEN 1 THEN 'I' WHEN 2 THEN 'U' ELSE 'D' END AS _op,
            o_orderkey + CASE WHEN o_orderkey % 101 = 1 AND o_orderkey % 2 = 0 THEN 20000000 WHEN o_orderkey % 101 = 3 AND o_orderkey % 5 = 0 THEN 30000000 ELSE 0 END AS o_orderkey,
            CASE WHEN o_orderkey % 101 <> 3 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 101 <> 3 THEN 'X' END AS o_orderstatus, CASE WHEN o_orderkey % 101 <> 3 THEN o_totalprice + 1 END AS o_totalprice,
            CASE WHEN o_orderkey % 101 <> 3 THEN o_orderdate END AS o_orderdate, CASE WHEN o_orderkey % 101 <> 3 THEN o_orderpriority END AS o_orderpriority
        FROM @orders WHERE o_orderkey % 101 IN (1, 2, 3)""",
    "events_backdated": "SELECT event_id, ts, CASE WHEN event_id % 20 = 0 THEN ts - INTERVAL '90' DAY ELSE ts END AS posted_at, user_id, value FROM @events",
    # customers: k % 20 in (0, 1) are pairs, whose class t carries a case; the others are singles
    "id_customers": """
        SELECT CAST(k AS INT) AS customer_id, CAST(t AS INT) AS t, twin,
            concat('First', CAST((p * 31 + 7) % 53 AS STRING)) AS first_name,
            CASE WHEN t = 3 AND twin THEN concat('  ', upper(surname), ' ') WHEN t = 7 AND twin THEN concat(surname, '-Brook') WHEN t = 15 THEN 'Testerman' WHEN t = 17 AND twin THEN 'Othername'
                WHEN t = 19 AND NOT twin THEN concat('Müller', CAST(p AS STRING)) WHEN t = 19 THEN concat('MULLER', CAST(p AS STRING)) ELSE surname END AS last_name,
            CASE WHEN t = 10 AND twin THEN concat('u', CAST(k AS STRING), '+test@mail.org') WHEN t = 11 AND twin THEN concat('Test', CAST(k % 100 AS STRING), '@Corp.Internal') WHEN t = 12 AND twin THEN 'qa@corp.internal'
                WHEN t = 16 THEN concat('house', CAST(p AS STRING), '@mail.org') WHEN t >= 0 THEN concat('u', CAST(p AS STRING), '@mail.org')
                WHEN p % 11 = 0 THEN NULL WHEN p % 11 = 1 THEN 'n/a' WHEN p % 11 = 2 THEN concat('  U', CAST(p AS STRING), '@Mail.ORG ') WHEN p % 11 = 3 THEN 'x@mail..org' WHEN p % 11 = 4 THEN 'x y@mail.org'
                WHEN p % 11 = 5 THEN 'user@example.com' WHEN p % 11 = 6 THEN 'nomail.org' WHEN p % 11 = 7 THEN 'mаil@mail.org' WHEN p % 11 = 8 THEN 'u@mail.org.' ELSE concat('u', CAST(p AS STRING), '@mail.org') END AS email,
            CASE WHEN t = 16 THEN concat('512555', CAST(2000 + p % 7000 AS STRING)) WHEN p % 13 = 0 THEN NULL WHEN p % 13 = 1 THEN '000-000-0000' WHEN p % 13 = 2 THEN '1234567890' WHEN p % 13 = 3 THEN '(512) 555-0142 ext 214'
                WHEN p % 13 = 4 THEN '800-FLOWERS' WHEN p % 13 = 5 THEN '44205550123' WHEN p % 13 = 6 THEN '1 512 555 0142' WHEN p % 13 = 7 THEN '５125550142' WHEN p % 13 = 8 THEN '012-555-0142' WHEN p % 13 = 9 THEN '555-0142' WHEN p % 13 = 10 THEN ' - '
                ELSE concat('512', CAST(2000000 + (p * 7919) % 7000000 AS STRING)) END AS phone,
            CASE WHEN t IN (1, 18) AND twin THEN NULL WHEN t IN (2, 13) AND twin THEN '0000' WHEN t = -1 AND p % 17 = 3 THEN '12' WHEN t = -1 AND p % 17 = 4 THEN '12a4' WHEN t = -1 AND p % 17 = 5 THEN ' 4821 ' WHEN t = -1 AND p % 17 = 6 THEN '8901'
                WHEN t = -1 AND p % 17 = 7 THEN '' ELSE lpad(CAST((p * 7919 + 1237) % 10000 AS STRING), 4, '0') END AS ssn_last4,
            CASE WHEN t = 13 AND twin THEN DATE '1900-01-01' WHEN t = -1 AND p % 19 = 4 THEN NULL WHEN t = -1 AND p % 19 = 5 THEN DATE '1970-01-01' WHEN t = -1 AND p % 19 = 6 THEN DATE '1905-05-05' WHEN t = -1 AND p % 19 = 7 THEN DATE '2027-02-03'
                ELSE make_date(CAST(1950 + p % 50 AS INT), CAST(1 + (p * 3 + CASE WHEN t = 8 AND twin THEN 1 ELSE 0 END) % 12 AS INT), CAST(1 + (p * 5) % 28 AS INT)) END AS date_of_birth,
            concat(CAST(p % 900 AS STRING), ' Mill Street') AS address_line1, 'Harbor' AS city, 'TX' AS state_code,
            CAST(make_date(2020, CAST(1 + k % 12 AS INT), CAST(1 + k % 28 AS INT)) AS @TS) AS created_at,
            CASE WHEN t = 9 OR k % 7 = 3 THEN NULL ELSE CAST(make_date(CAST(2022 + k % 2 AS INT), CAST(1 + k % 11 AS INT), CAST(1 + k % 27 AS INT)) AS @TS) END AS updated_at
        FROM (SELECT c_custkey AS k, c_custkey - CASE WHEN c_custkey % 20 = 1 THEN 1 ELSE 0 END AS p, concat('Name', CAST(c_custkey - CASE WHEN c_custkey % 20 = 1 THEN 1 ELSE 0 END AS STRING)) AS surname,
                CASE WHEN c_custkey % 20 IN (0, 1) THEN (c_custkey @DIV 20) % 20 ELSE -1 END AS t, c_custkey % 20 = 1 AS twin FROM @customer) b""",
    # a day later: some have another phone, and of these every third a later time of change
    "id_customers_later": """
        SELECT customer_id, email, CASE WHEN customer_id % 7 = 3 THEN concat('512', CAST(3000000 + customer_id AS STRING)) ELSE phone END AS phone,
            CASE WHEN customer_id % 21 = 3 THEN CAST(make_date(2024, 6, 1) AS @TS) ELSE updated_at END AS updated_at FROM @id_customers""",
    "id_advances": """
        SELECT customer_id * 2 AS advance_id, customer_id,
            CASE WHEN t IN (4, 5) THEN 'FUNDED ' WHEN t = 6 THEN 'Paid Off' WHEN t = 12 THEN 'Funded' WHEN t = 14 THEN 'declined' WHEN t = 0 THEN 'Pending'
                ELSE CASE (customer_id * 7) % 16 WHEN 0 THEN 'funded' WHEN 1 THEN 'FUNDED ' WHEN 2 THEN 'Funded' WHEN 3 THEN 'paid_off' WHEN 4 THEN 'Paid Off' WHEN 5 THEN 'PAID OFF' WHEN 6 THEN 'pending' WHEN 7 THEN 'Pending'
                    WHEN 8 THEN 'approved' WHEN 9 THEN 'APPROVED' WHEN 10 THEN 'declined' WHEN 11 THEN 'Declined' WHEN 12 THEN 'cancelled' WHEN 13 THEN 'canceled' WHEN 14 THEN 'expired' ELSE 'in review' END END AS status,
            CASE WHEN t = 14 THEN CAST(999999.99 AS DOUBLE) WHEN customer_id % 90 = 6 THEN CAST(0 AS DOUBLE) ELSE CAST((customer_id * 37) % 5000 + 100 AS DOUBLE) END AS principal_amount,
            concat('H', CAST(CASE WHEN t = 5 AND twin THEN customer_id ELSE customer_id - customer_id % 20 END AS STRING), CASE WHEN twin THEN '  ' ELSE '' END) AS repayment_account_hash
        FROM @id_customers WHERE (t = -1 AND customer_id % 3 = 0) OR t IN (0, 4, 5) OR (t = 6 AND NOT twin) OR (t IN (12, 14) AND twin)""",
    "id_cards": """
        SELECT customer_id AS card_id, customer_id, concat(CASE WHEN twin THEN 'FP' ELSE 'fp' END, CAST(CASE WHEN t IN (0, 3, 16) AND twin THEN customer_id - 1 ELSE customer_id END AS STRING)) AS card_fingerprint,
            customer_id % 2 = 0 OR t IN (0, 3) AS is_default
        FROM @id_customers WHERE customer_id % 20 <> 19""",
    "id_manual": """
        SELECT customer_id AS customer_id_a, customer_id + 1 AS customer_id_b, 'desk' AS decided_by FROM @id_customers WHERE t = 18 AND NOT twin
        UNION ALL SELECT customer_id, customer_id + 90000000, 'desk' FROM @id_customers WHERE t = 18 AND NOT twin AND customer_id % 400 = 360""",
    # ground truth, which resolution never reads
    "id_truth": "SELECT customer_id, customer_id - CASE WHEN twin AND t NOT IN (16, 17) THEN 1 ELSE 0 END AS person_id FROM @id_customers",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def spark_text(sf_dir: str, text: str) -> str:
    def name(m: re.Match) -> str:
        found = m[1]
        if found in FIXTURES:
            return f"({spark_text(sf_dir, FIXTURES[found])})"
        return f"parquet.`{sf_dir}/{found}.parquet`" if found in TABLES else {"TS": "TIMESTAMP_NTZ", "DIV": "div"}[found]

    return re.sub(r"@(\w+)", lambda m: name(m) if m[1] in FIXTURES or m[1] in TABLES or m[1] in ("TS", "DIV") else m[0], text)


def duck_text(text: str) -> str:
    def name(m: re.Match) -> str:
        found = m[1]
        if found in FIXTURES:
            return f"({duck_text(FIXTURES[found])})"
        return found if found in TABLES else {"TS": "TIMESTAMP", "DIV": "//"}[found]

    return re.sub(r"@(\w+)", lambda m: name(m) if m[1] in FIXTURES or m[1] in TABLES or m[1] in ("TS", "DIV") else m[0], text)


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a derived one."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(spark_text(sf_dir, FIXTURES[name]))

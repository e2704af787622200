"""Normalisers, entity resolution and its scoring as queries over the derived identity population."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import normalize as N
from ..operators import identity as I
from ..operators import publish
from ..operators import score as S
from ..operators.graph import folder
from ..sources.versions import Store
from .registry import Catalogue, Inputs

# --- the same rules in SQL ------------------------------------------------------------------------------------------


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _repeated(x: str) -> str:
    return f"regexp_full_match({x}, '{'|'.join(f'{d}{{3,}}' for d in range(10))}')"


def _sequential(x: str) -> str:
    return f"(length({x}) >= 4 AND regexp_full_match({x}, '[0-9]+') AND (strpos(repeat('0123456789', 5), {x}) > 0 OR strpos(repeat('9876543210', 5), {x}) > 0))"


def _far(x: str) -> str:
    return f"'non_ascii[' || printf('U+%04X', unicode(regexp_extract({x}, '[^\\x00-\\x7F]'))) || ']'"


def _ladder(raw: str, cases: list[tuple[str, str, str]], value: str, defect: str = "NULL") -> tuple[str, str, str]:
    """(normalized, status, defect_class) as SQL."""
    status = "CASE " + " ".join(f"WHEN {w} THEN '{s}'" for w, s, _ in cases) + " ELSE 'valid' END"
    why = "CASE " + " ".join(f"WHEN {w} THEN {d or 'NULL'}" for w, _, d in cases) + f" ELSE {defect} END"
    return f"CASE WHEN {status} = 'valid' THEN {value} END", status, f"CAST({why} AS VARCHAR)"


def _ssn(c: str):
    x = _strip(c)
    return _ladder(c, [(f"{c} IS NULL OR {x} = ''", "missing", ""), (f"NOT regexp_full_match({x}, '[0-9]+')", "malformed", "'non_numeric'"), (f"length({x}) <> 4", "malformed", f"'wrong_length_' || length({x})"), (_repeated(x), "placeholder", "'repeated_digits'"), (_sequential(x), "placeholder", "'sequential_digits'")], x)


def _dob(c: str):
    return _ladder(c, [(f"{c} IS NULL", "missing", ""), (f"{c} IN (DATE '1900-01-01', DATE '1901-01-01', DATE '1970-01-01')", "placeholder", "'canonical_epoch'"), (f"year({c}) < 1910 OR {c} > DATE '2026-08-18'", "malformed", "'implausible_year'")], f"strftime({c}, '%Y-%m-%d')")


def _name(c: str):
    x = f"lower(strip_accents({_strip(f'''regexp_replace({c}, '\\s+', ' ', 'g')''')}))"
    return _ladder(c, [(f"{c} IS NULL OR {x} = ''", "missing", "")], x)


def _email(c: str):
    x = _strip(c)
    low, plain = f"lower({x})", f"regexp_full_match({x}, '[A-Za-z0-9!#$%&''*+/=?^_`{{|}}~.-]+@[A-Za-z0-9.-]+')"
    local, domain = f"split_part({low}, '@', 1)", f"split_part({low}, '@', 2)"
    reserved = "('example.com', 'example.org', 'example.net', 'test', 'example', 'invalid', 'localhost')"
    return _ladder(
        c,
        [
            (f"{c} IS NULL OR {x} = ''", "missing", ""), (f"{low} IN ('n/a', 'na', 'none', 'null', 'unknown', 'x@x', '-', '.')", "placeholder", "'placeholder_literal'"), (f"NOT {plain} AND regexp_matches({x}, '[^\\x00-\\x7F]')", "malformed", _far(x)),
            (f"NOT {plain} AND NOT contains({x}, '@')", "malformed", "'missing_at'"), (f"NOT {plain} AND regexp_matches({x}, '\\s')", "malformed", "'internal_whitespace'"), (f"NOT {plain}", "malformed", "'illegal_character'"), (f"length({local}) > 64", "malformed", "'local_part_length'"),
            (f"contains({domain}, '..')", "malformed", "'double_dot_domain'"), (f"regexp_matches({domain}, '\\.$|^[.-]')", "malformed", "'trailing_punctuation'"), (f"NOT contains({domain}, '.')", "malformed", "'missing_tld'"),
            (f"{domain} IN {reserved} OR split_part({domain}, '.', -1) IN {reserved}", "placeholder", "'reserved_domain'"),
        ],
        low,
    )


def _phone(c: str):
    x = _strip(c)
    ext = "(?i)\\b(?:ext|x|extension)\\.?\\s*\\.?\\s*[0-9]{1,6}\\s*$"
    digits = f"regexp_replace(regexp_replace({x}, '{ext}', ''), '[^0-9]', '', 'g')"
    ten = f"CASE WHEN length({digits}) = 11 AND starts_with({digits}, '1') THEN substr({digits}, 2) ELSE {digits} END"
    return _ladder(
        c,
        [
            (f"{c} IS NULL OR {x} = ''", "missing", ""), (f"regexp_matches({x}, '[^\\x00-\\x7F]')", "malformed", _far(x)), (f"regexp_matches({x}, '[A-Za-z]') AND NOT regexp_matches({x}, '{ext}')", "malformed", "'vanity_or_letters'"), (f"{digits} = ''", "missing", ""),
            (_repeated(digits), "placeholder", "'repeated_digits'"), (_sequential(digits), "placeholder", "'sequential_digits'"), (f"length({ten}) = 11", "malformed", "'eleven_digits_non_us'"), (f"length({ten}) <> 10", "malformed", f"'digit_count_' || length({ten})"),
            (f"regexp_matches({ten}, '^[01]|^...[01]')", "malformed", "'invalid_nanp_prefix'"),
        ],
        f"'+1' || {ten}",
        f"CASE WHEN regexp_matches({x}, '{ext}') THEN 'extension_dropped' END",
    )


_KEYED = "lower(" + _strip("regexp_replace(replace(status, '_', ' '), '\\s+', ' ', 'g')") + ")"
_MEANING = f"CASE WHEN status IS NULL OR {_KEYED} = '' THEN 'missing' ELSE coalesce(CASE {_KEYED} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in N.STATUS_MEANINGS.items()) + " END, 'unrecognised') END"

# the whole resolution as common table expressions
_CTE = f"""
    adv AS (SELECT *, {_MEANING} AS meaning FROM @id_advances),
    money AS (SELECT customer_id, bool_or(meaning IN ('funded', 'paid_off')) AS moved, coalesce(string_agg(advance_id || '|' || meaning || '|' || trim(repayment_account_hash), ';' ORDER BY advance_id) FILTER (meaning IN ('funded', 'paid_off')), '') AS evidence,
        bool_or(principal_amount IN (0.0, 999999.99)) AS artifact FROM adv GROUP BY customer_id),
    known AS (SELECT c.*, coalesce(moved, false) AS moved,
        CASE WHEN split_part(lower(trim(coalesce(email, ''))), '@', 2) = '{I.INTERNAL_DOMAIN}' AND regexp_matches(split_part(lower(trim(coalesce(email, ''))), '@', 1), '{I.AUTOMATION_LOCAL}') THEN 'A' ELSE '' END
        || CASE WHEN regexp_matches(regexp_extract(split_part(lower(trim(coalesce(email, ''))), '@', 1), '^[^+]*[+](.*)$', 1), '{I.TEST_TAG}') THEN 'B' ELSE '' END
        || CASE WHEN coalesce(trim(ssn_last4) = '0000' AND date_of_birth = DATE '1900-01-01', false) OR coalesce(artifact, false) THEN 'C' ELSE '' END AS rules FROM @id_customers c LEFT JOIN money m ON c.customer_id = m.customer_id),
    screened AS (SELECT *, rules <> '' AND NOT moved AS is_test, rules <> '' AND moved AS blocked, {_ssn('ssn_last4')[0]} AS n_ssn, {_dob('date_of_birth')[0]} AS n_dob, {_name('last_name')[0]} AS n_last, {_name('first_name')[0]} AS n_first, {_email('email')[0]} AS n_email FROM known),
    keyed AS (SELECT *, CASE WHEN n_ssn IS NOT NULL AND n_dob IS NOT NULL AND n_last IS NOT NULL THEN n_ssn || '|' || n_dob || '|' || n_last END AS key FROM screened WHERE NOT is_test),
    applied AS (SELECT customer_id_a AS a, customer_id_b AS b FROM @id_manual WHERE customer_id_a IN (SELECT customer_id FROM keyed) AND customer_id_b IN (SELECT customer_id FROM keyed)),
    edges AS (SELECT a.customer_id AS a, b.customer_id AS b FROM keyed a JOIN keyed b ON a.key = b.key AND a.customer_id <> b.customer_id UNION SELECT a, b FROM applied UNION SELECT b, a FROM applied),
    reach(node, other) AS (SELECT customer_id, customer_id FROM keyed UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
    rooted AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
    members AS (SELECT k.*, r.root, coalesce(updated_at, created_at) AS fresh FROM keyed k JOIN rooted r ON k.customer_id = r.node),
    instruments AS (SELECT m.root, count(DISTINCT trim(repayment_account_hash)) AS n FROM members m JOIN adv a ON m.customer_id = a.customer_id WHERE meaning IN ('funded', 'paid_off') GROUP BY m.root),
    touched AS (SELECT DISTINCT root FROM members WHERE customer_id IN (SELECT a FROM applied UNION SELECT b FROM applied)),
    groups AS (SELECT root, count(*) AS size, count(*) FILTER (moved) AS n_money, first(customer_id ORDER BY moved DESC, fresh DESC, customer_id) AS survivor, array_to_string(list_sort(list(DISTINCT key) FILTER (key IS NOT NULL)), ' + ') AS group_key FROM members GROUP BY root),
    decided AS (SELECT g.*, CASE WHEN size > 1 AND n_money > 1 THEN CASE WHEN coalesce(i.n, 0) > 1 THEN '{I.REASON_DIFFERENT}' ELSE '{I.REASON_SAME}' END END AS reason FROM groups g LEFT JOIN instruments i ON g.root = i.root),
    mapped AS (
        SELECT m.customer_id, CASE WHEN size > 1 AND reason IS NULL THEN survivor ELSE m.customer_id END AS canonical_customer_id, CASE WHEN size = 1 THEN 'singleton' WHEN reason IS NOT NULL THEN 'review' ELSE 'merged' END AS resolution,
            CASE WHEN size > 1 AND reason IS NULL THEN CASE WHEN m.root IN (SELECT root FROM touched) THEN 'manual_merge' ELSE 'proof_tuple' END END AS rule, CASE WHEN size > 1 THEN group_key END AS group_key,
            CASE WHEN size > 1 AND reason IS NULL THEN CASE WHEN n_money = 1 THEN 'money_moved' ELSE 'freshest' END END AS survivor_reason
        FROM members m JOIN decided d ON m.root = d.root
        UNION ALL SELECT customer_id, customer_id, 'excluded_test', NULL, NULL, NULL FROM screened WHERE is_test),
    resolved AS (SELECT *, customer_id = canonical_customer_id AND resolution <> 'excluded_test' AS is_canonical FROM mapped),
    proposed AS (SELECT x.customer_id AS a, y.customer_id AS b FROM resolved x JOIN resolved y ON x.canonical_customer_id = y.canonical_customer_id AND x.customer_id < y.customer_id AND x.resolution = 'merged' AND y.resolution = 'merged'),
    truth AS (SELECT x.customer_id AS a, y.customer_id AS b FROM @id_truth x JOIN @id_truth y ON x.person_id = y.person_id AND x.customer_id < y.customer_id WHERE x.customer_id IN (SELECT customer_id FROM keyed) AND y.customer_id IN (SELECT customer_id FROM keyed))"""
WITH = f"WITH RECURSIVE {_CTE.strip()}\n"


def _signals() -> str:
    """The weak signals of rows x and y of customers, as SQL."""
    agree = lambda f, c: f"CASE WHEN {f(f'x.{c}')[0]} = {f(f'y.{c}')[0]} THEN "
    return (
        f"concat_ws(',', {agree(_email, 'email')} 'email' END, {agree(_phone, 'phone')} 'phone' END, {agree(_name, 'address_line1')} 'address' END, {agree(_name, 'last_name')} 'surname' END, "
        "CASE WHEN EXISTS (SELECT 1 FROM @id_cards p JOIN @id_cards r ON lower(trim(p.card_fingerprint)) = lower(trim(r.card_fingerprint)) WHERE p.customer_id = x.customer_id AND r.customer_id = y.customer_id) THEN 'card_fingerprint' END)"
    )


#: The clock of published resolutions.
AT = datetime(2026, 8, 18, 12)


def _resolve(t: Inputs):
    screening = I.screen(t.id_customers, t.id_advances)
    members = I.grouped(screening, t.id_manual)
    return screening, members


def _published(t: Inputs, runs: int = 1) -> Store:
    """A new mirror in which a resolution was published so many times."""
    store = Store(t.spark, folder(t.spark, "identity"))
    for k in range(runs):
        # the same rows in another order and partitioning each time
        publish.resolve(store, t.id_customers.repartition(3 + k, F.xxhash64("customer_id")), t.id_advances.repartition(5 - k), t.id_manual, AT)
    return store


def register(q: Catalogue) -> None:
    _normalisers(q), _resolution(q), _scoring(q)


def _normalisers(q: Catalogue) -> None:
    for name, column, spark_side, duck_side in (("ssn", "ssn_last4", N.ssn_last4, _ssn), ("dob", "date_of_birth", N.birthday, _dob), ("name", "last_name", N.name, _name), ("email", "email", N.email, _email), ("phone", "phone", N.phone, _phone)):
        value, status, why = duck_side(column)

        @q.add(f"fn_{name}", f"SELECT customer_id, {value} AS normalized, {status} AS status, {why} AS defect_class FROM @id_customers")
        def _(t: Inputs, column=column, side=spark_side):
            return t.id_customers.select("customer_id", side(F.col(column)).alias("n")).select("customer_id", "n.normalized", "n.status", "n.defect_class")

    @q.add("fn_status", f"SELECT advance_id, {_MEANING} AS meaning FROM @id_advances")
    def _(t: Inputs):
        return t.id_advances.select("advance_id", N.status_meaning(F.col("status")).alias("meaning"))

    digits = "lpad(CAST((c_custkey * 1111) % 100000 AS VARCHAR), CAST(3 + c_custkey % 3 AS INTEGER), '0')"

    @q.add("fn_digit_shapes", f"SELECT c_custkey, {_repeated(digits)} AS repeated, {_sequential(digits)} AS sequential FROM customer")
    def _(t: Inputs):
        d = F.expr("lpad(cast((c_custkey * 1111) % 100000 as string), cast(3 + c_custkey % 3 as int), '0')")
        return t.customer.select("c_custkey", N.repeated_digits(d).alias("repeated"), N.sequential_digits(d).alias("sequential"))

    @q.add("flt_evidence_gate", f"SELECT customer_id, {_email('email')[0]} AS email FROM @id_customers WHERE {_email('email')[1]} = 'valid'")
    def _(t: Inputs):
        return t.id_customers.select("customer_id", N.email(F.col("email")).alias("n")).where(N.is_evidence(F.col("n"))).select("customer_id", F.col("n.normalized").alias("email"))


def _resolution(q: Catalogue) -> None:
    @q.add("er_money_moved", f"WITH {_CTE.split('known AS')[0].strip().rstrip(',')} SELECT customer_id, moved FROM money")
    def _(t: Inputs):
        return I.money(t.id_advances).select("customer_id", "moved")

    @q.add("er_money_evidence", f"WITH {_CTE.split('known AS')[0].strip().rstrip(',')} SELECT customer_id, evidence FROM money WHERE moved")
    def _(t: Inputs):
        return I.money(t.id_advances).where("moved").select("customer_id", "evidence")

    @q.add("er_screening", WITH + "SELECT customer_id, rules, is_test, blocked FROM screened WHERE rules <> ''")
    def _(t: Inputs):
        return I.classify(t.id_customers, t.id_advances).where("rules <> ''").select("customer_id", "rules", "is_test", "blocked")

    @q.add("er_proof_groups", WITH + "SELECT key, count(*) AS n, min(customer_id) AS least FROM keyed WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1")
    def _(t: Inputs):
        people = I.with_key(I.screen(t.id_customers, t.id_advances).population)
        return people.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("customer_id").alias("least")).where("n > 1")

    @q.add("er_manual_edges", WITH + "SELECT customer_id_a, customer_id_b, (customer_id_a, customer_id_b) IN (SELECT a, b FROM applied) AS applied FROM @id_manual")
    def _(t: Inputs):
        ids = I.screen(t.id_customers, t.id_advances).population.select("customer_id")
        manual = t.id_manual
        both = manual.join(ids.withColumnRenamed("customer_id", "customer_id_a"), "customer_id_a", "left_semi").join(ids.withColumnRenamed("customer_id", "customer_id_b"), "customer_id_b", "left_semi").select("customer_id_a", "customer_id_b", F.lit(True).alias("applied"))
        return manual.select("customer_id_a", "customer_id_b").join(both, ["customer_id_a", "customer_id_b"], "left").withColumn("applied", F.coalesce("applied", F.lit(False)))

    @q.add("er_manual_read", "SELECT customer_id_a, customer_id_b, decided_by FROM @id_manual")
    def _(t: Inputs):
        return t.id_manual.select("customer_id_a", "customer_id_b", "decided_by").orderBy("customer_id_a", "customer_id_b")

    @q.add("er_components", WITH + "SELECT customer_id, root FROM members")
    def _(t: Inputs):
        return _resolve(t)[1].select("customer_id", "root")

    @q.add("er_refusals", WITH + "SELECT root, reason, size FROM decided WHERE reason IS NOT NULL")
    def _(t: Inputs):
        return I.decided(_resolve(t)[1]).where("reason is not null").select("root", "reason", "size")

    @q.add("er_survivors", WITH + "SELECT root, survivor, CASE WHEN n_money = 1 THEN 'money_moved' ELSE 'freshest' END AS survivor_reason FROM decided WHERE size > 1 AND reason IS NULL")
    def _(t: Inputs):
        return I.decided(_resolve(t)[1]).where("size > 1 and reason is null").select("root", "survivor", "survivor_reason")

    @q.add("er_map", WITH + "SELECT customer_id, canonical_customer_id, is_canonical, resolution, rule, group_key, survivor_reason FROM resolved")
    def _(t: Inputs):
        return I.customer_map(*_resolve(t))

    review = """SELECT reason, group_key, customer_ids, CAST('0x' || substr(md5(customer_ids), 1, 15) AS BIGINT) AS review_id FROM (
        SELECT d.reason, d.group_key, string_agg(CAST(m.customer_id AS VARCHAR), ',' ORDER BY m.customer_id) AS customer_ids FROM members m JOIN decided d ON m.root = d.root WHERE d.reason IS NOT NULL GROUP BY d.root, d.reason, d.group_key
        UNION ALL SELECT 'test_pattern_with_money', NULL, CAST(customer_id AS VARCHAR) FROM screened WHERE blocked) x"""

    @q.add("er_review_queue", WITH + review)
    def _(t: Inputs):
        return I.review_queue(*_resolve(t))

    @q.add("er_signals", f"SELECT x.customer_id AS a, y.customer_id AS b, {_signals()} AS signals FROM @id_customers x JOIN @id_customers y ON y.customer_id = x.customer_id + 1 WHERE x.t >= 0 AND NOT x.twin")
    def _(t: Inputs):
        pairs = t.id_customers.where("t >= 0 and not twin").select(F.col("customer_id").alias("a"), (F.col("customer_id") + 1).alias("b"))
        return I.signals(pairs, t.id_customers, t.id_cards)

    guards = """SELECT 'not_empty' AS guard, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM resolved UNION ALL SELECT 'rows_equal_mirror', abs(count(*) - (SELECT count(*) FROM customer)) FROM resolved
        UNION ALL SELECT 'unique', count(*) - count(DISTINCT customer_id) FROM resolved UNION ALL SELECT 'canonical_flag', count(*) FILTER (is_canonical <> (customer_id = canonical_customer_id AND resolution <> 'excluded_test')) FROM resolved
        UNION ALL SELECT 'no_alias_of_alias', count(*) FROM resolved x JOIN resolved y ON x.canonical_customer_id = y.customer_id WHERE NOT x.is_canonical AND x.resolution <> 'excluded_test' AND NOT y.is_canonical
        UNION ALL SELECT 'parts_sum', abs(count(*) - count(*) FILTER (resolution = 'excluded_test') - count(*) FILTER (is_canonical) - count(*) FILTER (NOT is_canonical AND resolution = 'merged')) FROM resolved"""

    @q.add("er_publish_guard", WITH + guards)
    def _(t: Inputs):
        return I.publish_guards(I.customer_map(*_resolve(t)), t.customer.count())

    @q.add("agg_map_counters", WITH + "SELECT count(*) AS customers_in, count(*) FILTER (resolution = 'excluded_test') AS excluded, count(*) FILTER (resolution = 'merged' AND NOT is_canonical) AS merged_away, count(*) FILTER (is_canonical) AS canonical_out, count(*) FILTER (resolution = 'review') AS in_review FROM resolved")
    def _(t: Inputs):
        m = I.customer_map(*_resolve(t))
        test = F.col("resolution") == "excluded_test"
        return m.agg(F.count("*").alias("customers_in"), F.count_if(test).alias("excluded"), F.count_if((F.col("resolution") == "merged") & ~F.col("is_canonical")).alias("merged_away"), F.count_if("is_canonical").alias("canonical_out"), F.count_if(F.col("resolution") == "review").alias("in_review"))

    email, phone = _email("email")[1], _phone("phone")[1]

    @q.add("agg_contact_quality", f"SELECT field, status, count(*) AS n FROM (SELECT 'email' AS field, {email} AS status FROM @id_customers UNION ALL SELECT 'phone', {phone} FROM @id_customers) x GROUP BY field, status")
    def _(t: Inputs):
        rows = t.id_customers.select(F.explode(F.array(F.struct(F.lit("email").alias("field"), N.email(F.col("email"))["status"].alias("status")), F.struct(F.lit("phone").alias("field"), N.phone(F.col("phone"))["status"].alias("status")))).alias("x"))
        return rows.groupBy("x.field", "x.status").agg(F.count("*").alias("n"))

    @q.add("er_bad_contact", WITH + f"SELECT count(*) AS canonical, count(*) FILTER (c.n_email IS NULL OR {_phone('phone')[0]} IS NULL) AS with_bad_contact FROM resolved r JOIN screened c ON r.customer_id = c.customer_id WHERE is_canonical")
    def _(t: Inputs):
        m = I.customer_map(*_resolve(t)).where("is_canonical").select("customer_id").join(t.id_customers, "customer_id")
        return m.agg(F.count("*").alias("canonical"), F.count_if(~(N.is_evidence(N.email(F.col("email"))) & N.is_evidence(N.phone(F.col("phone"))))).alias("with_bad_contact"))

    @q.add(
        "er_multi_default",
        WITH + "SELECT canonical_customer_id, count(*) AS defaults, count(DISTINCT owner) AS owners, CASE WHEN count(DISTINCT owner) > 1 THEN 'merge' ELSE 'before' END AS cause FROM (SELECT r.canonical_customer_id, c.customer_id AS owner FROM @id_cards c JOIN resolved r ON c.customer_id = r.customer_id WHERE is_default AND resolution <> 'excluded_test') x GROUP BY 1 HAVING count(*) > 1",
    )
    def _(t: Inputs):
        m = I.customer_map(*_resolve(t)).where("resolution <> 'excluded_test'").select("customer_id", "canonical_customer_id")
        cards = t.id_cards.where("is_default").join(m, "customer_id").groupBy("canonical_customer_id").agg(F.count("*").alias("defaults"), F.countDistinct("customer_id").alias("owners")).where("defaults > 1")
        return cards.withColumn("cause", F.when(F.col("owners") > 1, "merge").otherwise("before"))

    @q.add("er_idempotent", "SELECT 1::INTEGER AS customer_id, 1::INTEGER AS canonical_customer_id, 'x' AS resolution, 'x' AS evidence WHERE false")
    def _(t: Inputs):
        # two committed versions
        store = _published(t, 2)
        one, two = (store.table(store.at(n), "customer_map").select("customer_id", "canonical_customer_id", "resolution", "evidence") for n in (1, 2))
        return one.exceptAll(two).unionByName(two.exceptAll(one))

    @q.add("er_published", WITH + "SELECT customer_id, canonical_customer_id, is_canonical, resolution, rule, group_key, survivor_reason, 2::BIGINT AS run_id FROM resolved")
    def _(t: Inputs):
        store = _published(t, 2)
        return store.table(store.current(), "customer_map").select("customer_id", "canonical_customer_id", "is_canonical", "resolution", "rule", "group_key", "survivor_reason", "run_id")

    coverage = "SELECT 'not in the map' AS side, customer_id FROM @id_customers WHERE customer_id NOT IN (SELECT customer_id FROM resolved) UNION ALL SELECT 'not in the mirror', customer_id FROM resolved WHERE customer_id NOT IN (SELECT customer_id FROM later)"

    @q.add("set_map_coverage", WITH.rstrip() + ", later AS (SELECT customer_id FROM @id_customers WHERE customer_id % 13 <> 4)\n" + coverage)
    def _(t: Inputs):
        # the map of a run against the mirror after a day that deleted some customers
        store = _published(t)
        return publish.coverage(store.table(store.current(), "customer_map"), t.id_customers.where("customer_id % 13 <> 4"))

    @q.add("er_identity_runs", WITH + "SELECT r.run_id, count(*) AS customers_in, count(*) FILTER (resolution = 'excluded_test') AS excluded_test, count(*) FILTER (resolution = 'merged' AND is_canonical) AS groups_formed, count(*) FILTER (resolution = 'merged' AND NOT is_canonical) AS rows_merged, count(*) FILTER (is_canonical) AS canonical_out, (SELECT count(*) FROM (" + review + ") v) AS review_rows FROM resolved, (VALUES (1::BIGINT), (2)) r(run_id) GROUP BY r.run_id")
    def _(t: Inputs):
        store = _published(t, 2)
        return store.table(store.current(), "identity_run").select("run_id", "customers_in", "excluded_test", "groups_formed", "rows_merged", "canonical_out", "review_rows")

    @q.add("er_review_history", WITH + "SELECT run_id, reason, customer_ids FROM (" + review + ") v, (VALUES (1::BIGINT), (2)) r(run_id)")
    def _(t: Inputs):
        store = _published(t, 2)
        return store.table(store.current(), "merge_review").select("run_id", "reason", "customer_ids")

    told = """SELECT e.customer_id_a, e.customer_id_b, e.decided_by, e.endpoint, CASE WHEN k.customer_id IS NULL THEN 'not in the mirror' ELSE 'excluded_test by rule ' || k.rules END AS why
        FROM (SELECT *, customer_id_a AS endpoint FROM @id_manual UNION ALL SELECT *, customer_id_b FROM @id_manual) e LEFT JOIN screened k ON e.endpoint = k.customer_id WHERE k.customer_id IS NULL OR k.is_test"""

    @q.add("er_refused_edges", WITH + told)
    def _(t: Inputs):
        return publish.refused_edges(_resolve(t)[0], t.id_manual)

    @q.add("er_truth_isolated", WITH + "SELECT count(*) AS customers, 0::BIGINT AS rows_that_differ FROM resolved")
    def _(t: Inputs):
        # resolution of customers who carry a false truth with them is the same: nothing reads it
        plain, false = (I.customer_map(s, I.grouped(s, t.id_manual)) for s in (I.screen(c, t.id_advances) for c in (t.id_customers, t.id_customers.withColumn("person_id", F.lit(1)))))
        differ = plain.exceptAll(false.select(*plain.columns)).agg(F.count("*").alias("rows_that_differ"))
        return false.agg(F.count("*").alias("customers")).crossJoin(differ)  # a row each


def _scoring(q: Catalogue) -> None:
    @q.add("sc_truth_pairs", WITH + "SELECT a, b FROM truth")
    def _(t: Inputs):
        screening, _ = _resolve(t)
        return S.truth_pairs(screening.population.select("customer_id"), t.id_truth)

    score = """SELECT (SELECT count(*) FROM keyed) AS population, (SELECT count(*) FROM proposed) AS proposed, (SELECT count(*) FROM (SELECT * FROM proposed INTERSECT SELECT * FROM truth) i) AS correct,
        (SELECT count(*) FROM (SELECT * FROM proposed EXCEPT SELECT * FROM truth) w) AS wrong, (SELECT count(*) FROM (SELECT * FROM truth EXCEPT SELECT * FROM proposed) m) AS missed"""

    @q.add("sc_score", WITH + f"SELECT *, CASE WHEN proposed = 0 THEN 0.0::DOUBLE ELSE CAST(correct AS DOUBLE) / proposed END AS precision, CASE WHEN correct + missed = 0 THEN 0.0::DOUBLE ELSE CAST(correct AS DOUBLE) / (correct + missed) END AS recall FROM ({score}) x")
    def _(t: Inputs):
        screening, members = _resolve(t)
        return S.score(S.map_pairs(I.customer_map(screening, members)), screening.population.select("customer_id"), t.id_truth)

    def ablation(label: str, v: I.Variant) -> str:
        """One variant's score; pairs that share a key, a mail or an applied edge are linked, and no more is asked of them."""
        part = lambda f, c: f"CASE WHEN {f(c)[1]} = 'valid' THEN {f(c)[0]}" + ("" if v.placeholder_gate else f" WHEN {f(c)[1]} = 'placeholder' THEN trim(CAST({c} AS VARCHAR))") + " END"
        parts = [part(_ssn, "ssn_last4"), part(_dob, "date_of_birth")] + [part(_name, "last_name")] * v.last_name + [part(_name, "first_name")] * v.first_name
        test = "coalesce(contains(lower(concat_ws(' ', first_name, last_name, email)), 'test'), false)" if v.naive_detector else "is_test"
        inside = f"NOT {test}" if v.exclude_first else "true"
        scored = "true" if v.exclude_first else "NOT is_test"
        mail = "UNION SELECT a.customer_id, b.customer_id FROM keyed a JOIN keyed b ON a.n_email = b.n_email AND a.customer_id <> b.customer_id" if v.email_proves else ""
        cte = _CTE[: _CTE.index("keyed AS")] + f"keyed AS (SELECT *, {' || chr(124) || '.join(parts)} AS key FROM screened WHERE {inside}),\n    " + _CTE[_CTE.index("applied AS") : _CTE.index("mapped AS")].rstrip().rstrip(",")
        cte = cte.replace("UNION SELECT a, b FROM applied UNION", f"{mail} UNION SELECT a, b FROM applied UNION")
        return f"""SELECT * FROM (WITH RECURSIVE {cte.strip()},
            people AS (SELECT customer_id FROM keyed WHERE {scored}),
            proposed AS (SELECT x.customer_id AS a, y.customer_id AS b FROM members x JOIN members y ON x.root = y.root AND x.customer_id < y.customer_id JOIN decided d ON d.root = x.root AND d.reason IS NULL WHERE x.customer_id IN (SELECT * FROM people) AND y.customer_id IN (SELECT * FROM people)),
            truth AS (SELECT x.customer_id AS a, y.customer_id AS b FROM @id_truth x JOIN @id_truth y ON x.person_id = y.person_id AND x.customer_id < y.customer_id WHERE x.customer_id IN (SELECT * FROM people) AND y.customer_id IN (SELECT * FROM people))
            SELECT '{label}' AS variant, *, CASE WHEN proposed = 0 THEN 0.0::DOUBLE ELSE CAST(correct AS DOUBLE) / proposed END AS precision, CASE WHEN correct + missed = 0 THEN 0.0::DOUBLE ELSE CAST(correct AS DOUBLE) / (correct + missed) END AS recall
            FROM ({score.replace("FROM keyed", "FROM people")}) z) v"""

    @q.add("sc_ablations", " UNION ALL ".join(ablation(k, v) for k, v in S.ABLATIONS.items()))
    def _(t: Inputs):
        return S.ablations(t.id_customers, t.id_advances, t.id_manual, t.id_truth)

    cause = """SELECT cause, count(*) AS n FROM (SELECT CASE WHEN x.customer_id IS NULL OR y.customer_id IS NULL THEN 'mirror gap' WHEN x.key IS NULL OR y.key IS NULL THEN 'no proof tuple' WHEN x.key <> y.key THEN 'tuples disagree'
        WHEN d.reason IS NOT NULL THEN 'refused' ELSE 'unexplained' END AS cause FROM (SELECT * FROM truth EXCEPT SELECT * FROM proposed) m LEFT JOIN members x ON m.a = x.customer_id LEFT JOIN members y ON m.b = y.customer_id LEFT JOIN decided d ON d.root = x.root) z GROUP BY cause"""

    @q.add("sc_miss_causes", WITH + cause)
    def _(t: Inputs):
        screening, members = _resolve(t)
        return S.miss_causes(I.customer_map(screening, members), members, screening.population.select("customer_id"), t.id_truth)

    apart = "concat_ws(',', " + ", ".join(f"CASE WHEN coalesce(x.{c} = y.{c}, false) THEN NULL ELSE '{k}' END" for k, c in (("ssn", "n_ssn"), ("dob", "n_dob"), ("last_name", "n_last"))) + ")"
    missed = f"""SELECT a, b, cause, CASE WHEN cause = 'refused' THEN reason WHEN cause <> 'mirror gap' THEN apart END AS blocking, signals FROM (
        SELECT m.a, m.b, CASE WHEN x.customer_id IS NULL OR y.customer_id IS NULL THEN 'mirror gap' WHEN x.key IS NULL OR y.key IS NULL THEN 'no proof tuple' WHEN x.key <> y.key THEN 'tuples disagree' WHEN d.reason IS NOT NULL THEN 'refused' ELSE 'unexplained' END AS cause,
            d.reason, {apart} AS apart, {_signals()} AS signals FROM (SELECT * FROM truth EXCEPT SELECT * FROM proposed) m LEFT JOIN members x ON m.a = x.customer_id LEFT JOIN members y ON m.b = y.customer_id LEFT JOIN decided d ON d.root = x.root) z"""

    @q.add("sc_missed_pairs", WITH + missed)
    def _(t: Inputs):
        screening, members = _resolve(t)
        found = S.missed_pairs(I.customer_map(screening, members), members, screening.population.select("customer_id"), t.id_truth)
        return found.join(I.signals(found.select("a", "b"), t.id_customers, t.id_cards), ["a", "b"])

    scored = " UNION ALL ".join(ablation(k, v) for k, v in S.ABLATIONS.items())
    naive = "coalesce(contains(lower(concat_ws(' ', first_name, last_name, email)), 'test'), false)"
    clause = lambda n, text: f"CASE WHEN {n} > 0 THEN CAST({n} AS VARCHAR) || ' {text}' END"
    words = f"concat_ws(', ', {clause('customers_lost', 'customers not scored')}, {clause('customers_gained', 'customers scored besides')}, {clause('wrong_more', 'wrong pairs more')}, {clause('-wrong_more', 'wrong pairs fewer')}, {clause('missed_more', 'true pairs lost')}, {clause('-missed_more', 'true pairs found')})"
    priced = f"""SELECT variant, customers_lost, customers_gained, wrong_more, missed_more, CASE WHEN {words} = '' THEN 'no change on these rows' ELSE {words} END AS price FROM (
        SELECT v.variant, CASE WHEN v.variant = 'naive detector' THEN p.lost ELSE 0 END AS customers_lost, CASE WHEN v.variant = 'naive detector' THEN p.gained ELSE 0 END AS customers_gained, v.wrong - s.wrong AS wrong_more, v.missed - s.missed AS missed_more
        FROM ({scored}) v, (SELECT * FROM ({scored}) u WHERE variant = 'shipped') s, (WITH RECURSIVE {_CTE.strip()} SELECT count(*) FILTER ({naive} AND NOT is_test) AS lost, count(*) FILTER (is_test AND NOT {naive}) AS gained FROM screened) p WHERE v.variant <> 'shipped') z"""

    @q.add("sc_prices", priced)
    def _(t: Inputs):
        return S.prices(*S.scored_variants(t.id_customers, t.id_advances, t.id_manual, t.id_truth))

    @q.add("sc_detector", WITH + "SELECT count(*) FILTER (naive) AS naive_flagged, count(*) FILTER (naive AND rules <> '') AS naive_right, count(*) FILTER (rules <> '') AS shipped_flagged FROM (SELECT rules, coalesce(contains(lower(concat_ws(' ', first_name, last_name, email)), 'test'), false) AS naive FROM known) x")
    def _(t: Inputs):
        return S.detector(I.classify(t.id_customers, t.id_advances))

    @q.add("sc_rerun_matches_map", "SELECT a, b FROM (SELECT 1::INTEGER AS a, 2::INTEGER AS b) x WHERE false")
    def _(t: Inputs):
        screening, members = _resolve(t)
        published = S.map_pairs(I.customer_map(screening, members))
        again = S.group_pairs_of(members)
        return published.exceptAll(again).unionByName(again.exceptAll(published))

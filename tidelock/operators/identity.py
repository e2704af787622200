"""Entity resolution: screen test accounts, group by proof, refuse or merge, and publish a map.

Screening has its own result type, which grouping takes, so that the order of
the two can't be changed by accident.  Groups are stars around their least
member, never pairs; only manual and e-mail edges between stars need components.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N
from .graph import components, written

#: Where automated accounts have their mail; of the deployment.
INTERNAL_DOMAIN = "corp.internal"
# Fixed values of the specification.
AUTOMATION_LOCAL = r"^(test|qa|demo|dev|staging|automation)[._-]?[0-9]*$"
TEST_TAG = r"^(test|qa)[._-]?[0-9]*$"
ARTIFACT_SSN, ARTIFACT_BIRTHDAY, ARTIFACT_PRINCIPALS = "0000", "1900-01-01", (0.00, 999999.99)
REASON_PATTERN, REASON_SAME, REASON_DIFFERENT = "test_pattern_with_money", "two_funded_same_instrument", "two_funded_different_instrument"


@dataclass(frozen=True)
class Variant:
    """The shipped rules, and what an ablation changes."""

    placeholder_gate: bool = True
    last_name: bool = True
    first_name: bool = False
    email_proves: bool = False
    exclude_first: bool = True
    naive_detector: bool = False
    latest_birthday: str = N.LATEST_BIRTHDAY


SHIPPED = Variant()


@dataclass(frozen=True)
class Screening:
    """Customers apart: excluded as test accounts, and the population, in which `blocked` marks those that money kept."""

    excluded: DataFrame
    population: DataFrame


def money(advances: DataFrame) -> DataFrame:
    """Per customer: moved, the evidence in order of advances, and the instruments of advances that moved money."""
    moved = N.money_has_moved(F.col("status"))
    line = F.struct("advance_id", F.concat_ws("|", F.col("advance_id").cast("string"), N.status_meaning(F.col("status")), F.trim("repayment_account_hash")).alias("line"))
    return advances.groupBy("customer_id").agg(
        F.bool_or(moved).alias("moved"), F.concat_ws(";", F.array_sort(F.collect_list(F.when(moved, line)))["line"]).alias("evidence"), F.array_sort(F.collect_set(F.when(moved, F.trim("repayment_account_hash")))).alias("instruments")
    )


def classify(customers: DataFrame, advances: DataFrame) -> DataFrame:
    """Customers with the rules that fired (A internal automation, B test tag, C artifacts), moved, is_test and blocked."""
    local, domain = N.raw_email_parts(F.col("email"))
    artifacts = advances.groupBy("customer_id").agg(F.bool_or(F.col("principal_amount").isin(*ARTIFACT_PRINCIPALS)).alias("artifact"))
    rule_a = (domain == INTERNAL_DOMAIN) & local.rlike(AUTOMATION_LOCAL)
    rule_b = N.subaddress_tag(local).rlike(TEST_TAG)
    artifact_identity = (N.strip(F.col("ssn_last4")) == ARTIFACT_SSN) & (F.col("date_of_birth") == F.lit(ARTIFACT_BIRTHDAY).cast("date"))
    rule_c = F.coalesce(artifact_identity, F.lit(False)) | F.coalesce("artifact", F.lit(False))
    out = customers.join(artifacts, "customer_id", "left").join(money(advances), "customer_id", "left")
    out = out.withColumn("moved", F.coalesce("moved", F.lit(False))).withColumn("rules", F.concat(F.when(rule_a, F.lit("A")).otherwise(F.lit("")), F.when(rule_b, F.lit("B")).otherwise(F.lit("")), F.when(rule_c, F.lit("C")).otherwise(F.lit(""))))
    fired = F.col("rules") != ""
    return out.withColumn("is_test", fired & ~F.col("moved")).withColumn("blocked", fired & F.col("moved")).drop("artifact")


def naive_detector() -> Column:
    """`test` anywhere in the names or the address, letter case ignored."""
    return F.coalesce(F.contains(F.lower(F.concat_ws(" ", "first_name", "last_name", "email")), F.lit("test")), F.lit(False))


def screen(customers: DataFrame, advances: DataFrame, variant: Variant = SHIPPED) -> Screening:
    known = classify(customers, advances)
    if not variant.exclude_first:
        return Screening(known.where("false"), known)
    test = naive_detector() if variant.naive_detector else F.col("is_test")
    return Screening(known.where(test), known.where(~test))


def with_key(people: DataFrame, variant: Variant = SHIPPED) -> DataFrame:
    """Adds key: digits, birthday and surname where all are evidence, as one text; null otherwise."""
    parts = {"_ssn": N.ssn_last4(F.col("ssn_last4")), "_dob": N.birthday(F.col("date_of_birth"), variant.latest_birthday)}
    parts |= {"_last": N.name(F.col("last_name"))} if variant.last_name else {}
    parts |= {"_first": N.name(F.col("first_name"))} if variant.first_name else {}
    people = people.withColumns(parts)  # a projection of its own, so that each is worked out once

    def part(n: Column) -> Column:
        value = F.when(N.is_evidence(n), n["normalized"])
        return value if variant.placeholder_gate else F.coalesce(value, F.when(n["status"] == N.PLACEHOLDER, F.trim(n["raw"])))

    people = people.withColumns({c: part(F.col(c)) for c in parts})
    every = F.lit(True)
    for c in parts:
        every = every & F.col(c).isNotNull()
    return people.withColumn("key", F.when(every, F.concat_ws("|", *parts))).drop(*parts)


def grouped(screening: Screening, manual: DataFrame, variant: Variant = SHIPPED) -> DataFrame:
    """The population with key, root (least member of its group), touched (by an applied manual edge) and moved."""
    people = written(with_key(screening.population, variant))
    star = people.where("key is not null").groupBy("key").agg(F.min("customer_id").alias("star"))
    people = people.join(star, "key", "left").withColumn("star", F.coalesce("star", "customer_id"))
    ids = people.select("customer_id", "star")
    edge_a = ids.select(F.col("customer_id").alias("customer_id_a"), F.col("star").alias("a"))
    edge_b = ids.select(F.col("customer_id").alias("customer_id_b"), F.col("star").alias("b"))
    applied = manual.join(edge_a, "customer_id_a").join(edge_b, "customer_id_b")
    edges = applied.select("a", "b")
    if variant.email_proves:
        mail = people.withColumn("mail", N.email(F.col("email"))).where(N.is_evidence(F.col("mail"))).select(F.col("mail.normalized").alias("mail"), "star")
        edges = edges.unionByName(mail.join(mail.groupBy("mail").agg(F.min("star").alias("b")), "mail").select(F.col("star").alias("a"), "b"))
    roots = components(edges)
    touched = applied.select(F.explode(F.array("customer_id_a", "customer_id_b")).alias("customer_id")).distinct().withColumn("touched", F.lit(True))
    people = people.join(roots.withColumnRenamed("node", "star"), "star", "left").withColumn("root", F.coalesce("root", "star"))
    # written once: refusal, survivors, map, queue and scores all start from here
    return written(people.join(touched, "customer_id", "left").withColumn("touched", F.coalesce("touched", F.lit(False))))


def decided(members: DataFrame) -> DataFrame:
    """Per group: size, money-moved members, refusal and its reason, survivor and why, key text and rule."""
    fresh = F.coalesce("updated_at", "created_at")
    groups = members.groupBy("root").agg(
        F.count("*").alias("size"), F.count_if("moved").alias("n_money"), F.max_by("customer_id", F.struct(F.col("moved"), fresh, F.negative("customer_id"))).alias("survivor"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("moved"), F.col("instruments")))))).alias("n_instruments"), F.concat_ws(" + ", F.array_sort(F.collect_set("key"))).alias("group_key"), F.bool_or("touched").alias("manual"),
    )
    return groups.withColumn("reason", F.when((F.col("size") > 1) & (F.col("n_money") > 1), F.when(F.col("n_instruments") > 1, F.lit(REASON_DIFFERENT)).otherwise(F.lit(REASON_SAME)))).withColumn(
        "survivor_reason", F.when((F.col("size") > 1) & (F.col("n_money") <= 1), F.when(F.col("n_money") == 1, F.lit("money_moved")).otherwise(F.lit("freshest")))
    )


def customer_map(screening: Screening, members: DataFrame) -> DataFrame:
    """One row a customer: canonical id, resolution, rule, group key and survivor reason."""
    text = lambda c: F.lit(c).cast("string")
    rows = members.join(decided(members), "root")
    resolution = F.when(F.col("size") == 1, "singleton").when(F.col("reason").isNotNull(), "review").otherwise("merged")
    merged = resolution == "merged"
    rows = rows.select(
        "customer_id", F.when(merged, F.col("survivor")).otherwise(F.col("customer_id")).alias("canonical_customer_id"), resolution.alias("resolution"),
        F.when(merged, F.when(F.col("manual"), F.lit("manual_merge")).otherwise(F.lit("proof_tuple"))).alias("rule"), F.when(F.col("size") > 1, F.col("group_key")).alias("group_key"), F.when(merged, F.col("survivor_reason")).alias("survivor_reason"),
    )
    out = screening.excluded.select("customer_id", F.col("customer_id").alias("canonical_customer_id"), F.lit("excluded_test").alias("resolution"), text(None).alias("rule"), text(None).alias("group_key"), text(None).alias("survivor_reason"))
    both = rows.unionByName(out)
    return both.withColumn("is_canonical", (F.col("customer_id") == F.col("canonical_customer_id")) & (F.col("resolution") != "excluded_test"))


def review_queue(screening: Screening, members: DataFrame) -> DataFrame:
    """Refusals and test patterns that money blocked: reason, customer_ids as csv, group key and a stable review_id."""
    ids = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("customer_id")), lambda x: x.cast("string"))).alias("customer_ids")
    refused = members.join(decided(members).where("reason is not null").select("root", "reason", "group_key"), "root").groupBy("root", "reason", "group_key").agg(ids).drop("root")
    blocked = screening.population.where("blocked").select(F.lit(REASON_PATTERN).alias("reason"), F.lit(None).cast("string").alias("group_key"), F.col("customer_id").cast("string").alias("customer_ids"))
    return refused.unionByName(blocked).withColumn("review_id", review_id(F.col("customer_ids")))


def review_id(csv: Column) -> Column:
    """60 bits of the MD5 of the ids."""
    return F.conv(F.substring(F.md5(csv), 1, 15), 16, 10).cast("long")


#: Members of a group that pairs are made of, at most: a group of n has n * (n - 1) / 2 of them.
PAIRED_MEMBERS = 1000


def group_pairs(table: DataFrame, group: str, member: str, most: int = PAIRED_MEMBERS) -> DataFrame:
    """Pairs a < b of members of one group; groups are families, and a larger one than `most` is an error, not a smaller answer."""
    sizes = table.groupBy(F.col(group).alias("g")).agg(F.count("*").alias("n"))
    told = F.when(F.col("n") > most, F.raise_error(F.format_string(f"group %s has %s members, which are not paired beyond {most}", F.col("g").cast("string"), F.col("n").cast("string"))).cast("boolean")).otherwise(F.col("n") > 1)
    table = table.join(sizes.where(told).select(F.col("g").alias(group)), group, "left_semi")
    a, b = table.select(F.col(group).alias("g"), F.col(member).alias("a")), table.select(F.col(group).alias("g"), F.col(member).alias("b"))
    return a.join(b, "g").where("a < b").select("a", "b")


def signals(pairs: DataFrame, customers: DataFrame, cards: DataFrame) -> DataFrame:
    """Pairs with the weak signals that agree, in fixed order; they never merge anything."""
    seen = customers.select("customer_id", N.email(F.col("email")).alias("email"), N.phone(F.col("phone")).alias("phone"), N.name(F.col("address_line1")).alias("address"), N.name(F.col("last_name")).alias("surname"))
    own = cards.where(N.strip(F.col("card_fingerprint")) != "").groupBy("customer_id").agg(F.collect_set(F.lower(N.strip(F.col("card_fingerprint")))).alias("instruments"))
    seen = seen.join(own, "customer_id", "left")
    side = lambda s: seen.select(*[F.col(c).alias(s if c == "customer_id" else f"{s}_{c}") for c in seen.columns])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    agree = lambda c: N.is_evidence(F.col(f"a_{c}")) & N.is_evidence(F.col(f"b_{c}")) & (F.col(f"a_{c}.normalized") == F.col(f"b_{c}.normalized"))
    found = [F.when(agree(c), F.lit(c)) for c in ("email", "phone", "address", "surname")] + [F.when(F.arrays_overlap("a_instruments", "b_instruments"), F.lit("card_fingerprint"))]
    return both.select("a", "b", F.concat_ws(",", *found).alias("signals"))


def publish_guards(resolved: DataFrame, mirror_rows: int) -> DataFrame:
    """The six checks that a map must pass before it is published, each with what violates it."""
    alias = resolved.where(~F.col("is_canonical") & (F.col("resolution") != "excluded_test"))
    chained = alias.join(alias.select(F.col("customer_id").alias("canonical_customer_id")), "canonical_customer_id", "left_semi")
    counts = resolved.agg(
        F.count("*").alias("n"), (F.count("*") - F.countDistinct("customer_id")).alias("twice"), F.count_if(F.col("is_canonical") != ((F.col("customer_id") == F.col("canonical_customer_id")) & (F.col("resolution") != "excluded_test"))).alias("flag"),
        F.count_if(F.col("resolution") == "excluded_test").alias("out"), F.count_if("is_canonical").alias("canonical"), F.count_if((~F.col("is_canonical")) & (F.col("resolution") == "merged")).alias("merged_away"),
    ).crossJoin(chained.agg(F.count("*").alias("chained")))
    checks = {"not_empty": F.when(F.col("n") == 0, 1).otherwise(0), "rows_equal_mirror": F.abs(F.col("n") - mirror_rows), "unique": F.col("twice"), "canonical_flag": F.col("flag"), "no_alias_of_alias": F.col("chained"), "parts_sum": F.abs(F.col("n") - F.col("out") - F.col("canonical") - F.col("merged_away"))}
    rows = F.array(*[F.struct(F.lit(k).alias("guard"), v.cast("long").alias("violations")) for k, v in checks.items()])
    return counts.select(F.inline(rows))


def bad_contacts(customers: DataFrame) -> DataFrame:
    """Customers whose e-mail or phone is no evidence."""
    return customers.where(~(N.is_evidence(N.email(F.col("email"))) & N.is_evidence(N.phone(F.col("phone")))))

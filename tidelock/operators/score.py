"""Pair-level scoring of a published map against ground truth, ablations of its rules, and why pairs were missed."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions.scalars import ratio
from . import identity as I

ABLATIONS = {
    "shipped": I.SHIPPED,
    "email proves": replace(I.SHIPPED, email_proves=True),
    "no placeholder gate": replace(I.SHIPPED, placeholder_gate=False),
    "first name added": replace(I.SHIPPED, first_name=True),
    "last name dropped": replace(I.SHIPPED, last_name=False),
    "exclusion after merging": replace(I.SHIPPED, exclude_first=False),
    "naive detector": replace(I.SHIPPED, naive_detector=True),
    "exclusion after merging, no gate": replace(I.SHIPPED, exclude_first=False, placeholder_gate=False),
}


def truth_pairs(population: DataFrame, truth: DataFrame) -> DataFrame:
    """True pairs whose members are both in the population, which each variant has its own of."""
    return I.group_pairs(truth.join(population, "customer_id", "left_semi"), "person_id", "customer_id")


def map_pairs(resolved: DataFrame) -> DataFrame:
    """Pairs that the published map merged."""
    return I.group_pairs(resolved.where("resolution = 'merged'"), "canonical_customer_id", "customer_id")


def group_pairs_of(members: DataFrame) -> DataFrame:
    """Pairs that grouping and refusal propose; survivors don't matter for them."""
    merged = I.decided(members).where("size > 1 and reason is null").select("root")
    return I.group_pairs(members.join(merged, "root", "left_semi"), "root", "customer_id")


def score(proposed: DataFrame, population: DataFrame, truth: DataFrame) -> DataFrame:
    p, t = proposed.withColumn("p", F.lit(1)), truth_pairs(population, truth).withColumn("t", F.lit(1))
    both = p.join(t, ["a", "b"], "full_outer")
    right = F.col("p").isNotNull() & F.col("t").isNotNull()
    one = both.agg(F.count("p").alias("proposed"), F.count_if(right).alias("correct"), F.count_if(F.col("t").isNull()).alias("wrong"), F.count_if(F.col("p").isNull()).alias("missed"))
    one = population.agg(F.count("*").alias("population")).crossJoin(one)  # a row each
    return one.withColumn("precision", ratio(F.col("correct"), F.col("proposed"))).withColumn("recall", ratio(F.col("correct"), F.col("correct") + F.col("missed")))


def ablations(customers: DataFrame, advances: DataFrame, manual: DataFrame, truth: DataFrame) -> DataFrame:
    """The score of every variant; their populations differ, which is a cost of its own."""
    return scored_variants(customers, advances, manual, truth)[0]


def scored_variants(customers: DataFrame, advances: DataFrame, manual: DataFrame, truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scores by variant, and the customers (variant, customer_id) that each was scored over."""
    out = people = None
    for label, variant in ABLATIONS.items():
        screening = I.screen(customers, advances, variant)
        members = I.grouped(screening, manual, variant)
        pairs, population = group_pairs_of(members), screening.population.select("customer_id")
        if not variant.exclude_first:
            population = screening.population.where("not is_test").select("customer_id")
            pairs = pairs.join(population.withColumnRenamed("customer_id", "a"), "a", "left_semi").join(population.withColumnRenamed("customer_id", "b"), "b", "left_semi")
        one = score(pairs, population, truth).select(F.lit(label).alias("variant"), "*")
        out = one if out is None else out.unionByName(one)
        here = population.select(F.lit(label).alias("variant"), "customer_id")
        people = here if people is None else people.unionByName(here)
    return out, people


def prices(scores: DataFrame, populations: DataFrame) -> DataFrame:
    """What each variant costs against the shipped rules, in pairs and in customers, and the same in words.

    populations: variant and customer_id.  A variant that is scored over other customers has changed something, even where no
    pair moved.
    """
    base = scores.where("variant = 'shipped'").select(*[F.col(c).alias(f"_{c}") for c in ("wrong", "missed")])
    shipped = populations.where("variant = 'shipped'").select("customer_id", F.lit(1).alias("s"))
    others = populations.where("variant <> 'shipped'").select("variant", "customer_id")
    kept = others.join(shipped, "customer_id", "left").groupBy("variant").agg(F.count("s").alias("common"), F.count_if(F.col("s").isNull()).alias("customers_gained"))
    kept = kept.crossJoin(F.broadcast(shipped.agg(F.count("*").alias("all")))).select("variant", "customers_gained", (F.col("all") - F.col("common")).alias("customers_lost"))  # a row
    out = scores.where("variant <> 'shipped'").crossJoin(F.broadcast(base)).join(kept, "variant", "left").fillna(0, ["customers_gained", "customers_lost"])  # a row
    out = out.withColumn("wrong_more", F.col("wrong") - F.col("_wrong")).withColumn("missed_more", F.col("missed") - F.col("_missed"))
    clause = lambda n, text: F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {text}")))
    words = F.concat_ws(
        ", ", clause(F.col("customers_lost"), "customers not scored"), clause(F.col("customers_gained"), "customers scored besides"), clause(F.col("wrong_more"), "wrong pairs more"), clause(-F.col("wrong_more"), "wrong pairs fewer"),
        clause(F.col("missed_more"), "true pairs lost"), clause(-F.col("missed_more"), "true pairs found"),
    )
    return out.select("variant", "customers_lost", "customers_gained", "wrong_more", "missed_more", F.when(words == "", "no change on these rows").otherwise(words).alias("price"))


def missed_pairs(resolved: DataFrame, members: DataFrame, population: DataFrame, truth: DataFrame) -> DataFrame:
    """Each true pair that was not proposed: its cause, which the fields that kept it apart stand behind.

    blocking: the parts of the proof that are no evidence on a side, or differ; of a refused pair the reason.
    """
    missed = truth_pairs(population, truth).subtract(map_pairs(resolved))
    proof = {"ssn": N.ssn_last4(F.col("ssn_last4")), "dob": N.birthday(F.col("date_of_birth")), "last_name": N.name(F.col("last_name"))}
    told = members.withColumns({f"_{k}": v for k, v in proof.items()})
    evidence = {k: F.when(N.is_evidence(F.col(f"_{k}")), F.col(f"_{k}.normalized")) for k in proof}
    side = lambda s: told.select(F.col("customer_id").alias(s), F.col("key").alias(f"key_{s}"), F.col("root").alias(f"root_{s}"), F.lit(True).alias(f"in_{s}"), *[v.alias(f"{k}_{s}") for k, v in evidence.items()])
    refused = I.decided(members).where("reason is not null").select(F.col("root").alias("root_a"), "reason")
    told = missed.join(side("a"), "a", "left").join(side("b"), "b", "left").join(refused, "root_a", "left")
    cause = (
        F.when(F.col("in_a").isNull() | F.col("in_b").isNull(), "mirror gap")
        .when(F.col("key_a").isNull() | F.col("key_b").isNull(), "no proof tuple")
        .when(F.col("key_a") != F.col("key_b"), "tuples disagree")
        .when(F.col("reason").isNotNull(), "refused")
        .otherwise("unexplained")
    )
    apart = F.concat_ws(",", *[F.when(~F.coalesce(F.col(f"{k}_a") == F.col(f"{k}_b"), F.lit(False)), F.lit(k)) for k in proof])
    blocking = F.when(cause == "refused", F.col("reason")).when(cause != "mirror gap", apart)
    return told.select("a", "b", cause.alias("cause"), blocking.alias("blocking"))


def miss_causes(resolved: DataFrame, members: DataFrame, population: DataFrame, truth: DataFrame) -> DataFrame:
    """Why true pairs were not proposed: the causes part all misses."""
    return missed_pairs(resolved, members, population, truth).groupBy("cause").agg(F.count("*").alias("n"))


def detector(known: DataFrame) -> DataFrame:
    """The naive detector against the shipped rules, by customers."""
    naive = I.naive_detector()
    return known.agg(F.count_if(naive).alias("naive_flagged"), F.count_if(naive & (F.col("rules") != "")).alias("naive_right"), F.count_if(F.col("rules") != "").alias("shipped_flagged"))

"""Entity resolution: screening order, refusal, survivors, and what must not change them."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidelock.operators import identity as I
from tidelock.operators import publish
from tidelock.operators import score as S
from tidelock.operators.asof import next_key
from tidelock.operators.aggregates import behind_running_max, global_rank
from tidelock.operators.graph import components
from tidelock.sources.bookkeeping import decide, decisions
from tidelock.sources.versions import Store

DAY = datetime.datetime(2024, 1, 1)
CUSTOMER = "customer_id int, first_name string, last_name string, email string, phone string, ssn_last4 string, date_of_birth date, address_line1 string, created_at timestamp_ntz, updated_at timestamp_ntz"
ADVANCE = "advance_id int, customer_id int, status string, principal_amount double, repayment_account_hash string"
MANUAL = "customer_id_a int, customer_id_b int"


def person(k, last="Okafor", ssn="4821", dob=datetime.date(1980, 5, 6), email=None, updated=None):
    return (k, "Ada", last, email or f"p{k}@post.io", None, ssn, dob, "1 Quay", DAY, updated)


def resolve(spark, people, advances=(), manual=()):
    screening = I.screen(spark.createDataFrame(people, CUSTOMER), spark.createDataFrame(list(advances), ADVANCE))
    members = I.grouped(screening, spark.createDataFrame(list(manual), MANUAL))
    return {r.customer_id: r for r in I.customer_map(screening, members).collect()}, screening, members


def test_freshest_survives_and_money_beats_fresh(spark):
    people = [person(1), person(2, " OKAFOR ", updated=DAY + datetime.timedelta(9)), person(3, ssn="9370")]
    found, *_ = resolve(spark, people)
    assert {k: r.canonical_customer_id for k, r in found.items()} == {1: 2, 2: 2, 3: 3} and found[1].survivor_reason == "freshest" and found[3].resolution == "singleton"
    found, *_ = resolve(spark, people, [(1, 1, "Paid Off", 100.0, "H1")])
    assert found[2].canonical_customer_id == 1 and found[1].survivor_reason == "money_moved"


def test_second_money_moved_member_withdraws_a_merge(spark):
    people = [person(1), person(2), person(3)]
    money = [(1, 1, "funded", 100.0, "H1 "), (2, 2, "FUNDED ", 100.0, "H1")]
    found, screening, members = resolve(spark, people, money)
    assert {r.resolution for r in found.values()} == {"review"}
    assert [(r.reason, r.customer_ids) for r in I.review_queue(screening, members).collect()] == [(I.REASON_SAME, "1,2,3")]
    _, screening, members = resolve(spark, people, [money[0], (2, 2, "funded", 100.0, "H2")])
    assert I.review_queue(screening, members).first().reason == I.REASON_DIFFERENT
    # an unknown status is no money moved, and no reason to merge less
    assert resolve(spark, people, [money[0], (2, 2, "on hold", 1.0, "H2")])[0][2].resolution == "merged"


def test_placeholders_and_nulls_never_group(spark):
    found, *_ = resolve(spark, [person(1, ssn="0000"), person(2, ssn="0000"), person(3, ssn=None), person(4, ssn=None)])
    assert {r.resolution for r in found.values()} == {"singleton"}


def test_screening(spark):
    people = [person(1, email="qa.7@corp.internal"), person(2, email="ada+test@post.io"), person(3, email="TEST@corp.internal"), person(4, "Testerman"), person(5, email="tester@corp.internal", ssn="1357")]
    found, screening, _ = resolve(spark, people, [(9, 3, "funded", 5.0, "H")])
    assert {k for k, r in found.items() if r.resolution == "excluded_test"} == {1, 2}
    assert [r.customer_id for r in screening.population.where("blocked").collect()] == [3]
    artifact, *_ = resolve(spark, [person(1)], [(1, 1, "declined", 999999.99, "H")])
    assert artifact[1].resolution == "excluded_test"


def test_manual_edges_apply_only_within_the_population(spark):
    people = [person(1), person(2, ssn=None), person(3, email="x+test@post.io", ssn="2468")]
    found, *_ = resolve(spark, people, manual=[(1, 2), (1, 3), (2, 77)])
    assert found[2].canonical_customer_id == found[1].canonical_customer_id and found[1].rule == "manual_merge" and found[3].resolution == "excluded_test"


def test_order_of_rows_does_not_matter(spark):
    people = [person(k, ssn=f"{(k // 3 * 37) % 10000:04d}") for k in range(1, 30)]
    one, two = resolve(spark, people)[0], resolve(spark, people[::-1])[0]
    assert one == two


def test_guards_find_a_bad_map(spark):
    good, screening, members = resolve(spark, [person(1), person(2)])
    table = I.customer_map(screening, members)
    assert {r.violations for r in I.publish_guards(table, 2).collect()} == {0}
    bad = {r.guard: r.violations for r in I.publish_guards(table.unionByName(table.limit(1)), 2).collect()}
    assert bad["unique"] == 1 and bad["rows_equal_mirror"] == 1


def test_components_of_chains_and_loops(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_next_key_across_buckets(spark):
    left = spark.createDataFrame([(i, v) for i, v in enumerate([0, 5, 5, 11, 999, None, 7])], "i int, v long")
    keys = spark.createDataFrame([(k,) for k in (5, 8, 40, 900)], "k long")
    got = {r.i: r.n for r in next_key(left, "v", keys, "k", "n", bucket_keys=4).collect()}
    assert got == {0: 5, 1: 5, 2: 5, 3: 40, 4: None, 5: None, 6: 8}


def test_running_max_and_rank_across_buckets(spark):
    rows = spark.createDataFrame([(k, (k * 7) % 10) for k in range(30)], "k long, v long")
    got = {r.k for r in behind_running_max(rows, "k", "v", bucket=4).collect()}
    top, late = -1, set()
    for k in range(30):
        late |= {k} if (k * 7) % 10 < top else set()
        top = max(top, (k * 7) % 10)
    assert got == late
    assert {r.k: r.place for r in global_rank(rows.select("k"), "k", descending=True).collect()} == {k: 30 - k for k in range(30)}


def test_signals_keep_their_order(spark):
    people = spark.createDataFrame([(1, "A", "Ek", "h@post.io", "712-555-0133", None, None, "1 Quay", DAY, None), (2, "B", "EK ", "H@post.io", "(712) 555 0133", None, None, "1  quay", DAY, None)], CUSTOMER)
    cards = spark.createDataFrame([(1, "FP1 "), (2, "fp1")], "customer_id int, card_fingerprint string")
    row = I.signals(spark.createDataFrame([(1, 2)], "a int, b int"), people, cards).first()
    assert row.signals == "email,phone,address,surname,card_fingerprint"
    assert I.signals(spark.createDataFrame([(1, 2)], "a int, b int"), people.withColumn("email", F.lit("n/a")), cards).first().signals == "phone,address,surname,card_fingerprint"


@pytest.fixture
def tables(spark):
    people = [person(1), person(2), person(3, ssn="9370"), person(4, email="x+test@post.io", ssn="2468"), person(5, email="qa@corp.internal", ssn="1357")]
    manual = spark.createDataFrame([(1, 3, "desk"), (3, 4, "desk"), (2, 77, "lead")], "customer_id_a int, customer_id_b int, decided_by string")
    return spark.createDataFrame(people, CUSTOMER), spark.createDataFrame([(9, 5, "funded", 5.0, "H"), (8, 1, "paid off", 7.0, "K")], ADVANCE), manual


def test_a_resolution_is_published_whole_with_its_evidence(spark, tables, tmp_path):
    store = Store(spark, f"file://{tmp_path}/m")
    for day in (1, 2):
        now = publish.resolve(store, *tables, DAY + datetime.timedelta(day))
    found = {r.customer_id: r for r in store.table(now, "customer_map").collect()}
    assert {k: r.resolution for k, r in found.items()} == {1: "merged", 2: "merged", 3: "merged", 4: "excluded_test", 5: "singleton"}
    assert found[1].evidence == "8|paid_off|K" and found[4].evidence == "rules B" and found[2].evidence is None and {(r.run_id, r.resolved_at) for r in found.values()} == {(2, DAY + datetime.timedelta(2))}
    assert {(r.customer_id_a, r.endpoint, r.decided_by, r.why) for r in store.table(now, "manual_refused").collect()} == {(3, 4, "desk", "excluded_test by rule B"), (2, 77, "lead", "not in the mirror")}
    runs = {r.run_id: r for r in store.table(now, "identity_run").collect()}
    assert set(runs) == {1, 2} and (runs[2].customers_in, runs[2].excluded_test, runs[2].groups_formed, runs[2].rows_merged, runs[2].canonical_out, runs[2].review_rows, runs[2].manual_decisions_applied, runs[2].manual_decisions_refused) == (5, 1, 1, 2, 2, 1, 1, 2)
    assert sorted((r.run_id, r.customer_ids, r.evidence) for r in store.table(now, "merge_review").collect()) == [(1, "5", "5: 9|funded|H"), (2, "5", "5: 9|funded|H")]
    # a rerun takes the place of its run alone, and older versions stay
    again = publish.resolve(store, *tables, DAY, run_id=2)
    assert sorted(r.run_id for r in store.table(again, "identity_run").collect()) == [1, 2] == sorted(r.run_id for r in store.table(again, "merge_review").collect())
    assert {r.run_id for r in store.table(store.at(1), "customer_map").collect()} == {1}


def test_recorded_decisions_reach_a_resolution(spark, tables, tmp_path):
    store = Store(spark, f"file://{tmp_path}/m")
    assert decisions(store).count() == 0
    decide(store, 5, 3, "desk", DAY), decide(store, 3, 5, "lead", DAY, "again")
    assert [(r.customer_id_a, r.customer_id_b, r.decided_by, r.note) for r in decisions(store).collect()] == [(3, 5, "lead", "again")]
    now = publish.resolve(store, *tables[:2], decisions(store).select(*tables[2].columns), DAY)
    assert {r.customer_id: r.rule for r in store.table(now, "customer_map").collect()}[3] == "manual_merge"
    assert {(r.side, r.customer_id) for r in publish.coverage(store.table(now, "customer_map").where("customer_id <> 2"), tables[0].where("customer_id <> 4")).collect()} == {("not in the map", 2), ("not in the mirror", 4)}


def test_a_map_that_breaks_a_guard_is_not_published(spark, tables, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/m")
    before = publish.resolve(store, *tables, DAY)
    whole = publish.map_rows
    monkeypatch.setattr(publish, "map_rows", lambda *a: whole(*a).where("customer_id <> 3"))
    with pytest.raises(publish.PublishRefused, match="rows_equal_mirror"):
        publish.resolve(store, *tables, DAY)
    assert store.current() == before


def test_birthdays_after_the_day_of_a_run_are_no_evidence(spark):
    people = [person(1, dob=datetime.date(2027, 1, 1)), person(2, dob=datetime.date(2027, 1, 1))]
    tables = spark.createDataFrame(people, CUSTOMER), spark.createDataFrame([], ADVANCE), spark.createDataFrame([], MANUAL)
    for latest, merged in (("2026-12-31", 0), ("2027-06-01", 1)):
        variant = I.Variant(latest_birthday=latest)
        members = I.grouped(I.screen(*tables[:2], variant), tables[2], variant)
        assert I.decided(members).where("size > 1").count() == merged


def test_missed_pairs_name_what_kept_them_apart_and_ablations_their_price(spark):
    people = [person(1), person(2, ssn="9370"), person(3, "Ek", ssn=None), person(4, "Ek"), person(5, "Tester", ssn="2468")]
    truth = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c")], "customer_id int, person_id string")
    found, screening, members = resolve(spark, people)
    table = I.customer_map(screening, members)
    missed = S.missed_pairs(table, members, screening.population.select("customer_id"), truth)
    assert {(r.a, r.b): (r.cause, r.blocking) for r in missed.collect()} == {(1, 2): ("tuples disagree", "ssn"), (3, 4): ("no proof tuple", "ssn")}
    tables = spark.createDataFrame(people, CUSTOMER), spark.createDataFrame([], ADVANCE), spark.createDataFrame([], MANUAL)
    prices = {r.variant: r for r in S.prices(*S.scored_variants(*tables, truth)).collect()}
    assert prices["naive detector"].price == "1 customers not scored" and prices["first name added"].price == "no change on these rows"


def test_a_group_too_large_to_pair_is_an_error(spark):
    rows = spark.createDataFrame([(1, k) for k in range(6)] + [(2, 9)], "g int, m int")
    assert I.group_pairs(rows, "g", "m", most=6).count() == 15
    with pytest.raises(Exception, match="6 members, which are not paired beyond 5"):
        I.group_pairs(rows, "g", "m", most=5).count()

"""Incremental runs, their guards, and streams, on small versions of a source."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelock.operators import aggregates as A
from tidelock.operators import apply as P
from tidelock.operators import checks as C
from tidelock.operators import churn as H
from tidelock.operators import scenario as S
from tidelock.operators.asof import next_key
from tidelock.sources.bookkeeping import create_schema, require
from tidelock.sources.capture import Snapshot, net_ops
from tidelock.sources.manifest import CHANGE_FEED, HIGH_WATER, Manifest, TableSpec
from tidelock.sources.versions import Store
from tidelock.streaming.microbatch import mirror_stream

PEOPLE = TableSpec("people", ("id", "name"), ("id",), CHANGE_FEED)
LEDGER = TableSpec("ledger", ("entry", "cents"), ("entry",), HIGH_WATER, "entry", True)
MANIFEST = Manifest((PEOPLE, LEDGER))


def source(spark, version, people, ledger, log, fingerprint="a|1"):
    return Snapshot(
        spark, version, fingerprint, {"people": spark.createDataFrame(people, "id int, name string, secret string"), "ledger": spark.createDataFrame(ledger, "entry long, cents long")}, {"people": spark.createDataFrame(log, "version int, _op string, id int")}
    )


def rows(store, name):
    return sorted(tuple(r) for r in store.table(store.current(), name).select(*MANIFEST[name].columns).collect())


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/mirror")


def test_runs_replay_and_guards(spark, store):
    first = source(spark, 1, [(1, "ada", "x"), (2, "bo", "x"), (3, "cy", "x")], [(1, 10), (2, 20)], [])
    version, stats = P.load(first, store, MANIFEST)
    assert [(s.table, s.mode, s.rows_read, s.watermark_after) for s in stats] == [("people", "full_snapshot", 3, 1), ("ledger", "high_water", 2, 2)]
    assert rows(store, "people") == [(1, "ada"), (2, "bo"), (3, "cy")]  # the secret column is not listed, so it is not read
    # one update, one delete, one insert, one that comes and goes, two appended entries
    log = [(2, "U", 1), (2, "D", 2), (3, "I", 4), (2, "I", 9), (3, "D", 9)]
    second = source(spark, 3, [(1, "ada l", "x"), (3, "cy", "x"), (4, "di", "x")], [(1, 10), (2, 20), (3, 30), (5, 50)], log)
    _, stats = P.load(second, store, MANIFEST)
    assert [(s.mode, s.rows_read, s.inserted, s.updated, s.deleted) for s in stats] == [("change_feed", 3, 1, 1, 1), ("high_water", 2, 2, 0, 0)]
    assert rows(store, "people") == [(1, "ada l"), (3, "cy"), (4, "di")] and rows(store, "ledger") == [(1, 10), (2, 20), (3, 30), (5, 50)]
    # a replay reads nothing and changes nothing
    _, stats = P.load(second, store, MANIFEST)
    assert [s.rows_read for s in stats] == [0, 0] and store.current().watermarks == {"people": 3, "ledger": 5}
    # the retained log starts after the mark: that table alone is reloaded
    late = source(spark, 9, [(1, "ada l", "x"), (7, "gil", "x")], [(1, 10), (2, 20), (3, 30), (5, 50)], [(8, "I", 7), (9, "D", 3)])
    _, stats = P.load(late, store, MANIFEST)
    assert [(s.mode, s.rows_read) for s in stats] == [("full_snapshot", 2), ("high_water", 0)] and "older" in stats[0].notes
    assert rows(store, "people") == [(1, "ada l"), (7, "gil")]
    # another incarnation: everything from the start
    _, stats = P.load(source(spark, 1, [(5, "eve", "x")], [], [], "b|1"), store, MANIFEST)
    assert [(s.mode, s.rows_read, s.watermark_after) for s in stats] == [("full_snapshot", 1, 1), ("high_water", 0, 0)]
    assert rows(store, "people") == [(5, "eve")] and rows(store, "ledger") == []
    assert store.table(store.current(), "_load_run").count() == 10
    # every older version is as it was
    assert sorted(tuple(r) for r in store.table(store.at(1), "people").collect()) == [(1, "ada"), (2, "bo"), (3, "cy")] and store.table(store.at(1), "ledger").count() == 2


def test_a_failed_run_leaves_nothing_to_see(spark, store):
    P.load(source(spark, 1, [(1, "ada", "x")], [(1, 10)], []), store, MANIFEST)
    before = store.current()
    broken = source(spark, 2, [(1, "ada", "x")], [(1, 10), (2, 20), (2, 21)], [])
    with pytest.raises(ValueError, match="twice"):
        P.load(broken, store, MANIFEST)
    assert store.current() == before and rows(store, "ledger") == [(1, 10)]


def test_two_writers_cannot_both_commit(spark, store, monkeypatch):
    old = store.current()
    store.commit(old, run_id=1)
    with pytest.raises(RuntimeError):
        store.commit(old, run_id=2)
    # the other writer comes between the look and the rename
    now = store.current()
    monkeypatch.setattr(store, "current", lambda: now)
    store.commit(now, run_id=3)
    with pytest.raises(RuntimeError, match="no longer current"):
        store.commit(now, run_id=4)
    monkeypatch.undo()
    assert (store.current().number, store.current().run_id) == (2, 3)


class Killed(Exception):
    pass


@pytest.mark.parametrize("dies_at", ["append people", "append ledger", "append _load_run", "before the rename"])
def test_a_killed_run_changes_nothing_and_the_next_one_works(spark, store, monkeypatch, dies_at):
    first = source(spark, 1, [(1, "ada", "x"), (2, "bo", "x")], [(1, 10), (2, 20)], [])
    P.load(first, store, MANIFEST)
    later = source(spark, 2, [(1, "ada l", "x"), (2, "bo", "x"), (3, "cy", "x")], [(1, 10), (2, 20), (3, 30)], [(2, "U", 1), (2, "I", 3)])

    def die(method, when):
        whole = getattr(Store, method)

        def dying(self, name, *args, **kwargs):
            out = whole(self, name, *args, **kwargs)
            if name == when:
                raise Killed
            return out

        monkeypatch.setattr(Store, method, dying)

    if dies_at == "before the rename":
        monkeypatch.setattr(Store, "_publish", lambda *_: (_ for _ in ()).throw(Killed()))
    else:
        die("merge" if dies_at == "append people" else "append", dies_at.split()[1])
    with pytest.raises(Killed):
        P.load(later, store, MANIFEST)
    monkeypatch.undo()
    assert store.numbers() == [1] and rows(store, "people") == [(1, "ada"), (2, "bo")] and rows(store, "ledger") == [(1, 10), (2, 20)]
    _, stats = P.load(later, store, MANIFEST)
    assert [(s.rows_read, s.inserted, s.updated) for s in stats] == [(2, 1, 1), (1, 1, 0)]
    assert rows(store, "people") == [(1, "ada l"), (2, "bo"), (3, "cy")] and rows(store, "ledger") == [(1, 10), (2, 20), (3, 30)]
    assert store.table(store.at(1), "ledger").count() == 2 and store.numbers() == [1, 2]


def test_a_merge_writes_only_the_buckets_that_it_touches(spark, store):
    table = spark.createDataFrame([(k, f"n{k}") for k in range(400)], "id int, name string")
    entry = store.write_keyed("t", table, ["id"], 400, bucket_rows=10)
    delta = spark.createDataFrame([("U", 7, "new"), ("D", 8, None), ("I", 900, "more")], "_op string, id long, name string")
    done = store.merge("t", entry, delta, lambda old, d: P.merge(old, d, ["id"]))
    assert entry["buckets"] == done.buckets == 40 and 1 <= done.rewritten <= 3
    assert sum(done.entry["at"][b] != f for b, f in entry["at"].items()) <= 3 and done.before.count() < 60
    got = {r.id: r.name for r in store.read(done.entry).collect()}
    assert got == {k: f"n{k}" for k in range(400) if k not in (7, 8)} | {7: "new", 900: "more"}
    assert store.read(entry).count() == 400


def test_reset_and_schema(spark, store):
    P.load(source(spark, 1, [(1, "ada", "x")], [(1, 10)], []), store, MANIFEST)
    now = P.reset(store, "people")
    assert set(now.tables) == {"ledger", "_load_run"} and set(now.watermarks) == {"ledger"}
    assert create_schema(store).number == now.number + 1 and create_schema(store).number == now.number + 1
    assert store.table(store.current(), "customer_map").columns[:2] == ["customer_id", "canonical_customer_id"]
    with pytest.raises(LookupError, match="nothing, people"):
        require(store.current(), "people", "ledger", "nothing")
    assert set(P.reset(store).tables) == {"_load_run"}


def test_sums_keep_fractions_and_hold_large_ids(spark):
    rows = spark.createDataFrame([(4 * 10**18 + k, Decimal("2.20")) for k in range(4)], "id long, amount decimal(12,2)")
    other = rows.withColumn("amount", F.when(F.col("id") == 4 * 10**18, F.lit(Decimal("2.95"))).otherwise(F.col("amount")).cast("decimal(12,2)"))
    told = {(r.column_name, r.label): r.verdict for r in C.value_parity(rows, other).collect()}
    assert told["amount", "sum"] == C.FAIL and told["id", "sum"] == C.PASS
    assert A.key_scalars(rows, "id").first().key_sum == str(16 * 10**18 + 6) and {r.kind for r in C.key_parity(rows, other, "id").collect()} == {"matched"}
    assert A.frozen_sums(rows, "id", 5 * 10**18, ["amount"]).first().sum_amount == "8.80"


def test_next_key_of_points_far_below(spark):
    left, keys = spark.createDataFrame([(-(10**15),), (5,), (10,), (11,), (None,)], "v long"), spark.createDataFrame([(10,), (3,)], "k long")
    assert {r.v: r.n for r in next_key(left, "v", keys, "k", "n").collect()} == {-(10**15): 3, 5: 10, 10: 10, 11: None, None: None}
    assert {r.n for r in next_key(left, "v", keys.limit(0), "k", "n").collect()} == {None}


def test_update_and_insert_from(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, y int")
    changed = P.update_from(rows, spark.createDataFrame([(1, None), (9, "z")], "k int, x string"), ["k"])
    assert sorted(map(tuple, P.insert_from(changed, spark.createDataFrame([(2, "no", 0), (3, "c", 3)], "k int, x string, y int"), ["k"]).collect())) == [(1, None, 1), (2, "b", 2), (3, "c", 3)]


def test_watermark_race_loses_what_commits_late(spark, store):
    rows = spark.createDataFrame([(1, 10, 1), (2, 20, 1), (3, 50_000, 2), (4, 40, 1), (5, 50, 2)], "entry long, cents long, visible_at int")
    lost = H.watermark_race(rows, LEDGER, "visible_at", store)
    assert [tuple(r) for r in lost.collect()] == [(3, 50_000)] and store.current().watermarks == {"ledger": 5}


def test_days_of_churn_reach_the_mirror(spark, tmp_path):
    src, mirror = (Store(spark, f"file://{tmp_path}/{n}") for n in ("source", "mirror"))
    people = spark.createDataFrame([(k, f"n{k}", "x") for k in range(3000)], "id int, name string, secret string")
    H.seed(src, {"people": people, "ledger": spark.createDataFrame([(k, k) for k in range(2000)], "entry long, cents long")}, MANIFEST)
    reads = []
    for day in range(4):
        _, stats = P.load(Snapshot.of(src), mirror, MANIFEST, bucket_rows=50)
        reads.append(sum(s.rows_read for s in stats))
        for name in MANIFEST.names:
            there, here = (s.table(s.current(), name) for s in (src, mirror))
            assert not there.exceptAll(here.select(*there.columns)).count() and there.count() == here.count()
        if day < 2:
            H.churn(src, MANIFEST, {"people": "name"}, {})
    assert reads[0] == 5000 and 0 < reads[1] < 500 and reads[3] == 0
    assert {r._op for r in src.table(src.current(), "_changes_people").collect()} == {"I", "U", "D"}
    # a mark that the shortened log can't answer reloads its table
    H.churn(src, MANIFEST, {"people": "name"}, {}), H.churn(src, MANIFEST, {"people": "name"}, {})
    H.forget_changes(src, MANIFEST, 4)
    _, stats = P.load(Snapshot.of(src), mirror, MANIFEST)
    assert stats[0].mode == "full_snapshot" and "older" in stats[0].notes
    with pytest.raises(ValueError, match="missing"):
        H.set_values(src, MANIFEST["people"], spark.createDataFrame([(-5, "nobody")], "id int, name string"))


def test_net_ops(spark):
    log = spark.createDataFrame([(1, "U", 1), (2, "D", 1), (1, "I", 2), (2, "U", 2), (1, "D", 3), (2, "I", 3), (1, "I", 4), (2, "D", 4)], "version int, _op string, id int")
    assert {r.id: r._op for r in net_ops(log, ["id"]).collect()} == {1: "D", 2: "I", 3: "U"}


def test_manifest_tells_all_faults_at_once():
    with pytest.raises(ValueError, match="no way to read.*has no key.*listed twice"):
        TableSpec("t", ("a", "a"), (), "guess")


def test_manifest_refuses():
    with pytest.raises(ValueError):
        TableSpec("t", ("a",), ("b",), CHANGE_FEED)
    with pytest.raises(ValueError):
        TableSpec("t", ("a",), ("a",), HIGH_WATER, "b")
    with pytest.raises(ValueError):
        TableSpec("t", ("a;drop",), ("a;drop",), CHANGE_FEED)
    assert MANIFEST.unmanaged(["people", "tmp_backup"]) == ["tmp_backup"]


def test_break_rewrite_is_seen_and_swap_is_not(spark):
    table = spark.createDataFrame([(k, 100 * k) for k in range(1, 40)], "entry long, cents long")
    picked = S.pick_rows(table, "entry", "cents", 30).collect()
    assert [r.entry for r in picked] == [1, 2] and sum(S.REWRITES) != 0
    rewritten = S.rewrite(table, "entry", "cents", dict(zip([r.entry for r in picked], S.REWRITES, strict=True)))
    swapped = S.swap(table, "entry", "cents", 3, 7)
    card = lambda other: C.run_scorecard({"ledger": other}, {"ledger": table}, {"ledger": "entry"}, {"ledger": 39}, [])
    assert card(rewritten).verdict == C.FAIL and card(rewritten).exit_code == 1
    assert card(swapped).verdict == C.PASS and C.value_diff(table, swapped, "entry", "cents").count() == 2
    assert C.Scorecard().verdict == C.PASS


def test_netted_keys_do_not_cancel(spark):
    source, mirror = (spark.createDataFrame([(k,) for k in ks], "k long") for ks in ([1, 2, 3], [1, 2, 4]))
    assert {r.kind: r.n for r in C.key_parity(source, mirror, "k").collect()} == {"matched": 2, "missing": 1, "extra": 1}


@pytest.mark.parametrize(("source", "mirror", "verdict"), [([1, 2, 3], [1, 2, 3], C.PASS), ([1, 3], [1, 3], C.DIRTY), ([1, 2, 2], [1, 2, 2], C.FAIL), ([1, 2, 3], [1, 2], C.FAIL), ([], [], C.PASS)])
def test_contiguity(spark, source, mirror, verdict):
    a, b = (spark.createDataFrame([(k,) for k in ks], "k long") for ks in (source, mirror))
    assert C.contiguity(a, b, "k", 0, 10).first().verdict == verdict


def test_stream_mirrors_once(spark, store, tmp_path):
    schema = "user long, seq long, what string"
    feed = str(tmp_path / "feed")
    spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (1, 3, "c")], schema).coalesce(1).write.parquet(feed)
    run = lambda: mirror_stream(spark, feed, spark.createDataFrame([], schema).schema, store, "people", "user", "seq", str(tmp_path / "cp")).awaitTermination()
    run()
    # late and newer rows arrive together; the late one must not win
    spark.createDataFrame([(1, 2, "late"), (2, 9, "new"), (3, 4, "d")], schema).coalesce(1).write.mode("append").parquet(feed)
    run(), run()
    got = sorted(tuple(r) for r in store.table(store.current(), "people").select("user", "seq", "what").collect())
    assert got == [(1, 3, "c"), (2, 9, "new"), (3, 4, "d")]


def test_constraint_audit(spark):
    child = spark.createDataFrame([(1, 5), (1, 6), (2, None)], "k int, p int")
    found = {r.rule: r.violations for r in P.violations(child, ["k"], ["p"], {"k": [1]}, {"p": (spark.createDataFrame([(5,)], "id int"), "id")}).collect()}
    assert found == {"primary_key": 1, "not_null_p": 1, "check_k": 1, "foreign_key_p": 1}

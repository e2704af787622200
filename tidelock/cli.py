"""Commands over a source and a mirror of it.

    python -m tidelock.cli build TABLES SOURCE    a source that can change, as a store, from a folder of Parquet tables
    python -m tidelock.cli churn SOURCE N         N days of changes in it
    python -m tidelock.cli load SOURCE MIRROR     one incremental run; SOURCE may be a folder of tables, too
    python -m tidelock.cli check SOURCE MIRROR    the scorecard; exit code 1 if something failed
    python -m tidelock.cli break SOURCE MIRROR    rewrites two old rows, then swaps two, and restores each: what the checks see
    python -m tidelock.cli runs MIRROR            the run log
    python -m tidelock.cli reset MIRROR [TABLE..] forgets tables and their marks
    python -m tidelock.cli resolve TABLES MIRROR  resolves the derived population and publishes the map
    python -m tidelock.cli decide MIRROR A B WHO  records that customers A and B are one person
    python -m tidelock.cli score TABLES           precision and recall, ablations and what each costs
    python -m tidelock.cli demo TABLES FOLDER     four runs and resolutions with two days of churn, checks and breaks

TIDELOCK_TRANSCRIPTS names a folder for copies of what commands print.
"""

from __future__ import annotations

import os
import sys
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import checks, churn, identity, publish, scenario, score
from .operators.apply import RunStats, load, reset
from .operators.graph import written
from .plans.registry import Inputs
from .sources.bookkeeping import create_schema, decide, decisions, require
from .sources.capture import Snapshot
from .sources.gateway import connect
from .sources.manifest import CHANGE_FEED, MANIFEST
from .sources.settings import Settings
from .sources.versions import Store, Version
from .transcript import transcript


def session() -> SparkSession:
    return SparkSession.builder.appName("tidelock").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def open_source(spark: SparkSession, settings: Settings) -> Snapshot:
    """The source at one version: that of a store, or all listed tables of a folder, whose fingerprint is the folder; waits as settings say."""

    def open_() -> Snapshot:
        store = Store(spark, settings.source)
        if store.numbers():
            return Snapshot.of(store)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(settings.source)
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            raise FileNotFoundError(settings.source)
        return Snapshot(spark, 1, settings.source, {s.name: spark.read.parquet(f"{settings.source}/{s.name}.parquet") for s in settings.manifest().tables})

    return connect(open_, settings.unreachable_seconds, settings.refused_seconds)


# reports, of frames with a row a table, check, variant or day


def format_runs(stats: list[RunStats]) -> str:
    head = f"{'table':<12}{'mode':<16}{'read':>10}{'inserted':>10}{'updated':>10}{'deleted':>10}{'KiB':>12}{'mark':>12}{'buckets':>12}"
    rows = [
        f"{s.table:<12}{s.mode:<16}{s.rows_read:>10}{s.inserted:>10}{s.updated:>10}{s.deleted:>10}{s.payload_bytes / 1024:>12.1f}{str(s.watermark_after):>12}{f'{s.buckets_rewritten}/{s.buckets}':>12}  {s.notes}".rstrip()
        for s in stats
    ]
    total = f"{'TOTAL':<28}{sum(s.rows_read for s in stats):>10}{sum(s.inserted for s in stats):>10}{sum(s.updated for s in stats):>10}{sum(s.deleted for s in stats):>10}{sum(s.payload_bytes for s in stats) / 1024:>12.1f}"
    return "\n".join([head, *rows, total])


def format_card(card: checks.Scorecard) -> str:
    return "\n".join([*(f"{v:<14}{c:<40}{d}".rstrip() for c, v, d in card.outcomes), f"{card.verdict}: {checks.BLIND_SPOT}"])


def format_rows(df: DataFrame) -> str:
    """A small frame with aligned columns."""
    rows = [[*df.columns], *([("" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v)) for v in r] for r in df.collect())]
    widths = [max(len(r[k]) for r in rows) for k in range(len(df.columns))]
    return "\n".join("  ".join(v.ljust(w) for v, w in zip(r, widths, strict=True)).rstrip() for r in rows)


def format_resolution(store: Store, version: Version) -> str:
    """The last run's counters, its review queue by reason, and the manual decisions that it could not apply."""
    last = store.table(version, "identity_run").orderBy(F.desc("run_id")).limit(1)
    run_id = last.first().run_id
    queue = store.table(version, "merge_review").where(F.col("run_id") == run_id).groupBy("reason").agg(F.count("*").alias("rows")).orderBy("reason")
    return "\n\n".join(format_rows(x) for x in (last, queue, store.table(version, "manual_refused").orderBy("customer_id_a", "customer_id_b")))


# commands


def scorecard(snapshot: Snapshot, store: Store) -> checks.Scorecard:
    version = store.current()
    mirror = {s.name: df for s in MANIFEST.tables if (df := store.table(version, s.name)) is not None}
    keys = {s.name: s.key[0] for s in MANIFEST.tables}
    marks = {s.name: version.watermarks[s.name] for s in MANIFEST.tables if s.strategy != CHANGE_FEED and s.name in version.watermarks}
    relations = [("orders", "o_custkey", "customer", "c_custkey")] if {"orders", "customer"} <= set(mirror) else []
    return checks.run_scorecard(snapshot.tables, mirror, keys, marks, relations)


def break_demo(source: Store, mirror: Store) -> bool:
    """Rewrites two old rows of the source, which no run reads and the checks must see; swaps two values, which no aggregate
    can see; restores each and reads again.  Whether all of it went as it must."""
    spec, key, value = MANIFEST["events"], "event_id", "user_id"
    require(mirror.current(), spec.name)
    mark = mirror.current().watermarks[spec.name]
    picked = scenario.pick_rows(Snapshot.of(source).tables[spec.name], key, value, mark).collect()
    was = dict(map(tuple, picked))
    (a, x), (b, y) = was.items()
    kind = source.table(source.current(), spec.name).select(key, value).schema
    set_to = lambda rows: churn.set_values(source, spec, source.spark.createDataFrame(list(rows.items()), kind))
    went = True
    rewritten = {k: v + by for (k, v), by in zip(was.items(), scenario.REWRITES, strict=True)}
    for what, rows, seen in (("rewrite", rewritten, True), ("swap", {a: y, b: x}, False)):
        set_to(rows)
        _, stats = load(Snapshot.of(source), mirror, MANIFEST)
        read, verdict = sum(s.rows_read for s in stats), scorecard(Snapshot.of(source), mirror).verdict
        differ = checks.value_diff(Snapshot.of(source).tables[spec.name], mirror.table(mirror.current(), spec.name), key, value).count()
        set_to(was)
        restored = scorecard(Snapshot.of(source), mirror).verdict
        print(f"{what}: a run reads {read} rows, the checks say {verdict}, {differ} rows differ; restored, they say {restored}")
        went &= read == 0 and (verdict == checks.FAIL) == seen and differ == 2 and restored != checks.FAIL
    return went


def resolve(spark: SparkSession, tables: str, mirror: str, at: datetime | None = None) -> Store:
    store, t = Store(spark, mirror), Inputs(spark, tables)
    recorded = decisions(store).select(*[F.col(c).cast("int").alias(c) for c in ("customer_id_a", "customer_id_b")], "decided_by")
    publish.resolve(store, t.id_customers, t.id_advances, t.id_manual.unionByName(recorded).dropDuplicates(["customer_id_a", "customer_id_b"]), at or datetime.now(timezone.utc).replace(tzinfo=None))
    return store


def demo(spark: SparkSession, tables: str, folder: str) -> int:
    """Builds a source and runs load and resolution four times: at the start, after a day, after another, and once more with
    nothing new, which must read nothing; then the scorecard, the breaks and the score."""
    source, mirror, began = Store(spark, f"{folder}/source"), Store(spark, f"{folder}/mirror"), time.time()
    churn.seed(source, {s.name: spark.read.parquet(f"{tables}/{s.name}.parquet") for s in MANIFEST.tables}, MANIFEST)
    create_schema(mirror)
    for run in range(4):
        _, stats = load(Snapshot.of(source), mirror, MANIFEST)
        print(format_runs(stats))
        resolve(spark, tables, mirror.root)
        if run < 2:
            churn.churn(source, MANIFEST)
    read = sum(s.rows_read for s in stats)
    print(f"a replay read {read} rows")
    print(format_resolution(mirror, mirror.current()))
    card = scorecard(Snapshot.of(source), mirror)
    print(format_card(card))
    went = break_demo(source, mirror)
    print(format_score(spark, tables))
    print(f"{time.time() - began:.0f} s")
    return int(card.verdict == checks.FAIL or not went or read != 0)


def format_score(spark: SparkSession, tables: str) -> str:
    t = Inputs(spark, tables)
    screening = identity.screen(t.id_customers, t.id_advances)
    resolved = identity.customer_map(screening, identity.grouped(screening, t.id_manual))
    scores, people = map(written, score.scored_variants(t.id_customers, t.id_advances, t.id_manual, t.id_truth))
    shipped = score.score(score.map_pairs(resolved), screening.population.select("customer_id"), t.id_truth)
    return "\n\n".join(format_rows(x) for x in (shipped, scores, score.prices(scores, people)))


def main(args: list[str]) -> int:
    needs = {"build": 2, "churn": 2, "load": 2, "check": 2, "break": 2, "runs": 1, "reset": 1, "resolve": 2, "decide": 4, "score": 1, "demo": 2}
    if not args or args[0] not in needs or len(args) <= needs[args[0]]:
        print(__doc__)
        return 2
    with transcript(args[0], os.environ.get("TIDELOCK_TRANSCRIPTS")):
        return run(session(), *args)


def run(spark: SparkSession, command: str, *args: str) -> int:
    settings = Settings.from_env(source=args[0], mirror=args[-1])
    mirror = Store(spark, settings.mirror)
    if command == "build":
        churn.seed(mirror, {s.name: spark.read.parquet(f"{args[0]}/{s.name}.parquet") for s in MANIFEST.tables}, MANIFEST)
    elif command == "churn":
        for _ in range(int(args[1])):
            print(f"version {churn.churn(Store(spark, args[0]), MANIFEST).number}")
    elif command == "load":
        print(format_runs(load(open_source(spark, settings), mirror, settings.manifest())[1]))
    elif command == "check":
        card = scorecard(open_source(spark, settings), mirror)
        print(format_card(card))
        return card.exit_code
    elif command == "break":
        return int(not break_demo(Store(spark, args[0]), mirror))
    elif command == "runs":
        require(mirror.current(), "_load_run")
        print(format_rows(mirror.table(mirror.current(), "_load_run").orderBy("run_id", "table_name")))
    elif command == "reset":
        reset(Store(spark, args[0]), *args[1:])
    elif command == "decide":
        decide(Store(spark, args[0]), int(args[1]), int(args[2]), args[3], datetime.now(timezone.utc).replace(tzinfo=None))
    elif command == "resolve":
        store = resolve(spark, args[0], settings.mirror)
        print(format_resolution(store, store.current()))
    elif command == "score":
        print(format_score(spark, args[0]))
    else:
        return demo(spark, args[0], args[1])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

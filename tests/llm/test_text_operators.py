"""Substring dedup, decontamination, quality, near-duplicates and toxicity against brute force, with awkward rows."""

import random
import zlib

import numpy as np
import pytest

from tidelock.llm import boosting, components, decontaminate, neardup, quality, substring, toxicity
from tidelock.llm import textvec as tv
from tidelock.llm.shared import Scratch

from . import brute

WORDS = [f"{a}{b}" for a in ("ka", "mo", "ti", "re", "su", "lö", "IN", "Za") for b in ("n", "ra", "lle", "st", "o", "9")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def awkward(seed=1):
    """Documents with nulls, empty and very long texts, ties, copies and near copies; doc_ids are unique."""
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "é漢字 ﬁ\x00\x1c x"), (8, prose(rng, 6000)), (-5, "one")]
    base = [prose(rng, 120) for _ in range(4)]
    for k, text in enumerate(base):
        rows += [(100 * k + 10 + j, edited(rng, text, j % 6)) for j in range(12)] + [(100 * k + 40 + j, text if j else text.upper()) for j in range(3)]
    rows += [(900 + j, prose(rng, 3) + "\n" + base[0][:400] + "\n" + prose(rng, 20)) for j in range(3)]
    rng.shuffle(rows)
    return rows


def test_word_and_window_hashes_tell_texts_apart():
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(0, 30)) for _ in range(200)]
    data = [t.encode() for t in texts]
    buf, offsets = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    runs = tv.Runs(buf, offsets, tv.SPACED)
    words = [buf[a:b].tobytes().decode() for a, b in zip(runs.starts, runs.ends)]
    assert words == [w for t in texts for w in brute.SPACED.findall(t)]
    hashes = tv.span_hashes(buf, runs.starts, runs.ends)
    assert len(set(hashes.tolist())) == len(set(words)) == len(set(zip(words, hashes.tolist())))
    at, text = tv.window_starts(runs.first, runs.count, 3)
    windows = [tuple(words[k : k + 3]) for k in at]
    assert len(set(windows)) == len(set(zip(windows, tv.window_hashes(hashes, 3)[at].tolist())))


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, make_docs, words, percent):
    rows = awkward()
    found = neardup.near_duplicates(make_docs(rows).repartition(3), neardup.Rule(words, percent), Scratch(spark, "t")).collect()
    want = brute.components(rows, words, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {i: (len(brute.shingles(t, words)), want[i], want[i] == i) for i, t in rows}


def test_near_duplicates_of_one_large_group_in_small_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 700)
    rng = random.Random(5)
    base = prose(rng, 90)
    rows = [(k, edited(rng, base, k % 9)) for k in range(70)] + [(200 + k, edited(rng, edited(random.Random(k // 4), base, 14), k % 3)) for k in range(24)]
    found = neardup.near_duplicates(make_docs(rows), neardup.Rule(3, 85), Scratch(spark, "t")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.components(rows, 3, 85)


def test_near_duplicates_take_few_tasks_where_shuffles_have_many_partitions(spark, make_docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 700)
    rng = random.Random(6)
    base = prose(rng, 90)
    rows = [(k, edited(rng, base, k % 9)) for k in range(70)] + [(200 + k, edited(rng, edited(random.Random(k // 4), base, 14), k % 3)) for k in range(24)]
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    sc = spark.sparkContext
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        sc.setJobGroup("few-tasks", "near-duplicates")
        found = neardup.near_duplicates(make_docs(rows), neardup.Rule(3, 85), Scratch(spark, "t")).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    assert {r.doc_id: r.component_id for r in found} == brute.components(rows, 3, 85)
    status = sc.statusTracker()
    stages = {k for job in status.getJobIdsForGroup("few-tasks") for k in status.getJobInfo(job).stageIds}
    tasks = sum(stage.numCompletedTasks for stage in map(status.getStageInfo, stages) if stage)
    assert tasks < 60 * 16, tasks


@pytest.mark.parametrize("few", [0, 1000])
def test_components_settled_at_once_or_in_rounds(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_EDGES", few)
    rng = random.Random(7)
    chain = [(k, k + 1) for k in range(40)]
    rng.shuffle(chain)
    edges = chain + [(k, 900) for k in range(500, 530)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(90)] + [(7, 7), (950, 950), (3, 4), (4, 3), (2**62, -5)]
    least = {x: x for edge in edges if edge[0] != edge[1] for x in edge}
    for _ in least:
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    run = lambda rows, name: components.components(spark.createDataFrame(rows, "a long, b long"), Scratch(spark, "t"), name)
    found = run(edges, "g").collect()
    assert len(found) == len(least) and {r.node: r.root for r in found} == least
    assert run([(7, 7)], "loop").collect() == run([], "none").collect() == []
    assert {(r.node, r.root) for r in run([(2, 1), (3, 1), (9, 8)], "stars").collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}


def test_near_duplicates_with_components_in_rounds(spark, make_docs, monkeypatch):
    monkeypatch.setattr(components, "FEW_EDGES", 0)
    rows = awkward()
    found = neardup.near_duplicates(make_docs(rows).repartition(3), neardup.Rule(3, 85), Scratch(spark, "t")).collect()
    want = brute.components(rows, 3, 85)
    assert {r.doc_id: (r.component_id, r.kept) for r in found} == {i: (want[i], want[i] == i) for i, t in rows}


def test_near_duplicates_of_repeated_and_null_ids_and_empty_tables(spark, make_docs):
    run = lambda rows: sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(make_docs(rows), neardup.Rule(3, 85), Scratch(spark, "t")).collect()), key=str)
    assert run([(None, "a b c d"), (None, "a b c d"), (4, "a b c d"), (3, "a b c d"), (3, "a b c d")]) == sorted([(None, None, True)] * 2 + [(4, 3, False)] + [(3, 3, True)] * 2, key=str)
    assert run([]) == []


def test_near_duplicates_of_one_id_with_several_texts(spark, make_docs):
    a, b, c = "one two three four five six", "seven eight nine ten eleven", "twelve words of another kind here"
    rows = [(5, a), (5, b), (5, b), (5, c), (3, a), (9, b), (9, c + " x"), (8, "one two three four five  SIX"), (None, a), (6, None), (6, "")]
    docs, scratch = make_docs(rows).selectExpr("*", "'r' as row", "'t' as touched", "'h' as text_hash"), Scratch(spark, "t")
    found = scratch.keep(neardup.near_duplicates(docs, neardup.Rule(3, 60), scratch), "found")
    assert len(found.collect()) == len(rows)
    out = neardup.keep_firsts(docs, found)
    assert out.columns == docs.columns
    # the text a is kept by 3, b by 5 and c by 5: three documents, two of which share an id; both texts of 6 have no words
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert len(left) == 5 and {(3, a), (5, b), (5, c), (None, a)} < set(left)
    assert {(r.doc_id, r.component_id, r.kept) for r in found.collect()} == {(5, 3, False), (5, 5, True), (3, 3, True), (9, 5, False), (8, 3, False), (None, None, True), (6, 6, True)}


def test_near_duplicate_classes_with_very_many_copies(spark, make_docs, monkeypatch):
    monkeypatch.setattr(neardup, "HOT_CLASSES", 10)
    rows = [(k, "the same text in a third of all rows") for k in range(40)] + [(100 + k, f"row {k} on its own with words {k * k}") for k in range(60)] + [(300, None)]
    found = neardup.near_duplicates(make_docs(rows), neardup.Rule(3, 85), Scratch(spark, "t")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.components(rows, 3, 85)


def test_odd_sketches_estimate_high_similarity():
    rng = np.random.default_rng(0)
    for similar in (1.0, 0.95, 0.85, 0.5):
        a = rng.integers(0, 2**63, 4000).astype(np.uint64)
        n = int(2000 * similar)
        union = 2 * 2000 - n
        pair = [np.sort(a[:2000]), np.sort(np.concatenate((a[:n], a[2000:union])))]
        samples = neardup.min_samples(np.concatenate(pair), np.array([0, 2000, 4000]), 160)
        s = neardup.odd_sketches(samples)
        apart = int(np.bitwise_count(s[0] ^ s[1]).sum())
        true = n / union
        if true >= 0.85:
            assert apart < neardup.Rule(3, 85).refused_from()
        if true < 0.4:
            assert apart >= neardup.Rule(3, 85).refused_from() - 20


def test_substring_dedup(spark, make_docs):
    rows = awkward(2)
    found = substring.repeated_passages(make_docs(rows).repartition(3), Scratch(spark, "t"), least_words=12)
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end, r.n_words, r.n_units, r.first_doc_id))
    want = {i: p for i, p in brute.passages(rows, 12).items() if p}
    assert {i: sorted(p) for i, p in got.items()} == want and len(want) > 20
    cut = {r.doc_id: r.text for r in substring.remove_passages(make_docs(rows), found).collect()}
    assert cut == {i: t if i not in want else brute.without(t, [p[:2] for p in want[i]]) for i, t in rows}
    # the second time there is nothing left to remove
    again = substring.repeated_passages(substring.remove_passages(make_docs(rows), found), Scratch(spark, "t"), least_words=60)
    assert again.count() == 0


def test_substring_dedup_of_repeated_rows_null_ids_and_empty_tables(spark, make_docs):
    long = "alpha beta gamma delta. epsilon zeta eta theta. iota kappa lambda mu. "
    run = lambda rows: sorted(tuple(r) for r in substring.repeated_passages(make_docs(rows), Scratch(spark, "t"), 10).select("doc_id", "start", "n_words", "first_doc_id").collect())
    assert run([(1, long), (1, long), (2, long), (2, long)]) == [(2, 0, 12, 1)]
    assert run([(None, long), (None, long), (7, long)]) == [] and run([]) == []
    assert run([(3, long + long)]) == [(3, len(long), 12, 3)]
    two = make_docs([(1, long), (2, long), (2, "other " + long)])
    texts = sorted(r.text for r in substring.remove_passages(two, substring.repeated_passages(two, Scratch(spark, "t"), 8)).collect())
    assert texts == sorted([long, "", "other alpha beta gamma delta. "])


def test_substring_dedup_of_runs_within_sentences(spark, make_docs):
    rng = random.Random(6)
    plain = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(n))
    rows, cut = [], {}
    for k, n in enumerate([49, 50, *range(51, 61)]):
        passage = plain(n)
        rows.append((k, f"{plain(7)} {passage} {plain(9)}"))
        before, after = plain(11), plain(13)
        rows.append((100 + k, f"{before} {passage.replace('n', 'N').replace(' ', ', ')} {after}"))
        cut[100 + k] = f"{before}  {after}" if n > 50 else rows[-1][1]
    rows += [(200, "x " * 102), (201, "ab cd " * 60), (202, plain(60) * 2), (203, None), (204, "")]
    found = substring.passages(make_docs(rows).repartition(3), Scratch(spark, "t")).collect()
    spans = {}
    for r in found:
        spans.setdefault(r.doc_id, []).append((r.first_word, r.first_word + r.n_words))
    want = brute.repeated_words(rows, 51)
    assert {i: {k for a, b in s for k in range(a, b)} for i, s in spans.items()} == {i: hit for i, hit in want.items() if hit}
    assert sorted(spans) == [*range(102, 112), 200, 201, 202]
    docs = make_docs(rows)
    texts = {r.doc_id: r.text for r in substring.remove_passages(docs, substring.passages(docs, Scratch(spark, "t"))).collect()}
    assert {i: t for i, t in texts.items() if i in cut} == cut


def test_substring_dedup_removes_every_later_unit_if_asked_to(spark, make_docs):
    rows = awkward(3)
    found = Scratch(spark, "t").keep(substring.repeated_passages(make_docs(rows), Scratch(spark, "t"), least_words=1), "found")
    want = {i: p for i, p in brute.passages(rows, 1).items() if p}
    cut = {r.doc_id: r.text for r in substring.remove_passages(make_docs(rows), found).collect()}
    assert cut == {i: t if i not in want else brute.without(t, [p[:2] for p in want[i]]) for i, t in rows}
    assert any(p[2] < substring.LEAST_WORDS for found_here in want.values() for p in found_here)


def test_substring_dedup_of_grams_at_many_places(spark, make_docs):
    rows = awkward(5)
    source = substring._source(make_docs(rows).repartition(3))
    few, many = (sorted(map(tuple, substring._repeated_runs(source, Scratch(spark, "t"), hot).collect())) for hot in (10**6, 2))
    assert few == many and few


def test_substring_dedup_leaves_clashing_columns_alone(spark, make_docs):
    long = "alpha beta gamma delta. epsilon zeta eta theta. iota kappa lambda mu. "
    docs = make_docs([(1, long), (2, "Ä " + long + "é"), (None, long), (3, None)]).selectExpr("*", "doc_id as id", "'r' as row", "'c' as cut", "array(7) as cuts", "'v' as version", "'t' as `_versions`")
    out = substring.remove_passages(docs, substring.repeated_passages(docs, Scratch(spark, "t"), 8))
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text) for r in out.collect()} == {(1, long), (2, "Ä alpha beta gamma delta. é"), (None, long), (3, None)}
    assert all((r.row, r.cut, r["_versions"]) == ("r", "c", "t") for r in out.collect())


def test_substring_dedup_leaves_no_repeated_window(spark, make_docs):
    rows = awkward(4)
    docs = make_docs(rows)
    found = substring.passages(docs.repartition(3), Scratch(spark, "t"))
    spans = {}
    for r in found.collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.end, r.first_word, r.first_word + r.n_words))
    runs, whole = brute.repeated_words(rows, 51), brute.passages(rows, substring.LEAST_WORDS)
    words = {i: list(brute.ALNUM.finditer((t or "").translate(brute.LOWER))) for i, t in rows}
    for i, text in rows:
        want = runs[i] | {k for a, b, *_ in whole[i] for k, w in enumerate(words[i]) if a <= w.start() < b}
        here = sorted(spans.get(i, []))
        assert {k for *_, a, b in here for k in range(a, b)} == want
        assert all(x[1] <= y[0] for x, y in zip(here, here[1:])) and all(a <= words[i][k].start() and words[i][m - 1].end() <= b for a, b, k, m in here)
    assert sum(map(len, runs.values())) > 1000


ITEMS = [(1, "What is the height of the tower that stands by the old river gate today"), (2, "short one"), (3, None), (4, "..."), (5, "the height of the tower that stands by the old river"), (12, "Короткий тест")]


@pytest.mark.parametrize("per_pass", [200_000, 15])
def test_decontamination(spark, make_docs, per_pass):
    rng = random.Random(7)
    exact = "what is THE height, of the tower that stands by the old river gate today"
    rows = [(1, None), (2, ""), (3, exact), (4, prose(rng, 40) + " " + exact + " " + exact), (5, "height of the tower that stands by the old river gate"), (6, "Short, one? short two one short one"), (7, "x короткий-тест y"), (8, prose(rng, 3000)), (9, " ".join(exact.split()[:9])), (10, "short")]
    benchmark = spark.createDataFrame(ITEMS + [(1, ITEMS[0][1])], "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as n_hit")
    found = decontaminate.find_contamination(make_docs(rows).repartition(2), benchmark, Scratch(spark, "t"), phrases_per_pass=per_pass)
    got = {r.doc_id: (r.n_words, r.n_hit, set(r["items"])) for r in found.collect()}
    want = brute.contamination(rows, ITEMS)
    assert got == {i: (n, len(hit), items) for i, (n, hit, items) in want.items()} and len(want[4][1]) == 30
    texts = {r.doc_id: r.text for r in decontaminate.remove_spans(make_docs(rows), found).collect()}
    left = brute.contamination(texts.items(), ITEMS)
    assert all(len(left[i][1]) == 0 and left[i][0] == n - len(hit) for i, (n, hit, _) in want.items())
    assert all(texts[i] == t for i, t in rows if not want[i][1])


def test_decontamination_of_repeated_rows_and_empty_tables(spark, make_docs):
    docs, items = make_docs([(1, "short one"), (1, "short one"), (1, "clean"), (None, "short one")]), spark.createDataFrame(ITEMS, "item_id long, text string")
    for per_pass in (200_000, 10):
        got = decontaminate.find_contamination(docs, items, Scratch(spark, "t"), phrases_per_pass=per_pass)
        assert sorted((str(r.doc_id), r.n_hit) for r in got.collect()) == [("1", 0), ("1", 2), ("1", 2), ("None", 2)]
        assert sorted(r.text for r in decontaminate.remove_spans(docs, got).collect()) == ["", "", "", "clean"]
    assert decontaminate.find_contamination(make_docs([]), items, Scratch(spark, "t")).count() == 0
    assert decontaminate.find_contamination(docs, items.limit(0), Scratch(spark, "t")).where("n_hit > 0").count() == 0


def test_decontamination_searches_items_without_an_id(spark, make_docs):
    items = spark.createDataFrame([(None, "one two three"), (None, None), (None, "Four five"), (4, "four five")], "item_id long, text string")
    docs = make_docs([(1, "x one two three y"), (2, "four five z"), (3, "clean")])
    for per_pass in (200_000, 2):
        found = decontaminate.find_contamination(docs, items, Scratch(spark, "t"), phrases_per_pass=per_pass)
        assert sorted((r.doc_id, r.n_hit, r["items"]) for r in found.collect()) == [(1, 3, []), (2, 2, ["4"]), (3, 0, [])]
        assert sorted(r.text for r in decontaminate.remove_spans(docs, found).collect()) == sorted(["x  y", " z", "clean"])


def test_decontamination_in_one_pass_or_more_leaves_the_same_texts(spark, make_docs):
    rng = random.Random(8)
    exact = ITEMS[0][1]
    rows = [(1, None), (2, ""), (None, "é " + exact), (3, prose(rng, 30) + " " + exact + ". é " + exact + " z"), (3, "clean"), (3, "clean"), (4, prose(rng, 500))]
    docs = make_docs(rows).selectExpr("*", "'a' as _spans", "1 as _id", "'b' as _md5", "'r' as row", "2 as id", "'c' as cut", "'d' as of")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    one, many = (decontaminate.remove_contamination(docs, items, Scratch(spark, "t"), phrases_per_pass=n) for n in (200_000, 15))
    assert one.columns == many.columns == docs.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    left = [r.text for r in one.collect()]
    assert len(left) == len(rows) and all(not hit for _, hit, _ in brute.contamination(enumerate(left), ITEMS).values())


def test_fm_index_against_search():
    rng = np.random.default_rng(1)
    for n in (1, 5, 70, 900):
        ids = rng.integers(0, 4, n)
        ids[-1] = 0
        index = decontaminate.FMIndex(ids, sample_every=5)
        phrases = np.zeros((60, 4), np.int64)
        lengths = rng.integers(1, 5, 60)
        for row, k in enumerate(lengths):
            phrases[row, 4 - k :] = rng.integers(1, 6, k)
        lo, hi = index.search(phrases, lengths)
        for row, k in enumerate(lengths):
            p = phrases[row, 4 - k :]
            want = [at for at in range(n - k + 1) if (ids[at : at + k] == p).all()]
            assert sorted(index.locate(np.arange(lo[row], hi[row])).tolist()) == want


def labelled(spark, rng):
    good = [(k, " ".join(rng.choice(WORDS) for _ in range(60)) + ".") for k in range(80)]
    bad = [(100 + k, " ".join(rng.choice(WORDS) + "###" for _ in range(60))) for k in range(60)]
    return good + bad, spark.createDataFrame([(i, int(i < 100), int(i % 7 == 0)) for i, _ in good + bad] + [(None, 1, 1), (7777, 0, 0)], "doc_id long, quality int, toxic int")


def test_quality(spark, make_docs):
    rng = random.Random(11)
    rows, labels = labelled(spark, rng)
    rows = rows + [(500 + k, t) for k, (_, t) in enumerate(awkward(4))] + [(900, "a b c d e f g h " * 5), (901, "x y\nx y\n \n\nx y"), (901, "twice"), (None, "null id")]
    docs = make_docs(rows)
    model = quality.train(docs, labels)
    got = sorted(([str(r.doc_id), *tuple(r)[1:7]], r.kept) for r in quality.judge(docs, model).collect())
    assert [g for g, _ in got] == sorted([str(i), *brute.base_statistics(t)] for i, t in rows)
    kept = {g[0] for g, k in got if k}
    assert {str(i) for i in range(80)} <= kept and not {str(100 + i) for i in range(60)} & kept
    assert sorted(str(r.doc_id) for r in quality.keep_documents(docs, model).collect()) == sorted(g[0] for g, k in got if k)
    assert quality.judge(make_docs([]), model).count() == 0 and quality.train(docs, labels.limit(0)) is None
    assert quality.judge(docs, None).where("kept = base_failed").count() == 0


def test_quality_takes_the_least_of_a_documents_labels_and_one_of_its_texts(spark, make_docs):
    rng = random.Random(12)
    rows, labels = labelled(spark, rng)
    more = spark.createDataFrame([(k, 1, 0) for k in range(100, 160)] + [(k, 0, 0) for k in range(10)], "doc_id long, quality int, toxic int")
    trained = [quality.train(make_docs(r), l) for r, l in ((rows, labels.unionByName(more)), (rows[::-1] + rows[:30] * 3, more.unionByName(labels)))]
    x = rng_features = np.random.default_rng(1).random((50, len(quality.FEATURES)))
    assert (trained[0].probabilities(x) == trained[1].probabilities(rng_features)).all()


def test_trees_are_monotone_and_flat():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.random(3000) > 0.7).astype(float)
    model = boosting.fit(x, y, np.array([1, 0, -1]))
    assert ((model.probabilities(x) > 0.5) == y).mean() > 0.93
    steps = np.repeat(rng.random((50, 3))[:, None], 40, axis=1)
    for feature, sign in ((0, 1), (2, -1)):
        moved = steps.copy()
        moved[:, :, feature] = np.linspace(0, 1, 40)
        scores = model.scores(moved.reshape(-1, 3)).reshape(50, 40)
        assert (sign * np.diff(scores, axis=1) >= -1e-9).all()
    free = boosting.fit(x, 1 - y, np.array([1, 0, 0]))
    assert np.ptp(free.scores(np.column_stack((np.linspace(0, 1, 50), np.full(50, 0.5), np.full(50, 0.5))))) < 1e-9


def test_toxicity(spark, make_docs):
    """A lexicon that the code can't know, half of it with endings, and toxic texts by a word that clean ones have, too."""
    rng = random.Random(13)
    text = lambda extra: " ".join(rng.choice(WORDS) for _ in range(30)) + " " + extra
    kinds = ["you glurbig", "snarvel-{}", "mild mild", "", "mild" , "", "", ""]
    toxic = lambda k: k % 8 < 3 and not (k % 8 == 2 and k % 3 == 0)
    rows = [(k, text(kinds[k % 8].format(rng.choice(["ung", "end", "te"])))) for k in range(1600)]
    labels = spark.createDataFrame([(k, int(toxic(k))) for k in range(1000)] + [(7, 0), (None, 1), (9999, 1), (0, 1), (3, None)], "doc_id long, toxic int")
    docs = make_docs(rows + [(None, None), (5000, ""), (5001, "Glurbig!"), (5001, "Glurbig!")])
    chain = toxicity.train(docs, labels, Scratch(spark, "t"))
    got = toxicity.judge(docs, chain).collect()
    found = {r.doc_id: r for r in got}
    held_out = [(found[k].toxic, toxic(k)) for k in range(1000, 1600) if k % 8 != 2 and k % 8 != 4]
    assert np.mean([a == b for a, b in held_out]) > 0.97 and len(got) == 1604
    assert found[1000].p_marked > 0.5 > found[1000].p_unmarked and found[1001].p_marked > 0.5 and found[5001].toxic and not found[5000].toxic
    assert [len(m.weights) - len(chain.keys) for m in chain.models] == [0, 1, 2]  # each sees the categories before it
    assert toxicity.train(docs, labels.where("toxic = 0"), Scratch(spark, "t")) is None and toxicity.judge(docs, None).where("toxic").count() == 0
    assert toxicity.judge(make_docs([]), chain).count() == 0
    # rows that repeat a labelled document change nothing
    again = toxicity.train(make_docs(rows + rows[:50] * 4), labels.unionByName(labels), Scratch(spark, "t"))
    assert (again.keys == chain.keys).all() and all((a.weights == b.weights).all() for a, b in zip(again.models, chain.models))


def test_chain_by_hand():
    """Probabilities of a chain with given weights, one feature and category after another."""
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 2**63, 6).astype(np.uint64))
    models = [toxicity.Linear(rng.normal(size=6 + k), float(rng.normal())) for k in range(3)]
    chain = toxicity.Chain(toxicity.CATEGORIES, keys, models)
    has = rng.integers(0, 2, (9, 6))
    text, column = np.nonzero(has)
    got = chain.probabilities(np.concatenate((keys[column], keys[column][:4], [np.uint64(1)])), np.concatenate((text, text[:4], [0])), 9)
    for t in range(9):
        before = []
        for m in models:
            score = m.bias + sum(m.weights[j] for j in range(6) if has[t, j]) + sum(m.weights[6 + k] * p for k, p in enumerate(before))
            before.append(1 / (1 + np.exp(-score)))
        assert np.allclose(got[t], before)


def test_chain_chooses_features_without_the_fold_that_it_predicts():
    docs, toxic = np.array([[4, 4], [0, 0], [9, 1]]).T[0], np.array([4, 0, 9])
    all_of, without = toxicity.Choice.of(docs, toxic, 100, 20), toxicity.Choice.of(np.zeros(3, int), np.zeros(3, int), 80, 16)
    assert all_of.chosen.tolist() == [True, False, True] == all_of.markers.tolist() and not without.chosen.any()
    rng = np.random.default_rng(4)
    label = rng.random(400) < 0.3
    fold = np.arange(400) % toxicity.FOLDS
    # a feature that stands in toxic texts of the first fold only: no model that predicts that fold may know it
    has = [np.array([0]) if label[k] and fold[k] == 0 else np.zeros(0, int) for k in range(400)]
    counts = np.array([[sum(len(h) for h, f in zip(has, fold) if f == g) for g in range(toxicity.FOLDS)]])
    choices = [toxicity.Choice.of(counts.sum(1), counts.sum(1), 400, label.sum())]
    for f in range(toxicity.FOLDS):
        rest = np.arange(toxicity.FOLDS) != f
        choices.append(toxicity.Choice.of(counts[:, rest].sum(1), counts[:, rest].sum(1), (fold != f).sum(), label[fold != f].sum()))
    assert choices[0].chosen[0] and not choices[1].chosen[0] and choices[2].chosen[0]
    chain = toxicity.fit_chain(np.array([7], np.uint64), choices, has, label, fold)
    assert len(chain.models) == 3 and chain.models[0].weights[0] > 0


def test_hashes_have_no_structural_collisions():
    for n in (64, 128, 1024, 4096):
        word = np.array([bin(k).count("1") % 2 for k in range(n)], np.uint8) + 97
        both = np.concatenate((word, 195 - word))
        hashes = tv.span_hashes(both, np.array([0, n]), np.array([n, 2 * n]))
        assert hashes[0] != hashes[1]
        words = tv.splitmix(both.astype(np.uint64))
        windows = tv.window_hashes(words, n)
        assert windows[0] != windows[n] and len(windows) == n + 1


def test_hashing_bytes_is_stable():
    assert zlib.crc32(tv.span_hashes(np.frombuffer(b"abc", np.uint8), np.array([0]), np.array([3])).tobytes()) == zlib.crc32(tv.span_hashes(np.frombuffer(b"xabc", np.uint8), np.array([1]), np.array([4])).tobytes())

"""The pipeline's stages one by one against brute force on the smallest tables, and as a whole."""

import collections
import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tidelock.llm import decontaminate, quality, substring, tokens  # noqa: E402
from tidelock.llm.shared import Scratch  # noqa: E402

from . import brute  # noqa: E402
from .test_file_operators import check_packing  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows before, rows after) of each stage, written and read like a run does."""
    scratch, docs, out = Scratch(spark, "stages"), spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = scratch.keep(stage(spark, docs, SF), name)
        out[name] = (docs.collect(), after.collect(), after.columns)
        docs = after
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_order_and_columns(stages):
    assert list(stages) == ["quality_rules", "near_duplicates", "substring_dedup", "benchmark_decontamination", "packing"]
    assert all(c == COLUMNS for n, (_, _, c) in stages.items() if n != "packing")


def test_quality_stage(spark, stages):
    before, after, _ = stages["quality_rules"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in quality.judge(docs, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).where("kept").collect()}
    assert set(texts(after)) == kept and all(not brute.base_statistics(r.text)[-1] for r in after)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r.doc_id for r in before if labels.get(r.doc_id) == 1 and not brute.base_statistics(r.text)[-1]]
    assert sum(i in kept for i in good) >= 0.97 * len(good)


def test_near_duplicate_stage(stages):
    before, after, _ = stages["near_duplicates"]
    roots = brute.components(list(texts(before).items()), 5, 80)
    assert texts(after) == {i: t for i, t in texts(before).items() if roots[i] == i}


def test_substring_stage(stages):
    before, after, _ = stages["substring_dedup"]
    docs = list(texts(before).items())
    runs, whole = brute.repeated_words(docs, substring.RUN_WORDS), brute.passages(docs, substring.LEAST_WORDS)
    assert texts(after) == {i: brute.without(t, brute.spans_to_remove(t, runs[i], whole[i])) for i, t in docs}
    assert all(r.n_chars == len(r.text) for r in after)


def test_substring_stage_leaves_no_repeated_run(stages):
    before, after, _ = stages["substring_dedup"]
    docs = list(texts(before).items())
    runs, whole = brute.repeated_words(docs, substring.RUN_WORDS), brute.passages(docs, substring.LEAST_WORDS)
    words = {i: list(brute.ALNUM.finditer((t or "").translate(brute.LOWER))) for i, t in docs}
    for i, _ in docs:
        gone = runs[i] | {k for a, b, *_ in whole[i] for k, w in enumerate(words[i]) if a <= w.start() < b}
        assert brute.ALNUM.findall(texts(after)[i].translate(brute.LOWER)) == [w[0] for k, w in enumerate(words[i]) if k not in gone]
    assert any(runs.values()) and all(r.n_chars == len(r.text) for r in after)


def test_decontamination_stage(spark, stages):
    before, after, _ = stages["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want, left = brute.contamination(texts(before).items(), items), brute.contamination(texts(after).items(), items)
    assert {i: n - len(hit) for i, (n, hit, _) in want.items()} == {i: n for i, (n, _, _) in left.items()}
    assert all(texts(after)[i] == t for i, t in texts(before).items() if not want[i][1])
    assert decontaminate.WINDOW_WORDS == 10


def test_packing_stage(stages):
    before, after, _ = stages["packing"]
    check_packing(after, texts(before), "word_bpe_49k.json", 1, 2048)
    assert tokens.CUTS["word_bpe_49k.json"] == "dropped"


def test_run_is_the_stages_in_order(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    pieces = lambda rows: collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in rows)
    assert pieces(got.collect()) == pieces(stages["packing"][1])


def test_stages_take_awkward_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "null id " * 30), (3, "one two three four five six seven. " * 3), (3, "one two three four five six seven. " * 3), (4, "x" * 100_000)]
    for rows_now in (rows, []):
        docs = make_docs(rows_now).select(*COLUMNS, "kept").selectExpr("*", "1 as _gone", "2 as _cut", "'x' as row", "'y' as touched", "3 as id")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.collect()
            if name != "packing":
                assert out.columns == docs.columns

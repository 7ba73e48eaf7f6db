"""The chained stages on the smallest tables, each against what it must do to its input."""

from __future__ import annotations

import pathlib

import pyarrow as pa
import pytest

import bench
import corpus_pipeline
from daybook.llm import decontamination
from daybook.llm.decontamination import leaks
from daybook.llm.line_dedup import line_dedup
from daybook.llm.minhash_dedup import near_duplicates
from daybook.llm.rows import stored

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="test tables are not here")
def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, SMALL))
        seen[name] = frame
        if name != "byte_bpe":
            assert frame.columns == docs.columns
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = docs.join(labels.where("quality = 1"), "doc_id").where("size(split(trim(text), '\\\\s+')) > 60")
    assert good.join(seen["quality_rules"], "doc_id", "left_anti").count() <= 0.01 * good.count()
    assert seen["quality_rules"].join(labels.where("quality = 0"), "doc_id").count() == 0
    ids = lambda f: {r.doc_id for r in f.select("doc_id").collect()}
    thinned = {r.doc_id: r.text for r in line_dedup(seen["quality_rules"]).collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in seen["line_dedup"].collect()}
    assert all(thinned[i] == text and n == len(text) for i, (text, n) in after.items())
    groups = near_duplicates(seen["line_dedup"]).where("kept")
    assert ids(seen["minhash_dedup"]) == ids(groups)
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    gone = ids(leaks(seen["minhash_dedup"], bench))
    assert ids(seen["decontamination"]) == ids(seen["minhash_dedup"]) - gone
    last = {r.doc_id: r.text for r in seen["decontamination"].collect()}
    assert {r.doc_id: r.text for r in seen["byte_bpe"].collect()} == last
    assert all(r.n_tokens * 4 == len(r.ids) for r in seen["byte_bpe"].collect())


def test_lines_are_rebuilt_once(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "a\nb\nc\nd", 7), (2, "a\nb\nc", 5), (3, "x\na\nb\nc", 7), (4, None, 0), (5, "", 0)],
        "doc_id long, text string, n_chars long",
    )
    found = corpus_pipeline.lines(spark, docs, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # twice would be two Python workers per task, which stay for the stages after
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(map(tuple, found.collect())) == [(1, "a\nb\nc\nd", 7), (3, "x", 1), (4, None, None), (5, "", 0)]


def test_the_bench_times_corpus_queries():
    assert {"op1_line_dedup", "op10_chat_format", "pipeline"} <= set(bench.selected(""))
    assert set(bench.selected("op3_html_text,pipeline")) == {"op3_html_text", "pipeline"}


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, `row` string, out string, salt int, `odd.name` string"


def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows, one id twice, clashing names."""
    good = "An ordinary text with enough different words to pass the rules, number {} of some. "
    words = " ".join(f"word{i} of" for i in range(60))
    texts = [None, "", " \n ", "one", good.format(1) + words, good.format(1) + words, "x" * 20_000, f"{words} " * 500]
    rows = [(i, text, None, None, None, "k", "r", None, 3, "o") for i, text in enumerate(texts)]
    rows += [rows[4], rows[1], (4, words + " and more", "en", "s", 7, None, None, "o", None, None), (None, words, None, "s", 1, "k", "r", "o", 3, "o")]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="test tables are not here")
def test_odd_rows_and_empty_tables_at_each_stage(spark):
    odd = odd_documents(spark)
    given = {(r.doc_id, r.text) for r in odd.collect()}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, odd, SMALL)
        rows = found.collect()
        assert stage(spark, odd.limit(0), SMALL).count() == 0
        if name == "byte_bpe":
            assert sorted(found.columns) == ["doc_id", "ids", "lang", "n_tokens", "source", "text"]
            assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in rows) == sorted(
                (r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd.collect()
            )
            continue
        assert found.columns == odd.columns
        if name != "line_dedup":
            assert {(r.doc_id, r.text) for r in rows} <= given
        if name == "quality_rules":
            assert all(r.text and len(r.text.split()) >= 50 for r in rows)
        if name in ("line_dedup", "decontamination"):
            assert len(rows) == odd.count()
        if name == "minhash_dedup":
            # of the repeated row both go or both stay; the text under two ids stays once
            assert {r.doc_id for r in rows if r.text and "number 1" in r.text} == {4}
            assert [r for r in rows if r.doc_id is None]


@pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="test tables are not here")
def test_recall_of_benchmark_items(spark):
    """The search finds what the rule finds when it is tried at every place of every document."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = decontamination._items([(r.item_id, r.text) for r in bench.collect()])
    truth = set()
    for doc in docs.collect():
        block = pa.RecordBatch.from_arrays([pa.array([doc.text], pa.string())], ["text"])
        words = decontamination._block_words(block)[0].tolist()
        truth |= {(doc.doc_id, item.item_id) for item in items if decontamination.matched(item, words)}
    found = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    assert truth
    assert len(found & truth) >= 0.9 * len(truth)
    assert found <= truth

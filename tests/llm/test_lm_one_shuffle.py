"""A filter that stays in its partitions is made and probed in one job, whose texts are shuffled once."""

import os

import pytest

from martline.llm import lm_scoring
from martline.session import checkpoint_dir

ROWS = [(i, f"Word{i % 7} common word{i % 3} common\ttail {i}") for i in range(60)] + [(60, None), (61, ""), (None, "no id common"), (1, "Word1 common word1 common\ttail 1")]


def plain(spark, docs):
    return sorted(map(str, lm_scoring.score(docs, filter_bytes=1 << 60).collect()))


def tables_of(spark):
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.mark.parametrize("chunk", [64, 700])
def test_texts_are_shuffled_once_and_nothing_is_stored(spark, tmp_dir, monkeypatch, chunk):
    spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_dir}/docs")
    docs = spark.read.parquet(f"{tmp_dir}/docs")
    monkeypatch.setattr(lm_scoring, "CHUNK", chunk)
    want, before = plain(spark, docs), tables_of(spark)
    out = lm_scoring.score(docs, filter_bytes=0)
    assert sorted(map(str, out.collect())) == want and len(want) == len(ROWS)
    assert tables_of(spark) == before
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Initial Plan")].splitlines()
    assert sum("FileScan" in line for line in plan) == 1
    assert sum("ReusedExchange" in line for line in plan) == 1
    assert sum("Exchange hashpartitioning" in line for line in plan) == 4  # texts (named twice), counts, answers


def test_chunks_without_documents(spark, monkeypatch):
    """A few long texts leave most chunks empty; their statistics still count once."""
    docs = spark.createDataFrame([(1, "alpha beta " * 400), (2, "beta gamma " * 300), (4, "delta")], "doc_id long, text string")
    monkeypatch.setattr(lm_scoring, "CHUNK", 100)
    got = lm_scoring.score(docs, filter_bytes=0).collect()
    assert sorted(map(str, got)) == plain(spark, docs) and len(got) == 3
    told = [not lm_scoring.held_out(r.doc_id) for r in got]
    assert {r.train_tokens for r in got} == {sum(r.n_tokens for r, t in zip(got, told) if t)}
